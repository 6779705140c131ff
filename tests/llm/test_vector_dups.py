import numpy as np

from zonemill.llm import vector_dups
from zonemill.llm.components import connected_components
from zonemill.llm.vector_dups import near_duplicates

SCHEMA = "vec_id long, embedding array<float>, codes string"


def brute(vectors, threshold):
    ids = sorted(vectors)
    x = np.array([vectors[i] for i in ids], dtype=np.float64)
    x /= np.linalg.norm(x, axis=1)[:, None]
    linked = x @ x.T >= threshold
    np.fill_diagonal(linked, False)
    label = np.array(ids)
    while True:
        new = np.array([min(label[i], label[linked[i]].min()) if linked[i].any() else label[i] for i in range(len(ids))])
        if (new == label).all():
            return {i: (int(n), int(c)) for i, n, c in zip(ids, linked.sum(1), label, strict=True)}
        label = new


def test_equals_brute_force_with_a_dense_group_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(vector_dups, "BLOCK", 40)
    random = np.random.default_rng(3)
    base = random.standard_normal((40, 12))
    near = np.repeat(base[:1], 150, axis=0) + 0.12 * random.standard_normal((150, 12))
    some = base[1:20] + 0.1 * random.standard_normal((19, 12))
    vectors = np.vstack([base, near, some, base[5:8]]).astype(np.float32)
    rows = {i: v.tolist() for i, v in enumerate(vectors)}
    df = spark.createDataFrame([(i, v, "x") for i, v in rows.items()], SCHEMA).repartition(3)
    found = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in near_duplicates(df, 0.9).collect()}
    assert found == brute(rows, 0.9)
    assert max(n for n, _ in found.values()) > 100


def test_equals_brute_force_over_many_tables_of_small_buckets(spark, monkeypatch):
    monkeypatch.setattr(vector_dups, "BUCKET", 4)
    monkeypatch.setattr(vector_dups, "BLOCK", 16)
    random = np.random.default_rng(7)
    base = random.standard_normal((300, 24))
    near = base[random.integers(0, 60, 700)] + 0.32 * random.standard_normal((700, 24))
    rows = {i: v.tolist() for i, v in enumerate(np.vstack([base, near]))}
    assert vector_dups.tables_for(len(rows), 0.9)[1] > 20
    df = spark.createDataFrame(list(rows.items()), "vec_id long, embedding array<double>").repartition(3)
    found = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in near_duplicates(df, 0.9).collect()}
    assert found == brute(rows, 0.9)
    assert sum(n for n, _ in found.values()) > 1000


def test_codes_do_not_depend_on_the_rows_beside():
    vectors = np.random.default_rng(1).standard_normal((500, 64)).astype(np.float32).astype(np.float64)
    planes, numbers = vector_dups.directions(64, 9, 30), vector_dups.whole(vectors)
    together = vector_dups.sign_codes(numbers, planes, 9)
    apart = np.array([[vector_dups.sign_codes(numbers[i : i + 1], planes[:, t * 9 : t * 9 + 9], 9)[0, 0] for t in range(30)] for i in range(500)])
    assert (together == apart).all()


def test_vectors_that_link_with_nothing(spark):
    rows = [(1, None, ""), (2, [0.0, 0.0], ""), (3, [float("nan"), 1.0], ""), (4, [1.0, None], ""), (5, [1.0, 0.0], ""),
            (6, [1.0, 0.0], ""), (6, [1.0, 0.0], "again"), (7, [1.0, 0.0, 0.0], ""), (None, [1.0, 0.0], ""), (8, [2.0, 0.1], "")]
    found = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"])
             for r in near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert found == {1: (0, 1, True), 2: (0, 2, True), 3: (0, 3, True), 4: (0, 4, True), 5: (2, 5, True), 6: (2, 5, False),
                     7: (0, 7, True), 8: (2, 5, False)}
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7), (3, 2)]
    found = {r["id"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 150)}}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_an_id_with_two_vectors_is_two_vectors(spark):
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.01]), (2, [0.0, 1.0]), (3, [0.0, 1.0]), (3, [1.0, 0.02]), (3, [1.0, 0.02])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in near_duplicates(df, 0.9).collect())
    assert got == [(1, 2, 1, True), (1, 2, 1, True), (2, 1, 2, True), (3, 1, 2, False), (3, 2, 1, False)]
