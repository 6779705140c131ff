import numpy as np

from zonemill.llm import neighbours
from zonemill.llm.neighbours import grid, nearest, quantise

SCHEMA = "vec_id long, embedding array<float>, score string"


def brute(rows, queries, k):
    ok = [(i, np.array(v, dtype=np.float64)) for i, v, *_ in rows
          if i is not None and v and None not in v and np.isfinite(np.array(v, dtype=float)).all() and any(v)]
    out = {}
    for q, x in ok:
        if q in queries:
            out[q] = sorted((float(np.sqrt(((x - y) ** 2).sum())), i) for i, y in ok if i != q and len(y) == len(x))[:k]
    return out


def test_equals_brute_force_over_many_tiles(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 37)
    monkeypatch.setattr(neighbours, "QUERY_ROWS", 5)
    random = np.random.default_rng(1)
    rows = [(i, random.standard_normal(16).astype(np.float32).tolist(), "x") for i in range(400)]
    rows += [(1000 + i, rows[3][1], "copy") for i in range(15)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    found = {}
    for r in nearest(df, df.filter("vec_id % 20 = 0"), 10).orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
    expected = brute(rows, set(range(0, 2000, 20)), 10)
    assert {q: [i for _, i in f] for q, f in found.items()} == {q: [i for _, i in f] for q, f in expected.items()}
    assert all(np.allclose([s for s, _ in found[q]], [s for s, _ in expected[q]], atol=1e-12) for q in found)


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], ""), (1, [1.0, 1.0], ""), (2, None, ""), (3, [0.0, 0.0], ""), (4, [nan, 1.0], ""),
            (5, [inf, 1.0], ""), (6, [1.0, None], ""), (7, [1.0, 0.0, 0.0], ""), (None, [1.0, 2.0], ""), (8, [], ""),
            (0, [1.0, 0.0], "again"), (9, [3.0, 0.0], "")]
    df = spark.createDataFrame(rows, SCHEMA)
    found = [(r["query_id"], r["rank"], r["vec_id"]) for r in nearest(df, df, 2).collect()]
    assert sorted(found) == [(0, 1, 1), (0, 2, 9), (1, 1, 0), (1, 2, 0), (9, 1, 0), (9, 2, 0)]
    twice = spark.createDataFrame([(0, None, ""), (0, [1.0, 0.0], ""), (0, [9.0, 0.0], ""), (1, [2.0, 0.0], "")], SCHEMA)
    assert [(r["query_id"], r["vec_id"], r["score"]) for r in nearest(twice, twice.filter("vec_id = 0"), 5).collect()] == [(0, 1, 1.0)]
    assert nearest(df.limit(0), df, 2).count() == 0 and nearest(df, df.limit(0), 2).count() == 0


def test_error_bounds_hold():
    vectors = np.random.default_rng(2).standard_normal((50, 8))
    codes, scales, errors = quantise(vectors)
    assert codes.dtype == np.int8
    assert np.allclose(np.linalg.norm(vectors - codes * scales[:, None], axis=1), errors)


def test_copies_of_the_queries_are_never_broadcast(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 64)
    monkeypatch.setattr(neighbours, "QUERY_ROWS", 8)
    random = np.random.default_rng(3)
    rows = [(i, random.standard_normal(16).astype(np.float32).tolist(), "x") for i in range(900)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "vectors"))
    df = spark.read.parquet(str(tmp_path / "vectors"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        found = nearest(df, df.filter("vec_id % 10 = 0"), 3)
        got = {(r["query_id"], r["rank"]): r["vec_id"] for r in found.collect()}
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert "Broadcast" not in plan and "SortMergeJoin" in plan
    expected = brute(rows, set(range(0, 900, 10)), 3)
    assert got == {(q, n): i for q, f in expected.items() for n, (_, i) in enumerate(f, 1)}


def test_double_precision_is_kept(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0 + 1e-12, 0.0]), (2, [1.0 + 1e-13, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = [(r["query_id"], r["vec_id"]) for r in nearest(df, df.filter("vec_id = 0"), 2).orderBy("rank").collect()]
    assert found == [(0, 2), (0, 1)]


def test_the_grid_bounds_the_copies():
    for rows, asked, cells, cores in [(0, 0, 200, 4), (1, 1, 1, 1), (600_000, 6_000, 600, 6), (15_000_000, 150_000, 600, 6), (10**6, 10**6, 600, 6)]:
        blocks = -(-rows // neighbours.BLOCK_ROWS)
        parts, groups = grid(rows, asked, blocks, cells, cores)
        assert 1 <= parts <= max(1, blocks) and 1 <= groups and parts * groups <= cells
        if asked * 10 <= rows:
            assert parts * asked <= 2 * max(rows, 1) and groups == 1
    assert grid(10**6, 10**6, 245, 600, 50)[0] * grid(10**6, 10**6, 245, 600, 50)[1] > 100
