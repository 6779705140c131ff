import hashlib

import numpy as np
from pyspark.sql import functions as F

from zonemill.llm.centroids import cluster, search, squared

SCHEMA = "vec_id long, embedding array<float>, cluster string, id string"


def plain(rows, k, rounds, dim):
    """The same by full searches over Python numbers."""
    kept = [
        (i, [int(np.floor(1024 * np.float64(np.float32(x)))) for x in v])
        for i, v, *_ in rows
        if v is not None and len(v) == dim and None not in v and np.isfinite(v).all()
    ]
    draw = lambda i: (i is None, hashlib.sha256(f"3:{i}".encode()).hexdigest())
    first = sorted(kept, key=lambda r: (*draw(r[0]), r[0] or 0, r[1]))
    centres = [list(p) for _, p in first[:k]]
    for step in range(rounds + 1):
        near = [min((sum((a - b) ** 2 for a, b in zip(p, c)), j) for j, c in enumerate(centres)) for _, p in kept]
        if step < rounds:
            for j in range(len(centres)):
                held = [p for (_, p), (_, c) in zip(kept, near) if c == j]
                if held:
                    centres[j] = [sum(column) // len(held) for column in zip(*held)]
    total = [sum(d for d, c in near if c == j) for j in range(len(centres))]
    name = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    found = [(i, c, d, total[c], sum(total), name[c]) for (i, _), (d, c) in zip(kept, near)]
    return sorted(found, key=str)


def found(df, **options):
    draw = F.sha2(F.concat(F.lit("3:"), F.col("id").cast("string")).cast("binary"), 256)
    rows, _ = cluster(df, draw, **options)
    assert rows.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted((tuple(r) for r in rows.collect()), key=str)


def test_equals_full_searches(spark):
    random = np.random.default_rng(5)
    middle = random.standard_normal((9, 8))
    rows = [(i, (middle[i % 9] + 0.4 * random.standard_normal(8)).tolist(), "x", "y") for i in range(900)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    for k, rounds in ((6, 4), (23, 7), (1, 2), (2, 0)):
        assert found(df, k=k, rounds=rounds, dim=8) == plain(rows, k, rounds, 8)


def test_defined_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.0, 0.5]), (1, [0.0, 0.5]), (2, [0.0, 0.5]), (2, [0.25, 0.5]), (None, [0.0, -0.5]), (4, None), (5, []),
            (6, [1.0]), (7, [1.0, None]), (8, [nan, 1.0]), (9, [1.0, inf]), (10, [1.0, 2.0, 3.0]), (11, [-0.0005, 0.5])]
    rows = [(i, v, "own", "other") for i, v in rows]
    df = spark.createDataFrame(rows, SCHEMA)
    for k in (1, 2, 3, 4, 20):
        assert found(df, k=k, rounds=3, dim=2) == plain(rows, k, 3, 2)
    assert found(df.limit(0), dim=2) == [] and found(df.filter("vec_id = 4"), dim=2) == []
    big = spark.createDataFrame([(1, [3e38, -3e38], "", ""), (2, [0.0, 0.0], "", "")], SCHEMA)
    assert sorted(r[2] for r in found(big, k=1, rounds=0, dim=2)) == [0, 2 * 2**54]


def test_the_ball_leaves_centroids_out_and_ties_go_to_the_smaller_number():
    random = np.random.default_rng(3)
    centroids = (random.standard_normal((200, 4)) * 1000).astype(np.int64)
    points = centroids[random.integers(0, 200, 3000)] + random.integers(-30, 30, (3000, 4))
    full = np.array([squared(points, c) for c in centroids]).T
    exact = full.argmin(axis=1)
    near, second = exact.copy(), full.argsort(axis=1, kind="stable")[:, 1]
    n1, n2, d1, d2, done = search(points, centroids, near, second)
    assert (n1 == exact).all() and (d1 == full.min(axis=1)).all() and done < 0.2 * full.size
    assert (d2 == np.partition(full, 1, axis=1)[:, 1]).all()
    far = random.integers(0, 200, (2, 3000))
    far[1] = np.where(far[1] == far[0], (far[0] + 1) % 200, far[1])
    assert (search(points, centroids, far[0], far[1])[0] == exact).all()
    same = np.zeros((3, 4), dtype=np.int64)
    assert search(points[:5], same, np.full(5, 2), np.full(5, 1))[0].tolist() == [0] * 5
