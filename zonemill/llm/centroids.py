"""Centroid clustering of whole-number vectors by shallot search.

Every vector keeps its centroid, the centroid that was second nearest when it was last
searched, an upper bound of the distance to the first and a lower bound of the distance to
every other. Centroid moves loosen the bounds; a vector is searched again only where they no
longer tell its centroid apart. A search measures the two remembered centroids, starts from
the closer one and goes through the others in the order of their distance from it. Only those
within a ball can be among the two nearest: its radius is the distance to the start plus that
to the second nearest found so far, so it shrinks while the search goes on. Whatever lies in
the ball is compared by exact squared distances of integers; bounds are floating point,
widened by more than their rounding.

Vectors and their state are one written table. A pass reads it, and the tasks that write the
next one add one row with the sums of each of their clusters, in columns of their own, so that
new centroids cost no second pass over the vectors. Only centroids (``k`` vectors) reach the
driver and the tasks; a written pass is removed once the next one is there.

Defined cases: only vectors of exactly ``dim`` components, none NULL or non-finite, take part.
Whole components are held within ±2**27, where distances still fit in a long; larger ones are
taken as that. Repeated rows are vectors of their own, also as first centroids; rows with a
NULL id cluster like any and come last as first centroids. With fewer vectors than ``k``
there are as many centroids as vectors, and an empty table gives an empty result. Centroids
without vectors stay where they are. Other columns of the input are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonemill.llm.common import table_at, written_at
from zonemill.session import work_dir
from zonemill.sources import files

SCALE = 1024
LIMIT = 2**27
# Relative widening of bounds, far above the rounding of double precision.
SLACK = 1e-12
POINTS = "id long, point binary"
STATE = (
    "id long, point binary, near int, second int, upper double, lower double, distance long, "
    "cluster int, members long, total long, sums array<long>"
)


def whole_vectors(vectors: DataFrame, id_col: str, vector_col: str, dim: int) -> DataFrame:
    """(id, point): usable vectors as whole numbers, packed as 32-bit integers."""
    v = F.col(vector_col)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    chosen = vectors.filter((F.size(v) == dim) & finite).select(F.col(id_col).cast("long").alias("id"), v.alias("v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
            with np.errstate(over="ignore"):
                points = np.clip(np.floor(SCALE * x), -LIMIT, LIMIT).astype("<i4")
            yield pa.RecordBatch.from_arrays([batch.column(0), _packed(points)], names=["id", "point"])

    return chosen.mapInArrow(run, POINTS)


def _packed(points: np.ndarray) -> pa.Array:
    width = points.shape[1] * 4
    offsets = np.arange(len(points) + 1, dtype=np.int32) * width
    buffers = [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(points.tobytes())]
    return pa.Array.from_buffers(pa.binary(), len(points), buffers)


def _unpacked(column: pa.Array, dim: int) -> np.ndarray:
    data = b"".join(column.to_pylist())
    return np.frombuffer(data, dtype="<i4").reshape(-1, dim).astype(np.int64)


def first_centroids(points: DataFrame, k: int, draw: Column, dim: int) -> np.ndarray:
    """The ``k`` vectors that come first by ``draw``, an expression of ``id``."""
    order = [draw.asc_nulls_last(), F.col("id"), F.col("point")]
    rows = points.orderBy(*order).limit(k).select("point").collect()
    return np.array([np.frombuffer(r["point"], dtype="<i4") for r in rows], dtype=np.int64).reshape(-1, dim)


def squared(points: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    return ((points - centroid) ** 2).sum(axis=-1)


def search(
    points: np.ndarray, centroids: np.ndarray, near: np.ndarray, second: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """The two nearest centroids of each vector and their squared distances, from two remembered ones.

    Ties go to the smaller number. The last value is the number of distances computed. With a single
    centroid the second one is the same, at the greatest distance.
    """
    k, far = len(centroids), np.iinfo(np.int64).max
    d1 = squared(points, centroids[near])
    if k == 1:
        return near, near, d1, np.full(len(points), far), len(points)
    d2 = squared(points, centroids[second])
    swap = (d2 < d1) | ((d2 == d1) & (second < near))
    n1, n2 = np.where(swap, second, near), np.where(swap, near, second)
    d1, d2 = np.where(swap, d2, d1), np.where(swap, d1, d2)
    start, ball, done = n1.copy(), np.sqrt(d1), 2 * len(points)
    apart = np.sqrt(squared(centroids[:, None, :], centroids[None, :, :]).astype(np.float64))
    for c in np.unique(start):
        rows = np.nonzero(start == c)[0]
        for other in np.argsort(apart[c], kind="stable"):
            # Later centroids are farther from the start, so a vector out of reach stays so.
            rows = rows[apart[c, other] * (1 - SLACK) <= (ball[rows] + np.sqrt(d2[rows])) * (1 + SLACK)]
            if not len(rows):
                break
            if other == c:
                continue
            some = rows[(n1[rows] != other) & (n2[rows] != other)]
            d = squared(points[some], centroids[other])
            done += len(some)
            first = (d < d1[some]) | ((d == d1[some]) & (other < n1[some]))
            later = ~first & ((d < d2[some]) | ((d == d2[some]) & (other < n2[some])))
            at = some[first]
            n2[at], d2[at], n1[at], d1[at] = n1[at], d1[at], other, d[first]
            at = some[later]
            n2[at], d2[at] = other, d[later]
    return n1, n2, d1, d2, done


def _pass(centroids: np.ndarray, moved: np.ndarray | None, measure: bool):
    """One assignment of all vectors; ``moved`` are the distances the centroids went since the last one."""
    k, dim = centroids.shape
    half = np.full(k, np.inf)
    if k > 1:
        apart = np.sqrt(squared(centroids[:, None, :], centroids[None, :, :]).astype(np.float64))
        np.fill_diagonal(apart, np.inf)
        half = apart.min(axis=1) * (0.5 * (1 - SLACK))
    if moved is not None:
        # How far any centroid other than the own one went.
        most = np.array([max([m for j, m in enumerate(moved) if j != i], default=0.0) for i in range(k)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, members, total = np.zeros((k, dim), dtype=np.int64), np.zeros(k, dtype=np.int64), [0] * k
        for batch in batches:
            points, n = _unpacked(batch.column(1), dim), batch.num_rows
            if moved is None:
                near, second = np.zeros(n, dtype=np.int64), np.full(n, min(1, k - 1), dtype=np.int64)
                upper, lower = np.full(n, np.inf), np.zeros(n)
            else:
                near, second, upper, lower = (c.to_numpy().copy() for c in batch.columns[2:6])
                near, second = near.astype(np.int64), second.astype(np.int64)
                upper = upper * (1 + SLACK) + moved[near] * (1 + SLACK)
                lower = np.maximum(lower * (1 - SLACK) - most[near] * (1 + SLACK), 0.0)
            known = np.maximum(lower, half[near])
            distance = np.zeros(n, dtype=np.int64)
            open_ = np.nonzero(upper >= known)[0]
            if len(open_):
                exact = squared(points[open_], centroids[near[open_]])
                upper[open_] = np.sqrt(exact) * (1 + SLACK)
                open_ = open_[upper[open_] >= known[open_]]
            if len(open_):
                n1, n2, d1, d2, _ = search(points[open_], centroids, near[open_], second[open_])
                near[open_], second[open_] = n1, n2
                upper[open_], lower[open_] = np.sqrt(d1) * (1 + SLACK), np.sqrt(d2) * (1 - SLACK)
            if measure:
                distance = squared(points, centroids[near])
            order = np.argsort(near, kind="stable")
            found, at = np.unique(near[order], return_index=True)
            sums[found] += np.add.reduceat(points[order], at, axis=0)
            members += np.bincount(near, minlength=k)
            for cluster, part in zip(found.tolist(), np.split(distance[order], at[1:]), strict=True):
                total[cluster] += sum(part.tolist())
            yield _state(batch.columns[0], batch.columns[1], near, second, upper, lower, distance)
        yield _sums(sums, members, total)

    return run


KINDS = [
    ("id", pa.int64()), ("point", pa.binary()), ("near", pa.int32()), ("second", pa.int32()),
    ("upper", pa.float64()), ("lower", pa.float64()), ("distance", pa.int64()),
    ("cluster", pa.int32()), ("members", pa.int64()), ("total", pa.int64()), ("sums", pa.list_(pa.int64())),
]


def _batch(columns: list, n: int) -> pa.RecordBatch:
    arrays = [
        pa.nulls(n, kind) if c is None else c if isinstance(c, pa.Array) else pa.array(c, kind)
        for c, (_, kind) in zip(columns, KINDS, strict=True)
    ]
    return pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in KINDS])


def _state(ids: pa.Array, points: pa.Array, *state: np.ndarray) -> pa.RecordBatch:
    near, second, *rest = state
    return _batch([ids, points, near.astype(np.int32), second.astype(np.int32), *rest, *[None] * 4], len(ids))


def _sums(sums: np.ndarray, members: np.ndarray, total: list[int]) -> pa.RecordBatch:
    held = np.nonzero(members)[0]
    given = [held.astype(np.int32), members[held], [total[i] for i in held], [sums[i].tolist() for i in held]]
    return _batch([*[None] * 7, *given], len(held))


def _summed(state: DataFrame) -> dict[int, tuple[int, int, list[int]]]:
    """Members, summed distances and summed components of each cluster that holds a vector."""
    parts = state.filter(F.col("cluster").isNotNull())
    values = parts.select("cluster", F.posexplode(F.concat(F.array("members", "total"), "sums")).alias("at", "value"))
    found: dict[int, list[int]] = {}
    # One row per centroid and component at most.
    for r in values.groupBy("cluster", "at").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).orderBy("at").collect():
        found.setdefault(r["cluster"], []).append(int(r["value"]))
    return {c: (members, total, sums) for c, (members, total, *sums) in found.items()}


def cluster(
    vectors: DataFrame,
    draw: Column,
    k: int = 8,
    rounds: int = 10,
    dim: int = 64,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> tuple[DataFrame, np.ndarray]:
    """Clusters after ``rounds`` of assignment and update and a last assignment, and the final centroids.

    ``draw`` is an expression of the column ``id``; the first ``k`` vectors by it are the first
    centroids. The rows are (vec_id, cluster, distance, cluster_inertia, inertia,
    centroid_sha256), distances squared.
    """
    spark = vectors.sparkSession
    root = work_dir(spark, "centroids")
    points = written_at(whole_vectors(vectors, id_col, vector_col, dim), f"{root}/points")
    centroids = first_centroids(points, k, draw, dim)
    result = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if not len(centroids):
        return spark.createDataFrame([], result), centroids
    state, moved, held = points, None, {}
    for number in range(rounds + 1):
        path = f"{root}/pass-{number}"
        done = state.mapInArrow(_pass(centroids, moved, measure=number == rounds), STATE)
        done.write.parquet(path)
        state, before = table_at(spark, path, STATE), f"{root}/pass-{number - 1}" if number else None
        if before:
            files.delete(spark, before)
        held = _summed(state)
        state = state.filter(F.col("point").isNotNull())
        if number < rounds:
            after = centroids.copy()
            for c, (members, _, sums) in held.items():
                after[c] = [s // members for s in sums]
            moved = np.sqrt(squared(after, centroids).astype(np.float64)) * (1 + SLACK)
            centroids = after
    inertia = sum(total for _, total, _ in held.values())
    facts = [(c, total, inertia, digest(centroids[c])) for c, (_, total, _) in held.items()]
    told = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    rows = state.select(F.col("id").alias("vec_id"), F.col("near").alias("cluster"), "distance")
    return rows.join(F.broadcast(told), "cluster").select(*[part.split()[0] for part in result.split(", ")]), centroids


def digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(str(int(x)) for x in centroid).encode()).hexdigest()
