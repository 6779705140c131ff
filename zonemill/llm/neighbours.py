"""Approximate-free nearest neighbours by a block matrix join with int8 products.

Vectors and queries are packed into blocks. Every query block meets every vector block
once, as one row of a shuffled equi-join on the cells of a grid: parts of the vector blocks by
groups of the query blocks. In such a tile the product of int8
codes gives each distance with an error bound; the pairs whose lower bound does not exceed
the k-th smallest upper bound are computed again in double precision. A tile hands on k
rows a query, and the tiles of a query are merged by a running heap.

Defined cases: vectors that are NULL, zero, or hold NULL or non-finite components take no
part, neither as query nor as candidate. Vectors of different lengths are never compared.
A query is not its own candidate: rows that carry its id are left out. Ties go to the
smaller id; repeated rows of another id are one candidate each. An empty table gives an
empty result. Columns other than the two named are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

BLOCK_ROWS, QUERY_ROWS = 4096, 512
BLOCK = "dim int, ids binary, codes binary, scales binary, errors binary, vectors binary"
TILE = "query_id long, vec_id long, score double"
SINGLE = ArrayType(FloatType())


def usable(vector: Column) -> Column:
    """Whether a vector has a direction: finite components without NULL, not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def quantise(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, the scale of each row, and the exact length of each row's rounding error."""
    scales = np.abs(vectors).max(axis=1) / 127.0
    codes = np.rint(vectors / scales[:, None])
    errors = np.linalg.norm(vectors - codes * scales[:, None], axis=1)
    return codes.astype(np.int8), scales, errors


def grid(rows: int, asked: int, blocks: int, cells: int, cores: int) -> tuple[int, int]:
    """Parts of the vectors and groups of the queries: every query goes to each part, every vector to each group.

    Of ``cells`` at most, as many as the cores can use or as copy the queries no more than
    twice the vectors; sides in the ratio that copies least. No part is without a block.
    """
    share = max(1, rows) / max(1, asked)
    cells = max(1, min(cells, max(int(2 * share), 4 * cores)))
    parts = max(1, min(cells, blocks, math.isqrt(int(cells * share))))
    return parts, max(1, min(cells // parts, -(-asked // QUERY_ROWS)))


def _pack(rows: int, kind: type):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list[tuple[int, np.ndarray]]] = {}

        def block(dim: int) -> pa.RecordBatch:
            items = waiting.pop(dim)
            vectors = np.stack([v for _, v in items])
            codes, scales, errors = quantise(vectors)
            ids = np.array([i for i, _ in items], dtype=np.int64)
            parts = [ids, codes, scales, errors, vectors.astype(kind)]
            return pa.RecordBatch.from_arrays(
                [pa.array([dim], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in parts)],
                names=["dim", "ids", "codes", "scales", "errors", "vectors"],
            )

        for batch in batches:
            for key, vector in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                waiting.setdefault(len(vector), []).append((key, np.array(vector, dtype=np.float64)))
                if len(waiting[len(vector)]) >= rows:
                    yield block(len(vector))
        for dim in list(waiting):
            yield block(dim)

    return run


def _unpacked(row: dict, prefix: str) -> tuple[np.ndarray, ...]:
    ids = np.frombuffer(row[f"{prefix}ids"], np.int64)
    shape = (len(ids), row["dim"])
    codes = np.frombuffer(row[f"{prefix}codes"], np.int8).reshape(shape)
    raw = row[f"{prefix}vectors"]
    vectors = np.frombuffer(raw, np.float32 if len(raw) == 4 * codes.size else np.float64).reshape(shape).astype(np.float64)
    return ids, codes, np.frombuffer(row[f"{prefix}scales"]), np.frombuffer(row[f"{prefix}errors"]), vectors


def nearest_in_tile(query: tuple, block: tuple, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k nearest rows of a block for each query: query ids, row ids, distances."""
    q_ids, q_codes, q_scales, q_errors, q_vectors = query
    ids, codes, scales, errors, vectors = block
    # Products of int8 codes are whole numbers; float32 holds them exactly up to 2**24.
    exact = np.float32 if q_codes.shape[1] * 127 * 127 < 2**24 else np.float64
    product = (q_codes.astype(exact) @ codes.astype(exact).T).astype(np.float64)
    q_square = (q_codes.astype(np.float64) ** 2).sum(1) * q_scales**2
    square = (codes.astype(np.float64) ** 2).sum(1) * scales**2
    near = q_square[:, None] + square[None, :] - 2 * product * q_scales[:, None] * scales[None, :]
    near = np.sqrt(np.maximum(near, 0.0))
    bound = q_errors[:, None] + errors[None, :] + 1e-7 * (1 + near)
    upper = near + bound
    upper[q_ids[:, None] == ids[None, :]] = np.inf
    kth = np.partition(upper, min(k, upper.shape[1]) - 1, axis=1)[:, min(k, upper.shape[1]) - 1]
    which, row = np.nonzero((near - bound <= kth[:, None]) & (q_ids[:, None] != ids[None, :]))
    distance = np.sqrt(((q_vectors[which] - vectors[row]) ** 2).sum(1))
    order = np.lexsort((ids[row], distance, which))
    which, row, distance = which[order], row[order], distance[order]
    first = np.searchsorted(which, which, side="left")
    keep = np.arange(len(which)) - first < k
    return q_ids[which[keep]], ids[row[keep]], distance[keep]


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A task merges its tiles of a query by a heap before anything is shuffled.
        best: dict[int, list[tuple[float, int]]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                for query, key, distance in zip(
                    *(x.tolist() for x in nearest_in_tile(_unpacked(row, "q_"), _unpacked(row, ""), k)), strict=True
                ):
                    heap = best.setdefault(query, [])
                    if len(heap) < k:
                        heapq.heappush(heap, (-distance, -key))
                    else:
                        heapq.heappushpop(heap, (-distance, -key))
                if len(best) * k >= 200_000:
                    yield _rows(best)
                    best.clear()
        yield _rows(best)

    return run


def _rows(best: dict[int, list[tuple[float, int]]]) -> pa.RecordBatch:
    found = [(query, -key, -distance) for query, heap in best.items() for distance, key in heap]
    columns = list(zip(*found, strict=True)) or [(), (), ()]
    kinds = (pa.int64(), pa.int64(), pa.float64())
    return pa.RecordBatch.from_arrays(
        [pa.array(x, t) for x, t in zip(columns, kinds, strict=True)], names=["query_id", "vec_id", "score"]
    )


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """The ``k`` nearest ``vectors`` of each query by Euclidean distance: query_id, rank, vec_id, score."""

    def packed(df: DataFrame, rows: int) -> DataFrame:
        chosen = df.select(F.col(id_col).cast("long"), F.col(vector_col)).filter(
            F.col(id_col).isNotNull() & usable(F.col(vector_col))
        )
        return chosen.mapInArrow(_pack(rows, kind), BLOCK)

    # Single-precision vectors travel as they are; distances are taken in double precision.
    kind = np.float32 if vectors.schema[vector_col].dataType == queries.schema[vector_col].dataType == SINGLE else np.float64

    # An id with several vectors asks with the least of those that take part.
    asked = queries.filter(usable(F.col(vector_col))).groupBy(id_col).agg(F.min(vector_col).alias(vector_col))
    asked = packed(asked, QUERY_ROWS)
    asked = asked.select("dim", *[F.col(n).alias(f"q_{n}") for n in ("ids", "codes", "scales", "errors", "vectors")])
    # A stated query set against all rows, block by block: blocks are dealt to parts, query
    # blocks to groups, and every part meets every group in a cell of its own. Spark's size
    # estimates do not see the copies, so the join is told to shuffle, not to broadcast.
    spark = vectors.sparkSession
    rows = vectors.count()
    cells = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts, groups = grid(rows, queries.count(), -(-rows // BLOCK_ROWS), cells, spark.sparkContext.defaultParallelism)

    def dealt(ids: str, number: int) -> Column:
        return F.pmod(F.xxhash64(ids), F.lit(number)).cast("int")

    def each(number: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(number - 1)))

    blocks = packed(vectors, BLOCK_ROWS).withColumn("_part", dealt("ids", parts)).withColumn("_group", each(groups))
    asked = asked.withColumn("_group", dealt("q_ids", groups)).withColumn("_part", each(parts))
    tiles = blocks.join(asked.hint("merge"), ["dim", "_part", "_group"]).drop("_part", "_group")
    found = tiles.mapInArrow(_search(k), TILE)
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
