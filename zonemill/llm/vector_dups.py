"""Near-duplicate vectors: random-hyperplane signs in several tables, exact cosine, components.

Equal vectors are one class first. A class gets a sign code per table; classes that share
a bucket in some table are compared in double precision, each pair in the first table they
share. Buckets of more than ``BLOCK`` classes are cut into blocks, and a task compares one
block with one other, so a bucket that holds a third of all rows becomes many tasks. A task
hands on one row per class: its number of links there and one link that keeps it connected.

What is dealt to a table is the class and its vector in the bytes it is stored in, shuffled
once. Codes are not carried along: whether two linked classes share an earlier table is asked
of their vectors again. Signs are those of sums of whole numbers, which come out the same in
every task.

The number of bits grows with the logarithm of the number of classes, so that buckets keep
their size, and the number of tables follows from the bits: a pair at the threshold is
missed with probability ``MISS`` at most, a closer one far less often. Tables, and with them
the bytes shuffled for a vector, grow slowly with the number of classes: 12 for 10^4, 39 for
10^6, 124 for 10^8 classes at a cosine of 0.9.

Defined cases: vectors that are NULL, zero, or hold NULL or non-finite components link with
nothing and stay. Vectors of different lengths never link. Repeated vectors under different
ids link with each other (cosine 1). Rows that repeat an id as well are one vector; an id with
several vectors has a row for each, as they are different vectors. Rows with a NULL id are left
out. Other columns are ignored, and an empty table is an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from zonemill.llm.common import written
from zonemill.llm.components import connected_components, merged
from zonemill.llm.neighbours import usable

# A row costs as much to shuffle as about a thousand comparisons, hence the size of a bucket.
BUCKET = 1024
BLOCK = 4096
ROWS = 256
MISS = 1e-4
SEED = 20260101
TILE = ["dim", "table", "code", "tile"]


def tables_for(classes: int, threshold: float) -> tuple[int, int]:
    """Bits of a code and number of tables, from the number of classes."""
    bits = max(4, min(24, round(math.log2(max(classes, 1) / BUCKET + 1))))
    agree = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(MISS) / math.log(1 - agree)))


@lru_cache(maxsize=8)
def directions(dim: int, bits: int, tables: int) -> np.ndarray:
    """Random directions in whole numbers, those of a table side by side."""
    random = np.random.default_rng([SEED, dim])
    return np.rint(random.standard_normal((dim, bits * tables)) * 1024)


def whole(vectors: np.ndarray) -> np.ndarray:
    """Vectors scaled to whole numbers, whose products with the directions are exact in any order of adding."""
    return np.rint(vectors / np.abs(vectors).max(axis=1)[:, None] * 32767)


def sign_codes(numbers: np.ndarray, planes: np.ndarray, bits: int) -> np.ndarray:
    """A code per row and table: on which side of the table's planes a row lies."""
    signs = (numbers @ planes > 0).reshape(len(numbers), -1, bits)
    return signs @ (1 << np.arange(bits, dtype=np.int32))


def _coded(bits: int, tables: int, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            starts = batch.column(2).offsets.to_numpy()
            values = batch.column(2).values.to_numpy(zero_copy_only=False).astype(kind)
            lengths = np.diff(starts)
            for dim in np.unique(lengths).tolist():
                of_length = np.nonzero(lengths == dim)[0]
                for places in np.array_split(of_length, -(-len(of_length) // ROWS)):
                    vectors = values[starts[places][:, None] + np.arange(dim)]
                    codes = sign_codes(whole(vectors.astype(np.float64)), directions(dim, bits, tables), bits)
                    ends = np.arange(len(places) + 1, dtype=np.int32) * tables
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).take(pa.array(places)),
                            batch.column(1).take(pa.array(places)),
                            pa.array(np.full(len(places), dim, dtype=np.int32)),
                            pa.array([v.tobytes() for v in vectors], pa.binary()),
                            pa.ListArray.from_arrays(ends, codes.astype(np.int32).ravel()),
                        ],
                        names=["class", "copies", "dim", "vector", "codes"],
                    )

    return run


def _compare(threshold: float, bits: int, tables: int, kind: str):
    """Compare the two blocks of a tile; blocks of one bucket, or one block with itself."""

    def run(tile: pa.Table) -> pa.Table:
        tile = tile.sort_by("class")
        ids, copies, block = (tile.column(c).to_numpy() for c in ("class", "copies", "block"))
        dim, at, pair = (tile.column(c)[0].as_py() for c in ("dim", "table", "tile"))
        vectors = np.frombuffer(b"".join(tile.column("vector").to_pylist()), kind).reshape(len(ids), dim).astype(np.float64)
        planes, numbers = directions(dim, bits, tables), whole(vectors)

        @cache
        def codes(table: int) -> np.ndarray:
            return sign_codes(numbers, planes[:, table * bits : (table + 1) * bits], bits)[:, 0]

        units = vectors / np.linalg.norm(vectors, axis=1)[:, None]
        one, two = pair // 2**20, pair % 2**20
        left, right = np.nonzero(block == one)[0], np.nonzero(block == two)[0]
        links = np.zeros(len(ids), dtype=np.int64)
        root = np.arange(len(ids))
        for start in range(0, len(left), ROWS):
            rows = left[start : start + ROWS]
            x, y = np.nonzero(units[rows] @ units[right].T >= threshold)
            x, y = rows[x], right[y]
            if one == two:
                x, y = x[x < y], y[x < y]
            for earlier in range(at):
                if not len(x):
                    break
                fresh = codes(earlier)[x] != codes(earlier)[y]
                x, y = x[fresh], y[fresh]
            links += np.bincount(x, copies[y], len(ids)).astype(np.int64)
            links += np.bincount(y, copies[x], len(ids)).astype(np.int64)
            root = merged(root, x, y)
        linked = np.nonzero(links)[0]
        return pa.table({"a": ids[linked], "b": ids[root[linked]], "links": links[linked]})

    return run


def near_duplicates(
    df: DataFrame, threshold: float = 0.9, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """One row per id: vec_id, n_links, component_id, kept."""
    single = isinstance(df.schema[vector_col].dataType.elementType, FloatType)
    kind, vector = ("<f4", F.col(vector_col)) if single else ("<f8", F.col(vector_col).cast("array<double>"))
    given = df.select(F.col(id_col).cast("long").alias("vec_id"), vector.alias("embedding")).filter(F.col("vec_id").isNotNull())
    good = given.filter(usable(F.col("embedding"))).dropDuplicates(["vec_id", "embedding"])
    # A whole vector is one key: equal ones meet in a pre-aggregated count. Classes are numbered as
    # they are written, so an id with several vectors names no class.
    classes = good.groupBy("embedding").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"))
    classes = written(classes.withColumn("class", F.monotonically_increasing_id()), "classes")
    bits, tables = tables_for(classes.count(), threshold)
    coded = classes.select("class", "copies", "embedding").mapInArrow(
        _coded(bits, tables, kind), "class long, copies long, dim int, vector binary, codes array<int>"
    )
    coded = written(coded, "codes")
    bucket = ["dim", "table", "code"]
    sizes = coded.select("dim", F.posexplode("codes").alias("table", "code")).groupBy(*bucket).agg(F.count(F.lit(1)).alias("size"))
    # Written, so that Spark knows how large it is when it chooses the join.
    large = written(sizes.filter(F.col("size") > BLOCK).withColumn("blocks", F.ceil(F.col("size") / BLOCK)).drop("size"), "large")
    places = coded.select("class", "copies", "dim", "vector", F.posexplode("codes").alias("table", "code"))
    blocks = F.coalesce("blocks", F.lit(1).cast("long"))
    tiles = (
        places.join(large, bucket, "left")
        .withColumn("block", F.pmod(F.xxhash64("class"), blocks).cast("long"))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
        .withColumn("tile", F.least("block", "other") * 2**20 + F.greatest("block", "other"))
        .select(*TILE, "class", "copies", "block", "vector")
    )
    found = written(
        tiles.groupBy(*TILE).applyInArrow(_compare(threshold, bits, tables, kind), "a long, b long, links long"), "links"
    )
    linked = found.groupBy(F.col("a").alias("class")).agg(F.sum("links").alias("others"))
    components = connected_components(found.select("a", "b")).withColumnRenamed("id", "class")
    of_class = classes.join(linked, "class", "left").join(components, "class", "left")
    of_class = of_class.withColumn("component", F.coalesce("component", "class"))
    least = of_class.groupBy("component").agg(F.min("least").alias("component_id"))
    of_class = of_class.select("embedding", "copies", "others", "component").join(least, "component")
    named = good.join(of_class, "embedding").select(
        "vec_id", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), "component_id"
    )
    rest = given.select("vec_id").distinct().join(named.select("vec_id").distinct(), "vec_id", "left_anti")
    rest = rest.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return named.unionByName(rest).withColumn("kept", F.col("vec_id") == F.col("component_id"))
