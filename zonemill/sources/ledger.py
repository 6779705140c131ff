"""What publishes record beside a table: its columns, its files by partition, and digests of its keys.

The record is part of the small file that appears together with the data. It spares a look at
every file: the recorded columns are the read schema, and footers are read only of partitions
whose files are not the recorded ones, as when another writer added some.

Digests tell in which partitions a set of keys may be. For every partition they hold bit sets
of hashed keys, cut into buckets, with the least and the greatest key of each bucket. A
partition without any of the keys may look as if it had one; then its keys are read in vain.
"""

from __future__ import annotations

import hashlib
import json
import math
from collections.abc import Iterable
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonemill.functions.columns import col
from zonemill.functions.keys import MergeKeys
from zonemill.sources import files

APPLIED_NAME = "_applied"
KEYS_NAME = "_keys"
LEDGER = "_ledger"
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
BITS_PER_KEY = 64


@dataclass
class Held:
    """A table as it lies: one DataFrame over it, and its files by partition directory."""

    rows: DataFrame
    files: dict[str, str]
    partition_by: str | None = None
    # Partition directories whose files are not the recorded ones.
    unknown: set[str] = field(default_factory=set)
    keys: dict = field(default_factory=dict)


def recorded(spark: SparkSession, target: str) -> dict:
    return json.loads(files.read_text(spark, f"{target}/{APPLIED_NAME}") or "{}")


def file_digests(paths: Iterable[str], partition_by: str | None) -> dict[str, str]:
    """Number and hash of the file names in each partition directory; "" is the table itself."""
    names: dict[str, list[str]] = {}
    for path in paths:
        *_, folder, name = path.split("/")
        inside = partition_by is not None and folder.startswith(f"{partition_by}=")
        names.setdefault(unquote(folder) if inside else "", []).append(name)
    return {d: f"{len(n)}-{hashlib.sha256(chr(10).join(sorted(n)).encode()).hexdigest()}" for d, n in names.items()}


def held(spark: SparkSession, target: str) -> Held:
    """The table with the columns that any of its files has."""
    ledger = recorded(spark, target).get(LEDGER)
    merged = spark.read.option("mergeSchema", True)
    if not ledger:
        return Held(merged.parquet(target), {})
    schema, partition_by = T.StructType.fromJson(ledger["schema"]), ledger["partition_by"]
    rows = spark.read.schema(schema).parquet(target)
    now = file_digests(rows.inputFiles(), partition_by)
    unknown = {d for d, digest in now.items() if ledger["files"].get(d) != digest}
    if "" in unknown:
        return Held(merged.parquet(target), {})
    if unknown:
        more = merged.option("basePath", target).parquet(*[f"{target}/{d}" for d in sorted(unknown)]).schema
        schema = _united(schema, more)
        rows = spark.read.schema(schema).parquet(target) if schema else merged.parquet(target)
    return Held(rows, now, partition_by, unknown, ledger.get("keys") or {})


def _united(one: T.StructType, two: T.StructType) -> T.StructType | None:
    """All columns of both, or ``None`` where one has different types."""
    types = {f.name.lower(): f.dataType for f in one}
    if any(types.get(f.name.lower(), f.dataType) != f.dataType for f in two):
        return None
    return T.StructType([*one.fields, *[f for f in two if f.name.lower() not in types]])


def entry(rows: DataFrame, partition_by: str | None, digests: dict[str, str], keys: dict | None) -> dict:
    """What the ledger says of a table that holds ``rows``."""
    return {LEDGER: {"schema": rows.schema.jsonValue(), "partition_by": partition_by, "files": digests, "keys": keys}}


def bits_for(rows: int, partitions: int) -> int:
    """Bits of a partition's bit set: a power of two with room for twice the mean number of keys."""
    return 1 << max(15, math.ceil(math.log2(BITS_PER_KEY * 2 * max(1, rows) / max(1, partitions))))


def _positions(keyed: DataFrame, labels: list[str], bits: int) -> DataFrame:
    """Keys with the bucket and the bit of their hash, and as one comparable value."""
    place = F.xxhash64(*labels).bitwiseAND(F.lit(bits - 1))
    return keyed.withColumns(
        {"_bucket": F.bitmap_bucket_number(place), "_bit": F.bitmap_bit_position(place), "_key": F.struct(*labels)}
    )


def key_digests(rows: DataFrame, on: MergeKeys, partition_by: str, bits: int) -> DataFrame:
    """A row per partition and bucket: the bit set of its keys, the least and the greatest of them."""
    placed = _positions(on.project(rows, col(partition_by)), on.labels, bits)
    return placed.groupBy(partition_by, "_bucket").agg(
        F.bitmap_construct_agg("_bit").alias("bits"), F.min("_key").alias("least"), F.max("_key").alias("greatest")
    )


def candidate_partitions(table: Held, target: str, on: MergeKeys, wanted: DataFrame) -> list[str | None] | None:
    """Values of the partitions that may hold one of the ``wanted`` keys, or ``None`` if that is not known.

    Only digests of buckets that a wanted key falls into meet its bit set. Bit sets that
    share a bit have fewer bits together than apart.
    """
    if table.keys.get("names") != [n.lower() for n in on.names]:
        return None
    spark = wanted.sparkSession
    digests = spark.read.parquet(f"{target}/{KEYS_NAME}")
    asked = _positions(wanted, on.labels, table.keys["bits"]).groupBy("_bucket").agg(
        F.bitmap_construct_agg("_bit").alias("asked"), F.min("_key").alias("first"), F.max("_key").alias("last")
    )
    met = digests.join(asked, "_bucket").filter((F.col("least") <= F.col("last")) & (F.col("greatest") >= F.col("first")))
    apart = (F.bitmap_count("bits") + F.bitmap_count("asked")).alias("apart")
    both = met.select(col(table.partition_by), "_bucket", apart, F.explode(F.array("bits", "asked")).alias("part"))
    united = both.groupBy(col(table.partition_by), "_bucket", "apart").agg(F.bitmap_or_agg("part").alias("united"))
    hit = united.filter(F.bitmap_count("united") < F.col("apart")).select(col(table.partition_by).cast("string")).distinct()
    digested = set(table.keys["partitions"])
    unsure = [d for d in table.files if d in table.unknown or d not in digested]
    return list({row[0] for row in hit.collect()} | {partition_value(d) for d in unsure})


def partition_value(folder: str) -> str | None:
    """The value in the name of a partition directory."""
    value = unquote(folder.split("=", 1)[1])
    return None if value == NULL_PARTITION else value
