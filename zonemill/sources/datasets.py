"""Reading and writing datasets of a zone."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonemill.functions.clean import conform
from zonemill.functions.columns import col, quoted
from zonemill.layout import unit_path

CONTROL_SEPARATOR = ";"
# Fixed value: what stands for the unit in a path.
UNIT_MARK = "%bu%"


def read_parquet(
    spark: SparkSession,
    path: str,
    column: str | None = None,
    value: object = None,
    glob: str = "*.parquet",
    keep_partition_col: bool = True,
    schema: T.StructType | str | None = None,
    merge_schema: bool = False,
) -> DataFrame:
    """A Parquet dataset, or one partition value of it when column and value are given; 0, False and '' are values.

    The partition value is a filter, which prunes the directories of all other values.
    ``keep_partition_col=False`` leaves the filtered column out.
    """
    reader = spark.read.option("pathGlobFilter", glob).option("mergeSchema", merge_schema)
    df = (reader.schema(schema) if schema else reader).parquet(path)
    if column is not None and value is not None:
        df = df.filter(col(column) == value)
        return df if keep_partition_col else df.drop(column)
    return df


def read_table(
    spark: SparkSession,
    path: str,
    column: str | None = None,
    value: object = None,
    fmt: str = "parquet",
    merge_schema: bool = False,
) -> DataFrame:
    """A trusted or refined table in the given format, optionally one value of a column."""
    reader = spark.read.format(fmt)
    df = (reader.option("mergeSchema", True) if merge_schema else reader).load(path)
    return df.filter(col(column) == value) if column is not None and value is not None else df


def read_by_unit(
    spark: SparkSession,
    path: str,
    units: Sequence[str] | None,
    column: str | None = None,
    value: object = None,
    template: bool = False,
    glob: str = "*.parquet",
) -> dict[str, DataFrame]:
    """One dataset per business unit, from a sub-directory each or a ``%bu%`` template."""
    return {u: read_parquet(spark, unit_path(path, u, template), column, value, glob) for u in units or []}


def read_units(
    spark: SparkSession,
    path: str,
    units: Sequence[str] | None = None,
    template: bool = False,
    tag: str = "bu",
    glob: str = "*.parquet",
) -> DataFrame:
    """The datasets of all business units, or of the given ones, as one scan with the unit in a column.

    The unit is read from the path of each file. Only the directories of given units are
    listed, and a filter on the column passes the files of other units over. Columns that
    only some units have are NULL for the others.
    """
    place = path if template else f"{path.rstrip('/')}/%bu%"
    if UNIT_MARK not in place:
        raise ValueError(f"the template {path!r} holds no {UNIT_MARK}")
    reader = spark.read.option("pathGlobFilter", glob).option("mergeSchema", True)
    roots = [place.replace(UNIT_MARK, u) for u in units] if units is not None else [place.replace(UNIT_MARK, "*")]
    if not roots:
        raise ValueError("there are no units to unite")
    before, after = place.split(UNIT_MARK)
    shape = f"{re.escape(before)}([^/]*){re.escape(after.rstrip('/'))}/"
    found = F.regexp_extract(F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))), shape, 1)
    rows = reader.parquet(*roots)
    return rows.select(*map(col, rows.columns), found.alias(tag))


def tagged_union(frames: dict[str, DataFrame], tag: str = "bu") -> DataFrame:
    """The datasets of :func:`read_by_unit` as one, with the unit in a column."""
    if not frames:
        raise ValueError("there are no units to unite")
    tagged = [df.withColumn(tag, F.lit(unit)) for unit, df in frames.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def read_control_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A control table kept as delimited text with a header."""
    return spark.read.schema(schema).options(header=True, sep=CONTROL_SEPARATOR).csv(path)


def write_dataset(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "append",
    partition_by: str | Sequence[str] | None = None,
    schema: T.StructType | str | None = None,
    files: int | None = None,
    evolve: bool = False,
) -> None:
    """Write a dataset, appending by default.

    A partitioned write is rebalanced on its partition columns: small partitions share
    tasks, so they get few files, and a partition that holds a large part of the rows is
    split over several tasks. ``files`` asks for a number of writing tasks instead; the
    stage before them keeps its parallelism. ``schema`` selects and casts columns first.
    ``evolve`` lets a format with schema evolution add columns; with Parquet, read such
    a dataset with ``merge_schema``.
    """
    if schema is not None:
        df = conform(df, schema)
    columns = [partition_by] if isinstance(partition_by, str) else list(partition_by or [])
    writer = _laid_out(df, columns, files).write.format(fmt).mode(mode)
    if evolve:
        writer = writer.option("mergeSchema", True)
    if columns:
        writer = writer.partitionBy(*columns)
    writer.save(path)


def _laid_out(df: DataFrame, partition_by: Sequence[str], files: int | None) -> DataFrame:
    if files is not None:
        return df.repartition(files)
    return df.hint("rebalance", *map(quoted, partition_by)) if partition_by else df


def register_views(spark: SparkSession, tables: dict[str, str], fmt: str = "parquet") -> None:
    """Make the table at each path readable in SQL under its name."""
    for name, path in tables.items():
        read_table(spark, path, fmt=fmt).createOrReplaceTempView(name)


def register_query_views(spark: SparkSession, queries: dict[str, str]) -> None:
    """Make the result of each SQL text readable in SQL under its name."""
    for name, query in queries.items():
        spark.sql(query).createOrReplaceTempView(name)
