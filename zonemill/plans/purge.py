"""Collapse the history of listed datasets and keep an audit row for each."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonemill.functions.columns import require
from zonemill.functions.times import fixed, now_text
from zonemill.layout import PURGE_GREW_MESSAGE
from zonemill.operators.compact import compact, size_label
from zonemill.sources import ledger
from zonemill.sources.datasets import read_control_csv, write_dataset
from zonemill.sources.files import dataset_size
from zonemill.sources.publish import applied, publish_table

# Schemas and markers of the purge tables.
PURGE_SCHEMA = (
    "container string, path string, tb_name string, update_column string, table_type string, convert_date string"
)
MEASURE_SCHEMA = (
    "container string, path string, tb_name string, initial_size double, final_size double, msg_error string"
)
PURGED_TYPE = "NT"
YES = "S"
UNUSABLE_PATHS = ("", "/", "\\")


def purge_list(
    spark: SparkSession, paths: Sequence[tuple] | None = None, control_csv: str | None = None
) -> DataFrame:
    """Datasets to purge: the given ones, or those of the control file that are marked.

    A given dataset is (container, path, update column), or the leading fields of the
    control table in their order. Rows without a usable path are left out.
    """
    if paths:
        listed = spark.createDataFrame([_purge_row(p) for p in paths], PURGE_SCHEMA)
    elif control_csv:
        listed = read_control_csv(spark, control_csv, PURGE_SCHEMA).filter(F.col("table_type") == PURGED_TYPE)
    else:
        raise ValueError("give paths or a control file")
    return listed.filter(~F.trim("path").isin(*UNUSABLE_PATHS))


def _purge_row(fields: tuple) -> tuple:
    if len(fields) == 3:
        container, path, update_column = fields
        return container, path, None, update_column, None, None
    if not 4 <= len(fields) <= 6:
        raise ValueError(f"a dataset to purge has 3 to 6 fields, not {len(fields)}")
    return (*fields, *[None] * (6 - len(fields)))


def purge_dataset(spark: SparkSession, path: str, update_column: str, convert_date: bool = False) -> tuple[int, int]:
    """Compact one dataset in place, into one partition; returns its size before and after.

    A dataset that has only the files of its last purge by that column is left as it is, and
    none of them is read. The distinct rows are rebalanced, so the size of a file follows the
    session's advisory partition size. ``convert_date`` reads a numeric update column as epoch milliseconds; a
    dataset whose column is a date already, as after a purge, is compacted as it is.
    """
    last = applied(spark, path)
    initial = dataset_size(spark, path).first()["bytes"]
    held = ledger.held(spark, path)
    if last.get("purged") == update_column.lower() and held.files and not held.unknown:
        return initial, initial
    rows = held.rows
    (name,) = require(rows, [update_column], "the dataset")
    numeric = isinstance(rows.schema[name].dataType, T.NumericType)
    publish_table(compact(rows, name, convert_date and numeric), path, name, record={"purged": name.lower()}, held=held)
    return initial, dataset_size(spark, path).first()["bytes"]


def audit_rows(measured: DataFrame, time: str) -> DataFrame:
    """Audit rows from sizes and error texts; a dataset that grew is not OK either."""
    failed = F.col("msg_error").isNotNull()
    label = size_label(F.col("initial_size"), F.col("final_size"))
    message = F.when(failed, F.col("msg_error")).when(label == "NOK", F.lit(PURGE_GREW_MESSAGE)).otherwise(F.lit(""))
    return measured.select(
        "container",
        "path",
        "tb_name",
        "initial_size",
        "final_size",
        (F.col("initial_size") - F.col("final_size")).alias("size_difference"),
        F.when(failed, F.lit("NOK")).otherwise(label).alias("status"),
        message.alias("msg_error"),
        F.lit(time).alias("dt_purge"),
    )


def purge(
    spark: SparkSession,
    listed: DataFrame,
    locate: Callable[[str, str], str],
    result_path: str,
) -> DataFrame:
    """Purge every listed dataset and append one audit row for each.

    ``locate`` turns container and path into the location of a dataset. A dataset that
    fails keeps its data and the others go on.
    """
    measured = [_purged(spark, row, locate) for row in listed.collect()]
    audit = audit_rows(spark.createDataFrame(measured, MEASURE_SCHEMA), fixed(spark, now_text()))
    write_dataset(audit, result_path, files=1)
    return audit


def _purged(spark: SparkSession, row: Row, locate: Callable[[str, str], str]) -> tuple:
    named = (row["container"], row["path"], row["tb_name"])
    try:
        location = locate(row["container"], row["path"]).rstrip("/")
        initial, final = purge_dataset(spark, location, row["update_column"], row["convert_date"] == YES)
        return (*named, float(initial), float(final), None)
    except Exception as problem:
        return (*named, 0.0, 0.0, str(problem))
