"""The loads between zones and the run over a control table."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonemill.functions.clean import conform
from zonemill.functions.times import fixed, now_text, run_stamp, run_time_text, today_text
from zonemill.layout import ARCHIVE_ZONE, FAILED_ZONE, RAW_ZONE, TRUSTED_ZONE, table_path
from zonemill.operators.control import STATUS_KEYS, record_status, with_connection, work_list
from zonemill.plans.deliveries import TrustedTable, window_date
from zonemill.sources import files
from zonemill.sources.datasets import read_parquet, write_dataset
from zonemill.sources.jdbc import write_jdbc_table
from zonemill.sources.publish import publish_table, recover
from zonemill.streaming.ingest import ingest_stream

RESULT_SCHEMA = "status string, error string, FilePath string"
RUN_SUFFIX = "__run"


def new_stamp(spark: SparkSession) -> str:
    """Stamp of a run; all tables of the run share it."""
    return fixed(spark, run_stamp(run_time_text(F.current_timestamp())))


def zone_path(root: str, zone: str, row: Mapping[str, str]) -> str:
    """Directory of the table of a control row in a zone."""
    return table_path(root, zone, row["highway"], row["System"], row["SchemaName"], row["TableName"])


def extract_to_raw(
    spark: SparkSession,
    row: Mapping[str, str],
    root: str,
    read: Callable[[str], DataFrame],
    stamp: str,
    schema: T.StructType | str | None = None,
    files_per_delivery: int | None = None,
    allow_truncation: bool = False,
) -> str:
    """Land the result of a control row's source query as one delivery in raw.

    ``read`` runs the query text in the source, for example with ``extract_query``. With a
    ``schema``, values that it would cut raise unless ``allow_truncation`` is set. The
    delivery is written under a hidden name and appears with one rename. Returns its path.
    """
    found = read(row["Query"] + (row["Filter"] or ""))
    if schema is not None:
        found = conform(found, schema, allow_truncation)
    folder = zone_path(root, RAW_ZONE, row)
    name = f"{stamp}_{row['TableName']}.parquet"
    draft = f"{folder}/_{name}"
    write_dataset(found, draft, mode="overwrite", files=files_per_delivery)
    files.move(spark, draft, f"{folder}/{name}")
    return f"{folder}/{name}"


def raw_to_trusted(
    spark: SparkSession,
    row: Mapping[str, str],
    root: str,
    checkpoint_root: str,
    combine: bool = False,
    **merge_options: object,
) -> None:
    """Merge all waiting deliveries of a control row's table, a backlog in one step with ``combine``."""
    path = zone_path(root, TRUSTED_ZONE, row)
    ingest_stream(
        spark,
        raw_path=zone_path(root, RAW_ZONE, row),
        table=TrustedTable.from_control(row, path, **merge_options),
        checkpoint=zone_path(checkpoint_root, TRUSTED_ZONE, row),
        archive_path=zone_path(root, ARCHIVE_ZONE, row),
        failed_path=zone_path(root, FAILED_ZONE, row),
        as_of=window_date(row),
        combine=combine,
    )


def publish_to_warehouse(
    spark: SparkSession,
    row: Mapping[str, str],
    root: str,
    connection: Mapping[str, str],
    mode: str = "overwrite",
    write: Callable[..., None] = write_jdbc_table,
    **options: object,
) -> None:
    """Copy a refined table to the warehouse table of the same name, replacing its rows."""
    refined = "/".join([root.rstrip("/"), row["Zone"], row["SchemaName"], row["TableName"]])
    write(read_parquet(spark, refined, merge_schema=True), connection, row["Container"], row["TableName"], mode=mode, **options)


def _record_run(spark: SparkSession, control_path: str) -> None:
    """Put the kept results of a run into the control table."""
    kept = control_path.rstrip("/") + RUN_SUFFIX
    text = files.read_text(spark, kept)
    if text is None:
        return
    run = json.loads(text)
    control = spark.read.parquet(control_path)
    for done in (True, False):
        keys = [key for key, ok in run["ended"] if ok == done]
        if keys:
            ended = spark.createDataFrame(keys, [f"_{k}" for k in STATUS_KEYS])
            same = reduce(Column.__and__, [F.col(k).cast("string") == F.col(f"_{k}") for k in STATUS_KEYS])
            rows = spark.read.parquet(control_path).join(ended, same, "left_semi")
            control = record_status(control, rows, done, run["run_date"], run["advance"])
    publish_table(control, control_path)
    files.delete(spark, kept)


def run_work_list(
    spark: SparkSession,
    control_path: str,
    zone: str,
    step: Callable[[Row], object],
    connections: DataFrame | None = None,
    connection_keys: Sequence[str] = (),
    log_path: str | None = None,
    run_date: str | None = None,
    advance_on_failure: bool = False,
    **equals: str,
) -> DataFrame:
    """Run a load for every control row of a zone and keep each result in the control table.

    A failed table does not stop the others. The list has one row per table to load. The
    control table is rewritten once, at the end; until then the results lie in a small file
    beside it, from which the next run finishes a run that was cut off. Returns one result row per table, which is also appended to ``log_path``.
    """
    recover(spark, control_path)
    _record_run(spark, control_path)
    work = work_list(spark.read.parquet(control_path), zone, **equals)
    if connections is not None:
        work = with_connection(work, connections, connection_keys)
    results, ended = [], []
    for row in work.collect():
        place = "/".join([zone, row["highway"], row["System"], row["SchemaName"], row["TableName"]]) + "/"
        try:
            step(row)
            results.append(("succeeded", None, place))
        except Exception as problem:
            results.append(("failed", str(problem), place))
        ended.append([[str(row[k]) for k in STATUS_KEYS], results[-1][0] == "succeeded"])
        run = {"run_date": run_date or fixed(spark, today_text()), "advance": advance_on_failure, "ended": ended}
        files.write_text(spark, control_path.rstrip("/") + RUN_SUFFIX, json.dumps(run))
    _record_run(spark, control_path)
    report = spark.createDataFrame(results, RESULT_SCHEMA).withColumn("time", F.lit(fixed(spark, now_text())))
    if log_path is not None:
        write_dataset(report, log_path, files=1)
    return report
