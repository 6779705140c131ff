"""Staged replacement of a Parquet table, or of some partitions of it.

A table must not be overwritten while a query still reads it, and a failed write must
leave it as it was. The new data is therefore written beside the table and checked.
Then a small plan of renames is saved and carried out. A run that dies in between is
finished by the next one from that plan; one that died before leaves the table untouched.

Readers that list the table during the renames may see old and new partitions together.
On object stores a rename is a copy, so there the last step takes time with the size of
the replaced partitions. Use a table format with transactions where that matters.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from zonemill.functions.keys import MergeKeys
from zonemill.sources import files, ledger
from zonemill.sources.datasets import _laid_out
from zonemill.sources.ledger import APPLIED_NAME, KEYS_NAME, NULL_PARTITION, Held

PLAN_NAME = "_plan"


def staging_path(target: str) -> str:
    return target.rstrip("/") + "__staging"


def table_exists(spark: SparkSession, target: str) -> bool:
    """Whether the table has data files, after finishing a publish that was cut off.

    A partitioned table that lost its last row has none, and so no schema to read.
    """
    recover(spark, target)
    return any(not name.startswith(("_", ".")) for _, name, *_ in files.list_entries(spark, target))


def recover(spark: SparkSession, target: str) -> None:
    """Finish a publish that was checked, and discard one that was not."""
    staging = staging_path(target)
    plan = files.read_text(spark, f"{staging}/{PLAN_NAME}")
    if plan is not None:
        _carry_out(spark, target, json.loads(plan))
    files.delete(spark, staging)


def applied(spark: SparkSession, target: str) -> dict:
    """What the callers of publishes recorded beside the data."""
    recover(spark, target)
    return {k: v for k, v in ledger.recorded(spark, target).items() if k != ledger.LEDGER}


def publish_table(
    df: DataFrame,
    target: str,
    partition_by: str | None = None,
    touched: Iterable[object] | None = None,
    record: dict | None = None,
    in_place: DataFrame | None = None,
    held: Held | None = None,
    keys: list[str] | None = None,
) -> int:
    """Replace the table by ``df``, or only the ``touched`` partitions of it.

    ``df`` may read the table. Of a touched partition without new rows nothing remains.
    ``in_place`` are further rows, read from the table, whose partition does not change;
    they are written by the tasks that read them. ``df`` must have every column of the table. ``record`` is kept beside the data and
    appears together with it, as do the columns and files of the table (see ``ledger``);
    fields it leaves out stay. ``held`` is the table as the caller found it. With ``keys``,
    digests of these columns are kept for every partition written. Returns the number of
    rows written. A table has one writer at a time.
    """
    spark = df.sparkSession
    record = applied(spark, target) | (record or {})
    present = _refuse_loss(df, target, held)
    staging = staging_path(target)
    data = f"{staging}/data"
    columns = [partition_by] if partition_by else []
    written = Observation()
    laid_out = _laid_out(df, columns, None)
    if in_place is not None:
        laid_out = laid_out.unionByName(in_place)
    counted = laid_out.observe(written, F.count(F.lit(1)).alias("n"))
    counted.write.partitionBy(*columns).parquet(data)
    rows = written.get["n"]
    found = spark.read.schema(df.schema).parquet(data).count()
    if found != rows:
        raise RuntimeError(f"{found} rows staged for {target}, {rows} expected")

    plan: dict = {"replace": [""], "remove": [], "record": record}
    staged = spark.read.schema(df.schema).parquet(data)
    digests = ledger.file_digests(staged.inputFiles(), partition_by)
    left: dict[str, str] = {}
    if partition_by and touched is not None:
        parts = _partitions(spark, data, partition_by)
        lying = _partitions(spark, target, partition_by)
        gone = {_partition_value(v) for v in touched} - parts.keys()
        plan["replace"] = list(parts.values())
        plan["remove"] = [lying[v] for v in gone if v in lying]
        if present is not None:
            replaced = {unquote(n) for n in (*plan["replace"], *plan["remove"])}
            files_now = present.files or ledger.file_digests(present.rows.inputFiles(), partition_by)
            left = {d: digest for d, digest in files_now.items() if d and d not in replaced}
    told = _stage_keys(staged, keys, partition_by, f"{staging}/keys", rows, set(digests), left, present)
    plan["record"] = record | ledger.entry(df, partition_by, digests | left, told)
    files.write_text(spark, f"{staging}/{PLAN_NAME}", json.dumps(plan))
    _carry_out(spark, target, plan)
    files.delete(spark, staging)
    return rows


def _stage_keys(
    staged: DataFrame, keys: list[str] | None, partition_by: str | None, path: str, rows: int,
    fresh: set[str], left: dict[str, str], present: Held | None,
) -> dict | None:
    """Digests of the keys of all staged partitions, written to ``path``, and what the ledger says of keys.

    Digests of partitions that stay are still good unless another writer changed their files.
    """
    held = present.keys if present else {}
    names = [n.lower() for n in keys or []]
    kept = set(left) & set(held.get("partitions", ())) - (present.unknown if present else set())
    if not (keys and partition_by and rows):
        return held | {"partitions": sorted(kept)} if kept else None
    if names != held.get("names"):
        held, kept = {}, set()
    bits = held.get("bits") or ledger.bits_for(rows, len(fresh))
    # Rebalanced, so that a partition's digests are one file unless they are large.
    told = _laid_out(ledger.key_digests(staged, MergeKeys(staged, keys), partition_by, bits), [partition_by], None)
    told.write.partitionBy(partition_by).parquet(path)
    return {"names": names, "bits": bits, "partitions": sorted(kept | fresh)}


def _refuse_loss(df: DataFrame, target: str, held: Held | None) -> Held | None:
    """Raise if a file of the table has a column that the new rows lack; the table as it lies, if it has files."""
    spark = df.sparkSession
    if held is None and any(not name.startswith(("_", ".")) for _, name, *_ in files.list_entries(spark, target)):
        held = ledger.held(spark, target)
    if held is not None:
        lost = sorted({c.lower() for c in held.rows.columns} - {c.lower() for c in df.columns})
        if lost:
            raise ValueError(f"the new rows for {target} lack its columns {', '.join(lost)}")
    return held


def _carry_out(spark: SparkSession, target: str, plan: dict) -> None:
    """Renames and removals of a plan; steps already done are passed over."""
    staging = staging_path(target)
    for name in plan["replace"]:
        source, goal = f"{staging}/data/{name}".rstrip("/"), f"{target}/{name}".rstrip("/")
        if files.exists(spark, source):
            files.delete(spark, goal)
            files.move(spark, source, goal)
    for name in plan["remove"]:
        files.delete(spark, f"{target}/{name}")
    if files.exists(spark, f"{staging}/keys"):
        for name in plan["replace"]:
            source, goal = f"{staging}/keys/{name}".rstrip("/"), f"{target}/{KEYS_NAME}/{name}".rstrip("/")
            if files.exists(spark, source):
                files.delete(spark, goal)
                files.move(spark, source, goal)
    if plan["record"]:
        files.write_text(spark, f"{target}/{APPLIED_NAME}", json.dumps(plan["record"]))
    spark.catalog.refreshByPath(target)


def _partition_value(value: object) -> str:
    return NULL_PARTITION if value is None else str(value)


def _partitions(spark: SparkSession, path: str, column: str) -> dict[str, str]:
    """Partition directories of a table by the value in their name."""
    prefix = f"{column}="
    names = [name for _, name, is_directory, _, _ in files.list_entries(spark, path) if is_directory]
    return {unquote(n[len(prefix) :]): n for n in names if n.startswith(prefix)}
