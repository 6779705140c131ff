"""Merging one delivery of raw rows into a trusted table."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonemill.functions.clean import blank_to_null, with_partition_month
from zonemill.functions.columns import col, find
from zonemill.functions.keys import MergeKeys
from zonemill.layout import KEY_BUCKET, MONTH_FORMAT, PARTITION_MONTH, WINDOW_DAYS, split_keys
from zonemill.operators.merge import Upsert, keys_as, latest_per_key
from zonemill.operators.window_delete import delete_window, in_window
from zonemill.session import fits_broadcast
from zonemill.sources import ledger
from zonemill.sources.ledger import Held
from zonemill.sources.publish import applied, publish_table, table_exists


@dataclass(frozen=True)
class TrustedTable:
    """How a trusted table is kept.

    ``date_column`` gives the month of a partitioned table and the date of the window
    delete. A table without months may be cut into ``buckets`` directories by a hash of its
    keys, so that a delivery rewrites the buckets of its keys only; another number rewrites
    the table once. ``key_digests`` keeps digests of the keys of each month, which spare a
    delivery the keys of most months of a large table; a small one is faster without.
    ``merge_options`` go to the upsert.
    """

    path: str
    keys: list[str]
    date_column: str | None = None
    partitioned: bool = False
    merge_options: Mapping[str, object] = field(default_factory=dict)
    buckets: int = 0
    key_digests: bool = False

    def __post_init__(self):
        if self.partitioned and self.buckets:
            raise ValueError("a table has months or buckets, not both")

    def month_from_key(self) -> bool:
        return self.date_column is not None and self.date_column.lower() in [k.lower() for k in self.keys]

    def digest_keys(self) -> list[str] | None:
        """The keys by which months are looked up, where their values do not tell the month."""
        return self.keys if self.key_digests and self.partitioned and not self.month_from_key() else None

    @classmethod
    def from_control(cls, row: Mapping[str, str], path: str, **merge_options: object) -> TrustedTable:
        return cls(
            path=path,
            keys=split_keys(row["PrimaryKey"]),
            date_column=row["PartitionColumn"] or None,
            partitioned=row["Partition"] == "1",
            merge_options=merge_options,
        )


def window_date(row: Mapping[str, str]) -> str | None:
    """Reference date of the window delete of a control row, if it asks for one."""
    return row["UpdatedDate"] if row["FlagDelete"] == "1" else None


def load_delivery(
    spark: SparkSession,
    delivery: DataFrame,
    table: TrustedTable,
    as_of: str | None = None,
    record: dict | None = None,
) -> int:
    """Upsert the rows of one delivery, after deleting the window before ``as_of`` if given.

    The first delivery creates the table as it is, with one row per key where the merge
    options ask for the latest. Of a partitioned table only those
    months are read in full and replaced that hold a matched row, a new row or a deleted
    row; of a table in buckets, those buckets. Any error leaves the table as it was. Returns the number of rows written.
    """
    batch = blank_to_null(delivery)
    exists = table_exists(spark, table.path)
    if table.partitioned:
        if table.date_column is None:
            raise ValueError("a partitioned table needs a date column")
        if not exists or find(batch, table.date_column):
            batch = with_partition_month(batch, table.date_column)
    partition_by = PARTITION_MONTH if table.partitioned else KEY_BUCKET if table.buckets else None
    if table.buckets:
        record = (record or {}) | {"buckets": table.buckets}
        if not exists:
            batch = _in_buckets(batch, MergeKeys(batch, table.keys, "the delivery"), table)
    if not exists:
        if table.merge_options.get("on_duplicate") == "latest":
            batch = latest_per_key(batch, table.keys, table.merge_options["order_by"])
        return publish_table(batch, table.path, partition_by, record=record, keys=table.digest_keys())

    # Files may differ in their columns; the table's record says which there are.
    held = ledger.held(spark, table.path)
    current = held.rows
    months = None
    if table.buckets:
        on = MergeKeys(current, table.keys, "the target")
        batch = _in_buckets(keys_as(current, batch, on), on, table)
        if applied(spark, table.path).get("buckets") == table.buckets:
            months = touched_buckets(current, batch, table, as_of)
            current = current.filter(col(KEY_BUCKET).isin(months))
        else:
            current = _in_buckets(current, on, table)
    elif table.partitioned and PARTITION_MONTH not in current.columns:
        current = with_partition_month(current, table.date_column)
    elif table.partitioned:
        months = touched_months(current, batch, table, as_of, held)
        current = current.filter(_is_one_of(PARTITION_MONTH, months))
    if as_of is not None:
        current = delete_window(current, table.date_column, as_of)
    upsert = Upsert(current, batch, table.keys, **table.merge_options)
    if months is not None and upsert.small_keys:
        # Unmatched rows are read and written in the same task, month by month as they lie.
        changed, unchanged = upsert.changed(), upsert.unchanged()
    else:
        changed, unchanged = upsert.result(), None
    return publish_table(
        changed, table.path, partition_by, touched=months, record=record, in_place=unchanged, held=held, keys=table.digest_keys()
    )


def touched_months(
    current: DataFrame, batch: DataFrame, table: TrustedTable, as_of: str | None = None, held: Held | None = None
) -> list[str | None]:
    """Months whose rows an upsert of ``batch`` changes, adds to or deletes from.

    A matched row may leave its month, so the months of all matches count, unless the month
    derives from a key. They need a look at the keys of the months that may hold one, by the
    digests that ``held`` knows of, or else of the whole table.
    """
    parts = [batch.select(PARTITION_MONTH) if PARTITION_MONTH in batch.columns else _no_month(batch)]
    if not table.month_from_key():
        on = MergeKeys(current, table.keys, "the target")
        wanted = on.project(keys_as(current, batch, on)).distinct()
        known = ledger.candidate_partitions(held, table.path, on, wanted) if held and held.keys else None
        looked_at = current if known is None else current.filter(_is_one_of(PARTITION_MONTH, known))
        keys = on.project(looked_at, col(PARTITION_MONTH))
        if not fits_broadcast(wanted):
            keys = keys.distinct()
        parts.append(keys.join(wanted, on.labels, "left_semi").select(PARTITION_MONTH))
    if as_of is not None:
        # The month before the window is read too, for dates near midnight in another zone.
        first = F.date_format(F.add_months(F.date_add(F.lit(as_of).cast("date"), -WINDOW_DAYS), -1), MONTH_FORMAT)
        recent = current.filter(col(PARTITION_MONTH) >= first)
        parts.append(recent.filter(in_window(current, table.date_column, as_of)).select(PARTITION_MONTH))
    months = reduce(DataFrame.union, parts).distinct()
    return [row[0] for row in months.collect()]


def touched_buckets(current: DataFrame, batch: DataFrame, table: TrustedTable, as_of: str | None = None) -> list[int]:
    """Buckets whose rows an upsert of ``batch`` changes, adds to or deletes from: a key never leaves its bucket."""
    touched = batch.select(KEY_BUCKET)
    if as_of is not None:
        touched = touched.union(current.filter(in_window(current, table.date_column, as_of)).select(KEY_BUCKET))
    return [row[0] for row in touched.distinct().collect()]


def _in_buckets(rows: DataFrame, on: MergeKeys, table: TrustedTable) -> DataFrame:
    return rows.withColumn(KEY_BUCKET, F.pmod(F.xxhash64(*on.columns()), F.lit(table.buckets)).cast("int"))


def _no_month(batch: DataFrame) -> DataFrame:
    return batch.select(F.lit(None).cast("string").alias(PARTITION_MONTH))


def _is_one_of(name: str, values: list[str | None]) -> Column:
    given = [v for v in values if v is not None]
    test = col(name).isin(given)
    return test | col(name).isNull() if None in values else test


def repartition_table(spark: SparkSession, path: str, date_column: str) -> int:
    """Rewrite a table that was built without partitions by month."""
    if not table_exists(spark, path):
        raise ValueError(f"there is no table at {path}")
    held = ledger.held(spark, path)
    return publish_table(with_partition_month(held.rows, date_column), path, PARTITION_MONTH, held=held)
