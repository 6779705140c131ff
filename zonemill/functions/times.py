"""Date and run-time texts."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from zonemill.layout import DAY_FORMAT, MILLISECOND_FORMAT, RUN_ZONE, SECOND_FORMAT


def epoch_ms_to_date(column: Column) -> Column:
    """Epoch milliseconds as ``yyyy-MM-dd`` text in the session zone."""
    return F.date_format(F.timestamp_millis(column.cast("long")), DAY_FORMAT)


def run_time_text(instant: Column, zone: str = RUN_ZONE, source_zone: str | None = None) -> Column:
    """Local time of ``zone`` with milliseconds.

    ``source_zone`` is the zone a zone-less column is written in; leave it out for a
    TIMESTAMP column, whose wall clock is that of the session.
    """
    source = F.lit(source_zone) if source_zone else F.current_timezone()
    local = F.convert_timezone(source, F.lit(zone), instant.cast("timestamp_ntz"))
    return F.date_format(local, MILLISECOND_FORMAT)


def run_stamp(text: Column) -> Column:
    """The 17 digits of a run-time text, usable as a sortable file-name prefix."""
    return F.translate(text, "- :.", "")


def today_text() -> Column:
    return F.date_format(F.current_timestamp(), DAY_FORMAT)


def now_text() -> Column:
    return F.date_format(F.current_timestamp(), SECOND_FORMAT)


def fixed(spark: SparkSession, text: Column) -> str:
    """The value of a constant text now, to be the same in all rows and actions of a run."""
    return spark.range(1).select(text).first()[0]
