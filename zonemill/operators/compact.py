"""Collapse of rows that differ only in their update column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonemill.functions.columns import col, require
from zonemill.functions.times import epoch_ms_to_date


def compact(df: DataFrame, update_column: str, convert_date: bool = False) -> DataFrame:
    """Distinct rows without the update column, all stamped with its greatest value.

    ``convert_date`` reads the update column as epoch milliseconds. NULLs are ignored;
    with no value at all the stamp is NULL. Copies collapse in every task before the
    shuffle, and the maximum is a scalar subquery over that one column.
    """
    (update_column,) = require(df, [update_column], "the table")
    value = epoch_ms_to_date(col(update_column)) if convert_date else col(update_column)
    latest = df.agg(F.max(value)).scalar()
    return df.drop(update_column).dropDuplicates().withColumn(update_column, latest)


def size_label(initial: Column, final: Column) -> Column:
    """``NOK`` for a dataset that grew, else ``OK``."""
    return F.when(initial - final < 0, F.lit("NOK")).otherwise(F.lit("OK"))
