"""Rolling-window delete before re-delivered rows are merged."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonemill.functions.columns import col, require
from zonemill.layout import WINDOW_DAYS


def in_window(df: DataFrame, column: str, as_of: str, days: int = WINDOW_DAYS) -> Column:
    """True from ``days`` before ``as_of`` on, with no upper bound; NULL for NULL dates."""
    (column,) = require(df, [column], "the table")
    return col(column) >= F.date_add(F.lit(as_of).cast("date"), -days)


def delete_window(target: DataFrame, column: str, as_of: str, days: int = WINDOW_DAYS) -> DataFrame:
    """Target without the rows in the window; rows with a NULL date stay."""
    (column,) = require(target, [column], "the table")
    return target.filter(~in_window(target, column, as_of, days) | col(column).isNull())
