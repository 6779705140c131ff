"""Typed, NULL-tolerant comparison of merge keys.

A NULL boolean equals ``false`` and a NULL string equals ``''``. Any other NULL equals
only NULL. Every key turns into columns that are never NULL, so that joins on them are
plain equi-joins and grouping and joining hash the same values.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonemill.functions.columns import col, require


class MergeKeys:
    """The key columns of two tables, compared with the types of the first."""

    def __init__(self, df: DataFrame, keys: list[str], what: str = "the table"):
        self.names = require(df, keys, what)
        types = {f.name: f.dataType for f in df.schema}
        self.types = [types[name] for name in self.names]
        # Names of the comparable columns in a projection of them.
        self.labels = [f"_key{i}" for i in range(len(self.columns()))]

    def columns(self, side: str | None = None) -> list[Column]:
        """The comparable columns of a row whose keys have the names and types of these."""
        parts: list[Column] = []
        for name, data_type in zip(self.names, self.types):
            parts += _never_null(name, data_type, col(name, side))
        return parts

    def project(self, df: DataFrame, *more: Column) -> DataFrame:
        """Only the comparable key columns, and ``more``."""
        return df.select(*[k.alias(n) for k, n in zip(self.columns(), self.labels)], *more)

    def match(self, left: str, right: str) -> Column:
        """Row of ``left`` and row of ``right``, both with the original columns."""
        return _all_equal(self.columns(left), self.columns(right))

    def match_projected(self, left: str, right: str) -> Column:
        """Row of ``left`` with the original columns, row of ``right`` projected."""
        return _all_equal(self.columns(left), [col(n, right) for n in self.labels])


def _all_equal(left: list[Column], right: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, [x == y for x, y in zip(left, right)])


def _never_null(name: str, data_type: T.DataType, value: Column) -> list[Column]:
    if isinstance(data_type, T.BooleanType):
        return [F.coalesce(value, F.lit(False))]
    if isinstance(data_type, T.StringType):
        return [F.coalesce(value, F.lit(""))]
    if isinstance(data_type, T.NumericType):
        filler = F.lit(0)
    elif isinstance(data_type, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        filler = F.lit("1970-01-01")
    elif isinstance(data_type, T.BinaryType):
        filler = F.lit("")
    else:
        raise ValueError(f"column {name!r} of type {data_type.simpleString()} cannot be a merge key")
    return [F.coalesce(value, filler.cast(data_type)), value.isNull()]
