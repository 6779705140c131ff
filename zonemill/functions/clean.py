"""Cleaning steps between raw and trusted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonemill.functions.columns import col, find, require
from zonemill.layout import MONTH_FORMAT, PARTITION_MONTH


def blank_to_null(df: DataFrame) -> DataFrame:
    """Empty strings become NULL; a string of spaces stays."""
    return df.select(
        [
            F.nullif(col(f.name), F.lit("")).alias(f.name) if isinstance(f.dataType, T.StringType) else col(f.name)
            for f in df.schema
        ]
    )


def with_partition_month(df: DataFrame, column: str, name: str = PARTITION_MONTH) -> DataFrame:
    """Add the month of a date, timestamp or ISO string column as ``yyyy-MM`` text."""
    (column,) = require(df, [column], "the table")
    return df.withColumn(name, F.date_format(col(column), MONTH_FORMAT))


def conform(df: DataFrame, schema: T.StructType | str, allow_truncation: bool = False) -> DataFrame:
    """Select and cast the columns of ``schema``.

    Columns are found in any case; missing ones are NULL. A fraction, time of day or
    string tail that would be lost raises an error unless ``allow_truncation`` is set. A value
    out of range always raises, and a boolean is never taken for a number.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    return df.select([_conformed(df, f, allow_truncation).alias(f.name) for f in schema])


def _conformed(df: DataFrame, field: T.StructField, allow_truncation: bool) -> Column:
    name = find(df, field.name)
    target = field.dataType
    limit = target.length if isinstance(target, (T.VarcharType, T.CharType)) else None
    plain = T.StringType() if limit is not None else target
    if name is None:
        return F.lit(None).cast(plain)
    source = df.schema[name].dataType
    value = col(name)
    if isinstance(source, T.BooleanType) and isinstance(target, T.NumericType):
        raise ValueError(f"column {name!r} is boolean and is not taken as a number")
    if limit is not None:
        text = value.cast("string")
        if allow_truncation:
            return F.substring(text, 1, limit)
        return F.when(F.length(text) > limit, _fail(name, f"longer than {limit} characters")).otherwise(text)
    result = cast_in_range(name, value, source, plain)
    if _may_lose_parts(source, target) and not allow_truncation:
        return F.when(result.cast(source) != value, _fail(name, f"not exact as {target.simpleString()}")).otherwise(
            result
        )
    return result


def cast_in_range(name: str, value: Column, source: T.DataType, target: T.DataType) -> Column:
    """``value`` cast; a number out of range raises in any session, where a plain cast may wrap around."""
    result = value.cast(target)
    if source == target or not isinstance(source, T.NumericType):
        return result
    if isinstance(target, T.IntegralType):
        low, high = _bounds(target)
        wide = value if isinstance(source, (T.DoubleType, T.FloatType)) else value.cast("decimal(38,6)")
        under, over = (F.lit(str(x)).cast("decimal(38,6)") for x in (low - 1, high + 1))
        outside = (wide <= under) | (wide >= over)
    elif isinstance(target, T.DecimalType):
        outside = value.isNotNull() & value.try_cast(target).isNull()
    else:
        return result
    return F.when(outside, _fail(name, f"an overflow of {target.simpleString()}")).otherwise(result)


def _may_lose_parts(source: T.DataType, target: T.DataType) -> bool:
    digits = isinstance(source, T.FractionalType) and isinstance(target, (T.IntegralType, T.DecimalType))
    digits = digits or (isinstance(source, T.DoubleType) and isinstance(target, T.FloatType))
    time = isinstance(source, (T.TimestampType, T.TimestampNTZType)) and isinstance(target, T.DateType)
    return (digits or time) and source != target


def _bounds(target: T.IntegralType) -> tuple[int, int]:
    bits = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}[type(target)]
    return -(1 << bits - 1), (1 << bits - 1) - 1


def _fail(name: str, reason: str) -> Column:
    return F.raise_error(F.lit(f"value of column {name} is {reason}"))
