"""Reading source databases and writing warehouse tables over JDBC."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonemill.functions.columns import col

# Fixed values of the loads.
QUERY_TIMEOUT_SECONDS = 7200
DEFAULT_STRING_LENGTH = 1024


@dataclass(frozen=True)
class Split:
    """Range of a numeric, date or timestamp column to read in parallel."""

    column: str
    lower: object
    upper: object
    partitions: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": str(self.lower),
            "upperBound": str(self.upper),
            "numPartitions": str(self.partitions),
        }


def balanced_ranges(values: DataFrame, column: str, partitions: int) -> list[str]:
    """Predicates that cut the rows of a source into about equal parts by a numeric, date or timestamp column.

    ``values`` are the column's values, or a sample of them. Ranges end at their quantiles, so a
    crowded stretch is cut finely; a value that alone fills several parts has one of its own. NULLs
    go with the first range. Together the predicates hold every row once.
    """
    shares = [i / partitions for i in range(1, partitions)]
    found = values.select(F.percentile_approx(col(column), shares, F.lit(10_000))).first()[0] if shares else None
    if not found:
        return ["1 = 1"]
    heavy = {v for v, next_ in zip(found, found[1:]) if v == next_}
    name, predicates, lower = column, [], ""
    for value in sorted(set(found)):
        text = _literal(value)
        predicates.append(f"{name} < {text}" + (f" AND {lower}" if lower else f" OR {name} IS NULL"))
        lower = f"{name} >= {text}"
        if value in heavy:
            predicates.append(f"{name} = {text}")
            lower = f"{name} > {text}"
    return [*predicates, lower]


def _literal(value: object) -> str:
    return str(value) if isinstance(value, (int, float, Decimal)) else f"'{value}'"


def query_options(query: str, filter_text: str = "", split: Split | None = None) -> dict[str, str]:
    """Reader options for a source query; the filter text carries its own leading space."""
    text = query + (filter_text or "")
    options = {"queryTimeout": str(QUERY_TIMEOUT_SECONDS)}
    if split is None:
        return {**options, "query": text}
    return {
        **options,
        "dbtable": f"({text}) q",
        **split.options(),
    }


def extract_query(
    spark: SparkSession,
    connection: Mapping[str, str],
    query: str,
    filter_text: str = "",
    split: Split | None = None,
    custom_schema: str | None = None,
    ranges: Sequence[str] | None = None,
) -> DataFrame:
    """Result of a query that the source database runs.

    Without ``split`` or ``ranges`` (see :func:`balanced_ranges`) one task reads it all; give
    one for anything large.
    """
    if ranges:
        options = {**connection, "queryTimeout": str(QUERY_TIMEOUT_SECONDS)}
        url = options.pop("url")
        reader = spark.read.option("customSchema", custom_schema) if custom_schema else spark.read
        return reader.jdbc(url, f"({query}{filter_text or ''}) q", predicates=list(ranges), properties=options)
    reader = spark.read.format("jdbc").options(**connection, **query_options(query, filter_text, split))
    return (reader.option("customSchema", custom_schema) if custom_schema else reader).load()


def read_jdbc_table(
    spark: SparkSession, connection: Mapping[str, str], schema: str, table: str, split: Split | None = None
) -> DataFrame:
    """A warehouse table; filters and columns are pushed down to it.

    Without ``split`` one task reads it all; give one for anything large.
    """
    ranges = split.options() if split else {}
    return spark.read.format("jdbc").options(**connection, dbtable=f"{schema}.{table}", **ranges).load()


def table_options(
    df: DataFrame,
    schema: str,
    table: str,
    max_length: int | None = DEFAULT_STRING_LENGTH,
    create_options: str | None = None,
    batch_size: int | None = None,
    connections: int | None = None,
) -> dict[str, str]:
    """Writer options: target, string column types, physical table options, parallelism."""
    options = {"dbtable": f"{schema}.{table}"}
    strings = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    if max_length is not None and strings:
        options["createTableColumnTypes"] = ", ".join(f"`{c}` VARCHAR({max_length})" for c in strings)
    if create_options:
        options["createTableOptions"] = create_options
    if batch_size:
        options["batchsize"] = str(batch_size)
    if connections:
        options["numPartitions"] = str(connections)
    return options


def bounded_strings(df: DataFrame, max_length: int, truncate: bool = False) -> DataFrame:
    """Strings longer than the warehouse column raise, or are cut if ``truncate`` is set."""
    return df.select(
        [
            _bounded(f.name, max_length, truncate) if isinstance(f.dataType, T.StringType) else col(f.name)
            for f in df.schema
        ]
    )


def _bounded(name: str, max_length: int, truncate: bool) -> Column:
    value = col(name)
    if truncate:
        return F.substring(value, 1, max_length).alias(name)
    too_long = F.raise_error(F.lit(f"value of column {name} is longer than {max_length} characters"))
    return F.when(F.length(value) > max_length, too_long).otherwise(value).alias(name)


def write_jdbc_table(
    df: DataFrame,
    connection: Mapping[str, str],
    schema: str,
    table: str,
    mode: str = "append",
    max_length: int | None = DEFAULT_STRING_LENGTH,
    truncate_strings: bool = False,
    create_options: str | None = None,
    batch_size: int | None = None,
    connections: int | None = None,
) -> None:
    """Write a warehouse table; overwriting empties an existing table and keeps its definition."""
    if max_length is not None:
        df = bounded_strings(df, max_length, truncate_strings)
    options = table_options(df, schema, table, max_length, create_options, batch_size, connections)
    writer = df.write.format("jdbc").options(**connection, **options).mode(mode)
    if mode == "overwrite":
        writer = writer.option("truncate", True)
    writer.save()
