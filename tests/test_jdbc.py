"""Options and value checks of the JDBC sources; no database is started for a test."""

from unittest.mock import MagicMock

import pytest
from pyspark.sql import functions as F

from zonemill.plans.loads import publish_to_warehouse
from zonemill.sources.jdbc import (
    Split,
    bounded_strings,
    extract_query,
    query_options,
    read_jdbc_table,
    table_options,
    write_jdbc_table,
)


def test_query_and_filter_are_joined_as_they_are():
    assert query_options("SELECT * FROM t", " WHERE a = 1") == {
        "query": "SELECT * FROM t WHERE a = 1", "queryTimeout": "7200"
    }


def test_a_split_query_is_read_in_ranges():
    options = query_options("SELECT * FROM t", "", Split("id", 0, 1000, 8))
    assert options["dbtable"] == "(SELECT * FROM t) q" and "query" not in options
    assert [options[k] for k in ("partitionColumn", "lowerBound", "upperBound", "numPartitions")] == [
        "id", "0", "1000", "8"
    ]


def test_reader_calls():
    spark = MagicMock()
    extract_query(spark, {"url": "u"}, "SELECT 1", custom_schema="a int")
    options = spark.read.format.return_value.options
    assert options.call_args.kwargs["url"] == "u" and options.call_args.kwargs["query"] == "SELECT 1"
    options.return_value.option.assert_called_with("customSchema", "a int")
    read_jdbc_table(spark, {"url": "u"}, "dw", "t")
    assert options.call_args.kwargs == {"url": "u", "dbtable": "dw.t"}
    read_jdbc_table(spark, {"url": "u"}, "dw", "t", Split("id", 0, 9, 3))
    assert options.call_args.kwargs == {
        "url": "u", "dbtable": "dw.t", "partitionColumn": "id", "lowerBound": "0", "upperBound": "9", "numPartitions": "3"
    }


def test_table_options(spark):
    df = spark.createDataFrame([("x", 1)], "name string, n int")
    options = table_options(df, "dw", "t", 100, "WITH (HEAP)", 5000, 16)
    assert options == {
        "dbtable": "dw.t", "createTableColumnTypes": "`name` VARCHAR(100)", "createTableOptions": "WITH (HEAP)",
        "batchsize": "5000", "numPartitions": "16",
    }
    assert table_options(df.select("n"), "dw", "t") == {"dbtable": "dw.t"}


def test_long_strings_fail_or_are_cut(spark):
    df = spark.createDataFrame([("abcdef", 1), (None, 2)], "name string, n int")
    assert [r["name"] for r in bounded_strings(df, 3, truncate=True).collect()] == ["abc", None]
    assert [r["name"] for r in bounded_strings(df, 6).collect()] == ["abcdef", None]
    with pytest.raises(Exception, match="longer than 3"):
        bounded_strings(df, 3).collect()


@pytest.mark.parametrize("mode", ["append", "overwrite"])
def test_overwriting_empties_the_real_target(mode):
    df = MagicMock()
    df.schema = []
    write_jdbc_table(df, {"url": "u"}, "dw", "t", mode=mode, max_length=None)
    writer = df.write.format.return_value.options.return_value.mode
    writer.assert_called_with(mode)
    truncates = [c.args for c in writer.return_value.option.call_args_list]
    assert truncates == ([("truncate", True)] if mode == "overwrite" else [])


def test_publish_copies_the_refined_table(spark, lake):
    row = {"Zone": "refined", "SchemaName": "sales", "TableName": "t", "Container": "dw"}
    spark.range(3).write.parquet(f"{lake}/refined/sales/t")
    written = []
    publish_to_warehouse(
        spark, row, lake, {"url": "u"}, write=lambda df, *args, **kwargs: written.append((df.count(), args, kwargs))
    )
    assert written == [(3, ({"url": "u"}, "dw", "t"), {"mode": "overwrite"})]


def test_balanced_ranges_hold_every_row_once_and_none_is_large(spark):
    from zonemill.sources.jdbc import balanced_ranges

    # Most values are small: ranges of equal width would put nearly all rows into one.
    rows = spark.range(40_000).selectExpr("CASE WHEN id % 50 = 0 THEN NULL ELSE CAST(pow(id / 40000.0, 9) * 1000000 AS INT) END AS k")
    rows = rows.withColumn("d", F.expr("date_add(DATE '2020-01-01', k % 1000)"))
    rows.createOrReplaceTempView("zonemill_split_source")
    for column in ("k", "d"):
        ranges = balanced_ranges(spark.table("zonemill_split_source").sample(0.5, seed=1), column, 16)
        counts = [spark.sql(f"SELECT * FROM zonemill_split_source WHERE {r}").count() for r in ranges]
        assert sum(counts) == 40_000
        own = spark.sql(f"SELECT max(n) FROM (SELECT count(*) AS n FROM zonemill_split_source GROUP BY {column})").first()[0]
        assert max(counts) <= max(2 * 40_000 / 16, 2 * own)
    even = spark.range(1000).selectExpr("id AS k", "CAST(id AS TIMESTAMP) AS t")
    even.createOrReplaceTempView("zonemill_split_even")
    for column in ("k", "t"):
        ranges = balanced_ranges(even, column, 8)
        counts = [spark.sql(f"SELECT * FROM zonemill_split_even WHERE {r}").count() for r in ranges]
        assert sum(counts) == 1000 and max(counts) <= 2 * 1000 / 8
    assert balanced_ranges(even.limit(0), "k", 4) == balanced_ranges(even, "k", 1) == ["1 = 1"]
