"""Registered queries against DuckDB on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

from __spark_entry__ import entry
from zonemill.plans.registered import QUERIES
from zonemill.plans.registered_sql import ORACLE_SQL

SF_DIR = "/root/testdata/sf0.001"
NO_SQL = {"dataset_sizes"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ""
    if isinstance(value, (int, float)) or type(value).__name__ == "Decimal":
        return f"{float(value):.6f}"
    return str(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    expected = duck.sql(ORACLE_SQL[name])
    assert sorted(result.columns) == sorted(expected.columns)
    assert _rows(result.columns, result.collect()) == _rows(expected.columns, expected.fetchall())


LARGE = ["merge_orders", "merge_null_keys", "merge_audit", "merge_lineitem_latest", "merge_touched_months",
         "missing_customers", "ingest_window"]


@pytest.mark.parametrize("name", LARGE)
def test_query_equals_sql_when_nothing_is_broadcast(spark, duck, name):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        test_query_equals_sql(spark, duck, name)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_every_query_is_checked():
    assert set(QUERIES) - set(ORACLE_SQL) == NO_SQL
    assert set(ORACLE_SQL) <= set(QUERIES)


def test_dataset_sizes_equal_the_file_sizes(spark):
    sizes = {r["name"]: r["bytes"] for r in QUERIES["dataset_sizes"](spark, SF_DIR).collect()}
    assert sizes == {n: os.path.getsize(f"{SF_DIR}/{n}.parquet") for n in ("orders", "lineitem")}


def test_entry(spark):
    assert entry(spark).columns == ["PARTITION_DT", "orders", "value"]
    assert entry(spark).count() > 0
