import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from zonemill.functions.clean import blank_to_null, conform, with_partition_month
from zonemill.functions.times import epoch_ms_to_date, fixed, run_stamp, run_time_text
from zonemill.layout import split_keys, table_path, unit_path


def test_only_the_empty_string_is_blank(spark):
    df = spark.createDataFrame([("", " ", 0), ("x", None, 1)], "`a.b` string, c string, n int")
    assert [tuple(r) for r in blank_to_null(df).collect()] == [(None, " ", 0), ("x", None, 1)]


@pytest.mark.parametrize("type_", ["date", "timestamp", "timestamp_ntz", "string"])
def test_month_of_any_date_type(spark, type_):
    df = spark.sql(f"SELECT CAST('2020-10-31' AS {type_}) AS d UNION ALL SELECT NULL")
    assert {r[0] for r in with_partition_month(df, "D").select("PARTITION_DT").collect()} == {"2020-10", None}


def test_conform_truncates_only_when_allowed(spark):
    df = spark.sql("SELECT 1.25D AS a, 'abcdef' AS b, 12.345BD AS c, true AS d")
    cut = conform(df, "A int, b varchar(3), c decimal(4,1), gone date", allow_truncation=True)
    assert tuple(cut.first()) == (1, "abc", Decimal("12.3"), None)
    for schema in ("a int", "b varchar(3)", "c decimal(4,1)"):
        with pytest.raises(Exception, match="value of column"):
            conform(df, schema).collect()
    assert tuple(conform(df, "a float, b varchar(6), c decimal(9,4)").first()) == (1.25, "abcdef", Decimal("12.3450"))
    noon = spark.sql("SELECT TIMESTAMP '2020-01-01 12:00:00' AS t")
    with pytest.raises(Exception, match="value of column"):
        conform(noon, "t date").collect()
    assert str(conform(noon, "t date", allow_truncation=True).first()[0]) == "2020-01-01"
    with pytest.raises(ValueError, match="boolean"):
        conform(df, "d int")


def test_conform_never_hides_overflow(spark):
    with pytest.raises(Exception, match="(?i)overflow"):
        conform(spark.sql("SELECT 3000000000L AS a"), "a int", allow_truncation=True).collect()


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo"])
def test_run_time_is_the_same_in_every_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.sql("SELECT timestamp_millis(1662063613123) AS t")
        text = run_time_text(F.col("t"))
        assert tuple(df.select(text, run_stamp(text)).first()) == ("2022-09-01 17:20:13.123", "20220901172013123")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_epoch_milliseconds(spark):
    df = spark.createDataFrame([(0,), (1662063613123,), (None,)], "ms long")
    assert [r[0] for r in df.select(epoch_ms_to_date(F.col("ms"))).collect()] == ["1970-01-01", "2022-09-01", None]


def test_fixed_text(spark):
    assert fixed(spark, F.lit("x")) == "x"


def test_paths_and_keys():
    assert table_path("s3://lake/", "raw", "north", "erp", "sales", "drawer") == "s3://lake/raw/north/erp/sales/drawer"
    assert unit_path("raw/x", "mb") == "raw/x/mb/" and unit_path("raw/%bu%/x", "mb", template=True) == "raw/mb/x"
    assert split_keys("A/B/C") == ["A", "B", "C"]
    with pytest.raises(ValueError):
        split_keys("")


def test_dates_survive(spark):
    df = spark.createDataFrame([(datetime.date(2020, 1, 1),)], "d date")
    assert conform(df, "d timestamp").first()[0] == datetime.datetime(2020, 1, 1)
