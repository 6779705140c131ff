import os

import pytest
from pyspark.sql import functions as F

from zonemill.layout import PURGE_GREW_MESSAGE
from zonemill.operators.compact import compact
from zonemill.plans.purge import MEASURE_SCHEMA, audit_rows, purge, purge_dataset, purge_list


def test_compact_stamps_the_greatest_value(spark):
    df = spark.createDataFrame(
        [(1, "a", "2020-01-01"), (1, "a", "2020-01-03"), (2, None, None), (2, None, "2020-01-02")],
        "k int, v string, u string",
    )
    assert sorted(tuple(r) for r in compact(df, "U").collect()) == [(1, "a", "2020-01-03"), (2, None, "2020-01-03")]


def test_compact_without_any_update_value(spark):
    df = spark.createDataFrame([(1, None), (1, None)], "k int, u date")
    assert [tuple(r) for r in compact(df, "u").collect()] == [(1, None)]
    assert compact(df.filter("k = 2"), "u").count() == 0


def test_compact_has_no_cross_join_and_no_window(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    plan = compact(events.select("user_id", "ts"), "ts")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Window" not in plan and "Subquery" in plan


def test_purged_twice_and_milliseconds(spark, lake):
    spark.createDataFrame([(1, 86400000), (1, 172800000), (2, None)], "k int, u long").write.parquet(lake)
    purge_dataset(spark, lake, "u", convert_date=True)
    assert os.listdir(lake) == ["u=1970-01-03"] or "u=1970-01-03" in os.listdir(lake)
    once = sorted(map(tuple, spark.read.parquet(lake).collect()))
    assert [r[0] for r in once] == [1, 2]
    parts = [f for f in os.listdir(f"{lake}/u=1970-01-03") if f.startswith("part-")]
    assert len(parts) == 1
    purge_dataset(spark, lake, "u", convert_date=True)
    assert sorted(map(tuple, spark.read.parquet(lake).collect())) == once


def test_audit_labels(spark):
    measured = spark.createDataFrame(
        [("c", "a", "t", 10.0, 4.0, None), ("c", "b", "t", 4.0, 10.0, None), ("c", "d", "t", 0.0, 0.0, "boom"),
         ("c", "e", "t", 5.0, 5.0, None)],
        MEASURE_SCHEMA,
    )
    audit = audit_rows(measured, "now").collect()
    rows = {r["path"]: (r["size_difference"], r["status"], r["msg_error"]) for r in audit}
    assert rows == {
        "a": (6.0, "OK", ""), "b": (-6.0, "NOK", PURGE_GREW_MESSAGE), "d": (0.0, "NOK", "boom"), "e": (0.0, "OK", "")
    }
    assert audit_rows(measured, "now").dtypes[3:6] == [
        ("initial_size", "double"), ("final_size", "double"), ("size_difference", "double")
    ]


def test_work_from_the_control_file(spark, lake):
    os.makedirs(lake)
    with open(f"{lake}/tb_purge.csv", "w") as f:
        f.write("container;path;tb_name;update_column;table_type;convert_date\n")
        f.write("c;raw/a/;a;u;NT;N\nc;raw/b/;b;u;OT;N\nc; / ;c;u;NT;N\nc;\\;d;u;NT;N\nc;;e;u;NT;N\n")
    assert [r["tb_name"] for r in purge_list(spark, control_csv=lake).collect()] == ["a"]


def test_given_paths_have_three_to_six_fields(spark):
    rows = purge_list(spark, [("c", "raw/a/", "u"), ("c", "raw/b/", "b", "u"), ("c", None, "x", "u")]).collect()
    assert [(r["tb_name"], r["update_column"], r["table_type"]) for r in rows] == [(None, "u", None), ("b", "u", None)]
    with pytest.raises(ValueError):
        purge_list(spark, [("c", "p")])
    with pytest.raises(ValueError):
        purge_list(spark)


def test_a_failed_dataset_keeps_its_data_and_the_others_go_on(spark, lake):
    for name in ("a", "b"):
        spark.range(3).select((F.col("id") % 1).alias("k"), F.col("id").alias("u")).write.parquet(f"{lake}/c/{name}")
    listed = purge_list(spark, [("c", "a", "missing"), ("c", "b", "u")])
    audit = purge(spark, listed, lambda c, p: f"{lake}/{c}/{p}", f"{lake}/result")
    rows = {r["path"]: r for r in audit.collect()}
    assert rows["a"]["status"] == "NOK" and "missing" in rows["a"]["msg_error"] and rows["b"]["status"] == "OK"
    assert spark.read.parquet(f"{lake}/c/a").count() == 3 and spark.read.parquet(f"{lake}/c/b").count() == 1
    purge(spark, listed, lambda c, p: f"{lake}/{c}/{p}", f"{lake}/result")
    assert spark.read.parquet(f"{lake}/result").count() == 4


def test_a_second_purge_reads_none_of_the_files_of_the_first(spark, lake):
    import glob

    rows = spark.createDataFrame([(1, "a", 5), (1, "a", 7), (2, "b", 6)], "k int, v string, updated long")
    rows.write.parquet(lake)
    purge_dataset(spark, lake, "updated")
    (kept,) = glob.glob(f"{lake}/updated=7/*.parquet")
    with open(kept, "rb") as f:
        data = f.read()
    with open(kept, "wb") as f:
        f.write(b"not to be read")
    first, second = purge_dataset(spark, lake, "UPDATED")
    assert first == second
    with open(kept, "wb") as f:
        f.write(data)
    spark.createDataFrame([(1, "a"), (3, "c")], "k int, v string").write.mode("append").parquet(f"{lake}/updated=9")
    purge_dataset(spark, lake, "updated")
    assert sorted(tuple(r) for r in spark.read.parquet(lake).collect()) == [(1, "a", 9), (2, "b", 9), (3, "c", 9)]
