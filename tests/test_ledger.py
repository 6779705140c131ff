import glob

import pytest
from pyspark.sql import functions as F

from zonemill.functions.keys import MergeKeys
from zonemill.plans import deliveries
from zonemill.plans.deliveries import TrustedTable, load_delivery
from zonemill.sources import files, ledger, publish
from zonemill.sources.publish import applied, publish_table, table_exists


def delivery(spark, *rows):
    return spark.createDataFrame(rows, "k int, d string, v string").withColumn("d", F.col("d").cast("date"))


def held_rows(spark, path):
    return sorted((r["k"], str(r["d"]), r["v"]) for r in spark.read.option("mergeSchema", True).parquet(path).collect())


def candidates(spark, path, keys, rows):
    held = ledger.held(spark, path)
    on = MergeKeys(held.rows, keys, "the target")
    return ledger.candidate_partitions(held, path, on, on.project(rows).distinct())


def test_no_footer_of_an_untouched_month_is_read(spark, lake):
    table = TrustedTable(lake, ["k", "d"], "d", partitioned=True, key_digests=True)
    load_delivery(spark, delivery(spark, (1, "2020-01-01", "a"), (2, "2020-02-01", "b"), (3, "2020-03-01", "c")), table)
    (other,) = glob.glob(f"{lake}/PARTITION_DT=2020-02/*.parquet")
    with open(other, "wb") as f:
        f.write(b"no footer here")
    assert load_delivery(spark, delivery(spark, (3, "2020-03-01", "C"), (4, "2020-03-02", "n")), table) == 2
    march = spark.read.parquet(f"{lake}/PARTITION_DT=2020-03")
    assert sorted((r["k"], r["v"]) for r in march.collect()) == [(3, "C"), (4, "n")]
    assert applied(spark, lake) == {}


def test_columns_and_rows_of_another_writer_are_seen(spark, lake):
    table = TrustedTable(lake, ["k"], "d", partitioned=True, key_digests=True)
    load_delivery(spark, delivery(spark, (1, "2020-01-01", "a"), (2, "2020-02-01", "b")), table)
    more = delivery(spark, (9, "2020-02-05", "x")).withColumn("extra", F.lit(7))
    more.write.mode("append").parquet(f"{lake}/PARTITION_DT=2020-02")
    assert ledger.held(spark, lake).unknown == {"PARTITION_DT=2020-02"}
    # Key 9 is in no digest, but the files of its month are not the recorded ones.
    load_delivery(spark, delivery(spark, (9, "2020-03-01", "X")), table)
    assert held_rows(spark, lake) == [(1, "2020-01-01", "a"), (2, "2020-02-01", "b"), (9, "2020-03-01", "X")]
    held = ledger.held(spark, lake)
    assert not held.unknown and {r["k"]: r["extra"] for r in held.rows.collect()} == {1: None, 2: None, 9: 7}


def test_a_table_without_a_record_gets_one(spark, lake):
    rows = delivery(spark, (1, "2020-01-01", "a"), (2, "2020-02-01", "b")).withColumn("PARTITION_DT", F.date_format("d", "yyyy-MM"))
    rows.write.partitionBy("PARTITION_DT").parquet(lake)
    table = TrustedTable(lake, ["k"], "d", partitioned=True, key_digests=True)
    load_delivery(spark, delivery(spark, (2, "2020-02-02", "B")), table)
    held = ledger.held(spark, lake)
    assert held.files.keys() == {"PARTITION_DT=2020-01", "PARTITION_DT=2020-02"} and not held.unknown
    assert candidates(spark, lake, ["k"], delivery(spark, (5, "2020-02-01", ""))) == ["2020-01"]  # no digest of it yet
    load_delivery(spark, delivery(spark, (1, "2020-01-09", "A")), table)
    assert candidates(spark, lake, ["k"], delivery(spark, (5, "2020-02-01", ""))) == []
    assert held_rows(spark, lake) == [(1, "2020-01-09", "A"), (2, "2020-02-02", "B")]


def test_only_months_that_may_hold_a_key_are_looked_at(spark, lake, monkeypatch):
    table = TrustedTable(lake, ["K"], "d", partitioned=True, key_digests=True)
    months = F.expr("add_months(DATE '2020-01-15', CAST(k % 6 AS INT))")
    rows = spark.range(600).select(F.col("id").cast("int").alias("k"), F.lit("old").alias("v")).withColumn("d", months)
    load_delivery(spark, rows, table)
    assert candidates(spark, lake, ["K"], spark.createDataFrame([(7,), (13,)], "K int")) == ["2020-02"]
    assert candidates(spark, lake, ["K"], spark.createDataFrame([(1000,)], "K int")) == []  # above every key
    assert candidates(spark, lake, ["v"], rows) is None  # digests of other keys
    looked = []
    touched = deliveries._is_one_of
    monkeypatch.setattr(deliveries, "_is_one_of", lambda name, values: looked.append(values) or touched(name, values))
    load_delivery(spark, rows.filter("k = 13").withColumn("v", F.lit("new")), table)
    assert looked == [["2020-02"], ["2020-02"]]
    plan = ledger.held(spark, lake).rows.filter(touched("PARTITION_DT", looked[0]))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(PARTITION_DT" in plan and "= 2020-02" in plan
    # A key that moves out of its month, and one that is new.
    moved = rows.filter("k IN (14, 599)").withColumns({"d": F.lit("2021-01-01").cast("date"), "k": F.when(F.col("k") == 599, 700).otherwise(14)})
    load_delivery(spark, moved, table)
    assert candidates(spark, lake, ["K"], spark.createDataFrame([(14,)], "K int")) == ["2021-01"]
    held = {r["k"]: (r["v"], str(r["d"])[:7]) for r in spark.read.parquet(lake).collect()}
    assert len(held) == 601 and held[13] == ("new", "2020-02") and held[14] == ("old", "2021-01") and held[700][1] == "2021-01"


def test_false_candidates_only_cost_time(spark, lake, tmp_path, monkeypatch):
    first = delivery(spark, (1, "2020-01-01", "a"), (2, "2020-02-01", "b"), (None, "2020-03-01", "c"), (4, None, "d"))
    second = delivery(spark, (2, "2020-04-01", "B"), (None, "2020-05-01", "C"), (4, None, "D"), (6, "2020-01-09", "f"))
    tables = [TrustedTable(f"{lake}/{n}", ["k"], "d", partitioned=True, key_digests=True) for n in ("exact", "all")]
    for table in tables:
        load_delivery(spark, first, table)
    load_delivery(spark, second, tables[0])
    monkeypatch.setattr(ledger, "candidate_partitions", lambda held, *a: [ledger.partition_value(d) for d in held.files])
    load_delivery(spark, second, tables[1])
    expected = [(1, "2020-01-01", "a"), (2, "2020-04-01", "B"), (4, "None", "D"), (6, "2020-01-09", "f"), (None, "2020-05-01", "C")]
    for table in tables:
        found = spark.read.parquet(table.path).collect()
        assert sorted(((r["k"], str(r["d"]), r["v"]) for r in found), key=repr) == sorted(expected, key=repr)


@pytest.mark.parametrize("step", range(1, 9))
def test_digests_of_a_publish_that_was_cut_off_are_those_of_its_data(spark, lake, monkeypatch, step):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "v int, p string")
    publish_table(old, lake, "p", keys=["v"])
    new = spark.createDataFrame([(10, "a"), (20, "b")], "v int, p string")
    calls = iter(range(100))

    def interrupted(function):
        def run(*args):
            if next(calls) >= step:
                raise KeyboardInterrupt
            return function(*args)

        return run

    monkeypatch.setattr(publish, "recover", lambda *a: None)
    for name in ("write_text", "delete", "move"):
        monkeypatch.setattr(files, name, interrupted(getattr(files, name)))
    with pytest.raises(KeyboardInterrupt):
        publish_table(new, lake, "p", touched=["a", "b"], keys=["v"])
    monkeypatch.undo()
    assert table_exists(spark, lake)
    where = {v: candidates(spark, lake, ["v"], spark.createDataFrame([(v,)], "v int")) for v in (1, 2, 3, 10, 20)}
    assert where == {1: [], 2: [], 3: ["c"], 10: ["a"], 20: ["b"]}
