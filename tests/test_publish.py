import json
import os

import pytest
from pyspark.sql import functions as F

from zonemill.plans.deliveries import TrustedTable, load_delivery, repartition_table, touched_months
from zonemill.sources import files, publish
from zonemill.sources.publish import applied, publish_table, staging_path, table_exists


def snapshot(path):
    found = {}
    for folder, _, names in os.walk(path):
        for name in names:
            with open(f"{folder}/{name}", "rb") as f:
                found[os.path.relpath(f"{folder}/{name}", path)] = f.read()
    return found


def values(spark, path):
    return sorted(tuple(r) for r in spark.read.parquet(path).collect())


def test_a_table_may_be_replaced_by_a_query_on_itself(spark, lake):
    publish_table(spark.range(5), lake)
    assert publish_table(spark.read.parquet(lake).filter("id > 2"), lake) == 2
    assert values(spark, lake) == [(3,), (4,)]
    assert not os.path.exists(staging_path(lake))


def test_touched_partitions_only(spark, lake):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, None)], "v int, p string")
    publish_table(rows, lake, "p", record={"n": 1})
    before = snapshot(f"{lake}/p=a")
    new = spark.createDataFrame([(20, "b")], "v int, p string")
    publish_table(new, lake, "p", touched=["b", "c", None])
    assert values(spark, lake) == [(1, "a"), (20, "b")]
    assert snapshot(f"{lake}/p=a") == before and not os.path.exists(f"{lake}/p=c")
    assert applied(spark, lake) == {"n": 1}


def test_failed_write_leaves_the_table_as_it_was(spark, lake):
    publish_table(spark.range(5), lake)
    before = snapshot(lake)
    broken = spark.read.parquet(lake).select(F.raise_error(F.lit("broken")).cast("long").alias("id"))
    with pytest.raises(Exception, match="broken"):
        publish_table(broken, lake)
    assert snapshot(lake) == before
    assert table_exists(spark, lake) and not os.path.exists(staging_path(lake))


@pytest.mark.parametrize("step", range(6))
def test_a_publish_cut_off_anywhere_is_finished_or_discarded(spark, lake, monkeypatch, step):
    """Stop before the n-th file operation, then recover: all old or all new, never mixed."""
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "v int, p string")
    publish_table(old, lake, "p", record={"n": 1})
    new = spark.createDataFrame([(10, "a"), (20, "b")], "v int, p string")
    calls = iter(range(100))

    def interrupted(function):
        def run(*args):
            if next(calls) >= step:
                raise KeyboardInterrupt
            return function(*args)

        return run

    recover = publish.recover
    monkeypatch.setattr(publish, "recover", lambda *a: None)
    for name in ("write_text", "delete", "move"):
        monkeypatch.setattr(files, name, interrupted(getattr(files, name)))
    with pytest.raises(KeyboardInterrupt):
        publish_table(new, lake, "p", touched=["a", "b", "c"], record={"n": 2})
    monkeypatch.undo()
    assert publish.recover is recover and table_exists(spark, lake)
    if step == 0:
        assert values(spark, lake) == [(1, "a"), (2, "b"), (3, "c")] and applied(spark, lake) == {"n": 1}
    else:
        assert values(spark, lake) == [(10, "a"), (20, "b")] and applied(spark, lake) == {"n": 2}
    assert not os.path.exists(staging_path(lake))


def test_an_interrupted_full_replacement_is_not_a_first_load(spark, lake):
    publish_table(spark.range(5), lake)
    staging = staging_path(lake)
    spark.range(7).write.parquet(f"{staging}/data")
    files.write_text(spark, f"{staging}/_plan", json.dumps({"replace": [""], "remove": [], "record": None}))
    files.delete(spark, lake)
    assert table_exists(spark, lake)
    assert spark.read.parquet(lake).count() == 7


SCHEMA = "k int, d date, v string"


def delivery(spark, *rows):
    return spark.createDataFrame(rows, "k int, d string, v string").withColumn("d", F.col("d").cast("date"))


def test_only_touched_months_are_rewritten(spark, lake):
    table = TrustedTable(lake, ["K"], "D", partitioned=True)
    load_delivery(
        spark,
        delivery(spark, (1, "2020-01-01", "a"), (2, "2020-02-01", ""), (3, "2020-03-01", "c"), (4, None, "d")),
        table,
    )
    before = {m: snapshot(f"{lake}/PARTITION_DT={m}") for m in ("2020-02", "2020-03")}
    # Key 1 moves from January to May; January has no rows left.
    assert load_delivery(spark, delivery(spark, (1, "2020-05-01", "A"), (5, "2020-05-02", "e")), table) == 2
    assert not os.path.exists(f"{lake}/PARTITION_DT=2020-01")
    assert {m: snapshot(f"{lake}/PARTITION_DT={m}") for m in before} == before
    held = {r["k"]: (r["v"], r["PARTITION_DT"]) for r in spark.read.parquet(lake).collect()}
    assert held == {
        1: ("A", "2020-05"), 2: (None, "2020-02"), 3: ("c", "2020-03"), 4: ("d", None), 5: ("e", "2020-05")
    }
    load_delivery(spark, delivery(spark, (4, "2020-03-05", "D")), table)
    held = {r["k"]: r["PARTITION_DT"] for r in spark.read.parquet(lake).collect()}
    assert held[4] == "2020-03" and not os.path.exists(f"{lake}/PARTITION_DT={publish.NULL_PARTITION}")


def test_months_follow_from_a_date_key_without_a_look_at_the_table(spark, lake):
    table = TrustedTable(lake, ["k", "d"], "d", partitioned=True)
    load_delivery(spark, delivery(spark, (1, "2020-01-01", "a"), (2, "2020-02-01", "b")), table)
    current = spark.read.parquet(lake)
    batch = delivery(spark, (2, "2020-02-01", "B"), (1, "2020-03-01", "n")).withColumn(
        "PARTITION_DT", F.date_format("d", "yyyy-MM")
    )
    assert sorted(touched_months(current, batch, table)) == ["2020-02", "2020-03"]
    assert sorted(touched_months(current, batch, TrustedTable(lake, ["k"], "d", True))) == [
        "2020-01", "2020-02", "2020-03"
    ]


def test_bad_key_leaves_the_trusted_table_intact(spark, lake):
    load_delivery(spark, delivery(spark, (1, "2020-01-01", "a")), TrustedTable(lake, ["k"]))
    before = snapshot(lake)
    with pytest.raises(ValueError, match="no column"):
        load_delivery(spark, delivery(spark, (2, "2020-01-01", "b")), TrustedTable(lake, ["other"]))
    twice = delivery(spark, (1, "2020-01-01", "b"), (1, "2020-01-01", "c"))
    with pytest.raises(Exception, match="several source rows"):
        load_delivery(spark, twice, TrustedTable(lake, ["k"]))
    assert snapshot(lake) == before


def test_a_delivery_without_the_date_column(spark, lake):
    table = TrustedTable(lake, ["k"], "d", partitioned=True)
    load_delivery(spark, delivery(spark, (1, "2020-01-01", "a"), (2, "2020-02-01", "b")), table)
    load_delivery(spark, delivery(spark, (1, None, "A"), (3, None, "c")).drop("d"), table)
    held = {r["k"]: (r["v"], r["PARTITION_DT"]) for r in spark.read.parquet(lake).collect()}
    assert held == {1: ("A", "2020-01"), 2: ("b", "2020-02"), 3: ("c", None)}


def test_table_built_without_months_is_rewritten(spark, lake):
    load_delivery(spark, delivery(spark, (1, "2020-01-01", "a")), TrustedTable(lake, ["k"]), record={"n": 1})
    load_delivery(spark, delivery(spark, (2, "2020-02-01", "b")), TrustedTable(lake, ["k"], "d", partitioned=True))
    assert values(spark, lake)[0][-1] == "2020-01" and os.path.exists(f"{lake}/PARTITION_DT=2020-02")
    assert repartition_table(spark, lake, "d") == 2 and applied(spark, lake) == {"n": 1}


def test_new_column_with_evolution(spark, lake):
    table = TrustedTable(lake, ["k"], "d", partitioned=True, merge_options={"evolve": True})
    load_delivery(spark, delivery(spark, (1, "2020-01-01", "a"), (2, "2020-02-01", "b")), table)
    load_delivery(spark, delivery(spark, (2, "2020-02-01", "B")).withColumn("x", F.lit(7)), table)
    load_delivery(spark, delivery(spark, (3, "2020-03-01", "c")), table)
    held = {r["k"]: r["x"] for r in spark.read.option("mergeSchema", True).parquet(lake).collect()}
    assert held == {1: None, 2: 7, 3: None}


def test_unmatched_rows_are_not_shuffled_for_a_small_delivery(spark, lake, tmp_path, monkeypatch):
    table = TrustedTable(lake, ["k"], "d", partitioned=True)
    days = F.expr("date_add(DATE '2020-01-01', CAST(k % 60 AS INT))")
    first = spark.range(0, 3000).selectExpr("CAST(id AS INT) AS k", "CAST(id AS STRING) AS v").withColumn("d", days)
    first.write.parquet(f"{tmp_path}/first")
    load_delivery(spark, spark.read.parquet(f"{tmp_path}/first"), table)
    first.filter("k BETWEEN 2990 AND 3000").withColumn("v", F.lit("new")).write.parquet(f"{tmp_path}/second")
    plans = []
    publish_ = publish.publish_table

    def kept(df, *args, in_place=None, **kwargs):
        plans.append(in_place._jdf.queryExecution().executedPlan().toString())
        return publish_(df, *args, in_place=in_place, **kwargs)

    monkeypatch.setattr("zonemill.plans.deliveries.publish_table", kept)
    load_delivery(spark, spark.read.parquet(f"{tmp_path}/second"), table)
    (plan,) = plans
    assert "LeftAnti" in plan and "Exchange hashpartitioning" not in plan
    held = spark.read.parquet(lake)
    assert held.count() == 3000 and held.filter("v = 'new'").count() == 10
    assert held.filter("PARTITION_DT <> date_format(d, 'yyyy-MM')").count() == 0


def test_an_emptied_table_is_loaded_anew(spark, lake):
    table = TrustedTable(lake, ["k"], "d", partitioned=True)
    none = delivery(spark, (1, "2020-01-01", "a")).filter("k > 1")
    assert load_delivery(spark, none, table, record={"n": 1}) == 0
    assert applied(spark, lake) == {"n": 1} and not table_exists(spark, lake)
    load_delivery(spark, delivery(spark, (1, "2020-01-01", "a")), table, record={"n": 2})
    assert load_delivery(spark, none, table, as_of="2020-01-01", record={"n": 3}) == 0
    assert not table_exists(spark, lake) and applied(spark, lake) == {"n": 3}
    assert load_delivery(spark, delivery(spark, (2, "2020-01-01", "b")), table) == 1
    assert values(spark, lake)[0][0] == 2 and applied(spark, lake) == {"n": 3}


def test_a_delivery_rewrites_the_buckets_of_its_keys_only(spark, lake):
    table = TrustedTable(lake, ["K"], "d", buckets=16)
    first = spark.range(200).selectExpr("CAST(id AS INT) AS k", "DATE '2020-01-01' AS d", "'old' AS v")
    load_delivery(spark, first, table, record={"n": 1})
    assert applied(spark, lake) == {"n": 1, "buckets": 16}
    before = {p: snapshot(f"{lake}/{p}") for p in os.listdir(lake) if p.startswith("KEY_BUCKET")}
    assert len(before) == 16
    # The delivery has its key in another type.
    second = spark.createDataFrame([(7, "2020-02-01", "new"), (500, "2020-02-01", "new")], "k long, d string, v string")
    load_delivery(spark, second.withColumn("d", F.col("d").cast("date")), table)
    changed = {p for p in before if snapshot(f"{lake}/{p}") != before[p]}
    held = {r["k"]: (r["v"], r["KEY_BUCKET"]) for r in spark.read.parquet(lake).collect()}
    assert len(held) == 201 and held[7][0] == held[500][0] == "new"
    assert changed == {f"KEY_BUCKET={held[7][1]}", f"KEY_BUCKET={held[500][1]}"}
    # The window delete reaches rows of every bucket, another number of buckets moves every row.
    load_delivery(spark, second.limit(0).withColumn("d", F.col("d").cast("date")), table, as_of="2020-02-20")
    assert {r["k"] for r in spark.read.parquet(lake).collect()} == set(range(200)) - {7}
    load_delivery(spark, first.filter("k < 3").withColumn("v", F.lit("third")), TrustedTable(lake, ["K"], "d", buckets=3))
    held = {r["k"]: r["KEY_BUCKET"] for r in spark.read.parquet(lake).collect()}
    assert len(held) == 199 and set(held.values()) == {0, 1, 2}
    with pytest.raises(ValueError, match="not both"):
        TrustedTable(lake, ["k"], "d", partitioned=True, buckets=2)
