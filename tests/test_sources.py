import os

import pytest
from pyspark.sql import functions as F

from zonemill.sources import files
from zonemill.sources.datasets import (
    read_by_unit,
    read_units,
    read_control_csv,
    read_parquet,
    read_table,
    register_query_views,
    register_views,
    tagged_union,
    write_dataset,
)

ORDERS = "/root/testdata/sf0.001/orders.parquet"


def part_files(path):
    return [f for _, _, names in os.walk(path) for f in names if f.startswith("part-")]


def test_partition_value_prunes_and_can_be_dropped(spark, lake):
    write_dataset(spark.read.parquet(ORDERS), lake, partition_by="o_orderstatus")
    kept = read_parquet(spark, lake, "o_orderstatus", "F")
    assert "o_orderstatus" in kept.columns
    assert "PartitionFilters: [isnotnull(o_orderstatus" in kept._jdf.queryExecution().executedPlan().toString()
    dropped = read_parquet(spark, lake, "o_orderstatus", "F", keep_partition_col=False)
    assert "o_orderstatus" not in dropped.columns and dropped.count() == kept.count() > 0
    # Only both arguments together filter.
    assert read_parquet(spark, lake, "o_orderstatus").count() == read_parquet(spark, lake).count() == 1500


def test_glob_reads_only_matching_files(spark, lake):
    write_dataset(spark.range(5), lake)
    assert read_parquet(spark, lake).count() == 5
    assert read_parquet(spark, lake, glob="none*.parquet", schema="id long").count() == 0


def test_units(spark, lake):
    for unit, n in (("mb", 2), ("vq", 3)):
        write_dataset(spark.range(n), f"{lake}/{unit}")
    units = read_by_unit(spark, lake, ["mb", "vq"])
    assert {u: df.count() for u, df in units.items()} == {"mb": 2, "vq": 3}
    assert read_by_unit(spark, lake, None) == {}
    assert tagged_union(units).groupBy("bu").count().count() == 2
    with pytest.raises(ValueError):
        tagged_union({})


def test_partitioned_write_has_few_files(spark, lake):
    spread = spark.read.parquet(ORDERS).repartition(16).withColumn("m", F.date_format("o_orderdate", "yyyy-MM"))
    write_dataset(spread, lake, partition_by="m")
    months = spread.select("m").distinct().count()
    assert len(part_files(lake)) <= months + 4
    assert read_table(spark, lake).count() == 1500


def test_a_partition_with_most_rows_is_split_over_tasks(spark, lake):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200KB")
    try:
        rows = spark.range(0, 40000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 20).cast("string")).alias("m"),
            F.md5(F.col("id").cast("string")).alias("v"),
        )
        write_dataset(rows, lake, partition_by="m")
        assert len(part_files(f"{lake}/m=hot")) > 1
        assert spark.read.parquet(lake).count() == 40000
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_number_of_files_and_modes(spark, lake):
    write_dataset(spark.range(100), lake, files=3)
    assert len(part_files(lake)) == 3
    write_dataset(spark.range(10), lake, files=1)
    assert spark.read.parquet(lake).count() == 110
    write_dataset(spark.range(10), lake, mode="overwrite", schema="id string")
    assert read_table(spark, lake).dtypes == [("id", "string")]


def test_control_csv(spark, lake):
    os.makedirs(lake)
    with open(f"{lake}/t.csv", "w") as f:
        f.write("a;b\n1;x y\n2;\n")
    assert [tuple(r) for r in read_control_csv(spark, lake, "a int, b string").collect()] == [(1, "x y"), (2, None)]


def test_inventory_shows_empty_files_and_size_is_a_sum(spark, lake):
    os.makedirs(f"{lake}/d/e")
    for name, size in (("a.parquet", 0), ("d/b.parquet", 10), ("d/e/c.parquet", 5)):
        with open(f"{lake}/{name}", "wb") as f:
            f.write(b"x" * size)
    listed = {r["name"]: (r["is_directory"], r["length"]) for r in files.file_inventory(spark, lake).collect()}
    assert listed["a.parquet"] == (False, 0) and listed["d"][0]
    sizes = files.dataset_size(spark, lake)
    assert sizes.first()["bytes"] == 15
    plan = sizes._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<length:bigint>" in plan
    assert files.file_inventory(spark, f"{lake}/none").count() == 0


def test_views(spark, lake):
    write_dataset(spark.range(4), lake)
    register_views(spark, {"numbers": lake})
    register_query_views(spark, {"even": "SELECT id FROM numbers WHERE id % 2 = 0"})
    assert spark.sql("SELECT count(*) FROM even").first()[0] == 2


def test_small_texts_and_moves(spark, lake):
    assert files.read_text(spark, f"{lake}/t") is None
    files.write_text(spark, f"{lake}/t", "ação")
    files.write_text(spark, f"{lake}/t", "ação 2")
    assert files.read_text(spark, f"{lake}/t") == "ação 2"
    files.move(spark, f"{lake}/t", f"{lake}/deep/u")
    assert not files.exists(spark, f"{lake}/t")
    files.write_text(spark, f"{lake}/t", "")
    with pytest.raises(FileExistsError):
        files.move(spark, f"{lake}/t", f"{lake}/deep/u")


def test_units_are_one_scan_pruned_by_the_file_path(spark, lake):
    rows = spark.createDataFrame([(1, "a b"), (2, "a b"), (3, "c+d%"), (4, "é")], "v int, u string")
    rows.write.partitionBy("u").parquet(f"{lake}/t")
    rows.filter("v = 1").select("v", "v").toDF("v", "extra").write.parquet(f"{lake}/s/x.y/data")
    rows.filter("v > 1").select("v").write.parquet(f"{lake}/s/z/data")
    every = read_units(spark, f"{lake}/t/u=%bu%", template=True)
    assert every._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert len(every.inputFiles()) >= 3
    found = sorted((r["v"], r["bu"]) for r in every.collect())
    assert [v for v, _ in found] == [1, 2, 3, 4] and found[0][1] == "a b" and found[3][1] == "é"
    some = read_units(spark, f"{lake}/t/u=%bu%", ["a b"], template=True, tag="unit")
    assert sorted((r["v"], r["unit"]) for r in some.collect()) == [(1, "a b"), (2, "a b")]
    below = read_units(spark, f"{lake}/s/%bu%/data/", template=True)
    assert sorted((r["v"], r["extra"], r["bu"]) for r in below.collect()) == [(1, 1, "x.y"), (2, None, "z"), (3, None, "z"), (4, None, "z")]
    one = below.filter("bu = 'z'")
    one.collect()
    metrics = one._jdf.queryExecution().executedPlan()
    assert "file_path" in metrics.toString()
    with pytest.raises(ValueError, match="no units"):
        read_units(spark, f"{lake}/t", [])
    with pytest.raises(ValueError, match="no %bu%"):
        read_units(spark, f"{lake}/t", template=True)
