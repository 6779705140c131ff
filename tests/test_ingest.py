import os
import shutil

import pytest
from pyspark.sql import functions as F

from zonemill.layout import FAILED_ZONE, RAW_ZONE, TRUSTED_ZONE
from zonemill.plans import loads
from zonemill.plans.loads import extract_to_raw, new_stamp, raw_to_trusted, zone_path
from zonemill.plans.deliveries import TrustedTable
from zonemill.sources import files
from zonemill.sources.publish import applied
from zonemill.streaming import ingest
from zonemill.streaming.ingest import ingest_stream


class Lake:
    def __init__(self, spark, root):
        self.spark, self.root = spark, root
        self.raw, self.path = f"{root}/raw", f"{root}/trusted"
        self.table = TrustedTable(self.path, ["k"], "d", partitioned=True)

    def land(self, stamp, *rows, single=False):
        df = self.spark.createDataFrame(rows, "k int, d string, v string").withColumn("d", F.col("d").cast("date"))
        goal = f"{self.raw}/{stamp}_t.parquet"
        if single:
            df.coalesce(1).write.parquet(f"{self.root}/one{stamp}")
            (part,) = [f for f in os.listdir(f"{self.root}/one{stamp}") if f.startswith("part-")]
            os.makedirs(self.raw, exist_ok=True)
            shutil.copy(f"{self.root}/one{stamp}/{part}", goal)
        else:
            df.repartition(2).write.parquet(goal)

    def ingest(self, as_of=None, combine=False):
        ingest_stream(
            self.spark, self.raw, self.table, f"{self.root}/checkpoint", f"{self.root}/archive",
            f"{self.root}/failed", as_of, combine,
        )

    def held(self):
        return {r["k"]: r["v"] for r in self.spark.read.parquet(self.path).collect()}


@pytest.fixture
def lake_(spark, lake):
    return Lake(spark, lake)


def test_files_and_directories_in_name_order(spark, lake_):
    lake_.land("002", (1, "2020-02-01", "second"), (2, "2020-02-01", ""))
    lake_.land("001", (1, "2020-01-01", "first"), (3, "2020-01-01", "third"), single=True)
    lake_.ingest()
    assert lake_.held() == {1: "second", 2: None, 3: "third"}
    done = applied(spark, lake_.path)
    assert done["batch"] == 0 and done["deliveries"] == ["001_t.parquet", "002_t.parquet"]


def test_nothing_waiting_is_no_run(spark, lake_):
    lake_.ingest("2020-01-01")
    assert not os.path.exists(lake_.path)
    lake_.land("001", (1, "2020-01-01", "a"))
    lake_.ingest()
    before = applied(spark, lake_.path)
    lake_.ingest("2020-01-15")
    assert lake_.held() == {1: "a"} and applied(spark, lake_.path) == before


def test_empty_files_are_rejected_before_the_stream(spark, lake_):
    lake_.land("001", (1, "2020-01-01", "a"))
    for stamp in ("000", "002", "003"):
        with open(f"{lake_.raw}/{stamp}_t.parquet", "wb"):
            pass
    lake_.ingest()
    assert lake_.held() == {1: "a"}
    failed = os.listdir(f"{lake_.root}/failed")
    assert {"000_t.parquet", "002_t.parquet", "003_t.parquet"} <= set(failed)
    assert [n for n in os.listdir(lake_.raw) if not n.startswith(".")] == []


def test_merged_deliveries_are_archived_under_their_names(spark, lake_):
    lake_.land("001", (1, "2020-01-01", "a"), single=True)
    lake_.land("002", (2, "2020-01-01", "b"))
    lake_.ingest()
    shown = lambda path: sorted(n for n in os.listdir(path) if not n.startswith("."))
    assert shown(lake_.raw) == [] and shown(f"{lake_.root}/archive") == ["001_t.parquet", "002_t.parquet"]
    assert spark.read.parquet(f"{lake_.root}/archive/002_t.parquet").count() == 1
    assert lake_.held() == {1: "a", 2: "b"}


def test_archive_of_a_path_with_a_file_system(spark, lake):
    lake_ = Lake(spark, lake)
    lake_.land("001", (1, "2020-01-01", "a"))
    table = TrustedTable(f"file://{lake_.path}", ["k"], "d", partitioned=True)
    places = [f"file://{lake}/{name}" for name in ("checkpoint", "archive/t", "failed")]
    ingest_stream(spark, f"file://{lake_.raw}", table, *places)
    assert os.path.isdir(f"{lake}/archive/t/001_t.parquet") and not os.path.exists(f"{lake_.raw}/001_t.parquet")


def test_an_interrupted_move_to_the_archive_is_finished(spark, lake_, monkeypatch):
    lake_.land("001", (1, "2020-01-01", "a"))
    lake_.land("002", (2, "2020-01-01", "b"))
    move = files.move

    def stopped(spark_, source, target):
        if source.endswith("002_t.parquet") and "archive" in target:
            os.makedirs(target)
            raise OSError("cut off")
        move(spark_, source, target)

    monkeypatch.setattr(files, "move", stopped)
    with pytest.raises(OSError, match="cut off"):
        lake_.ingest()
    monkeypatch.setattr(files, "move", move)
    lake_.ingest()
    assert spark.read.parquet(f"{lake_.root}/archive/002_t.parquet").count() == 1
    assert not os.path.exists(f"{lake_.raw}/002_t.parquet") and lake_.held() == {1: "a", 2: "b"}


def test_window_is_deleted_once_per_run(spark, lake_):
    lake_.land("001", (1, "2020-01-01", "old"), (2, "2020-03-01", "gone"), (3, "2020-03-02", "gone"), (4, None, "x"))
    lake_.ingest()
    lake_.land("002", (5, "2020-03-05", "kept"))
    lake_.land("003", (6, "2020-03-06", "kept"))
    lake_.ingest("2020-03-20")
    assert lake_.held() == {1: "old", 4: "x", 5: "kept", 6: "kept"}


def test_a_failed_run_goes_on_where_it_stopped(spark, lake_, monkeypatch):
    lake_.land("001", (1, "2020-03-01", "gone"))
    lake_.ingest()
    lake_.land("002", (2, "2020-03-05", "b"))
    lake_.land("003", (3, "2020-03-06", "c"))
    load = ingest.load_delivery
    loaded = []

    def fail_second(spark_, delivery, table, **kwargs):
        loaded.append((kwargs["record"]["deliveries"][-1], kwargs["as_of"]))
        if len(loaded) == 2:
            raise RuntimeError("lost")
        return load(spark_, delivery, table, **kwargs)

    monkeypatch.setattr(ingest, "load_delivery", fail_second)
    with pytest.raises(Exception, match="lost"):
        lake_.ingest("2020-03-20")
    assert lake_.held() == {2: "b"}
    lake_.ingest("2020-03-20")
    # The second delivery is not merged again, and the window not deleted again.
    assert loaded == [
        ("002_t.parquet", "2020-03-20"), ("003_t.parquet", None), ("003_t.parquet", None)
    ]
    assert lake_.held() == {2: "b", 3: "c"}


def test_a_repeated_batch_changes_nothing(spark, lake_):
    """Drop the commit of the last batch, as if the run had died just before it."""
    schema = "k int, d string, InsertedDate string, UpdatedDate string"
    dated = spark.createDataFrame([(1, "2020-01-01", "i", "u")], schema).withColumn("d", F.col("d").cast("date"))
    dated.write.parquet(f"{lake_.raw}/001_t.parquet")
    lake_.ingest()
    dated.withColumn("k", F.lit(2)).write.parquet(f"{lake_.raw}/002_t.parquet")
    lake_.ingest()
    before = spark.read.parquet(lake_.path).orderBy("k").collect()
    assert before[1]["UpdatedDate"] is None and before[1]["InsertedDate"] == "i"
    commits = f"{lake_.root}/checkpoint/commits"
    for name in ("1", ".1.crc"):
        os.rename(f"{commits}/{name}", f"{lake_.root}/dropped-{name}")
    lake_.ingest()
    assert os.path.exists(f"{commits}/1")
    assert spark.read.parquet(lake_.path).orderBy("k").collect() == before


ROW = {
    "PartitionKey": "p", "RowKey": "r", "highway": "north", "System": "erp", "SchemaName": "sales",
    "TableName": "drawer", "PrimaryKey": "K", "Partition": "1", "PartitionColumn": "D", "FlagDelete": "1",
    "UpdatedDate": "2020-03-20", "Query": "SELECT * FROM source_rows", "Filter": " WHERE k < 3",
}


def test_source_to_raw_to_trusted(spark, lake):
    spark.createDataFrame([(1, "2020-01-01", ""), (2, "2020-02-01", "b"), (3, None, "c")], "k int, d string, v string"
                          ).withColumn("d", F.col("d").cast("date")).createOrReplaceTempView("source_rows")
    stamp = new_stamp(spark)
    assert len(stamp) == 17 and stamp.isdigit()
    landed = extract_to_raw(spark, ROW, lake, spark.sql, stamp)
    assert landed == f"{lake}/raw/north/erp/sales/drawer/{stamp}_drawer.parquet"
    raw_to_trusted(spark, ROW, lake, f"{lake}/checkpoints")
    trusted = spark.read.parquet(zone_path(lake, TRUSTED_ZONE, ROW))
    assert sorted(tuple(r)[0::2] for r in trusted.collect()) == [(1, None), (2, "b")]
    # A table whose own name holds the zone name keeps its path.
    assert zone_path(lake, FAILED_ZONE, {**ROW, "TableName": "rawdata"}).endswith("failed/north/erp/sales/rawdata")
    assert [n for n in os.listdir(zone_path(lake, RAW_ZONE, ROW)) if n.startswith("_")] == []
    extract_to_raw(spark, ROW, lake, spark.sql, stamp)
    with pytest.raises(FileExistsError):
        extract_to_raw(spark, ROW, lake, spark.sql, stamp)


def test_work_list_run_records_every_result(spark, lake):
    rows = [
        {**ROW, "RowKey": name, "TableName": name, "Zone": "trusted", "JobStatus": status, "JobExecution": 0}
        for name, status in (("good", "1"), ("bad", "1"), ("idle", "2"))
    ]
    control = f"{lake}/control"
    spark.createDataFrame(rows).withColumn("JobExecution", F.col("JobExecution").cast("int")).write.parquet(control)
    healthy = []

    def step(row):
        if row["TableName"] == "bad" and not healthy:
            raise RuntimeError("source is down")

    def run():
        report = loads.run_work_list(
            spark, control, TRUSTED_ZONE, step, log_path=f"{lake}/log", run_date="2020-04-01", System="erp"
        )
        status = {r["TableName"]: (r["JobExecution"], r["UpdatedDate"]) for r in spark.read.parquet(control).collect()}
        return {r["FilePath"]: (r["status"], r["error"]) for r in report.collect()}, status

    report, status = run()
    assert report["trusted/north/erp/sales/bad/"] == ("failed", "source is down")
    assert report["trusted/north/erp/sales/good/"] == ("succeeded", None)
    assert status == {"good": (1, "2020-04-01"), "bad": (0, "2020-03-20"), "idle": (0, "2020-03-20")}
    healthy.append(True)
    _, status = run()
    assert status["bad"] == (1, "2020-04-01")
    assert spark.read.parquet(f"{lake}/log").count() == 4
    others = [c for c in ROW if c not in ("RowKey", "TableName", "UpdatedDate")]
    kept = spark.read.parquet(control).select(others).distinct().collect()
    assert [r.asDict() for r in kept] == [{c: ROW[c] for c in others}]


def test_a_run_that_was_cut_off_is_recorded_by_the_next(spark, lake):
    control, calls = f"{lake}/control", []
    rows = [
        {**ROW, "RowKey": name, "TableName": name, "Zone": "trusted", "JobStatus": "1", "JobExecution": 0}
        for name in ("a", "b")
    ]
    spark.createDataFrame(rows).write.parquet(control)

    def cut(row):
        calls.append(row["RowKey"])
        if len(calls) == 2:
            raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        loads.run_work_list(spark, control, "trusted", cut, run_date="2022-01-01")
    status = lambda: {r["RowKey"]: (r["JobExecution"], r["UpdatedDate"]) for r in spark.read.parquet(control).collect()}
    assert {n for n, _ in status().values()} == {0}
    loads.run_work_list(spark, control, "refined", lambda row: None)
    assert status() == {calls[0]: (1, "2022-01-01"), calls[1]: (0, ROW["UpdatedDate"])}
    assert not files.exists(spark, control + loads.RUN_SUFFIX)


def test_empty_delivery_directory(spark, lake_):
    lake_.land("001", (1, "2020-01-01", "a"))
    spark.createDataFrame([], "k int, d date, v string").write.parquet(f"{lake_.raw}/002_t.parquet")
    lake_.ingest()
    assert lake_.held() == {1: "a"} and files.exists(spark, f"{lake_.root}/archive/002_t.parquet")


def test_combined_deliveries_give_the_same_table(spark, tmp_path, monkeypatch):
    """A backlog with a repeated new key and a new column, merged one by one and combined."""
    loads_ = []
    load = ingest.load_delivery

    def counted(spark_, delivery, table, **kwargs):
        loads_.append(len(kwargs["record"]["deliveries"]))
        return load(spark_, delivery, table, **kwargs)

    monkeypatch.setattr(ingest, "load_delivery", counted)
    tables = []
    for combine in (False, True):
        one = Lake(spark, str(tmp_path / str(combine)))
        one.land("000", (0, "2020-03-10", "gone"), (9, "2020-01-01", "stays"))
        one.ingest()
        one.land("001", (1, "2020-01-01", "a"), (2, "2020-01-02", "a"), (None, "2020-01-02", "n"))
        one.land("002", (2, "2020-02-02", "b"), (3, "2020-02-03", ""))
        one.land("003", (3, "2020-04-03", "c"), (None, "2020-03-03", "c"), (9, "2020-02-01", "c"))
        one.land("004", (5, "2020-04-05", "d"), (5, "2020-04-05", "d"))
        one.land("005", (1, "2020-04-05", "e"))
        one.land("006", (2, "2020-04-05", "f"))
        loads_.clear()
        one.ingest("2020-03-20", combine)
        tables.append(sorted((tuple(r) for r in spark.read.parquet(one.path).collect()), key=repr))
        assert loads_ == ([1, 2, 3, 4, 5, 6] if not combine else [3, 4, 6])
    assert tables[0] == tables[1] and len(tables[0]) == 7


def test_deliveries_with_audit_columns_are_not_combined(spark, lake):
    dated = spark.createDataFrame([(1, "x", "y")], "k int, InsertedDate string, UpdatedDate string")
    assert [n for _, n in ingest.combined([dated, dated], TrustedTable(lake, ["k"]))] == [1, 1]
    plain = TrustedTable(lake, ["k"], merge_options={"audit": "none"})
    assert [n for _, n in ingest.combined([dated, dated], plain)] == [2]
    wider = dated.withColumn("z", F.lit(1))
    assert [n for _, n in ingest.combined([dated, wider, wider], plain)] == [1, 2]


def test_a_backlog_takes_as_many_jobs_as_two_deliveries(spark, lake):
    """Repeats within deliveries are found in one aggregate over all of them."""
    from zonemill.plans.deliveries import TrustedTable
    from zonemill.streaming.ingest import combined

    def jobs(number):
        paths = [f"{lake}/{number}/{i}" for i in range(number)]
        for i, path in enumerate(paths):
            keys = [1, 2, 2] if i == 3 else [i, i + 1]
            spark.createDataFrame([(k, i) for k in keys], "k int, v int").write.parquet(path)
        frames = [spark.read.schema("k int, v int").parquet(path) for path in paths]
        group = f"combine-{number}"
        spark.sparkContext.setJobGroup(group, group)
        runs = combined(frames, TrustedTable(f"{lake}/t", ["K"]))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return [n for _, n in runs], len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)), runs

    two, eight = jobs(2), jobs(8)
    assert two[0] == [2] and eight[0] == [3, 1, 4] and eight[1] <= two[1] + 1
    assert sorted((r["k"], r["v"]) for r in eight[2][0][0].collect()) == [(0, 0), (1, 1), (2, 2), (3, 2)]
