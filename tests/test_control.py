import pytest

from zonemill.operators.control import record_status, with_connection, work_list

CONTROL = "PartitionKey string, RowKey string, Zone string, JobStatus string, FlagFilter string, System string, n int"


@pytest.fixture
def control(spark):
    return spark.createDataFrame(
        [
            ("p", "1", "raw", "1", "0", "alpha", 1),
            ("p", "2", "raw", "1", "1", "alpha", 2),
            ("p", "3", "trusted", "1", "0", "beta", 3),
            ("p", "4", "refined", "2", "0", "alpha", 4),
            ("p", "5", "refined", "1", "0", "alpha", 5),
        ],
        CONTROL,
    )


def keys(df):
    return sorted(r["RowKey"] for r in df.collect())


def test_filters_of_each_load(control):
    assert keys(work_list(control, "raw")) == ["1"]
    assert keys(work_list(control, "trusted", System="beta")) == ["3"]
    assert keys(work_list(control, "refined", System="alpha")) == ["4"]
    assert keys(work_list(control, n="5")) == ["5"]
    assert len(keys(work_list(control))) == 5
    with pytest.raises(ValueError, match="no column"):
        work_list(control, Colour="red")


def test_connection_of_a_work_row(spark, control):
    connections = spark.createDataFrame(
        [("alpha", "h2", "pw", 2), ("alpha", "h1", "pw", 1)], "System string, Host string, PASSWORD string, seq int"
    )
    work = work_list(control, "raw")
    with pytest.raises(Exception, match="several connections"):
        with_connection(work, connections, ["System"]).collect()
    first = with_connection(work, connections, ["system"], pick="first", order_by=["seq"])
    assert "PASSWORD" not in first.columns and [r["Host"] for r in first.collect()] == ["h1"]
    with pytest.raises(ValueError, match="order"):
        with_connection(work, connections, ["System"], pick="first")
    none = with_connection(work_list(control, "trusted"), connections, ["System"]).collect()
    assert [(r["RowKey"], r["Host"]) for r in none] == [("3", None)]


def test_status_moves_only_with_success(spark, control):
    table = control.selectExpr("*", "'2020-01-01' AS UpdatedDate", "0 AS JobExecution")
    after = record_status(table, table.filter("RowKey = '1'"), True, "2020-02-02")
    after = record_status(after, table.filter("RowKey = '2'"), False, "2020-02-02")
    after = record_status(after, table.filter("RowKey = '3'"), False, "2020-02-02", advance_on_failure=True)
    status = {r["RowKey"]: (r["UpdatedDate"], r["JobExecution"], r["n"]) for r in after.collect()}
    assert status == {
        "1": ("2020-02-02", 1, 1), "2": ("2020-01-01", 0, 2), "3": ("2020-02-02", 0, 3),
        "4": ("2020-01-01", 0, 4), "5": ("2020-01-01", 0, 5),
    }


def test_status_keys_may_hold_quotes(spark):
    table = spark.createDataFrame([("it's", "a/b", "2020-01-01", 0)],
                                  "PartitionKey string, RowKey string, UpdatedDate string, JobExecution int")
    assert record_status(table, table, True, "2020-02-02").first()["JobExecution"] == 1
