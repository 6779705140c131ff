import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("zonemill-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def lake(tmp_path):
    return str(tmp_path / "lake")


@pytest.fixture(params=["broadcast", "shuffle"])
def join_plan(request, spark):
    """Run a test once with small sources broadcast and once with every join shuffled."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    if request.param == "shuffle":
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield request.param
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
