"""Session settings and the shared folder for written intermediates."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh directory for intermediate tables.

    It lies in the shared folder of ``spark.checkpoint.dir``. Only a session without
    that setting, as in local tests, gets a temporary folder of this machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        shared = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def size_in_bytes(df: DataFrame) -> int:
    """Size of ``df`` as the optimizer estimates it from file sizes and pruned columns."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def fits_broadcast(df: DataFrame) -> bool:
    """Whether Spark will broadcast ``df`` by itself, by its own size estimate.

    The operators add no broadcast hint. They only ask which plan Spark is going to
    choose, and arrange the other inputs for that plan.
    """
    limit = df._jdf.sparkSession().sessionState().conf().autoBroadcastJoinThreshold()
    return 0 <= size_in_bytes(df) <= limit
