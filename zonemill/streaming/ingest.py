"""Raw to trusted: every waiting delivery is merged once, then archived.

A delivery is a file or a directory directly under the raw path of a table, named so
that names sort by time. It must appear complete, by one rename, and not change after.

A file stream decides which deliveries are new; its checkpoint remembers them across
runs. The stream carries paths only. The rows of a delivery are then read as a plain
Parquet scan, with the columns that any file of that delivery has, so that pruning, file statistics and
adaptive execution work as for any batch job.

Deliveries waiting at the start of a run are one micro-batch. A batch may be repeated
after a failure, so every publish records the deliveries of the batch merged so far, and
a repeated batch goes on after them. Merged deliveries are archived by one rename each,
once the stream has committed their batch; a run that was cut off before is finished by
the next one.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonemill.functions.columns import find
from zonemill.functions.keys import MergeKeys
from zonemill.layout import INSERTED_COLUMN, UPDATED_COLUMN
from zonemill.operators.merge import latest_per_key
from zonemill.plans.deliveries import TrustedTable, load_delivery
from zonemill.sources import files
from zonemill.sources.publish import applied

# The columns of Spark's binary file source; contents are never selected.
FEED_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def reject_empty(spark: SparkSession, raw_path: str, failed_path: str) -> DataFrame:
    """Move zero-length files from raw to failed, and return what was moved.

    Spark reads an empty file as no rows and would archive it as a good one.
    """
    waiting = files.file_inventory(spark, raw_path)
    rejected = waiting.filter(~F.col("is_directory") & (F.col("length") == 0))
    names = [row["name"] for row in rejected.select("name").collect()]
    for name in names:
        files.delete(spark, f"{failed_path}/{name}")
        files.move(spark, f"{raw_path}/{name}", f"{failed_path}/{name}")
    return rejected


def archive_merged(spark: SparkSession, raw_path: str, archive_path: str, checkpoint: str, record: dict) -> None:
    """Move the deliveries of the recorded batch from raw to the same name in the archive.

    A batch that the stream has not committed may run again and still needs its files. A
    delivery that was moved in part, where a rename is a copy, is moved anew.
    """
    stream = files.read_text(spark, f"{checkpoint}/metadata")
    if stream is None or json.loads(stream)["id"] != record.get("query"):
        return
    if not files.exists(spark, f"{checkpoint}/commits/{record['batch']}"):
        return
    for name in record["deliveries"]:
        if files.exists(spark, f"{raw_path}/{name}"):
            files.delete(spark, f"{archive_path}/{name}")
            files.move(spark, f"{raw_path}/{name}", f"{archive_path}/{name}")


def combined(deliveries: list[DataFrame], table: TrustedTable) -> list[tuple[DataFrame, int]]:
    """Runs of deliveries as one each, with their number, in the same order.

    One merge of a run equals its merges one by one if its deliveries have the same
    columns, no audit columns and no repeated key within a delivery: the last delivery
    that holds a key decides its row. Anything else stays a delivery of its own.
    """
    fit = [_may_combine(delivery, table) for delivery in deliveries]
    alone = {i for i, d in enumerate(deliveries) if not (_alike(deliveries, fit, i - 1, i) or _alike(deliveries, fit, i, i + 1))}
    repeats = _with_repeats({i: d for i, d in enumerate(deliveries) if fit[i] and i not in alone}, table.keys)
    fit = [f and i not in repeats for i, f in enumerate(fit)]
    runs: list[list[DataFrame]] = []
    for i, delivery in enumerate(deliveries):
        if _alike(deliveries, fit, i - 1, i):
            runs[-1].append(delivery)
        else:
            runs.append([delivery])
    return [(_last_rows(run, table) if len(run) > 1 else run[0], len(run)) for run in runs]


def _alike(deliveries: list[DataFrame], fit: list[bool], i: int, j: int) -> bool:
    return 0 <= i and j < len(deliveries) and fit[i] and fit[j] and deliveries[i].schema == deliveries[j].schema


def _may_combine(delivery: DataFrame, table: TrustedTable) -> bool:
    audited = table.merge_options.get("audit", "null") != "none" and (
        find(delivery, INSERTED_COLUMN) or find(delivery, UPDATED_COLUMN)
    )
    if audited or table.merge_options.get("on_duplicate", "error") != "error":
        return False
    return all(find(delivery, key) is not None for key in table.keys)


def _with_repeats(deliveries: dict[int, DataFrame], keys: list[str]) -> set[int]:
    """Deliveries that hold a key more than once, by one aggregate over the keys of all of them."""
    tagged = [MergeKeys(d, keys, "the delivery").project(d, F.lit(i).alias("_delivery")) for i, d in deliveries.items()]
    groups: dict[str, DataFrame] = {}
    for given in tagged:  # deliveries with keys of other types are counted apart
        name = given.schema.simpleString()
        groups[name] = groups[name].union(given) if name in groups else given
    counts = [g.groupBy(*g.columns).count().filter("count > 1").select("_delivery").distinct() for g in groups.values()]
    return {row[0] for row in reduce(DataFrame.union, counts).distinct().collect()} if counts else set()


def _last_rows(run: list[DataFrame], table: TrustedTable) -> DataFrame:
    numbered = [delivery.withColumn("_delivery", F.lit(i)) for i, delivery in enumerate(run)]
    return latest_per_key(reduce(DataFrame.unionByName, numbered), table.keys, ["_delivery"]).drop("_delivery")


def delivery_feed(spark: SparkSession, raw_path: str) -> DataFrame:
    """Stream of the names of new deliveries, one row per file of them."""
    root = files.qualified(spark, raw_path)
    below = F.substring("path", len(root) + 2, 1 << 30)
    return (
        spark.readStream.format("binaryFile")
        .schema(FEED_SCHEMA)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .load(raw_path)
        .select(F.split_part(below, F.lit("/"), F.lit(1)).alias("delivery"))
    )


def ingest_stream(
    spark: SparkSession,
    raw_path: str,
    table: TrustedTable,
    checkpoint: str,
    archive_path: str,
    failed_path: str,
    as_of: str | None = None,
    combine: bool = False,
) -> None:
    """Merge all waiting deliveries in name order, then stop.

    With ``as_of``, rows of the window before it are deleted once per run, together with
    the first delivery; without any delivery nothing is deleted. ``combine`` merges
    neighbouring deliveries in one step where that gives the same table, so that a
    backlog costs one pass over it. Merged deliveries end under ``archive_path`` by their
    own names, empty ones under ``failed_path``.
    """
    if not files.exists(spark, raw_path):
        return
    archive_merged(spark, raw_path, archive_path, checkpoint, applied(spark, table.path))
    reject_empty(spark, raw_path, failed_path)

    def load_waiting(feed: DataFrame, batch_id: int) -> None:
        # The stream's own session plans without adaptive execution; rows are read in ours.
        query = feed.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        waiting = sorted(row[0] for row in feed.distinct().collect())
        last = applied(spark, table.path)
        if last.get("query") == query and last["batch"] > batch_id:
            return
        repeated = last.get("query") == query and last["batch"] == batch_id
        merged = list(last["deliveries"]) if repeated else []
        left = [name for name in waiting if name not in merged]
        # Files of one delivery may differ in their columns.
        frames = [spark.read.option("mergeSchema", True).parquet(f"{raw_path}/{name}") for name in left]
        for delivery, size in combined(frames, table) if combine else [(frame, 1) for frame in frames]:
            first = not merged
            merged, left = merged + left[:size], left[size:]
            load_delivery(
                spark,
                delivery,
                table,
                as_of=as_of if first else None,
                record={"query": query, "batch": batch_id, "deliveries": merged},
            )

    stream = (
        delivery_feed(spark, raw_path)
        .writeStream.foreachBatch(load_waiting)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    stream.awaitTermination()
    archive_merged(spark, raw_path, archive_path, checkpoint, applied(spark, table.path))
