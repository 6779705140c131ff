"""Listing, moving and removing files through the Hadoop file system of the session."""

from __future__ import annotations

from functools import lru_cache
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@lru_cache(maxsize=1)
def _path_class(jvm: Any) -> Any:
    # Every part of a dotted Java name is a call to the JVM.
    return jvm.org.apache.hadoop.fs.Path


def _system(spark: SparkSession, path: str) -> tuple[Any, Any]:
    handle = _path_class(spark._jvm)(path)
    return handle.getFileSystem(spark._jsc.hadoopConfiguration()), handle


def qualified(spark: SparkSession, path: str) -> str:
    """The path as Spark reports it, with its file system."""
    system, handle = _system(spark, path)
    return system.makeQualified(handle).toString()


def exists(spark: SparkSession, path: str) -> bool:
    system, handle = _system(spark, path)
    return bool(system.exists(handle))


def delete(spark: SparkSession, path: str) -> None:
    system, handle = _system(spark, path)
    if system.exists(handle) and not system.delete(handle, True):
        raise OSError(f"could not delete {path}")


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file or directory; the target must not exist."""
    system, handle = _system(spark, source)
    goal = _path_class(spark._jvm)(target)
    if system.exists(goal):
        raise FileExistsError(target)
    system.mkdirs(goal.getParent())
    if not system.rename(handle, goal):
        raise OSError(f"could not move {source} to {target}")


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small text file, or ``None`` if there is none."""
    system, handle = _system(spark, path)
    if not system.exists(handle):
        return None
    stream = system.open(handle)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file that appears complete or not at all."""
    system, handle = _system(spark, path)
    draft = _path_class(spark._jvm)(path + ".draft")
    stream = system.create(draft, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    if system.exists(handle):
        system.delete(handle, False)
    if not system.rename(draft, handle):
        raise OSError(f"could not write {path}")


def list_entries(spark: SparkSession, path: str) -> list[tuple]:
    """Direct entries of a directory, by name: path, name, is_directory, length, modified."""
    system, handle = _system(spark, path)
    if not system.exists(handle):
        return []
    entries = [
        (s.getPath().toString(), s.getPath().getName(), s.isDirectory(), s.getLen(), s.getModificationTime())
        for s in system.listStatus(handle)
    ]
    return sorted(entries, key=lambda e: e[1])


def file_inventory(spark: SparkSession, path: str) -> DataFrame:
    """What waits in a landing directory, with sizes; empty files are included.

    Spark's own file sources leave out zero-length files, so this is a listing of the
    direct entries. A landing directory holds one entry per waiting delivery.
    """
    rows = [(p, n, d, size, ms) for p, n, d, size, ms in list_entries(spark, path)]
    listed = spark.createDataFrame(rows, "path string, name string, is_directory boolean, length long, ms long")
    return listed.withColumn("modification_time", F.timestamp_millis("ms")).drop("ms")


def dataset_size(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Bytes and files under a directory, over all levels; file contents are not read."""
    found = spark.read.format("binaryFile").options(recursiveFileLookup=True, pathGlobFilter=glob).load(path)
    return found.agg(
        F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"),
        F.count("length").alias("files"),
    )
