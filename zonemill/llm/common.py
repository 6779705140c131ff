"""What several of the operators share."""

from __future__ import annotations

import os
import pickle
import shutil
import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from zonemill.session import work_dir

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
# Bytes and rows of one Arrow batch, so that a worker's memory does not follow text length.
BATCH_BYTES, BATCH_ROWS = "16m", "2000"
SAMPLE_PARTS = 64
# Bytes of text of one label that a classifier learns from.
SAMPLE_BYTES = 64 << 20


def prepare(spark: SparkSession) -> None:
    """Send this package to the Python workers, once a Spark context, and keep their batches small."""
    context = spark.sparkContext
    if not getattr(context, "_zonemill_sent", False):
        # The driver hands the archive to the executors, wherever they run.
        folder = tempfile.mkdtemp(prefix="zonemill-")
        context.addPyFile(shutil.make_archive(f"{folder}/zonemill_source", "zip", ROOT, "zonemill"))
        context._zonemill_sent = True
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table_at(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def written_at(df: DataFrame, path: str) -> DataFrame:
    """``df`` written to a path of the shared folder and read back, which cuts its lineage."""
    df.write.parquet(path)
    return table_at(df.sparkSession, path, df.schema)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a fresh path of the shared folder and read back."""
    return written_at(df, work_dir(df.sparkSession, name))


def remainder(id_col: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``: the folds of the labelled rows."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(divisor))


def sampled_rows(df: DataFrame, id_col: str, by: str, rows: int) -> DataFrame:
    """At most ``rows`` ids of each value of ``by``, chosen by a hash of the id.

    Ranked first within ``SAMPLE_PARTS`` parts of each value, then among the parts' first
    rows, so that no task holds more than that many times ``rows``, however large a value
    is. The bound is the caller's documented training parameter.
    """
    draw = F.xxhash64(F.lit("training"), F.col(id_col).cast("string"))
    part = F.pmod(draw, F.lit(SAMPLE_PARTS))
    chosen = df.select(id_col, by).withColumns({"_draw": draw, "_part": part})
    for groups in ([by, "_part"], [by]):
        order = Window.partitionBy(*groups).orderBy("_draw", id_col)
        chosen = chosen.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= rows).drop("_rank")
    return chosen.select(id_col, by)


def labelled_texts(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label: str, rows: int) -> DataFrame:
    """(_id, _label, _text): at most ``rows`` labelled texts of each label, of ``SAMPLE_BYTES`` in all.

    Only ids are ranked; the texts of the chosen ids are then read in one scan. Texts count
    against the bytes in the order of a hash of their ids; the first one always stays.
    """
    chosen = sampled_rows(labels.filter(F.col(id_col).isNotNull() & F.col(label).isNotNull()).distinct(), id_col, label, rows)
    chosen = chosen.select(F.col(id_col).alias("_id"), F.col(label).alias("_label"))
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    # At most ``rows`` ids a label, so the hint is safe at any size; a repeated id counts once.
    found = texts.join(F.broadcast(chosen), "_id").groupBy("_id", "_label").agg(F.min("_text").alias("_text"))
    order = Window.partitionBy("_label").orderBy(F.xxhash64(F.col("_id").cast("string")), "_id")
    size = F.coalesce(F.octet_length("_text"), F.lit(0)).cast("long")
    before = F.coalesce(F.sum(size).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return found.withColumn("_before", before).filter((F.col("_before") == 0) | (F.col("_before") + size <= SAMPLE_BYTES)).drop("_before")


def trained(sample: DataFrame, train: Callable[[list[str | None], list], object]) -> object:
    """What ``train`` makes of all texts and labels of a bounded sample, in the order of their ids.

    It runs in one task, so that neither the texts nor what training needs take memory of the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
        rows.sort(key=lambda r: (r[0], str(r[1])))
        model = train([r[2] for r in rows], [r[1] for r in rows]) if rows else None
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])

    told = sample.select("_id", "_label", "_text").repartition(1).mapInArrow(run, "model binary").collect()
    return pickle.loads(told[0]["model"]) if told else None


def add_columns(
    df: DataFrame, inputs: list[str], added: str, make: Callable[[], Callable], keep: list[str] | None = None
) -> DataFrame:
    """Columns computed in Python from Arrow batches; ``keep`` names the columns to hand on.

    ``make`` is called once a task and gives a function from Python lists of the input
    columns to lists of the added ones. Columns with the name of an added one are replaced.
    """
    new = StructType.fromDDL(added)
    kept = [c for c in (df.columns if keep is None else keep) if c not in new.names]
    source = df.select(*kept, *[F.col(c).alias(f"_in{i}") for i, c in enumerate(inputs)])
    schema = StructType([*source.schema.fields[: len(kept)], *new.fields])
    kinds = [to_arrow_type(f.dataType) for f in new.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                values = work(*(c.to_pylist() for c in part.columns[len(kept) :]))
                fresh = [pa.array(v, t) for v, t in zip(values, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns[: len(kept)], *fresh], names=[*kept, *new.names])

    return source.mapInArrow(run, schema)


class WordCache(dict):
    """A bounded word → value map that fills itself.

    ``make`` computes the value of an unseen word. Once ``size`` words are young, the
    older generation is forgotten, so at most ``2 * size`` entries are held.
    """

    def __init__(self, make: Callable[[str], object], size: int = 150_000):
        super().__init__()
        self.make, self.size, self.old = make, size, {}

    def __missing__(self, word: str) -> object:
        value = self.old.get(word)
        if value is None:
            value = self.make(word)
        if len(word) <= 64:
            self[word] = value
        return value

    def trim(self) -> None:
        """Call between texts, never while values of one text are being looked up."""
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
