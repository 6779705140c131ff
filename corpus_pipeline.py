"""A training corpus from ``documents``: reject toxic and poor texts, drop near-copies, mix, pack.

Every stage takes (spark, docs, sf_dir), works on all that the stage before kept, and all
but the last return the columns of the documents they got. Labels come from ``sf_dir``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonemill.llm import quality, text_dups, toxicity
from zonemill.llm.common import prepare, table, written
from zonemill.llm.mixing import mix
from zonemill.llm.packing import pack_texts
from zonemill.llm.queries import MIX_POWERS, learnable, topic


def _free(docs: DataFrame, *names: str) -> list[str]:
    """Names like the given ones that ``docs`` does not use."""
    held = {c.lower() for c in docs.columns}
    free = []
    for name in names:
        while name.lower() in held:
            name += "_"
        held.add(name.lower())
        free.append(name)
    return free


def _passed(docs: DataFrame, sf_dir: str, classifier, cut: float, wanted: int) -> DataFrame:
    score, predicted = _free(docs, "_score", "_predicted")
    model = classifier.fit(docs, learnable(table(docs.sparkSession, sf_dir, "labels")))
    scored = classifier.score_texts(docs, model, cut=cut, names=(score, predicted))
    return scored.filter(F.col(predicted) == wanted).select(*docs.columns)


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not predicted toxic. NULL and empty texts score as clean; repeated rows are judged
    alike; without labels of both classes, or on an empty table, nothing is rejected; all columns stay."""
    prepare(spark)
    return _passed(docs, sf_dir, toxicity, 0.5, 0)


def reject_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted good. NULL and empty texts get the score of an empty text; repeated rows are
    judged alike; without labels of both classes, or on an empty table, nothing is rejected; all columns stay."""
    prepare(spark)
    return _passed(docs, sf_dir, quality, 0.3, 1)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that of the smallest id. NULL and empty texts and
    rows with a NULL id stay; rows of one id with different texts are judged apart; all columns stay."""
    prepare(spark)
    return text_dups.without_near_duplicates(docs).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn to the target weights of source, language and kind of text. NULLs are a value of
    their own; rows of one id are drawn alike; an empty table gives an empty result; all columns stay."""
    prepare(spark)
    kind, *names = _free(docs, "_topic", "_tokens", "_probability", "_kept")
    powers = {kind if c == "topic" else c: power for c, power in MIX_POWERS.items()}
    mixed = mix(docs.withColumn(kind, topic(F.col("text"))), powers, names=tuple(names))
    return mixed.filter(F.col(names[2])).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of the tokens of all documents, a row per piece. NULL texts are empty ones, which are
    their end token alone; every row is packed, repeated ones too; other columns are left out."""
    prepare(spark)
    return pack_texts(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", reject_toxic),
    ("quality", reject_poor),
    ("near_duplicates", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack),
]

# Classifiers, hashing and a tokenizer have no SQL; see the tests of the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
