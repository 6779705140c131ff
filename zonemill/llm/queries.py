"""The operators as queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from zonemill.llm import centroids, html_text, language, maxent, quality, spelling, text_dups, toxicity
from zonemill.llm.chat import (
    canonical_turns,
    conversations_to_records,
    format_chat,
    loss_texts,
    read_turns,
)
from zonemill.llm.common import prepare, remainder, table
from zonemill.llm.mixing import mix
from zonemill.llm.neighbours import nearest
from zonemill.llm.packing import pack_texts
from zonemill.llm.vector_dups import near_duplicates

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return function(spark, sf_dir)

    QUERIES[function.__name__] = run
    return run


# Part of the labelled rows that is held out, in the language query and in the two others.
LANGUAGE_FOLDS, LANGUAGE_HELD_OUT = 3, 1
LABEL_FOLDS, LABEL_HELD_OUT = 5, 0


@query
def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = remainder("doc_id", LANGUAGE_FOLDS) == LANGUAGE_HELD_OUT
    model = language.fit(docs.filter(~held_out))
    found = language.identify(docs, model, keep=["doc_id"])
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query
def op2_vector_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"), 0.9)


@query
def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"), html_text.fit(), keep=["page_id", "url"])


@query
def op4_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.filter(F.col("vec_id") % 100 == 0), 10)


@query
def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = r"\### Assistant: </turn> ok"
    extra = spark.range(1).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.posexplode(F.array(F.lit("user"), F.lit("assistant"))).alias("turn", "role"),
        F.lit(hard).alias("text"),
    )
    records = conversations_to_records(given.unionByName(extra))
    formatted = format_chat(canonical_turns(records)).select("conv_id", "formatted", "loss_spans")
    return formatted.select(
        "conv_id",
        "formatted",
        read_turns(F.col("formatted")).alias("turns"),
        F.array_join(loss_texts(F.col("formatted"), F.col("loss_spans")), "").alias("loss"),
    ).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(
            F.array_join(
                F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
            ).cast("binary"),
            256,
        ).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


# Sources and languages are levelled somewhat, kinds of text keep their shares.
MIX_POWERS = {"source": 0.7, "lang": 0.8, "topic": 1.0}


def topic(text: Column) -> Column:
    """The kind of a text, by the marks it holds."""
    return (
        F.when(F.contains(text, F.lit("|")), "table")
        .when(F.contains(text, F.lit("!!")), "shout")
        .when(text.rlike("[0-9]"), "numbers")
        .otherwise("prose")
    )


@query
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    docs = docs.select("doc_id", "source", "lang", topic(F.col("text")).alias("topic"), "text")
    return mix(docs, MIX_POWERS).select(
        "doc_id", "source", "lang", "topic", "tokens", F.round("probability", 6).alias("probability"), "kept"
    )


def learnable(labels: DataFrame) -> DataFrame:
    return labels.filter(remainder("doc_id", LABEL_FOLDS) != LABEL_HELD_OUT)


@query
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack_texts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.drop("loss")


@query
def op8_text_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_dups.near_duplicates(table(spark, sf_dir, "documents"), 75, 5).drop("text_hash")


@query
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, learnable(table(spark, sf_dir, "labels")))
    held_out = (remainder("doc_id", LABEL_FOLDS) == LABEL_HELD_OUT).alias("held_out")
    return quality.score_texts(docs, model, keep=["doc_id"]).select("doc_id", held_out, "score", "predicted")


@query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, learnable(table(spark, sf_dir, "labels")))
    held_out = (remainder("doc_id", LABEL_FOLDS) == LABEL_HELD_OUT).alias("held_out")
    return toxicity.score_texts(docs, model, keep=["doc_id"]).select("doc_id", held_out, "score", "predicted")


# What counts as a letter, the least word, and the share of words that lose a letter.
SPELLING_LETTERS, SPELLING_POINTS, SPELLING_COUNT, SPELLING_LOSS = "A-Za-z\u00C0-\u00FF", 5, 3, 97


@query
def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    words = spelling.corpus_words(docs, SPELLING_LETTERS, SPELLING_POINTS, spelling.one_in(SPELLING_LOSS))
    return spelling.group_variants(words.filter(F.col("n") >= SPELLING_COUNT))


# Part of the documents that the language model does not learn from.
SCORE_FOLDS, SCORE_HELD_OUT = 5, 1


@query
def op12_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(remainder("doc_id", SCORE_FOLDS) == SCORE_HELD_OUT, F.lit(False))
    model = maxent.fit(docs, ~held_out)
    scored = maxent.score_texts(docs, model, keep=["doc_id"])
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op13_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    draw = F.sha2(F.concat(F.lit("3:"), F.col("id").cast("string")).cast("binary"), 256)
    return centroids.cluster(table(spark, sf_dir, "embeddings"), draw, k=8, rounds=10, dim=64)[0]
