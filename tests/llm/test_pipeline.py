import hashlib
import re
import zlib

import corpus_pipeline
import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from zonemill.llm import quality, toxicity
from zonemill.llm.oracles import ORACLE_SQL
from zonemill.llm.queries import QUERIES, learnable

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Input and output of every stage, written and read again."""
    root, docs, seen = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{SF_DIR}/documents.parquet"), {}
    docs = docs.withColumn("score", F.lit("mine")).withColumn("topic", F.lit("mine")).withColumn("tokens", F.lit(1))
    docs = docs.withColumns({n: F.lit("mine") for n in ("_score", "_topic", "_tokens", "_kept", "_gone", "text_hash")})
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF_DIR).write.parquet(f"{root}/{name}")
        out = spark.read.parquet(f"{root}/{name}")
        seen[name] = (docs, out)
        docs = out
    return seen


def test_stages_hand_on_the_columns_of_documents(stages):
    names = list(stages)
    assert names == ["toxicity", "quality", "near_duplicates", "mixing", "packing"]
    for name in names[:-1]:
        given, out = stages[name]
        assert out.schema.names == given.schema.names and 0 < out.count() <= given.count()
        assert out.exceptAll(given).isEmpty()


@pytest.mark.parametrize("name, classifier, cut, wanted", [("toxicity", toxicity, 0.5, 0), ("quality", quality, 0.3, 1)])
def test_classifier_stages_keep_what_scores_say_text_by_text(spark, stages, name, classifier, cut, wanted):
    given, out = stages[name]
    model = classifier.fit(given, learnable(spark.read.parquet(f"{SF_DIR}/labels.parquet")))
    if classifier is toxicity:
        score = lambda text: float(toxicity.TextScorer(model).scores([text])[0])
    else:
        measure = model.features()
        score = lambda text: float(model.probability(np.array([measure(text)]))[0])
    rows = given.select("doc_id", "text").collect()
    kept = sorted(r["doc_id"] for r in rows if int(score(r["text"]) >= cut) == wanted)
    assert sorted(r["doc_id"] for r in out.select("doc_id").collect()) == kept and 0 < len(kept) < len(rows)


def test_mixing_keeps_what_plain_raking_says(stages):
    given, out = stages["mixing"]
    rows = given.select("doc_id", "source", "lang", "text").collect()
    kind = lambda t: "table" if "|" in t else "shout" if "!!" in t else "numbers" if re.search("[0-9]", t) else "prose"
    cell_of = {r["doc_id"]: (r["source"], r["lang"], kind(r["text"])) for r in rows}
    held = {}
    for r in rows:
        held[cell_of[r["doc_id"]]] = held.get(cell_of[r["doc_id"]], 0) + -(-len(r["text"]) // 4)
    targets = []
    for at, power in enumerate((0.7, 0.8, 1.0)):
        sums = {}
        for cell, n in held.items():
            sums[cell[at]] = sums.get(cell[at], 0) + n
        raised = {v: float(n) ** power for v, n in sums.items()}
        targets.append({v: x / sum(raised.values()) for v, x in raised.items()})
    share = {cell: float(n) for cell, n in held.items()}
    for _ in range(10):
        for at in range(3):
            sums = {}
            for cell, x in share.items():
                sums[cell[at]] = sums.get(cell[at], 0) + x
            share = {cell: x * targets[at][cell[at]] / sums[cell[at]] if sums[cell[at]] else 0.0 for cell, x in share.items()}
    everything = sum(held.values())
    wanted = {cell: x / sum(share.values()) * everything for cell, x in share.items()}
    low, high = 0.0, 1e6  # the scale at which 0.9 of the tokens are kept, by halving
    for _ in range(200):
        scale = (low + high) / 2
        kept = sum(n * min(1.0, scale * wanted[cell] / n) for cell, n in held.items() if n)
        low, high = (scale, high) if kept < 0.9 * everything else (low, scale)
    chance = {cell: min(1.0, high * wanted[cell] / n) if n else 1.0 for cell, n in held.items()}
    draw = lambda i: int(hashlib.md5(f"mix:{i}".encode()).hexdigest()[:8], 16) / 2**32
    expected = sorted(i for i, cell in cell_of.items() if draw(i) < chance[cell])
    assert sorted(r["doc_id"] for r in out.select("doc_id").collect()) == expected


def test_near_duplicates_leave_one_of_each_group(stages):
    given, out = stages["near_duplicates"]
    texts = {r["doc_id"]: r["text"] for r in given.collect()}
    from tests.llm.test_text_dups import brute

    assert {r["doc_id"] for r in out.collect()} == {i for i, (_, c) in brute(texts).items() if i == c}


def test_packing_holds_every_id_of_what_was_mixed(stages):
    mixed, pieces = stages["packing"]
    total = pieces.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("all")).collect()
    assert {r["doc_id"] for r in total} == {r["doc_id"] for r in mixed.collect()} and all(r["n"] == r["all"] for r in total)


def test_run_over_an_empty_table(spark, tmp_path):
    for name in ("documents", "labels"):
        spark.read.parquet(f"{SF_DIR}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "embeddings", "conversations"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    found, expected = QUERIES[name](spark, SF_DIR), connection.sql(ORACLE_SQL[name])
    assert sorted(found.columns) == sorted(expected.columns)
    order = sorted(found.columns)
    cell = lambda v: f"{v:.6f}" if isinstance(v, float) else str(v)
    at = [expected.columns.index(c) for c in order]
    rows = sorted(tuple(cell(r[i]) for i in at) for r in expected.fetchall())
    assert sorted(tuple(cell(r[c]) for c in order) for r in found.collect()) == rows


def test_every_operator_has_one_query():
    numbers = [int(name[2:].split("_")[0]) for name in QUERIES if name.startswith("op")]
    assert sorted(numbers) == list(range(1, 14))


def test_labels_are_learnt_from_the_right_rows(spark):
    labels = spark.range(200).select(F.col("id").alias("doc_id"))
    assert {r[0] for r in learnable(labels).collect()} == {i for i in range(200) if zlib.crc32(str(i).encode()) % 5}
