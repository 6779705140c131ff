import pytest
from pyspark.sql import functions as F

from zonemill.llm import mixing
from zonemill.llm.mixing import calibrated, mix
from zonemill.llm.queries import MIX_POWERS, topic

SCHEMA = "doc_id long, source string, lang string, text string, kept string"


def docs(spark, rows):
    return spark.createDataFrame([(i, s, la, t, "old") for i, (s, la, t) in enumerate(rows)], SCHEMA)


def test_marginals_and_expected_tokens(spark):
    rows = [("a" if i % 3 else "b", "en" if i % 5 else "de", "x" * (4 * (1 + i % 7))) for i in range(3000)]
    targets = {
        "source": spark.createDataFrame([("a", 1.0), ("b", 1.0)], "source string, target double"),
        "lang": spark.createDataFrame([("en", 3.0), ("de", 1.0)], "lang string, target double"),
    }
    mixed = mix(docs(spark, rows), targets=targets, keep_share=0.3)
    expected = {
        column: {r[0]: r[1] for r in mixed.groupBy(column).agg(F.sum(F.col("tokens") * F.col("probability"))).collect()}
        for column in targets
    }
    total = mixed.agg(F.sum("tokens")).first()[0]
    assert sum(expected["source"].values()) == pytest.approx(0.3 * total)
    assert expected["source"]["a"] == pytest.approx(expected["source"]["b"], rel=1e-6)
    assert expected["lang"]["en"] == pytest.approx(3 * expected["lang"]["de"], rel=1e-6)
    kept = mixed.filter("kept").agg(F.sum("tokens")).first()[0]
    assert kept == pytest.approx(0.3 * total, rel=0.1)
    assert mixed.columns == ["doc_id", "source", "lang", "text", "tokens", "probability", "kept"]
    assert [r["kept"] for r in mixed.orderBy("doc_id").collect()] == [r["kept"] for r in mixed.orderBy("doc_id").collect()]


def test_whole_cells_and_all_kept(spark):
    rows = [("hot", "en", "x" * 40)] * 300 + [("rare", "en", "x" * 40)] * 10
    levelled = {r["source"]: r["p"] for r in mix(docs(spark, rows), {"source": 0.0}, keep_share=0.5)
                .groupBy("source").agg(F.max("probability").alias("p")).collect()}
    assert levelled["rare"] == 1.0 and levelled["hot"] == pytest.approx((0.5 * 310 - 10) / 300)
    assert mix(docs(spark, rows), {"source": 1.0}, keep_share=1.0).filter("NOT kept").isEmpty()


def test_nulls_empty_texts_and_missing_targets(spark):
    rows = [(None, None, None), (None, "en", ""), ("a", "en", "x" * 400), ("b", None, "x" * 400), (None, "en", "y" * 400)]
    found = mix(docs(spark, rows), {"source": 1.0, "lang": 1.0}, keep_share=1.0).orderBy("doc_id").collect()
    assert [r["tokens"] for r in found] == [0, 0, 100, 100, 100] and all(r["kept"] for r in found)
    only = {"source": spark.createDataFrame([("a", 1.0)], "source string, target double")}
    kept = {r["doc_id"] for r in mix(docs(spark, rows), targets=only, keep_share=0.3).filter("kept").collect()}
    assert kept <= {0, 1, 2} and {3, 4}.isdisjoint(kept)
    assert mix(docs(spark, []), {"source": 0.5}).count() == 0


def test_weighted_marginals_at_the_registered_parameters(spark):
    given = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").withColumn("topic", topic(F.col("text")))
    mixed = mix(given.withColumn("w", F.lit("old")), MIX_POWERS, weight="w").select(*MIX_POWERS, "tokens", "probability", "w").cache()
    total = mixed.agg(F.sum("tokens")).first()[0]
    for column, power in MIX_POWERS.items():
        kept = F.col("tokens") * F.col("probability")
        rows = mixed.groupBy(column).agg(F.sum("tokens").alias("t"), F.sum(kept).alias("k"), F.sum(kept * F.col("w")).alias("w")).collect()
        goal = sum(r["t"] ** power for r in rows)
        assert [r["w"] / (0.9 * total) for r in rows] == pytest.approx([r["t"] ** power / goal for r in rows], rel=0.01)
        assert sum(r["k"] for r in rows) == pytest.approx(0.9 * total) == pytest.approx(sum(r["w"] for r in rows))


@pytest.mark.parametrize("keep_share", [0.05, 0.5, 0.9, 0.999, 1.0])
def test_the_scale_is_that_of_the_closed_form(spark, keep_share):
    rows = [(f"c{i}", 1 + i * 37 % 100, float((i * i) % 97)) for i in range(200)] + [("none", 0, 0.0)]
    cells = spark.createDataFrame(rows, "source string, tokens long, share double")
    found = {r["source"]: r["probability"] for r in calibrated(cells, keep_share).collect()}
    total, shares = sum(r[1] for r in rows), sum(r[2] for r in rows)
    rated = sorted(((share / shares * total / tokens, tokens, share / shares * total) for _, tokens, share in rows if tokens), reverse=True)
    whole, rest, scale = 0, sum(r[2] for r in rated), 0.0
    for _, tokens, wanted in rated:
        if rest > 1e-9 * total:
            scale = max(scale, (total * keep_share - whole) / rest)
        whole, rest = whole + tokens, rest - wanted
    for name, tokens, share in rows:
        plain = min(1.0, scale * share / shares * total / tokens) if tokens else 1.0
        assert found[name] == pytest.approx(plain, rel=1e-9)


def test_texts_without_any_token_stay(spark):
    assert mix(docs(spark, [("a", "en", ""), ("b", None, None)]), {"source": 0.7, "lang": 0.8}).filter("kept").count() == 2


def test_no_task_holds_all_cells(spark, monkeypatch):
    plans, write = [], mixing.written

    def noted(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, name)

    monkeypatch.setattr(mixing, "written", noted)
    mix(docs(spark, [("a", "en", "x" * 40), ("b", "de", "y" * 80)]), {"source": 0.7, "lang": 0.8})
    assert len(plans) == mixing.ROUNDS + 2
    assert not any("Window" in plan or "SinglePartition" in plan for plan in plans)
