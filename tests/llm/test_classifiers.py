import pytest
from pyspark.sql import functions as F

from zonemill.llm import language, quality, toxicity
from zonemill.llm.common import WordCache, remainder

SF_DIR = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def labelled(spark):
    """Labelled documents, and whether each may be learnt from."""
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{n}.parquet") for n in ("documents", "labels"))
    return docs.join(labels, "doc_id"), labels


def held_out_accuracy(scored, label):
    rows = scored.filter(remainder("doc_id", 5) == 0).select("predicted", label).collect()
    return sum(r["predicted"] == r[label] for r in rows) / len(rows), len(rows)


# A twentieth of the texts marked toxic here holds no insult, and some clean texts words of the same family.
@pytest.mark.parametrize(("classifier", "label", "least"), [(quality, "quality", 0.97), (toxicity, "toxic", 0.95)])
def test_held_out_accuracy(spark, labelled, classifier, label, least):
    docs, labels = labelled
    model = classifier.fit(docs, labels.filter(remainder("doc_id", 5) != 0))
    accuracy, rows = held_out_accuracy(classifier.score_texts(docs, model), label)
    assert accuracy > least and rows > 500


@pytest.fixture(scope="module")
def toxic_model():
    from pyarrow import parquet

    docs = parquet.read_table(f"{SF_DIR}/documents.parquet", columns=["doc_id", "text"]).to_pydict()
    labels = parquet.read_table(f"{SF_DIR}/labels.parquet").to_pydict()
    text = dict(zip(docs["doc_id"], docs["text"], strict=True))
    pairs = [(text[i], t) for i, t in zip(labels["doc_id"], labels["toxic"], strict=True)]
    pairs = [p for p in pairs if p[1]] + [p for p in pairs if not p[1]][:600]
    return toxicity.train([t for t, _ in pairs], [y for _, y in pairs])


def test_gaps_and_inserted_characters(toxic_model):
    scorer = toxicity.TextScorer(toxic_model)
    many = "the idiot is stupid trash, worthless scum"
    bad = [many, many.upper(), "an i-d-i-o-t, s-t-u-p-i-d t-r-a-s-h, worthless s.c.u.m", "the idixot is stuxpid trxash, worthxless scum",
           "i d i o t , s t u p i d and worthless scum trash", "x " * 5000 + many]
    good = ["the and of in", "onhe thdet anre", "", None, "...", "a b c d", "one idiot"]
    assert (scorer.scores(bad) >= 0.5).all() and (scorer.scores(good) < 0.5).all()
    sentence, _ = toxicity.worst_sentences(["All of it is. You stupid idiot here. The end of."], toxic_model)[0]
    assert sentence == "You stupid idiot here"


def test_dictionaries_see_whole_texts(monkeypatch):
    given = []
    learn = quality.zstandard.train_dictionary
    monkeypatch.setattr(quality.zstandard, "train_dictionary", lambda room, parts: given.append(b"".join(parts)) or learn(room, parts))
    words = [f"w{i * 7919 % 3000}" for i in range(3000)]
    texts = [f"{' '.join(words[i:] + words[:i])} end{i}" for i in range(0, 400, 10)]
    assert quality.train(texts, [i % 2 for i in range(40)])
    assert all(f"end{i * 10}".encode() in b"".join(given) for i in range(40) if i % 4 < 2)


def test_repeats_of_one_insult_count(toxic_model):
    scorer = toxicity.TextScorer(toxic_model)
    insults = ["idiot", "stupid", "trash", "worthless", "scum", "moron"]
    assert (scorer.scores([f"the {w} of a {w}, {w} and again {w}, that {w}" for w in insults]) >= 0.5).all()
    assert (scorer.scores([f"the {w} of" for w in insults]) < 0.5).all()


@pytest.mark.parametrize("stored", [0, 3, 10])
def test_a_full_store_of_words_changes_no_score(toxic_model, monkeypatch, stored):
    texts = [f"an i-d-{i}-iot, s-t-u-p-i-d it's no-{i} tr_ash. {'long' * 20}{i}" for i in range(120)] + ["an i-d-1-iot", None, "it's."]
    expected = toxicity.TextScorer(toxic_model).scores(texts)
    monkeypatch.setattr(toxicity, "STORED", stored)
    scorer = toxicity.TextScorer(toxic_model)
    # A worker reads batch after batch with the words it knows from those before.
    for size in (1, 7, len(texts)):
        found = [s for start in range(0, len(texts), size) for s in scorer.scores(texts[start : start + size])]
        assert abs(expected - found).max() < 1e-9


def test_the_store_of_words_is_bounded(toxic_model, monkeypatch):
    monkeypatch.setattr(toxicity, "STORED", 40)
    scorer = toxicity.TextScorer(toxic_model)
    for i in range(100):
        scorer.scores([f"no-{i} it's it-{i}, {i}-{i}"])
        assert len(scorer.odd) <= 40


def test_insults_cut_by_spaces(toxic_model):
    bad = ["the mo ron of id iot and stu pid with wor thless", "an i  d  i  o  t and s \t t u  p  i  d of t  r a s h",
           "it is i d i o t of it, s tu p id as tr a sh is", "id. iot, mo-ron, stu pid; wor th less"]
    good = ["the on and er in of to at it is", "a b c d e f", "un it io to of or on mo"]
    scorer = toxicity.TextScorer(toxic_model)
    assert (scorer.scores(bad) >= 0.5).all() and (scorer.scores(good) < 0.5).all()


@pytest.mark.parametrize("block", [3, 20_000])
def test_windows_have_the_values_of_the_joined_words(monkeypatch, block):
    monkeypatch.setattr(toxicity, "BLOCK", block)
    weights = toxicity.np.random.default_rng(1).normal(size=toxicity.SIZE**toxicity.ORDER)
    model, seen = toxicity.ToxicModel(weights, 0.3), set()
    words, owner = toxicity.word_rows(["i d io t the mo ron", "a b", "", "...", "q", "éß 0 x of idiots", "to " * 20])
    for first, many, values in model.window_scores(words, owner):
        joined = ["".join(words[a : a + n]) for a, n in zip(first, many, strict=True)]
        assert abs(values - model.span_scores(joined)).max() < 1e-9
        seen |= set(zip(first.tolist(), many.tolist(), strict=True))
    assert {(0, 2), (0, 4), (4, 3), (5, 2), (7, 2)} <= seen and not {(0, 5), (6, 2), (8, 2), (9, 2)} & seen
    assert max(n for _, n in seen) == toxicity.PIECES


def test_folded_weights_equal_kernels_with_every_landmark():
    landmarks = ["idiot", "stupid", "the", "onre"]
    row, table = toxicity.landmark_table(landmarks)
    gram = toxicity.kernel(landmarks, row, table)
    assert abs(gram - gram.T).max() < 1e-5 and (abs(gram.diagonal() - 1) < 0.35).all()
    alpha = [0.5, -1.0, 2.0, 0.25]
    model = toxicity.ToxicModel((table @ alpha)[row], 0.1)
    spans = ["idiot", "idixot", "zz", "", "a", "stupidity"]
    assert abs(model.span_scores(spans) - (toxicity.kernel(spans, row, table) @ alpha + 0.1)).max() < 1e-5


@pytest.mark.parametrize("classifier", [quality, toxicity])
def test_without_labels_nothing_is_rejected(spark, classifier):
    docs = spark.createDataFrame([(1, "a text", 0), (2, None, 1), (2, "", 1)], "doc_id long, text string, score int")
    labels = spark.createDataFrame([(1, None, None), (2, 7, 7), (None, 1, 1)], "doc_id long, quality int, toxic int")
    scored = classifier.score_texts(docs, classifier.fit(docs, labels))
    rows = scored.collect()
    wanted = 1 if classifier is quality else 0
    assert scored.columns == ["doc_id", "text", "score", "predicted"] and [r["predicted"] for r in rows] == [wanted] * 3
    assert classifier.score_texts(docs.limit(0), None).count() == 0


def test_language_of_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.fit(docs.filter(remainder("doc_id", 3) != 1))
    rows = language.identify(docs, model).filter(remainder("doc_id", 3) == 1).collect()
    assert sum(r["lang_pred"] == r["lang"] for r in rows) / len(rows) > 0.98
    assert all(0 <= r["score"] <= 1 for r in rows)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "12 !? _"), (4, "thenand " * 30_000)], "doc_id long, text string")
    found = {r["doc_id"]: r["lang_pred"] for r in language.identify(odd.withColumn("score", F.lit(9)), model).collect()}
    assert found == {1: "und", 2: "und", 3: "und", 4: "en"}
    assert [r["lang_pred"] for r in language.identify(odd, None).collect()] == ["und"] * 4


def test_unseen_words_back_off_to_shorter_grams():
    model = language.train(["aaab aaab aaac"] * 5 + ["zzzy zzzx zzzx"] * 5, ["a"] * 5 + ["z"] * 5)
    scores = {w: model.word_scores(w) for w in ("aaab", "aaad", "qqza", "öö")}
    assert scores["aaab"][0] > scores["aaab"][1] and scores["aaad"][0] > scores["aaad"][1] and not scores["öö"].any()
    assert language.train([], []) is None and language.train(["", None], ["a", "b"]) is None


def test_word_scores_of_a_text_with_more_words_than_the_table(monkeypatch):
    model = language.train(["aa ab ac ad ae af"], ["a"])
    scores = language.WordScores(model, 4)
    words = ["aa", "ab", "ac", "ad", "ae", "af", "zz"]
    assert (scores.of(words) == [model.word_scores(w) for w in words]).all()


def test_a_cache_forgets_and_stays_right():
    cache = WordCache(len, 3)
    for word in ["a", "bb", "ccc", "dddd", "a", "e" * 100] * 5:
        assert cache[word] == len(word)
        cache.trim()
    assert len(cache) <= 3 and len(cache.old) <= 4


def test_language_query_equals_a_plain_reading(spark):
    """Every text word by word, from the model's tables, without caches and batches."""
    import math
    from collections import Counter

    from pyspark.sql import functions as F

    from zonemill.llm import language
    from zonemill.llm.common import remainder
    from zonemill.llm.queries import op1_language

    path = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{path}/documents.parquet")
    model = language.fit(docs.filter(remainder("doc_id", 3) != 1))
    found = {r["doc_id"]: r for r in op1_language(spark, path).collect()}
    for row in docs.select("doc_id", "text").collect():
        words = Counter(language.words_of(row["text"]))
        got = found[row["doc_id"]]
        if not any(w.isalpha() for w in words):
            assert (got["lang_pred"], got["score"]) == ("und", 0.0)
            continue
        total = [0.0] * len(model.languages)
        for word, n in words.items():
            for i, value in enumerate(model.word_scores(word)):
                total[i] += n * float(value)
        top = max(total)
        assert total[model.languages.index(got["lang_pred"])] == pytest.approx(top, abs=1e-6)
        assert got["score"] == pytest.approx(1 / sum(math.exp(t - top) for t in total), abs=1e-6)
    assert docs.filter(F.col("text").isNotNull()).count() > 100


def test_quality_query_equals_a_plain_reading(spark):
    """Compressed sizes chunk by chunk and the logistic curve term by term, a text at a time."""
    import math

    import zstandard

    from zonemill.llm import quality
    from zonemill.llm.queries import learnable, op9_quality

    path = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{path}/documents.parquet")
    model = quality.fit(docs, learnable(spark.read.parquet(f"{path}/labels.parquet")))
    found = {r["doc_id"]: r for r in op9_quality(spark, path).collect()}

    def packed(chunk, dictionary=None):
        held = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        settings = {"write_content_size": False, "write_checksum": False, "write_dict_id": False}
        return len(zstandard.ZstdCompressor(level=3, dict_data=held, **settings).compress(chunk))

    for row in docs.select("doc_id", "text").filter("length(text) < 3000").limit(40).collect():
        data, features = (row["text"] or "").encode(), []
        for size, (good, bad) in model.dictionaries.items():
            parts = [data[i : i + size] for i in range(0, len(data), size)] or [b""]
            a, b = (sum(packed(p, d) for p in parts) for d in (good, bad))
            features += [(b - a) / max(a, b), a / max(1, len(data)), b / max(1, len(data))]
        largest = max(model.dictionaries)
        parts = [data[i : i + largest] for i in range(0, len(data), largest)] or [b""]
        features.append(sum(map(packed, parts)) / max(1, len(data)))
        z = [min(6.0, max(-6.0, (x - float(m)) / float(s))) for x, m, s in zip(features, model.middle, model.spread, strict=True)]
        terms = [1.0, *z, *[z[i] * z[j] for i in range(len(z)) for j in range(i, len(z))]]
        value = sum(t * float(c) for t, c in zip(terms, model.curve, strict=True))
        score = 1 / (1 + math.exp(-min(30.0, max(-30.0, value))))
        got = found[row["doc_id"]]
        assert got["score"] == pytest.approx(score, abs=1e-9) and got["predicted"] == int(got["score"] >= 0.3)
