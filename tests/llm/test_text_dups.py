import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from zonemill.llm import text_dups
from zonemill.llm.text_dups import Shingles, near_duplicates, without_near_duplicates

SCHEMA = "doc_id long, text string, keys string"


def shingles(text):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()


def brute(texts):
    sets = {i: shingles(t) for i, t in texts.items()}
    label = {i: i for i in texts}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    ids = sorted(texts)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                label[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def corpus(seed=5):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    passage = [draw.choice(words) for _ in range(30)]
    texts = []
    for i in range(60):
        base = [draw.choice(words) for _ in range(draw.randint(6, 120))]
        if i % 3 == 0:
            base += passage
        texts.append(base)
        for _ in range(80 if i == 0 else draw.randint(0, 3)):
            copy = list(base)
            for _ in range(draw.randint(0, 4)):
                copy[draw.randrange(len(copy))] = draw.choice(words)
            texts.append(copy)
    draw.shuffle(texts)
    return {i: " ".join(t) for i, t in enumerate(texts)}


def found(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_duplicates(df).collect()}


def test_equals_brute_force_with_a_large_group_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(text_dups, "BLOCK", 32)
    texts = corpus()
    df = spark.createDataFrame([(i, t, "x") for i, t in texts.items()], SCHEMA).repartition(3)
    assert found(df) == brute(texts)


def test_nulls_short_texts_case_and_repeats(spark):
    long = " ".join(f"v{i % 700}x{i}" for i in range(40_000))
    texts = {1: None, 2: "", 3: " \t\n ", 4: "Two Words", 5: "two\twords", 6: "two words more", 7: long, 8: long + " end",
             9: "Éa b c d e", 10: "éa b c d e", 11: "a b"}
    df = spark.createDataFrame([(i, t, "x") for i, t in texts.items()] + [(4, "Two Words", "again"), (None, "two words", "")], SCHEMA)
    rows = near_duplicates(df).collect()
    assert len(rows) == 13 and [r["component_id"] for r in rows if r["doc_id"] is None] == [None]
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows if r["doc_id"]} == brute(texts)
    assert all(r["kept"] for r in rows if r["doc_id"] in (1, 2, 3, 4, None))
    assert near_duplicates(df.limit(0)).count() == 0


def test_shingles_of_fewer_words_than_one():
    of = Shingles().of
    assert len(of("a b c")) == 1 and len(of("a b c d e f")) == 2 and len(of("a a a a a a a")) == 1
    assert set(of("a b c").tolist()) != set(of("a b c d e").tolist())


def test_similarities_that_the_trees_would_lose_are_refused(spark):
    with pytest.raises(ValueError, match="at least 75"):
        near_duplicates(spark.createDataFrame([(1, "a")], "doc_id long, text string"), 50)


def test_an_id_with_two_texts_is_two_documents(spark):
    one = "one text of words that nothing else in here shares with it at all"
    two = "quite another text of which there is a copy under an id that is less"
    rows = [(3, two + " x", ""), (5, one, ""), (5, two, ""), (7, one + " y", ""), (9, None, "")]
    df = spark.createDataFrame(rows, SCHEMA)
    by_text = {r["text_hash"]: r for r in near_duplicates(df).collect()}
    hashes = {r["text"]: r["h"] for r in df.selectExpr("text", "xxhash64(text) AS h").collect()}
    told = {t: (by_text[hashes[t]]["component_id"], by_text[hashes[t]]["kept"]) for _, t, _ in rows}
    assert told == {two + " x": (3, True), one: (5, True), two: (3, False), one + " y": (5, False), None: (9, True)}
    left = without_near_duplicates(df.withColumns({"text_hash": F.lit(1), "kept": F.lit("mine")}))
    assert sorted((r["doc_id"], r["text"] or "") for r in left.collect()) == [(3, two + " x"), (5, one), (9, "")]


def test_large_regions_lose_nothing_that_the_windows_miss(spark, monkeypatch):
    """Without any window, all links come from the comparison of what is in different components."""
    texts = corpus(seed=9)
    df = spark.createDataFrame([(i, t, "x") for i, t in texts.items()], SCHEMA).repartition(3)
    monkeypatch.setattr(text_dups, "WINDOW", 1)
    monkeypatch.setattr(text_dups, "REGION_BLOCK", 16)

    def nothing(batches):
        import pyarrow

        for _ in batches:
            pass
        yield pyarrow.RecordBatch.from_arrays([pyarrow.array([], pyarrow.int64())] * 2, names=["a", "b"])

    nothing.__module__ = "__main__"  # workers cannot import this file
    monkeypatch.setattr(text_dups, "_windows", nothing)
    assert found(df) == brute(texts)


def test_a_region_of_two_thousand_classes_equals_brute_force(spark):
    """Texts of one base with a tenth of their words changed: most pairs are near the threshold."""
    draw = random.Random(4)
    base = [f"b{i}" for i in range(200)]
    texts = {}
    for i in range(2000):
        words = list(base)
        for _ in range(draw.choice([0, 1, 2, 3, 4])):
            words[draw.randrange(len(words))] = f"n{draw.randrange(10**6)}"
        texts[i] = " ".join(words)
    sets = {i: shingles(t) for i, t in texts.items()}
    numbers = {s: n for n, s in enumerate({x for one in sets.values() for x in one})}
    held = np.zeros((len(texts), len(numbers)), dtype=np.float32)
    for i, one in sets.items():
        held[i, [numbers[s] for s in one]] = 1
    both = held @ held.T
    size = held.sum(axis=1)
    near = 100 * both >= 75 * (size[:, None] + size[None, :] - both)
    label = np.arange(len(texts))
    while True:
        least = np.where(near, label[None, :], len(texts)).min(axis=1)
        if (least == label).all():
            break
        label = least
    df = spark.createDataFrame([(i, t, "x") for i, t in texts.items()], SCHEMA).repartition(3)
    assert {i: c for i, (_, c) in found(df).items()} == dict(enumerate(label.tolist()))
