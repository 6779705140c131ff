import random
import re
import zlib
from collections import Counter

from zonemill.llm import spelling
from zonemill.llm.queries import SPELLING_LETTERS, op11_spelling
from zonemill.llm.spelling import affected, common_grams, corpus_words, decompose, edit_places, group_variants, list_keys, near_in_list, one_in


def distance_one(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_words(docs, least=5):
    counts = Counter()
    for i, text in docs:
        for run in re.findall(f"[{SPELLING_LETTERS}]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= least:
                counts[run] += 1
    return counts


def plain_groups(counts):
    near = {w: [] for w in counts}
    shapes = {}
    for w in counts:
        for key in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            shapes.setdefault(key, []).append(w)
    for w in counts:
        around = {o for key in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))} for o in shapes[key]}
        near[w] = [o for o in around if o != w and distance_one(w, o)]
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * counts[w] else None
    out = set()
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), counts[form[w]] if form[w] else None))
    return out


def words_of(spark, counts):
    return spark.createDataFrame(list(counts.items()), "word string, n long").repartition(4)


def test_query_equals_brute_force(spark):
    path = "/root/testdata/sf0.001"
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{path}/documents.parquet").collect()]
    counts = {w: n for w, n in plain_words(docs).items() if n >= 3}
    found = op11_spelling(spark, path)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert {tuple(r) for r in found.collect()} == plain_groups(counts)


def _crowd(seed, size):
    """Words of few letters, many of them near each other, of 5 to 60 letters."""
    r = random.Random(seed)
    words = Counter()
    for _ in range(size):
        w = "".join(r.choice(["ab", "aa", "ba", "bé", "ÿ"]) for _ in range(r.choice([3, 3, 4, 5, 30])))[: r.choice([5, 6, 7, 8, 60])]
        for _ in range(3):
            at = r.randrange(len(w) + 1)
            w = r.choice([w, w[:at] + r.choice("abé") + w[at:], w[:at] + w[at + 1 :], w[:at] + "b" + w[at + 1 :]])
            if len(w) >= 5:
                words[w] += r.choice([1, 2, 5, 40])
    return words


def test_no_pair_is_lost_with_common_grams_and_long_lists(spark, monkeypatch):
    counts = _crowd(1, 900)
    expected = plain_groups(counts)
    for common, at_most in ((5000, 200), (30, 4), (5, 1)):
        monkeypatch.setattr(spelling, "COMMON", common)
        monkeypatch.setattr(spelling, "LIST", at_most)
        assert {tuple(r) for r in group_variants(words_of(spark, counts)).collect()} == expected


def test_every_near_pair_shares_a_list(spark, monkeypatch):
    monkeypatch.setattr(spelling, "COMMON", 20)
    counts = _crowd(2, 500)
    common = common_grams(words_of(spark, counts))
    assert common and all(len(g) <= spelling.LONGEST for g in common)
    keys = {w: set(list_keys(w, common).items()) for w in counts}
    places = {w: edit_places(w) for w in counts}
    pairs = 0
    for a in counts:
        for b in counts:
            if a < b and distance_one(a, b):
                pairs += 1
                both = keys[a] & keys[b]
                assert any(near_in_list([a, b], fixed) for _, fixed in both)
                one = [{k for k, whole in places[w] if whole == kind} for w in (a, b) for kind in (False, True)]
                assert (one[0] & one[2]) if len(a) == len(b) else (one[0] & one[3]) | (one[1] & one[2])
    assert pairs > 300
    ends = decompose("\x02abcab\x03", {"ab": 9, "abc": 9})
    assert ends == [2, 5, 4, 5, 7, 7] and affected(ends) == 3


def test_words_of_the_corpus(spark):
    long = "x" * 200_000
    docs = [(1, "Straße STRASSE ÉCOLE école 12three four"), (1, "Straße STRASSE ÉCOLE école 12three four"),
            (None, "letters LETTERS let"), (3, None), (4, ""), (5, f"{long} {long}y " + "words " * 50_000)]
    df = spark.createDataFrame([(i, t, "mine", 7) for i, t in docs], "doc_id long, text string, word string, n long")
    found = {r["word"]: r["n"] for r in corpus_words(df, SPELLING_LETTERS, 5, one_in(97)).collect()}
    assert found == plain_words(docs)
    assert {r["word"] for r in corpus_words(df, SPELLING_LETTERS, 5).collect()} >= {"École", "école", "straße", long}
    grouped = {r["word"]: r for r in group_variants(corpus_words(df, SPELLING_LETTERS, 5)).collect()}
    assert grouped[long]["n_near"] == 1 and grouped[long]["form"] is None and grouped["words"]["root"] == "words"
    assert group_variants(corpus_words(df.limit(0), SPELLING_LETTERS, 5)).count() == 0


def test_forms_are_followed_to_the_last_and_ties_go_by_order(spark):
    chain = {"aaaaa": 1, "aaaab": 2, "aaabb": 4, "aabbb": 8, "abbbb": 16, "bbbbb": 40, "bbbbc": 40, "ccccc": 3}
    found = {r["word"]: r for r in group_variants(words_of(spark, chain)).collect()}
    assert {found[w]["root"] for w in list(chain)[:6]} == {"bbbbb"}
    assert found["abbbb"]["form"] == "bbbbb" and found["bbbbc"]["form"] is None and found["ccccc"]["n_near"] == 0
    tie = {"words": 1, "wards": 5, "woéds": 5, "woods": 5}
    assert {r["word"]: r["form"] for r in group_variants(words_of(spark, tie)).collect()}["words"] == "wards"
