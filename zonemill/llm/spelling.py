"""Grouping of spelling variants by an index of variable-length grams.

Words are the runs of letters of a corpus with their number of occurrences. Two words are near
if they differ by exactly one inserted, deleted or replaced code point.

*Gram dictionary.* Grams of ``SHORTEST`` code points on are counted over all words. A gram that
stands more than a threshold's times is too common to tell words apart and is pruned: its
extensions by one code point take its place, up to ``LONGEST``. The threshold is the number of
gram places over ``COMMON``, so no more than ``COMMON`` grams of a length are above it, and
only these reach the driver and the tasks. The dictionary itself, all grams that no pruned
gram stops short of, is implied by them.

*Decomposition.* A word, with a mark at both ends, has one gram at each place: the shortest
that is not pruned. The gram depends on the code points it covers alone, so one edit affects
only the grams that cover the edited place.

*Bounds.* The most grams of a word that any one edit can affect is counted exactly, as the
depth to which its grams cover a place. If it is m, a near word shares all but m grams. With
the grams of every word in one order, rarest first, the first shared gram is among the first
m + 1 of both words: a word enters only these lists. With at least ``LONGEST`` code points
a word has more than m grams, so no near pair is lost.

*Merging.* One edit leaves everything on one side of it alone. A shared gram therefore comes
with all that stands before it, or with all that stands behind it, and the lists are kept by
gram and either of these, in one shuffle. A task reads its lists as a sorted stream and holds
one of up to ``LIST`` words. Near words in it are found by what is left of the rest of a word
without one code point, so the work follows the words of a list, not their pairs. The words of
a longer list are handed on as they come, and meet by list and place of the edit in a join, in
groups that hold no more words than one place has code points; there the edit distance decides.

Defined cases: NULL and empty texts hold no word; a NULL id counts as an empty one; a repeated
row counts again; an empty table gives an empty result; texts and words of any length are read
whole; equal counts are told apart by the order of the code points; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonemill.llm.common import written

SHORTEST, LONGEST = 2, 5
COMMON = 50_000
LIST = 1_000
# Words whose counts a task holds before it hands them on.
HELD = 300_000
LONG_TEXT, LONG_WORD = 1 << 20, 256
FIRST, LAST = "\x02", "\x03"


def counted(words: Iterator[Counter]) -> Iterator[pa.RecordBatch]:
    """Counters summed up and handed on as (word, n) in parts of bounded size."""
    held: Counter = Counter()
    for some in words:
        held.update(some)
        if len(held) >= HELD:
            yield _counts(held)
            held.clear()
    yield _counts(held)


def _counts(held: Counter) -> pa.RecordBatch:
    columns = [pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())]
    return pa.RecordBatch.from_arrays(columns, names=["word", "n"])


def one_in(divisor: int) -> Callable[[str], Callable[[str], str]]:
    """A change of words that a hash of document and word draws: one in ``divisor`` loses a code point."""

    def of_document(name: str) -> Callable[[str], str]:
        seed = zlib.crc32(f"{name}:".encode())

        def change(word: str) -> str:
            h = zlib.crc32(word.encode(), seed)
            if h % divisor:
                return word
            at = h % len(word)
            return word[:at] + word[at + 1 :]

        return change

    return of_document


def corpus_words(
    docs: DataFrame,
    letters: str,
    least: int,
    change: Callable[[str], Callable[[str], str]] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(word, n): runs of ``letters`` of at least ``least`` code points, A-Z in lower case, over all texts.

    ``change`` gives, for the id of a document as text, a function of its words to those counted.
    """
    given = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("name"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = re.compile(f"[{letters}]{{{least},}}")
        every, one_by_one = pattern.findall, pattern.finditer

        def of_texts() -> Iterator[Counter]:
            for batch in batches:
                for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    if not text:
                        continue
                    text = text.encode().lower().decode()  # bytes.lower() changes A-Z only
                    words = Counter(every(text) if len(text) < LONG_TEXT else map(re.Match.group, one_by_one(text)))
                    if change is None:
                        yield words
                        continue
                    other, changed = change(name), Counter()
                    for word, n in words.items():
                        changed[other(word)] += n
                    yield changed

        yield from counted(of_texts())

    # A change may shorten a word.
    summed = given.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return summed.filter(F.char_length("word") >= least)


def common_grams(words: DataFrame) -> dict[str, int]:
    """The pruned grams and their counts, no more than ``COMMON`` of each length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def of_words() -> Iterator[Counter]:
            for batch in batches:
                for word in batch.column(0).to_pylist():
                    s = FIRST + word + LAST
                    yield Counter(s[p : p + q] for q in range(SHORTEST, LONGEST + 1) for p in range(len(s) - q + 1))

        yield from counted(of_words())

    places = words.agg(F.sum(F.char_length("word") + 1)).first()[0] or 0
    grams = words.select("word").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    found = grams.filter(F.col("n") > max(1, places // COMMON)).toArrow()
    return dict(zip(found.column("word").to_pylist(), found.column("n").to_pylist(), strict=True))


def decompose(s: str, common: dict[str, int]) -> list[int]:
    """Where the gram ends that stands at each place of a marked word."""
    ends, n = [], len(s)
    for p in range(n - SHORTEST + 1):
        e = p + SHORTEST
        while e < n and e - p < LONGEST and s[p:e] in common:
            e += 1
        ends.append(e)
    return ends


def affected(ends: list[int]) -> int:
    """The most grams that one edit can affect."""
    # The grams that cover a place start fewer than LONGEST places before it.
    return max(sum(e > p for e in ends[max(0, p - LONGEST + 1) : p + 1]) for p in range(len(ends)))


def list_keys(word: str, common: dict[str, int]) -> dict[int, int]:
    """The lists that a word enters: by each of its rarest grams, with all before it and with all behind it.

    Of each its key and how many code points of the word are fixed by it, from the front or, as a
    negative number, from the back.
    """
    s = FIRST + word + LAST
    ends = decompose(s, common)
    grams = [s[p:e] for p, e in enumerate(ends)]
    # A shared gram keeps its rank among the grams of the same text, whatever stands around it.
    order = sorted(range(len(ends)), key=lambda p: (common.get(grams[p], 0), grams[p], p))
    keys = {}
    for p in order[: affected(ends) + 1]:
        front, back = min(ends[p] - 1, len(word)), min(len(s) - 1 - p, len(word))
        keys[xxhash.xxh3_64_intdigest(f"{p}<{s[: ends[p]]}") - (1 << 63)] = front
        keys[xxhash.xxh3_64_intdigest(f"{ends[p] - p}>{s[p:]}") - (1 << 63)] = -back
    return keys


def _indexed(common: dict[str, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                keys = [list_keys(word, common) for word in part.column(0).to_pylist()]
                rows = pa.array([i for i, some in enumerate(keys) for _ in some], pa.int64())
                given = [pa.array([k for some in keys for k in some], pa.int64()), pa.array([f for some in keys for f in some.values()], pa.int32())]
                yield pa.RecordBatch.from_arrays([*given, *(c.take(rows) for c in part.columns)], names=["key", "fixed", "word", "n"])

    return run


def one_edit(a: str, b: str) -> bool:
    """Whether exactly one code point is inserted, deleted or replaced."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    low, high = 0, len(a)  # the length of the common front
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a[low:middle] == b[low:middle] else (low, middle - 1)
    return a[low + (len(a) == len(b)) :] == b[low + 1 :]


def near_in_list(words: list[str], fixed: int) -> set[tuple[int, int]]:
    """Places of the near words of a list whose words share the ``fixed`` code points.

    Words of ``LONG_WORD`` code points on are compared pair by pair, as their shortened forms take room.
    """
    rest = [w[fixed:] if fixed > 0 else w[: len(w) + fixed] for w in words]
    whole = {r: i for i, r in enumerate(rest)}
    replaced: dict[tuple[int, str], list[int]] = {}
    pairs = set()
    for i, r in enumerate(rest):
        if len(words[i]) > LONG_WORD:
            continue
        for at in range(len(r)):
            left = r[:at] + r[at + 1 :]
            other = whole.get(left)
            if other is not None:
                pairs.add((i, other))
            replaced.setdefault((at, left), []).append(i)
    for same in replaced.values():
        pairs.update((a, b) for a in same for b in same if a < b)
    long = [i for i, w in enumerate(words) if len(w) >= LONG_WORD]
    pairs.update((a, b) for at, a in enumerate(long) for b in long[:at] if one_edit(words[a], words[b]))
    return pairs


MERGED = "word string, n long, other string, other_n long, key long, place long, whole boolean"


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near pairs of short lists, and the words of long ones by place, from lists that arrive sorted."""
    out: list[tuple] = []

    def told() -> pa.RecordBatch:
        kinds = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.bool_())
        columns = list(zip(*out, strict=True)) or [()] * 7
        out.clear()
        names = [part.split()[0] for part in MERGED.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    def short(group: list[tuple[str, int]], fixed: int) -> None:
        words = [w for w, _ in group]
        for a, b in near_in_list(words, fixed):
            if words[a] > words[b]:
                a, b = b, a
            out.append((*group[a], *group[b], None, None, None))

    now, fixed_now, group, long = None, 0, [], False
    for batch in batches:
        for key, fixed, word, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if key != now:
                if len(group) > 1 and not long:
                    short(group, fixed_now)
                now, fixed_now, group, long = key, fixed, [], False
            group.append((word, n))
            if long or len(group) > LIST:
                long = True
                for w, m in group:
                    for place, whole in edit_places(w):
                        out.append((w, m, None, None, key, place, whole))
                        if len(out) * len(w) > 4_000_000:
                            yield told()
                group = []
            if len(out) > 20_000:
                yield told()
    if len(group) > 1 and not long:
        short(group, fixed_now)
    yield told()


def edit_places(word: str) -> list[tuple[int, bool]]:
    """(place, whole) keys: of the word without each of its code points, and of the word itself at every gap.

    Words that differ by one replaced code point share a key of the first kind; a word with one
    code point more than another has a key of the first kind that is of the second kind there.
    """
    before, behind = xxhash.xxh3_64(), xxhash.xxh3_64()
    heads, tails = [before.intdigest()], [behind.intdigest()]
    for c in word:
        before.update(c.encode())
        heads.append(before.intdigest())
    for c in reversed(word):
        behind.update(c.encode())
        tails.append(behind.intdigest())
    n = len(word)

    def key(size: int, at: int, tail: int) -> int:
        return xxhash.xxh3_64_intdigest(f"{size} {at} {heads[at]} {tails[tail]}") - (1 << 63)

    return [(key(n - 1, i, n - 1 - i), False) for i in range(n)] + [(key(n, i, n - i), True) for i in range(n + 1)]


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, n, other, other_n): near words, each pair in both orders; every word has at least ``LONGEST`` code points."""
    index = words.select("word", "n").mapInArrow(_indexed(common_grams(words)), "key long, fixed int, word string, n long")
    parts = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lists = index.repartition(parts, "key").sortWithinPartitions("key")
    merged = written(lists.mapInArrow(_merged, MERGED), "lists")
    by_gram = merged.filter(F.col("other").isNotNull()).select("word", "n", "other", "other_n")
    placed = merged.filter(F.col("place").isNotNull()).select("word", "n", "key", "place", "whole")
    # A near word is found on one side by the key of what one edit leaves.
    a, b = placed.filter(~F.col("whole")).alias("a"), placed.alias("b")
    met = (F.col("a.key") == F.col("b.key")) & (F.col("a.place") == F.col("b.place")) & (F.col("a.word") != F.col("b.word"))
    once = F.col("b.whole") | (F.col("a.word") < F.col("b.word"))
    by_place = _checked(a.join(b, met & once & _one_edit()))
    pairs = written(by_gram.unionByName(by_place).distinct(), "near")
    turned = pairs.select(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    return pairs.unionByName(turned)


def _one_edit() -> Column:
    apart = F.abs(F.char_length("a.word") - F.char_length("b.word")) <= 1
    return apart & (F.levenshtein(F.col("a.word"), F.col("b.word"), 1) == 1)


def _checked(met: DataFrame) -> DataFrame:
    """The pairs of a join, the smaller word first."""
    first = F.col("a.word") < F.col("b.word")
    return met.select(
        F.least("a.word", "b.word").alias("word"),
        F.when(first, F.col("a.n")).otherwise(F.col("b.n")).alias("n"),
        F.greatest("a.word", "b.word").alias("other"),
        F.when(first, F.col("b.n")).otherwise(F.col("a.n")).alias("other_n"),
    )


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): where following the forms ends. ``forms`` holds (word, form) for words that have one.

    Every round doubles the way gone. Counts at least double from a word to its form, so ways
    are no longer than the logarithm of a count, and a few rounds reach every end.
    """
    now = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        a, b = now.alias("a"), now.alias("b")
        further = a.join(b, F.col("a.root") == F.col("b.word"), "left")
        now = written(
            further.select("a.word", F.coalesce("b.root", "a.root").alias("root"), F.col("b.root").isNotNull().alias("moved")),
            "roots",
        )
        if not now.filter("moved").limit(1).count():
            return now.select("word", "root")
        now = now.drop("moved")


def group_variants(words: DataFrame, ratio: int = 2) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of (word, n).

    ``form`` is the near word of largest n, if that is at least ``ratio`` times the word's.
    """
    words = written(words.select("word", "n"), "words")
    least = words.agg(F.min(F.char_length("word"))).first()[0]
    if least is not None and least < LONGEST:
        raise ValueError(f"words must have at least {LONGEST} code points")
    best = near_pairs(words).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best")
    )
    told = words.join(best, "word", "left")
    told = told.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.col("best.other").alias("form"), (-F.col("best.less")).alias("form_n"))
    real = F.col("form_n") >= ratio * F.col("n")
    told = written(told.withColumns({c: F.when(real, F.col(c)) for c in ("form", "form_n")}), "forms")
    ends = roots(told.filter(F.col("form").isNotNull()))
    return told.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
