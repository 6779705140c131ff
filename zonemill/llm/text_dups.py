"""Near-duplicate texts: a MinHash LSH forest, exact similarity of whole shingle sets, components.

1. Every text gets the set of its distinct word shingles, a signature of ``HASHES`` minima
   and, for each of ``TREES`` sorted signature orders, the key of its first ``DEPTH``
   values. Texts with equal sets are one class from here on.
2. Classes that share a key form a region of that order. Regions are sorted by the values
   that follow and read in windows, so that neighbours share the longest common prefix: a
   small region is compared as a whole, a large one first where prefixes go on, to whatever
   depth the region needs, and then between what that left apart. A window hands on the strongest links between its classes, by
   the share of equal signature values, that join those above ``SCREEN``.
3. The components of these candidates are compared exactly: the texts of a component meet in
   one task, or in one task for every two blocks of it, and pairs above the screen are
   confirmed on the full sets unless confirmed links join them already. Their components
   are the result.

A region of up to ``WINDOW`` classes is read by one task as a whole. The windows of a larger one
join most of what is alike; then all its pairs of classes that are in different components are
compared too, in blocks of ``REGION_BLOCK``. So every pair that shares a key is compared or joined
by others, whatever the size of its regions. A pair at a similarity of 0.75 shares no key with
probability (1 - 0.75**4)**32 < 1e-5 and falls below the screen with probability < 1e-6. A component of more than ``BLOCK`` different texts costs work that is quadratic in its number of different
texts, spread over tasks; exact copies cost nothing.

Defined cases: NULL texts and texts without a word have no shingles, link with nothing and
are kept; texts of fewer words than a shingle are one shingle; a row with a NULL id is
compared with nothing and kept, its component NULL; rows that repeat an id and its text are one
document of which every row is returned, rows of one id with different texts are different
documents, each with its own component; columns other than the two named are ignored; an empty
table gives an empty result; of equal candidates the smaller ids win.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonemill.functions.columns import quoted
from zonemill.llm.common import WordCache, written
from zonemill.llm.components import connected_components, merged

WORDS, TREES, DEPTH = 5, 32, 4
HASHES = TREES * DEPTH
SCREEN, LEAST = 0.56, 75
WINDOW, OVERLAP, BLOCK, REGION_BLOCK = 64, 16, 256, 2048
MARKS = "n_shingles long, h1 long, h2 long, keys array<long>, sketch binary"

_random = np.random.default_rng(20260102)
MIX = _random.integers(1, 2**63, 16, dtype=np.uint64) | np.uint64(1)
SLOPES = _random.integers(1, 2**32, (HASHES, 1), dtype=np.uint32) | np.uint32(1)
SHIFTS = _random.integers(0, 2**32, (HASHES, 1), dtype=np.uint32)


def mixed(x: np.ndarray, which: int = 5) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * MIX[which]
    return x ^ (x >> np.uint64(29))


class Shingles:
    """Sets of word shingles as sorted 64-bit hashes."""

    def __init__(self, size: int = WORDS):
        self.size = size
        self.words = WordCache(xxhash.xxh3_64_intdigest)

    def of(self, text: str | None) -> np.ndarray:
        # Lower case for A-Z only, and only the six white-space bytes part words.
        words = (text or "").encode().lower().split()
        hashes = np.fromiter(map(self.words.__getitem__, words), dtype=np.uint64, count=len(words))
        self.words.trim()
        if not len(hashes):
            return hashes
        n = min(self.size, len(hashes))
        total = np.full(len(hashes) - n + 1, n, dtype=np.uint64) * MIX[6:7]
        for k in range(n):
            total += hashes[k : len(hashes) - n + 1 + k] * MIX[k % 5] + MIX[7:8] * np.uint64(k // 5)
        return np.unique(mixed(total))


def signature(shingles: np.ndarray) -> np.ndarray:
    """The least value of each hash function over a set."""
    least = np.full(HASHES, 2**32 - 1, dtype=np.uint32)
    values = (shingles >> np.uint64(32)).astype(np.uint32)
    for start in range(0, len(values), 1024):
        least = np.minimum(least, (SLOPES * values[None, start : start + 1024] + SHIFTS).min(axis=1))
    return least


def tree_keys(least: np.ndarray) -> np.ndarray:
    """The key of the first ``DEPTH`` values in each order; order t starts at value t * DEPTH."""
    parts = least.astype(np.uint64).reshape(TREES, DEPTH)
    total = np.arange(TREES, dtype=np.uint64) * MIX[8]
    for k in range(DEPTH):
        total = total + parts[:, k] * MIX[9 + k]
    return mixed(total, 13).view(np.int64)


def sketch(least: np.ndarray) -> np.ndarray:
    """A byte of each value: equal values have equal bytes, others rarely."""
    return ((least * np.uint32(2654435761)) >> np.uint32(24)).astype(np.uint8)


def _marked(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(size)
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                found = shingles.of(text)
                if not len(found):
                    rows.append((0, 0, 0, None, None))
                    continue
                least = signature(found)
                sums = int(found.sum().view(np.int64)), int(mixed(found, 14).sum().view(np.int64))
                rows.append((len(found), *sums, tree_keys(least).tolist(), sketch(least).tobytes()))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary())
            fresh = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), *fresh], names=["doc_id", "text_hash", "n_shingles", "h1", "h2", "keys", "sketch"]
            )

    return run


def _in_groups(batches: Iterator[pa.RecordBatch], key: list[str]) -> Iterator[list[dict]]:
    """Runs of rows with equal keys from a sorted stream."""
    group, now = [], None
    for batch in batches:
        for row in batch.to_pylist():
            mark = tuple(row[k] for k in key)
            if mark != now and group:
                yield group
                group = []
            now = mark
            group.append(row)
    if group:
        yield group


def alike(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Numbers of equal sketch bytes between the rows of two blocks."""
    return np.array([(two == row).sum(axis=1) for row in one])


def strongest(ids: np.ndarray, sketches: np.ndarray) -> list[tuple[int, int]]:
    """A forest of the strongest links above the screen that joins all that they join."""
    equal = alike(sketches, sketches)
    x, y = np.nonzero(np.triu(equal >= SCREEN * HASHES, 1))
    root, links = np.arange(len(ids)), []
    for at in np.lexsort((ids[y], ids[x], -equal[x, y])):
        a, b = root[x[at]], root[y[at]]
        if a != b:
            root[root == max(a, b)] = min(a, b)
            one, two = int(ids[x[at]]), int(ids[y[at]])
            if one != two:
                links.append((max(one, two), min(one, two)))
    return links


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidate links from regions that arrive sorted by key and the values that follow."""

    def region(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
        # A region is held only window by window.
        held: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if held and held[-1]["key"] != row["key"]:
                    yield held
                    held = []
                held.append(row)
                if len(held) == WINDOW:
                    yield held
                    held = held[-OVERLAP:]
        yield held

    seen: set[tuple[int, int]] = set()

    def out() -> pa.RecordBatch:
        pairs = sorted(seen)
        seen.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], names=["a", "b"]
        )

    for rows in region(batches):
        if len(rows) > 1:
            sketches = np.frombuffer(b"".join(r["sketch"] for r in rows), np.uint8).reshape(len(rows), -1)
            seen.update(strongest(np.array([r["class"] for r in rows]), sketches))
        if len(seen) >= 50_000:
            yield out()
    yield out()


def _rest_of_regions(members: DataFrame, families: DataFrame) -> DataFrame:
    """Links above the screen between classes of a large region that are in different components.

    The classes outside the region's largest component meet all classes of the region, block
    by block, so that no task holds more than two blocks, however large a region is.
    """
    own = members.join(families, "class", "left").withColumn("component", F.coalesce("component", "class"))
    counts = own.groupBy("key", "component").agg(F.count(F.lit(1)).alias("held"))
    top = counts.groupBy("key").agg(F.max(F.struct("held", "component")).alias("top"), F.sum("held").alias("all"))
    top = top.filter(F.col("top.held") < F.col("all"))
    blocks, others = F.ceil(F.col("all") / REGION_BLOCK), F.ceil((F.col("all") - F.col("top.held")) / REGION_BLOCK)
    own = own.join(top.select("key", F.col("top.component").alias("largest"), blocks.alias("blocks"), others.alias("others")), "key")

    def block(number: str, salt: str) -> Column:
        return F.pmod(F.xxhash64("class", F.lit(salt)), F.col(number))

    def each(number: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(number) - 1))

    told = ["key", "class", "sketch", "component"]
    rest = own.filter(F.col("component") != F.col("largest"))
    rest = rest.select(*told, F.lit(True).alias("asks"), block("others", "rest").alias("one"), each("blocks").alias("two"))
    every = own.select(*told, F.lit(False).alias("asks"), each("others").alias("one"), block("blocks", "all").alias("two"))
    tiles = rest.unionByName(every).repartition("key", "one", "two").sortWithinPartitions("key", "one", "two")
    return tiles.mapInArrow(_between, "a long, b long")


def _between(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The strongest links between components of tiles that arrive sorted."""
    for rows in _in_groups(batches, ["key", "one", "two"]):
        asking, asked = [r for r in rows if r["asks"]], [r for r in rows if not r["asks"]]
        if not asking or not asked:
            continue
        ids = np.array([r["class"] for r in (*asking, *asked)])
        _, root = np.unique([r["component"] for r in (*asking, *asked)], return_inverse=True)
        one, two = (np.frombuffer(b"".join(r["sketch"] for r in some), np.uint8).reshape(len(some), -1) for some in (asking, asked))
        links = []
        equal = alike(one, two)
        x, y = np.nonzero((equal >= SCREEN * HASHES) & (root[: len(one), None] != root[None, len(one) :]))
        for at in np.argsort(-equal[x, y], kind="stable"):
            a, b = x[at], len(one) + y[at]
            if root[a] != root[b]:
                root[root == max(root[a], root[b])] = min(root[a], root[b])
                links.append((int(max(ids[a], ids[b])), int(min(ids[a], ids[b]))))
        if links:
            yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in links], pa.int64()) for i in (0, 1)], names=["a", "b"])


def shared(one: np.ndarray, two: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(one) > len(two):
        one, two = two, one
    at = np.searchsorted(two, one)
    return int((two[np.minimum(at, len(two) - 1)] == one).sum())


def _confirm(size: int, percent: int):
    """Confirmed links of tiles: (a, b) with b the least class that a is joined to in the tile."""

    def links(rows: list[dict], shingles: Shingles) -> list[tuple[int, int]]:
        rows = sorted({(r["class"], r["block"]): r for r in rows}.values(), key=lambda r: r["class"])
        ids = np.array([r["class"] for r in rows])
        sketches = np.frombuffer(b"".join(r["sketch"] for r in rows), np.uint8).reshape(len(rows), -1)
        block = np.array([r["block"] for r in rows])
        left, right = np.nonzero(block == rows[0]["one"])[0], np.nonzero(block == rows[0]["two"])[0]
        sets = [shingles.of(r["text"]) for r in rows]
        sizes = np.array([len(s) for s in sets])
        equal = alike(sketches[left], sketches[right])
        x, y = np.nonzero(equal >= SCREEN * HASHES)
        strength, x, y = equal[x, y], left[x], right[y]
        if rows[0]["one"] == rows[0]["two"]:
            strength, x, y = strength[x < y], x[x < y], y[x < y]
        fits = 100 * np.minimum(sizes[x], sizes[y]) >= percent * np.maximum(sizes[x], sizes[y])
        strength, x, y = strength[fits], x[fits], y[fits]
        order = np.argsort(-strength, kind="stable")
        root = np.arange(len(rows))
        for a, b in zip(x[order].tolist(), y[order].tolist(), strict=True):
            if root[a] != root[b]:
                both = shared(sets[a], sets[b])
                if 100 * both >= percent * (sizes[a] + sizes[b] - both):
                    root = merged(root, np.array([a]), np.array([b]))
        moved = np.nonzero(root != np.arange(len(rows)))[0]
        return [(int(ids[at]), int(ids[root[at]])) for at in moved]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(size)
        for rows in _in_groups(batches, ["component", "one", "two"]):
            found = links(rows, shingles)
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p[i] for p in found], pa.int64()) for i in (0, 1)], names=["a", "b"]
                )

    return run


def near_duplicates(
    docs: DataFrame, percent: int = 75, words: int = WORDS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept, and text_hash, which tells rows of one id apart.

    ``percent`` is at least ``LEAST``: trees, depth and screen would lose most links below it.
    """
    if percent < LEAST:
        raise ValueError(f"percent must be at least {LEAST}, not {percent}")
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    given = given.withColumn("text_hash", F.xxhash64("text"))
    marked = given.select("doc_id", "text", "text_hash").mapInArrow(_marked(words), f"doc_id long, text_hash long, {MARKS}")
    marked = written(marked, "shingles")
    same, head = ["n_shingles", "h1", "h2"], ["doc_id", "text_hash"]
    named = marked.filter(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    # Classes are numbered as they are written, so an id with several texts names no class. The
    # first text of the first id stands for a class.
    classes = named.groupBy(*same).agg(F.min(F.struct(*head)).alias("head")).withColumn("class", F.monotonically_increasing_id())
    classes = written(classes.select(*same, "head.*", "class"), "classes")
    heads = named.join(classes, [*same, *head]).dropDuplicates(["class"])
    heads = written(heads.select("class", *head, "keys", "sketch"), "heads")

    places = heads.select("class", F.posexplode("keys").alias("tree", "key"))
    regions = places.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    active = written(places.join(regions, "key"), "regions")
    following = F.substring(F.concat("sketch", "sketch"), DEPTH * (F.col("tree") + 1) + 1, F.lit(16))
    members = written(
        active.join(heads.select("class", "sketch"), "class").select(
            "key", "n", following.alias("following"), "class", "sketch"
        ),
        "members",
    )
    small, large = members.filter(F.col("n") <= WINDOW), members.filter(F.col("n") > WINDOW)
    order, read = ["key", "following", "class"], ["key", "class", "sketch"]
    whole = small.repartition("key").sortWithinPartitions(*order).select(*read)
    cut = large.repartitionByRange(*order).sortWithinPartitions(*order).select(*read)
    candidates = whole.mapInArrow(_windows, "a long, b long").unionByName(cut.mapInArrow(_windows, "a long, b long"))
    families = written(
        connected_components(candidates, "candidates").select(F.col("id").alias("class"), "component"), "families"
    )
    # Pairs of large regions that no window held, unless they are in one component already.
    more = written(_rest_of_regions(large.select("key", "class", "sketch", "n"), families), "more")
    if more.limit(1).count():
        known = families.select(F.col("class").alias("a"), F.col("component").alias("b"))
        both = connected_components(known.unionByName(more), "candidates")
        families = written(both.select(F.col("id").alias("class"), "component"), "families")

    sizes = families.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    dealt = (
        families.join(sizes, "component")
        .withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .select("class", "component", "block", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"))
    )
    # Texts of the candidates alone are moved, once for all tiles of a class and then to each tile.
    texts = families.select("class").join(heads.select("class", *head, "sketch"), "class")
    full = texts.join(given, head).select("class", "text", "sketch")
    tiles = dealt.join(full, "class").repartition("component", "one", "two")
    tiles = tiles.sortWithinPartitions("component", "one", "two")
    links = written(tiles.mapInArrow(_confirm(words, percent), "a long, b long"), "links")

    groups = connected_components(links, "groups").select(F.col("id").alias("class"), "component")
    grouped = classes.join(groups, "class", "left").withColumn("component", F.coalesce("component", "class"))
    least = grouped.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    of_class = grouped.join(least, "component").select(*same, "component_id")
    found = marked.select(*head, *same).join(of_class, same, "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id")
    found = found.select("doc_id", "n_shingles", own, "text_hash")
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept")
    return found.select("doc_id", "n_shingles", "component_id", kept, "text_hash")


def without_near_duplicates(
    docs: DataFrame, percent: int = 75, words: int = WORDS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` that :func:`near_duplicates` keeps, told apart by id and text."""
    found = near_duplicates(docs, percent, words, id_col, text_col).filter(~F.col("kept"))
    gone = found.select("doc_id", "text_hash").distinct().alias("gone")
    given = docs.alias("given")
    of_id = F.col(f"given.{quoted(id_col)}").cast("long") == F.col("gone.doc_id")
    of_text = F.xxhash64(F.col(f"given.{quoted(text_col)}")) == F.col("gone.text_hash")
    return given.join(gone, of_id & of_text, "left_anti")
