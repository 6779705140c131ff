"""Language-model scores: a hashed maximum-entropy model with a class-factored softmax.

Tokens are the white-space separated words of a text, A-Z in lower case, and one end per text.
The probability of a token is that of its class, given the two tokens before it, times its
probability within the class.

*Classes.* The ``SINGLES`` commonest training words and the end are classes of their own; any
other word belongs to one of ``ENDINGS`` classes by a hash of its last two bytes. So every
token, known or not, has a class that is found without a table of the vocabulary.

*Class softmax.* The log-linear weights of the features (class, word before), (class, word
before that: a skip) and (class, both) lie in one hashed table of ``2 ** TABLE_BITS`` numbers;
words are told apart by their classes. The counts of (context, class) over all training texts
are the sufficient statistic of the model. They are gathered once by Spark, and ``ROUNDS``
gradient updates follow: tasks compute the gradient of their contexts, tasks sum slices of it,
and the sums update the table, each weight by a step of its own size under a Gaussian prior.

*Within a class.* A known word has its discounted share of the class's training tokens. The
discount of all its words, with half a token more, is the share of words never seen, from the
numbers of words seen once and twice. The unknown token is one event, as in the base score:
its probability is summed over the classes. Probabilities of all tokens that can come next add
up to one (tested).

*Scale.* The vocabulary grows with the texts and stays distributed: counted with partial sums
in the tasks, written, and joined by word. Only words above a count that no more than ``KNOWN``
words reach go to the tasks, which score them on the spot; every other occurrence travels as one
row to its word's count and back to its text. All else that leaves the tasks is bounded: class
counts, the weight table, and contexts times classes.

Defined cases: NULL and empty texts are an end alone; a repeated row is scored as often as it
stands there; with nothing to learn from, every token is the unknown one with probability 1;
texts of any length are read whole; other columns are kept if asked for. ``docs`` must give the
same rows in the same order when a task runs again, as a table scan does.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonemill.llm.common import WordCache, written

SINGLES, ENDINGS = 159, 96
CLASSES = 1 + SINGLES + ENDINGS
KNOWN = 65_536
TABLE_BITS = 19
ROUNDS, STEP, PRIOR, LARGEST = 12, 0.4, 0.5, 1.0
# Tasks that share the contexts, and slices of the table that are summed: the statistic is bounded by the number of classes.
GRADIENT_PARTS = 8
HELD = 300_000
# The end, as a word that no text holds.
END = b" "
LN10 = float(np.log(10.0))


def words_of(text: str | None) -> list[bytes]:
    """Split at the six ASCII white-space characters; bytes.lower() changes A-Z only."""
    return text.encode().lower().split() if text else []


def ending(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % ENDINGS


def _random_codes() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash codes of the word before, the word before that, both, and the class."""
    random = np.random.default_rng(12)
    sizes = (CLASSES, CLASSES, CLASSES * CLASSES, CLASSES)
    return tuple(random.integers(0, 1 << TABLE_BITS, n, dtype=np.int32) for n in sizes)


@dataclass
class Tables:
    """The class softmax: biases and hashed weights."""

    bias: np.ndarray
    weights: np.ndarray = field(default_factory=lambda: np.zeros(1 << TABLE_BITS, dtype=np.float32))

    def __post_init__(self):
        one, two, both, of_class = _random_codes()
        self.one, self.two, self.both, self.of_class = one[:, None] ^ of_class, two[:, None] ^ of_class, both, of_class

    def logits(self, contexts: np.ndarray) -> np.ndarray:
        """Of every class after each context (word before * CLASSES + word before that)."""
        first, second = np.divmod(contexts, CLASSES)
        trigram = self.weights[self.both[contexts][:, None] ^ self.of_class]
        return self.bias + self.weights[self.one[first]] + self.weights[self.two[second]] + trigram

    def log_shares(self, contexts: np.ndarray) -> np.ndarray:
        """Log probability of every class after each context."""
        logits = self.logits(contexts).astype(np.float64)
        top = logits.max(axis=1, keepdims=True)
        return logits - top - np.log(np.exp(logits - top).sum(axis=1, keepdims=True))

    def gradient(self, contexts: np.ndarray, classes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, float]:
        """Gradient of the log-likelihood of counted (context, class) events by weight, and its value."""
        total, value = np.zeros(1 << TABLE_BITS), 0.0
        order = np.argsort(contexts, kind="stable")
        contexts, classes, counts = contexts[order], classes[order], counts[order].astype(np.float64)
        found, row = np.unique(contexts, return_inverse=True)
        for start in range(0, len(found), 1024):
            low, high = np.searchsorted(row, [start, start + 1024])
            some, at = found[start : start + 1024], row[low:high] - start
            logs = self.log_shares(some)
            here = np.bincount(at, counts[low:high], minlength=len(some))
            rest = -here[:, None] * np.exp(logs)
            np.add.at(rest, (at, classes[low:high]), counts[low:high])
            value += float(logs[at, classes[low:high]] @ counts[low:high])
            first, second = np.divmod(some, CLASSES)
            for codes in (self.one[first], self.two[second], self.both[some][:, None] ^ self.of_class):
                total += np.bincount(codes.ravel(), rest.ravel(), minlength=len(total))
        return total, value

    def events(self, contexts: np.ndarray, classes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """How often each weight was active in the counted events."""
        first, second = np.divmod(contexts, CLASSES)
        codes = (self.one[first, classes], self.two[second, classes], self.both[contexts] ^ self.of_class[classes])
        return sum(np.bincount(c, counts, minlength=1 << TABLE_BITS) for c in codes)


@dataclass
class Model:
    """All that tasks need to score a text, and the written vocabulary (word, n)."""

    train_tokens: int
    distinct: int
    known: dict[bytes, tuple[int, int]]
    ends: int
    discount: np.ndarray  # share of words never seen in each class of endings
    off: np.ndarray  # what a word's count is lowered by there
    members: np.ndarray  # tokens of the class
    tables: Tables
    vocabulary: DataFrame | None = None
    likelihoods: list[float] = field(default_factory=list)
    norm: np.ndarray | None = None
    unknown: np.ndarray | None = None

    def __getstate__(self):
        return {**self.__dict__, "vocabulary": None}

    def symbol(self, word: bytes) -> int:
        """The class of a word: 0 is the end."""
        held = self.known.get(word)
        return held[0] if held else 1 + SINGLES + ending(word)

    def base(self, count: np.ndarray | int) -> np.ndarray:
        return np.log10((count + 0.5) / (self.train_tokens + 0.5 * (self.distinct + 1)))

    def settle(self) -> None:
        """Log of the sum of all classes' weights after every context, and log probability of the unknown token."""
        share, norm, unknown = np.log(self.discount), [], []
        for start in range(0, CLASSES * CLASSES, 1024):
            logits = self.tables.logits(np.arange(start, min(start + 1024, CLASSES * CLASSES))).astype(np.float64)
            top = logits.max(axis=1)
            norm.append(top + np.log(np.exp(logits - top[:, None]).sum(axis=1)))
            logs = logits - norm[-1][:, None]
            # Where there was no end to learn from, the end is unknown too.
            unseen = np.exp(logs[:, 1 + SINGLES :] + share).sum(axis=1) + (0.0 if self.ends else np.exp(logs[:, 0]))
            unknown.append(np.log(unseen))
        self.norm, self.unknown = np.concatenate(norm), np.concatenate(unknown)


def _contexts(symbols: np.ndarray) -> np.ndarray:
    """Context of each token of texts that all end with the symbol 0."""
    first = np.r_[0, symbols[:-1]]
    second = np.where(first == 0, 0, np.r_[0, 0, symbols[:-2]][: len(symbols)])
    return first * CLASSES + second


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter = Counter()
    for batch in batches:
        for text in batch.column(0).to_pylist():
            held.update(words_of(text))
            held[END] += 1
            if len(held) >= HELD:
                yield _counts(held)
                held.clear()
    yield _counts(held)


def _counts(held: Counter) -> pa.RecordBatch:
    columns = [pa.array(held.keys(), pa.binary()), pa.array(held.values(), pa.int64())]
    return pa.RecordBatch.from_arrays(columns, names=["word", "n"])


def vocabulary(texts: DataFrame) -> DataFrame:
    """(word, n) over all texts, the end among the words; written."""
    counts = texts.mapInArrow(_counted, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return written(counts, "vocabulary")


def _known_words(words: DataFrame) -> list[tuple[bytes, int]]:
    """The words above the least count that no more than ``KNOWN`` words reach, commonest first."""
    step = F.floor(F.log2("n") * 16).cast("int")
    sizes = sorted(words.groupBy(step.alias("step")).count().collect(), reverse=True)  # a row per step, at most 1024
    low, held = None, 0
    for row in sizes:
        held += row["count"]
        if held > KNOWN:
            break
        low = row["step"]
    if low is None:
        return []
    found = words.filter(step >= low).select("word", "n").toArrow()
    return sorted(zip(*(c.to_pylist() for c in found.columns), strict=True), key=lambda x: (-x[1], x[0]))


def _class_counter(model: Model):
    """Counts of (context, class) of the texts of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols = WordCache(model.symbol)
        symbols.update({w: s for w, (s, _) in model.known.items()})
        total = np.zeros(CLASSES**3, dtype=np.int32)
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                found: list[int] = []
                for text in batch.column(0).slice(start, 500).to_pylist():
                    found.extend(map(symbols.__getitem__, words_of(text)))
                    found.append(0)
                at = np.array(found, dtype=np.int64)
                keys, counts = np.unique(_contexts(at) * CLASSES + at, return_counts=True)
                total[keys] += counts.astype(np.int32)
                symbols.trim()
        held = np.nonzero(total)[0]
        for start in range(0, len(held), 100_000):
            some = held[start : start + 100_000]
            context, of_class = np.divmod(some, CLASSES)
            columns = [pa.array(context.astype(np.int32)), pa.array(of_class.astype(np.int32)), pa.array(total[some].astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=["context", "class", "n"])

    return run


GRADIENTS = "slice int, part int, gradient binary, events binary, value double"


def _gradients(sent: Broadcast, first: bool):
    """The gradient of a task's contexts in slices, in the first round with the events of each weight."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [[c.to_numpy() for c in batch.columns] for batch in batches if batch.num_rows]
        if held:
            context, of_class, n = (np.concatenate(c) for c in zip(*held, strict=True))
            tables, part = sent.value, TaskContext.get().partitionId()
            gradient, value = tables.gradient(context, of_class, n)
            events = tables.events(context, of_class, n) if first else np.zeros(0)
            slices = zip(np.array_split(gradient, GRADIENT_PARTS), np.array_split(events, GRADIENT_PARTS), strict=True)
            for at, pair in enumerate(slices):
                yield _slice(at, part, [x.astype("<f4") for x in pair], value)

    return run


def _slice(at: int, part: int, pair: list[np.ndarray], value: float) -> pa.RecordBatch:
    columns = [pa.array([at], pa.int32()), pa.array([part], pa.int32()), *(pa.array([x.tobytes()]) for x in pair), pa.array([value])]
    return pa.RecordBatch.from_arrays(columns, names=["slice", "part", "gradient", "events", "value"])


def _slice_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a slice: the sums over its parts, in their order, so that a repeated task gives the same bits."""
    rows = sorted(r for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns), strict=True))
    for at, own in groupby(rows, key=lambda r: r[0]):
        _, _, gradients, events, values = zip(*own, strict=True)
        pair = [sum(np.frombuffer(x, "<f4").astype("<f8") for x in parts) for parts in (gradients, events)]
        yield _slice(at, 0, pair, sum(values))


def train(tables: Tables, counts: DataFrame, rounds: int = ROUNDS) -> list[float]:
    """Gradient updates of the weights by counted (context, class, n); the log-likelihood before each.

    Tasks sum the gradients, so a round brings each weight's sum back to the driver once, from however many parts.
    """
    parts = written(counts.repartition(GRADIENT_PARTS, "context"), "contexts")
    events, values = None, []
    for number in range(rounds):
        sent = parts.sparkSession.sparkContext.broadcast(tables)
        # However many files and shuffle partitions there are, a task takes many.
        told = parts.coalesce(GRADIENT_PARTS).mapInArrow(_gradients(sent, number == 0), GRADIENTS)
        told = told.repartition(GRADIENT_PARTS, "slice").coalesce(GRADIENT_PARTS).mapInArrow(_slice_sums, GRADIENTS)
        found = told.toArrow().sort_by("slice")
        # Else the tables of all rounds stay until the driver happens to collect its garbage.
        sent.destroy()
        if not found.num_rows:
            break
        gradient = np.frombuffer(b"".join(found["gradient"].to_pylist()), "<f8")
        if events is None:
            events = np.frombuffer(b"".join(found["events"].to_pylist()), "<f8")
        step = STEP * (gradient - PRIOR * tables.weights) / (events + PRIOR + 1)
        tables.weights = (tables.weights + np.clip(step, -LARGEST, LARGEST)).astype(np.float32)
        values.append(found["value"][0].as_py())
    return values


def fit(docs: DataFrame, learn: Column, text_col: str = "text") -> Model:
    """The model of the texts of all rows for which ``learn`` holds."""
    texts = docs.filter(learn).select(F.col(text_col).alias("text"))
    words = vocabulary(texts)
    of_class = F.pmod(F.crc32(F.substring("word", -2, 2)), F.lit(ENDINGS)).cast("int")
    grouped = (
        words.filter(F.col("word") != F.lit(END))
        .groupBy(of_class.alias("class"))
        .agg(
            F.sum("n").alias("n"),
            F.count(F.lit(1)).alias("words"),
            F.count_if(F.col("n") == 1).alias("once"),
            F.count_if(F.col("n") == 2).alias("twice"),
        )
        .collect()
    )
    ends = words.filter(F.col("word") == F.lit(END)).first()
    ends = ends["n"] if ends else 0
    tokens, distinct, once, twice = (np.zeros(ENDINGS) for _ in range(4))
    for r in grouped:
        at = r["class"]
        tokens[at], distinct[at], once[at], twice[at] = r["n"], r["words"], r["once"], r["twice"]
    train_tokens, all_words = int(tokens.sum()) + ends, int(distinct.sum()) + (ends > 0)
    common = [(w, n) for w, n in _known_words(words) if w != END]
    known, bias = {}, np.full(CLASSES, -np.inf)
    for at, (word, n) in enumerate(common):
        single = at < SINGLES
        known[word] = (1 + at if single else 1 + SINGLES + ending(word), n)
        if single:
            bias[1 + at] = np.log(n)
            for given, part in ((tokens, n), (distinct, 1), (once, n == 1), (twice, n == 2)):
                given[ending(word)] -= part
    # How many of a word's tokens go to words never seen.
    off = np.where(once > 0, once / np.maximum(once + 2 * twice, 1), 0.5).clip(0.1, 0.9)
    members = tokens + 0.5
    bias[1 + SINGLES :] = np.log(members)
    bias[0] = np.log(ends) if ends else np.log(0.5)
    model = Model(train_tokens, all_words, known, ends, (off * distinct + 0.5) / members, off, members, Tables(bias), words)
    counts = texts.mapInArrow(_class_counter(model), "context int, class int, n long")
    model.likelihoods = train(model.tables, counts.groupBy("context", "class").agg(F.sum("n").alias("n")))
    model.settle()
    return model


class TextScorer:
    """Scores of texts up to the words whose counts are looked up elsewhere."""

    def __init__(self, model: Model):
        self.model, tables = model, model.tables
        words = list(model.known)
        self.rare = 1 + len(words)  # code 0: the end; then known words; then a rare word of each class
        self.codes = WordCache(lambda word: self.rare + ending(word))
        self.codes.update({w: 1 + i for i, w in enumerate(words)})
        self.fixed = dict(self.codes)
        held = np.array([0, *(model.known[w][0] for w in words)], dtype=np.int64)
        counts = np.array([model.ends, *(model.known[w][1] for w in words)], dtype=np.float64)
        self.symbols = np.r_[held, 1 + SINGLES + np.arange(ENDINGS)]
        at = np.maximum(held - 1 - SINGLES, 0)
        within = np.log(np.maximum(counts - model.off[at], 1e-9) / model.members[at])
        self.within = np.where(held > SINGLES, within, 0.0)
        self.base = model.base(counts)
        self.one, self.two = tables.weights[tables.one], tables.weights[tables.two]

    def score(self, texts: list[str | None]) -> tuple[list[np.ndarray], list[np.ndarray], list[bytes]]:
        """Of each text: tokens, known ones, base score and score, without its rare words. Of each rare
        word: its text, log probability but for its count, discount, log probability if unknown; the word."""
        tokens: list[bytes] = []
        ends = []
        for text in texts:
            tokens += words_of(text)
            tokens.append(END)
            ends.append(len(tokens))
        ends = np.array(ends, dtype=np.int64)
        self.codes[END] = 0
        codes = np.fromiter(map(self.codes.__getitem__, tokens), dtype=np.int64, count=len(tokens))
        symbols = self.symbols[codes]
        contexts = _contexts(symbols)
        first, second = np.divmod(contexts, CLASSES)
        tables = self.model.tables
        logs = tables.bias[symbols] + self.one[first, symbols] + self.two[second, symbols] - self.model.norm[contexts]
        logs += tables.weights[tables.both[contexts] ^ tables.of_class[symbols]]
        rare = codes >= self.rare
        here = np.where(rare, 0, codes)
        value = np.where(rare, 0.0, logs + self.within[here])
        if not self.model.ends:
            value = np.where(codes == 0, self.model.unknown[contexts], value)
        base = np.where(rare, 0.0, self.base[here])
        known = ~rare & ((codes > 0) | (self.model.ends > 0))
        starts = np.r_[0, ends[:-1]]
        sums = [np.add.reduceat(x, starts) for x in (known.astype(np.int64), base, value)]
        at = np.nonzero(rare)[0]
        of_class = symbols[at] - 1 - SINGLES
        parts = [logs[at] - np.log(self.model.members[of_class]), self.model.off[of_class], self.model.unknown[contexts[at]]]
        words = [tokens[i] for i in at.tolist()]
        if len(self.codes) > self.codes.size + len(self.fixed):
            self.codes.clear()
            self.codes.update(self.fixed)
        return [np.diff(np.r_[0, ends]), *sums], [np.searchsorted(ends, at, side="right"), *parts], words


PARTS = "row long, word binary, tokens long, known long, base double, log double, off double, score double"


def score_texts(
    docs: DataFrame,
    model: Model,
    text_col: str = "text",
    keep: list[str] | None = None,
    names: tuple[str, ...] = ("n_tokens", "n_known", "train_tokens", "base_score", "score"),
) -> DataFrame:
    """Add the numbers of tokens, of known ones and of training tokens, the base score and the model's score."""
    kept = [c for c in (docs.columns if keep is None else keep) if c not in names]
    source = docs.select(F.col(text_col).alias("_text"), *[F.col(c).alias(f"_keep{i}") for i, c in enumerate(kept)])
    schema = PARTS + "".join(f", _keep{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(kept))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = TextScorer(model)
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            for start in range(0, batch.num_rows, 200):
                part = batch.slice(start, 200)
                (tokens, known, base, value), (owner, log, off, unknown), words = scorer.score(part.column(0).to_pylist())
                rows = number + np.arange(part.num_rows)
                number += part.num_rows
                # A text's own row meets no word: words hold no space.
                own = [b" %d" % r for r in rows.tolist()]
                n, none = len(words), np.full(part.num_rows, np.nan)
                columns = [
                    pa.array(np.r_[rows, rows[owner]]),
                    pa.array(own + words, pa.binary()),
                    pa.array([*tokens.tolist(), *[None] * n], pa.int64()),
                    pa.array([*known.tolist(), *[None] * n], pa.int64()),
                    pa.array(np.r_[base, np.zeros(n)]),
                    pa.array(np.r_[none, log], from_pandas=True),
                    pa.array(np.r_[none, off], from_pandas=True),
                    pa.array(np.r_[value, unknown]),
                ]
                index = pa.array([*range(part.num_rows), *[None] * n], pa.int64())
                columns += [c.take(index) for c in part.columns[1:]]
                names = ["row", "word", "tokens", "known", "base", "log", "off", "score", *part.schema.names[1:]]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    parts = source.mapInArrow(run, schema)
    counts = model.vocabulary.select("word", "n")
    met = parts.join(counts, "word", "left")
    whole, held = F.col("tokens").isNotNull(), F.col("n").isNotNull()
    below = model.train_tokens + 0.5 * (model.distinct + 1)
    base = F.log10((F.coalesce(F.col("n"), F.lit(0)) + 0.5) / F.lit(below))
    met = met.select(
        "row",
        "tokens",
        F.when(whole, F.col("known")).otherwise(held.cast("long")).alias("known"),
        F.when(whole, F.col("base")).otherwise(base).alias("base"),
        F.when(held, F.col("log") + F.log(F.col("n") - F.col("off"))).otherwise(F.col("score")).alias("score"),
        *[f"_keep{i}" for i in range(len(kept))],
    )
    summed = met.groupBy("row").agg(
        *[F.first(f"_keep{i}", ignorenulls=True).alias(f"_keep{i}") for i in range(len(kept))],
        *[F.sum(c).alias(c) for c in ("tokens", "known", "base", "score")],
    )
    told = [F.col("tokens"), F.col("known"), F.lit(model.train_tokens).cast("long"), F.col("base"), F.col("score") / F.lit(LN10)]
    return summed.select(
        *[F.col(f"_keep{i}").alias(c) for i, c in enumerate(kept)], *[c.alias(n) for c, n in zip(told, names, strict=True)]
    )
