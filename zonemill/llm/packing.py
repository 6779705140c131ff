"""Packing token sequences: vector bin packing with the dot-product heuristic.

A piece of an example asks for tokens, one segment, and loss-bearing tokens; a sequence has
room for so many of each. The open sequence takes the waiting piece whose demand has the
greatest dot product with the room left, both as shares of the limits, among those that fit
whole. When none fits whole, the piece that fills the sequence best is cut, and its rest
waits on. A sequence is closed when it is full in tokens, segments or loss.

Every task packs the texts it reads, with a bounded window of waiting examples, so nothing
is shuffled and no group meets in one task. A task's last tokens are cut at powers of two,
where a sequence needs no padding. Sequence ids hold the task's number and are unique.

Defined cases: NULL text is the empty text, a document of the end id alone; a NULL id is
kept; repeated rows are packed each; texts of any length are cut into as many pieces as
needed; an example without loss-bearing tokens asks for none; an empty table gives no
piece; other columns are ignored. Results of a lost task are the same when it runs again,
as it reads the same rows in the same order.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonemill.llm.common import WordCache

WINDOW = 256
WORD = re.compile(r"[^\x20\x09-\x0D]+")
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, loss long"
)


@dataclass(frozen=True)
class Limits:
    """What one sequence holds at most."""

    tokens: int = 4096
    segments: int = 1024
    loss: int = 4096


@dataclass
class Example:
    """A document's ids, as bytes of four each, from ``start`` on; loss is borne from ``loss_from`` on."""

    doc_id: int | None
    ids: bytes
    loss_from: int = 0
    start: int = 0

    @property
    def total(self) -> int:
        return len(self.ids) // 4

    @property
    def tokens(self) -> int:
        return self.total - self.start

    def loss(self, length: int) -> int:
        return max(0, self.start + length - max(self.start, self.loss_from))

    def most(self, tokens: int, loss: int) -> int:
        """How many of the next ids fit into so much room."""
        free = max(0, self.loss_from - self.start)
        return max(0, min(self.tokens, tokens, free + loss))


# Letters below U+0250, and white space that the tokenizer drops. Runs of these letters never
# touch the tokens around them, but for an apostrophe.
LETTERS = "a-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
RUNS = re.compile(rf"[{LETTERS}]+|[^\x20\x09-\x0D{LETTERS}]+")
RUN = re.compile(rf"[{LETTERS}]+")
UNSURE = re.compile(r"['\u0250-\U0010ffff]|<\|")


class TextIds:
    """Token ids of texts by a cache of words; the same as the tokenizer gives for the whole text.

    The tokenizer drops white space, so words do not touch each other. In texts of plain
    Latin letters, runs of letters are looked up instead, in lower case, as the tokenizer
    splits there too; their ids come from its merges alone, past its text handling. Any
    other text is looked up by its words as they are.
    """

    def __init__(self, path: str, end_id: int):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merges = self.tokenizer.model
        self.end = np.array([end_id], dtype="<u4").tobytes()
        self.runs = WordCache(self._run, 300_000)
        self.words = WordCache(self._word, 50_000)
        self.letters = WordCache(lambda c: "".join(p for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(c)))

    def _word(self, word: str) -> bytes:
        return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _run(self, run: str) -> bytes:
        if not RUN.fullmatch(run):
            return self._word(run)
        coded = run if run.isascii() else "".join(map(self.letters.__getitem__, run))
        return np.array([token.id for token in self.merges.tokenize(coded)], dtype="<u4").tobytes()

    def of(self, text: str | None) -> bytes:
        text = text or ""
        if UNSURE.search(text) or not is_normalized("NFC", text):
            ids = b"".join(map(self.words.__getitem__, WORD.findall(text)))
        else:
            ids = b"".join(map(self.runs.__getitem__, RUNS.findall(text.lower())))
        self.words.trim()
        self.runs.trim()
        return ids + self.end


@lru_cache(maxsize=2)
def text_ids(path: str, end_id: int) -> TextIds:
    """One for all tasks of a Python worker."""
    return TextIds(path, end_id)


class Packer:
    """Packs a stream of examples of one task; yields (example, start, length, sequence, offset, loss)."""

    def __init__(self, limits: Limits, first_sequence: int = 0, window: int = WINDOW):
        self.limits, self.window, self.sequence = limits, window, first_sequence
        self.waiting: list[Example] = []
        self.demand = np.zeros((0, 3))
        self.scale = np.array([limits.tokens, limits.segments, limits.loss], dtype=np.float64)
        self._open(limits.tokens)

    def _open(self, tokens: int) -> None:
        self.room = np.array([tokens, self.limits.segments, min(tokens, self.limits.loss)], dtype=np.float64)
        self.filled = 0

    def _close(self, tokens: int) -> None:
        if self.filled:
            self.sequence += 1
        self._open(tokens)

    def _demand(self, example: Example) -> list[int]:
        return [example.tokens, 1, example.loss(example.tokens)]

    def _choose(self) -> tuple[int, int]:
        """The waiting example to place, and how many of its ids: all where it fits."""
        fits = (self.demand <= self.room).all(axis=1)
        if fits.any():
            gain = (self.demand / self.scale) @ (self.room / self.scale)
            best = int(np.argmax(np.where(fits, gain, -1.0)))
            return best, self.waiting[best].tokens
        if self.room[1] < 1:
            return -1, 0
        parts = [e.most(int(self.room[0]), int(self.room[2])) for e in self.waiting]
        best = int(np.argmax(parts))
        return best, parts[best]

    def _place(self) -> Iterator[tuple]:
        best, length = self._choose()
        if length == 0:
            self._close(self.limits.tokens)
            return
        example = self.waiting[best]
        loss = example.loss(length)
        yield example, example.start, length, self.sequence, self.filled, loss
        self.room -= (length, 1, loss)
        self.filled += length
        example.start += length
        if example.tokens:
            self.demand[best] = self._demand(example)
        else:
            self.waiting[best] = self.waiting[-1]
            self.waiting.pop()
            self.demand[best] = self.demand[-1]
            self.demand = self.demand[:-1]
        if self.room[0] < 1 or self.room[1] < 1:
            self._close(self.limits.tokens)

    def add(self, example: Example) -> Iterator[tuple]:
        self.waiting.append(example)
        self.demand = np.vstack([self.demand, [self._demand(example)]])
        while len(self.waiting) > self.window:
            yield from self._place()

    def finish(self) -> Iterator[tuple]:
        left = int(self.demand[:, 0].sum())
        while left:
            if not self.filled and left < self.limits.tokens:
                self._open(1 << (left.bit_length() - 1))
            for piece in self._place():
                left -= piece[2]
                yield piece


def _pack(path: str, limits: Limits, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = text_ids(path, end_id)
        packer = Packer(limits, TaskContext.get().partitionId() << 33)
        names = [c.split()[0] for c in PIECES.split(", ")]

        def rows(pieces: list[tuple]) -> pa.RecordBatch:
            out = [
                (e.doc_id, start, n, zlib.crc32(e.ids[4 * start : 4 * (start + n)]), e.total, sequence, at, loss)
                for e, start, n, sequence, at, loss in pieces
            ]
            columns = list(zip(*out, strict=True)) or [()] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

        for batch in batches:
            for start in range(0, batch.num_rows, 200):
                part = batch.slice(start, 200)
                found = []
                for doc_id, text, loss_from in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    found += packer.add(Example(doc_id, ids.of(text), loss_from or 0))
                yield rows(found)
        yield rows(list(packer.finish()))

    return run


def pack_texts(
    df: DataFrame,
    tokenizer_path: str,
    limits: Limits = Limits(),
    id_col: str = "doc_id",
    text_col: str = "text",
    loss_from: Column | None = None,
    end_id: int = 2,
) -> DataFrame:
    """One row per piece: where it lies in its document and in its sequence.

    ``loss_from`` is the number of a document's first ids that bear no loss, such as a
    prompt's; by default all ids bear loss.
    """
    first = F.lit(0) if loss_from is None else loss_from
    chosen = df.select(F.col(id_col).cast("long"), F.col(text_col), first.cast("long"))
    return chosen.mapInArrow(_pack(tokenizer_path, limits, end_id), PIECES)
