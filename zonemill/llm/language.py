"""Language identification by word frequencies, backing off to character n-grams.

A word the model knows scores its log frequency in each language. An unseen word scores
the mean log frequency of its character n-grams, from the longest length at which at least
half of them are known, down to single characters; a word with none known says nothing.
The scores of all words of a text add up; the language with the highest sum is predicted
and ``score`` is its posterior over a flat prior.

Training reads at most ``SAMPLE_TEXTS`` texts of each language (a documented bound), chosen
by a hash of the id. Words are runs of letters in lower case. Defined cases: NULL and empty
texts, and texts without a letter, are ``und`` with score 0, and so is everything without
training rows; ties go to the language first in the alphabet; rows with a NULL language
are not learnt from but predicted; repeated rows are scored each; other columns are kept,
and clashing ones are replaced.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonemill.llm.common import add_columns, labelled_texts, trained

SAMPLE_TEXTS = 500
LONGEST, SHARE = 5, 0.5
WORD = re.compile(r"[^\W\d_]+")
UNKNOWN = "und"


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def grams(word: str, n: int) -> list[str]:
    marked = f"^{word}$" if n > 1 else word
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


@dataclass
class LanguageModel:
    """Log frequencies by language: of words, and of n-grams by length. An item's row is in a dictionary."""

    languages: list[str]
    words: tuple[dict[str, int], np.ndarray]
    grams: dict[int, tuple[dict[str, int], np.ndarray]]

    def word_scores(self, word: str) -> np.ndarray:
        rows, table = self.words
        if word in rows:
            return table[rows[word]]
        for n in range(LONGEST, 0, -1):
            rows, table = self.grams[n]
            parts = grams(word, n)
            found = [rows[g] for g in parts if g in rows]
            if found and len(found) >= SHARE * len(parts):
                return table[found].sum(0) / len(found)
        return np.zeros(len(self.languages))


def _log_frequencies(counts: list[Counter]) -> tuple[dict[str, int], np.ndarray]:
    """Smoothed log frequency of each item by language, relative to the mean over languages."""
    items = sorted(set().union(*counts))
    table = np.array([[c[i] for c in counts] for i in items], dtype=np.float64).reshape(len(items), len(counts))
    logs = np.log((table + 0.5) / (table.sum(0) + 0.5 * len(items)))
    return {item: at for at, item in enumerate(items)}, logs - logs.mean(1, keepdims=True)


class WordScores:
    """Scores of words, computed once and kept in a table of bounded size."""

    def __init__(self, model: LanguageModel, size: int = 250_000):
        self.model, self.size, self.rows = model, size, {}
        self.table = np.zeros((size, len(model.languages)))

    def of(self, words: list[str]) -> np.ndarray:
        """A row per word. More distinct words than ``size``, as one huge text may have, are scored in parts."""
        if len(words) > self.size:
            half = len(words) // 2
            return np.vstack([self.of(words[:half]), self.of(words[half:])])
        fresh = [w for w in words if w not in self.rows]
        if len(self.rows) + len(fresh) > self.size:
            self.rows, fresh = {}, words
        for word in fresh:
            if word not in self.rows:
                self.table[len(self.rows)] = self.model.word_scores(word)
                self.rows[word] = len(self.rows)
        return self.table[[self.rows[w] for w in words]]


def train(texts: list[str | None], langs: list[str]) -> LanguageModel | None:
    languages = sorted(set(langs))
    counts = {lang: Counter() for lang in languages}
    for text, lang in zip(texts, langs, strict=True):
        counts[lang].update(words_of(text))
    if not any(counts.values()):
        return None
    by_length = {}
    for n in range(1, LONGEST + 1):
        found = []
        for lang in languages:
            total = Counter()
            for word, times in counts[lang].items():
                for gram in grams(word, n):
                    total[gram] += times
            found.append(total)
        by_length[n] = _log_frequencies(found)
    return LanguageModel(languages, _log_frequencies(list(counts.values())), by_length)


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> LanguageModel | None:
    """The model from the rows of ``docs`` with a language; filter them to what may be learnt from."""
    labels = docs.select(id_col, lang_col)
    return trained(labelled_texts(docs, labels, id_col, text_col, lang_col, SAMPLE_TEXTS), train)


def identify(
    docs: DataFrame, model: LanguageModel | None, text_col: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """Add ``lang_pred`` and ``score``."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # bounded by the training sample

    def make():
        known = shared.value
        if known is None:
            return lambda texts: ([UNKNOWN] * len(texts), [0.0] * len(texts))
        scores = WordScores(known)

        def one(text: str | None) -> tuple[str, float]:
            words = Counter(words_of(text))
            if not any(w.isalpha() for w in words):
                return UNKNOWN, 0.0
            total = np.array(list(words.values()), dtype=np.float64) @ scores.of(list(words))
            share = np.exp(total - total.max())
            return known.languages[int(total.argmax())], float(1 / share.sum())

        def work(texts: list[str | None]) -> tuple[list[str], list[float]]:
            found = [one(t) for t in texts]
            return [lang for lang, _ in found], [score for _, score in found]

        return work

    return add_columns(docs, [text_col], "lang_pred string, score double", make, keep)
