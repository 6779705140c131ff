"""Quality: a compression classifier on zstandard dictionaries of good and bad labelled text.

Two dictionaries are trained for each chunk size, one on good and one on bad texts. A text
is cut into chunks, so that its own repetitions do not hide a dictionary, and compressed
with each. The difference of the two sizes over the larger one, and the sizes over the
length of the text, become a probability by a logistic curve of second order, fitted on
labelled texts that the dictionaries have not seen. A plain compression, without a
dictionary, is the scale for a text's own repetition.

Training reads at most ``SAMPLE_TEXTS`` labelled texts of each class (a documented bound):
half for the dictionaries, which see every chunk of them, half for the curve. Every text is scored whole, in every chunk.
Defined cases: NULL counts as the empty text, which has a score like any other; labels
other than 0 and 1 are not used; without labelled texts of both classes, or with too few
for a dictionary, every score is 1, so that nothing is rejected; repeated rows are scored
each; other columns are kept, and clashing ones are replaced by the score columns.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonemill.llm.common import add_columns, labelled_texts, trained

SAMPLE_TEXTS = 1600
CHUNKS = (256, 1024)
DICTIONARY_BYTES, LEVEL = 65536, 3
PLAIN = {"write_content_size": False, "write_checksum": False, "write_dict_id": False}


def chunks(text: bytes, size: int) -> list[bytes]:
    return [text[at : at + size] for at in range(0, len(text), size)] or [b""]


@dataclass
class QualityModel:
    """Dictionaries by chunk size (good, bad) and the curve."""

    dictionaries: dict[int, tuple[bytes, bytes]]
    middle: np.ndarray | None = None
    spread: np.ndarray | None = None
    curve: np.ndarray | None = None

    def features(self):
        """A function from text to its normalised compressed sizes."""

        def compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
            trained = zstandard.ZstdCompressionDict(dictionary)
            return zstandard.ZstdCompressor(level=LEVEL, dict_data=trained, **PLAIN)

        pairs = {size: tuple(compressor(d) for d in both) for size, both in self.dictionaries.items()}
        plain = zstandard.ZstdCompressor(level=LEVEL, **PLAIN)

        def of(text: str | None) -> list[float]:
            data = (text or "").encode()
            length, out = max(1, len(data)), []
            for size, (good, bad) in pairs.items():
                parts = chunks(data, size)
                a, b = sum(len(good.compress(p)) for p in parts), sum(len(bad.compress(p)) for p in parts)
                out += [(b - a) / max(a, b), a / length, b / length]
            return [*out, sum(len(plain.compress(p)) for p in chunks(data, max(pairs))) / length]

        return of

    def terms(self, features: np.ndarray) -> np.ndarray:
        """Standardised features, their squares and products."""
        z = np.clip((features - self.middle) / self.spread, -6, 6)
        products = [z[:, i] * z[:, j] for i in range(z.shape[1]) for j in range(i, z.shape[1])]
        return np.column_stack([np.ones(len(z)), z, *products])

    def probability(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.terms(features) @ self.curve, -30, 30)))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        w = w + np.linalg.solve(hessian, x.T @ (y - p) - ridge * w)
    return w


def train(texts: list[str | None], quality: list[int]) -> QualityModel | None:
    """The model from labelled texts; ``None`` where a class is missing or too small."""
    halves: dict[int, list[list[str]]] = {label: [[], []] for label in (0, 1)}
    for text, label in zip(texts, quality, strict=True):
        both = halves[label]
        both[len(both[0]) > len(both[1])].append(text or "")
    if min(len(halves[0][1]), len(halves[1][1])) == 0:
        return None
    dictionaries = {}
    for size in CHUNKS:
        pieces = {}
        for label in (0, 1):
            parts = [chunks(t.encode(), size) for t in halves[label][0]]
            pieces[label] = [p for ps in parts for p in ps if p]
        # A dictionary must be much smaller than its samples.
        room = min(DICTIONARY_BYTES, min(sum(map(len, p)) for p in pieces.values()) // 8)
        try:
            good, bad = (zstandard.train_dictionary(room, pieces[label]).as_bytes() for label in (1, 0))
        except (zstandard.ZstdError, ValueError):
            return None
        dictionaries[size] = (good, bad)
    model = QualityModel(dictionaries)
    measure = model.features()
    seen = [(measure(t), label) for label in (0, 1) for t in halves[label][1]]
    features, y = np.array([f for f, _ in seen]), np.array([label for _, label in seen], dtype=float)
    model.middle, model.spread = features.mean(0), features.std(0) + 1e-6
    model.curve = _logistic(model.terms(features), y)
    return model


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality"
) -> QualityModel | None:
    """The model from labelled texts; ``labels`` holds the rows that may be learnt from."""
    usable = labels.filter(F.col(label_col).isin(0, 1))
    return trained(labelled_texts(docs, usable, id_col, text_col, label_col, SAMPLE_TEXTS), train)


def score_texts(
    docs: DataFrame,
    model: QualityModel | None,
    text_col: str = "text",
    cut: float = 0.3,
    keep: list[str] | None = None,
    names: tuple[str, str] = ("score", "predicted"),
) -> DataFrame:
    """Add ``score`` (0 to 1, higher: better) and ``predicted`` (1 from ``cut`` on)."""

    def make():
        measure = model.features() if model else None

        def work(texts: list[str | None]) -> tuple[list[float], list[int]]:
            scores = model.probability(np.array([measure(t) for t in texts])).tolist() if model else [1.0] * len(texts)
            return scores, [int(s >= cut) for s in scores]

        return work

    return add_columns(docs, [text_col], f"{names[0]} double, {names[1]} int", make, keep)
