"""Toxicity: a support vector machine on a subsequence string kernel, with Nyström landmarks.

The kernel compares two spans by the subsequences of three characters they share. An
occurrence weighs ``DECAY`` to the power of its length, gaps included, and reaches over at
most ``REACH`` characters, so a span with inserted or missing characters stays close to the
plain one. Digits and signs written for letters count as these.

A span is a word with its ends marked, the word with inner punctuation left out, or a window:
neighbouring words read as one, up to ``JOINED`` of any length and up to ``PIECES`` of at most
``SHORT`` letters, with any white space or punctuation between them. Each span tells a gain,
and a text scores the sum of its ``WORST`` worst spans that share no word, wherever they
stand, with repeats of sure ones counted: a text that says one insult often is as toxic as one
that says several. Repeats of mild spans, which clean texts hold too, do not count, since they
come with the length of a text. Training is multiple-instance: only texts are labelled, so the
spans that the current model finds worst in a toxic text stand for it, and every span of a
clean text is clean. Copies with inserted characters are added to the toxic spans. What a
window tells compares toxic words with the windows of clean texts, as words are joined by
chance there.

The machine is trained on Nyström features of ``LANDMARKS`` landmark spans. Its decision is
linear in the kernel, so it folds into one weight per subsequence, and scoring looks these
weights up: the same values as kernels with every landmark, at a fraction of the work.

Training reads at most ``SAMPLE_TEXTS`` labelled texts of each class (a documented bound);
every text is scored whole. Defined cases: NULL and empty texts, and texts without any
word, get the score of the neutral span; a NULL label or a label other than 0 and 1 is not
used; without labelled texts of both classes every score is 0; repeated rows are scored
each; other columns are kept, and clashing ones are replaced by the score columns.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonemill.llm.common import add_columns, labelled_texts, trained

SAMPLE_TEXTS = 1000
LANDMARKS = 200
SURE = 5.0
WORST = 5
# How much worse a lost clean text is than a missed toxic one: clean texts are many.
CLEAN = 4.0
ORDER, REACH, DECAY = 3, 6, 0.5
SIZE = 64
# Words whose values a worker keeps, and more only where the texts read at once hold more.
STORED = 300_000
LONGEST = 48
JOINED, PIECES, SHORT = 3, 16, 2
# Words whose windows are read at once.
BLOCK = 20_000
SENTENCE = re.compile(r"[.!?\n]+(?=\s|$)")
EDGE = re.compile(r"^\W+|\W+$")
INNER = re.compile(r"[\W_]+")
# Characters that stand for a letter.
ALIKE = {ord(sign): ord(letter) for sign, letter in zip("0134578@$", "oleastbas", strict=True)}


CLASSES = np.array([at - 94 if 97 <= at <= 122 else 30 + at % 33 for at in range(0x110000 >> 4)], dtype=np.int32)
CLASSES[list(ALIKE)] = CLASSES[list(ALIKE.values())]


def folded(spans: list[str]) -> np.ndarray:
    """Character classes of spans of one length, a row each, with a mark at both ends."""
    points = np.frombuffer("".join(spans).encode("utf-32-le"), dtype=np.uint32).reshape(len(spans), -1)
    out = np.ones((len(spans), points.shape[1] + 2), dtype=np.int32)
    out[:, 1:-1] = CLASSES[np.minimum(points, len(CLASSES) - 1)]
    out[:, -1] = 2
    return out


def bare_form(word: str) -> str:
    """The word without punctuation."""
    return word if word.isalnum() else INNER.sub("", word)


def pieces(word: str) -> list[str]:
    """The spans of a word: without outer punctuation, and without inner punctuation too.

    A word of more than ``LONGEST`` characters is read in overlapping parts, whole.
    """
    if word.isalnum():
        found = [word]
    else:
        bare = EDGE.sub("", word)
        found = [bare] if bare else []
        joined = INNER.sub("", bare)
        if joined != bare and joined:
            found.append(joined)
    if len(found) == 1 and len(found[0]) <= LONGEST:
        return found
    step = LONGEST // 2
    return [s[i : i + LONGEST] for s in found for i in range(0, max(1, len(s) - step), step)]


def word_rows(texts: list[str]) -> tuple[list[str], np.ndarray]:
    """The words of all texts without punctuation, and the number of the text of each."""
    rows = [[w for w in (bare_form(w) for w in t.split()) if w] for t in texts]
    return [w for row in rows for w in row], np.repeat(np.arange(len(rows)), [len(row) for row in rows])


def subsequences(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Subsequence codes of spans of one length, a row each, and their weights.

    Weights are scaled so that a span whose subsequences all differ has length 1.
    """
    n = codes.shape[1]
    parts, weights = [np.zeros((len(codes), 0), dtype=np.int32)], [np.zeros(0)]
    for one in range(1, REACH):
        for two in range(one + 1, REACH + 1):
            if two < n:
                parts.append((codes[:, : n - two] * SIZE + codes[:, one : n - two + one]) * SIZE + codes[:, two:])
                weights.append(np.full(n - two, DECAY ** (two - ORDER + 1)))
    weight = np.concatenate(weights)
    return np.concatenate(parts, axis=1), weight / max(np.linalg.norm(weight), 1e-9)


def _windows(sizes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First word and number of words of every window within one text."""
    long = np.r_[0, np.cumsum(sizes > SHORT)]
    first, many = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
    at = np.arange(len(sizes))
    for number in range(2, PIECES + 1):
        at = at[at + number <= len(sizes)]
        at = at[owner[at] == owner[at + number - 1]]
        if number > JOINED:
            at = at[long[at + number] == long[at]]
        first.append(at)
        many.append(np.full(len(at), number))
    return np.concatenate(first), np.concatenate(many)


def by_length(spans: list[str]) -> Iterator[tuple[list[int], list[str]]]:
    """Spans grouped by length, with their places, in parts of bounded size."""
    groups: dict[int, list[int]] = {}
    for at, span in enumerate(spans):
        groups.setdefault(len(span), []).append(at)
    for places in groups.values():
        for start in range(0, len(places), 8192):
            part = places[start : start + 8192]
            yield part, [spans[at] for at in part]


def landmark_table(landmarks: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Row of each subsequence code (0: in no landmark), and the landmarks' weights by row."""
    coded = [(codes[0], weights) for codes, weights in (subsequences(folded([s])) for s in landmarks)]
    used = np.unique(np.concatenate([c for c, _ in coded]))
    row = np.zeros(SIZE**ORDER, dtype=np.int32)
    row[used] = np.arange(1, len(used) + 1)
    table = np.zeros((len(used) + 1, len(landmarks)), dtype=np.float32)
    for at, (codes, weights) in enumerate(coded):
        np.add.at(table[:, at], row[codes], weights)
    return row, table


def kernel(spans: list[str], row: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The subsequence kernel of each span with each landmark."""
    out = np.zeros((len(spans), table.shape[1]), dtype=np.float32)
    for places, some in by_length(spans):
        codes, weights = subsequences(folded(some))
        at, total = row[codes], np.zeros((len(some), table.shape[1]), dtype=np.float32)
        for column, weight in enumerate(weights):
            total += np.float32(weight) * table[at[:, column]]
        out[places] = total
    return out


@dataclass
class ToxicModel:
    """Weight per subsequence and the intercept; what a span's value tells; the text's calibration.

    ``gains`` are log likelihood ratios of toxic to clean texts at the decision values ``marks``.
    Repeats of spans above ``sure`` count: those of milder ones come with the length of a text.
    """

    weights: np.ndarray
    bias: float
    slope: float = 1.0
    middle: float = 0.0
    marks: np.ndarray = field(default_factory=lambda: np.array([0.0, 1.0]))
    gains: np.ndarray = field(default_factory=lambda: np.array([0.0, 1.0]))
    window_gains: np.ndarray = field(default_factory=lambda: np.array([0.0, 1.0]))
    spelled_gains: np.ndarray = field(default_factory=lambda: np.array([0.0, 1.0]))
    sure: float = -np.inf

    def span_scores(self, spans: list[str]) -> np.ndarray:
        """Decision values of the machine."""
        scores = np.full(len(spans), self.bias)
        for places, some in by_length(spans):
            codes, weights = subsequences(folded(some))
            scores[places] += self.narrow().take(codes) @ weights
        return scores

    def span_gains(self, spans: list[str]) -> np.ndarray:
        return np.interp(self.span_scores(spans), self.marks, self.gains)

    def window_scores(self, words: list[str], owner: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """First words, numbers of words and decision values of all windows, in blocks.

        The values are those of :meth:`span_scores` for the joined words, by sums over all
        subsequences that begin before a place.
        """
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        for start, first, many, values, _ in self.word_and_window_scores(words, owner, lengths):
            if len(first):
                yield first + start, many, values

    def word_and_window_scores(
        self, words: list[str], owner: np.ndarray, lengths: np.ndarray
    ) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """For each block of words: its start, the windows that begin in it (counted from there), and
        the values of its words and of the further words that its windows reach."""
        for start in range(0, len(words), BLOCK):
            some = words[start : start + BLOCK + PIECES - 1]
            sizes = lengths[start : start + len(some)]
            first, many = _windows(sizes, owner[start : start + len(some)])
            first, many = first[own := first < BLOCK], many[own]
            one = np.arange(len(some))
            values = self._joined("".join(some), sizes, np.r_[one, first], np.r_[np.ones_like(one), many])
            yield start, first, many, values[len(some) :], values[: len(some)]

    def _joined(self, text: str, sizes: np.ndarray, first: np.ndarray, many: np.ndarray) -> np.ndarray:
        codes = folded([text])[0, 1:-1]
        after = np.r_[codes, np.zeros(REACH, dtype=np.int32)]
        ends = np.cumsum(sizes)
        starts = ends - sizes
        last = first + many - 1
        begin, end = starts[first], ends[last]
        length = end - begin
        narrow = self.narrow()
        head, tail = np.zeros((REACH + 1, len(sizes))), np.zeros((REACH + 1, len(sizes)))
        # What all subsequences up to the first place of a word weigh, and up to its end.
        to_start, to_end, sums = np.zeros(len(sizes)), np.zeros(len(sizes)), {}
        pairs = {one: (codes * SIZE + after[one : one + len(codes)]) * SIZE for one in range(1, REACH)}
        for two in range(2, REACH + 1):
            decay = DECAY ** (two - ORDER + 1)
            inner = np.zeros(len(codes))
            back = np.maximum(ends - two, 0)
            third = after[two : two + len(codes)]
            for one in range(1, two):
                inner += narrow.take(pairs[one] + third)
                # The mark before the first character is 1, the one after the last is 2.
                head[two] += narrow[(SIZE + after[starts + one - 1]) * SIZE + after[starts + two - 1]]
                tail[two] += narrow[(codes[back] * SIZE + after[back + one]) * SIZE + 2]
            sums[two] = np.r_[0.0, np.cumsum(inner)]
            to_start += decay * sums[two][starts]
            to_end += decay * sums[two][back]
            head[two] = head[two - 1] + decay * head[two]
            tail[two] = tail[two - 1] + decay * tail[two]
        total = to_end[last] - to_start[first]
        short = np.nonzero(length < REACH)[0]
        if len(short):
            total[short] = 0.0
            for two, summed in sums.items():
                part = summed[np.maximum(end[short] - two, begin[short])] - summed[begin[short]]
                total[short] += DECAY ** (two - ORDER + 1) * part
        reach = np.minimum(length, REACH)
        total += head[reach, first] + tail[reach, last]
        few = short
        for one in range(REACH - 1):
            few = few[length[few] > one]
            total[few] += DECAY ** (length[few] + 2.0 - ORDER) * narrow[(SIZE + codes[begin[few] + one]) * SIZE + 2]
        sizes_ = np.arange(int(length.max()) + 1)
        squares = sum(np.maximum(sizes_ + 2 - two, 0) * (two - 1) * (DECAY ** (two - ORDER + 1)) ** 2 for two in range(2, REACH + 1))
        return self.bias + total / np.maximum(np.sqrt(squares), 1e-9)[length]

    def narrow(self) -> np.ndarray:
        """The weights in single precision, for look-ups; sums are taken in double precision."""
        held = self.__dict__.get("_narrow")
        if held is None or held[0] is not self.weights:
            held = self.__dict__["_narrow"] = (self.weights, self.weights.astype(np.float32))
        return held[1]

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_narrow"}

    def probability(self, totals: np.ndarray) -> np.ndarray:
        """Of texts, from the sums of the gains of their ``WORST`` worst spans."""
        return 1 / (1 + np.exp(-np.clip(self.slope * (totals - self.middle), -30, 30)))


def text_spans(text: str) -> set[str]:
    """The distinct spans of the words of a text."""
    return {s for word in set(text.lower().split()) for s in pieces(word)}


def sentences(text: str) -> list[str]:
    return [s.strip() for s in SENTENCE.split(text) if s.strip()]


def _svm(x: np.ndarray, y: np.ndarray, cost: float = 20.0, rounds: int = 60) -> np.ndarray:
    """Squared-hinge linear machine by Newton steps, classes weighed equally; the last weight is the intercept."""
    x = np.hstack([x, np.ones((len(x), 1))])
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())) * len(y)
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        margin = 1 - y * (x @ w)
        active = margin > 0
        xa, ca = x[active], cost * weight[active]
        gradient = w - xa.T @ (ca * y[active] * margin[active])
        hessian = np.eye(len(w)) + (xa * ca[:, None]).T @ xa
        step = np.linalg.solve(hessian, gradient)
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _noisy(span: str, random: np.random.Generator) -> str:
    """The span with one or two characters inserted."""
    letters = "abcdefghijklmnopqrstuvwxyz*.-_"
    for _ in range(int(random.integers(1, 3))):
        at = int(random.integers(1, max(2, len(span))))
        span = span[:at] + letters[int(random.integers(len(letters)))] + span[at:]
    return span


def train(texts: list[str], toxic: list[int], seed: int = 7) -> ToxicModel | None:
    """The machine from labelled texts; ``None`` without texts of both classes."""
    low = [(t or "").lower() for t in texts]
    bags = [sorted(text_spans(t)) for t in low]
    bad = [(b, t) for b, t, label in zip(bags, low, toxic, strict=True) if label == 1 and b]
    good = [(b, t) for b, t, label in zip(bags, low, toxic, strict=True) if label == 0 and b]
    if not bad or not good:
        return None
    # A quarter of the texts is set apart for the calibration, if that is enough of them.
    apart_bad, apart_good = bad, good
    if min(len(bad), len(good)) >= 60:
        apart_bad, apart_good = bad[::4], good[::4]
        bad, good = ([b for i, b in enumerate(bs) if i % 4] for bs in (bad, good))
    rows_bad, rows_good = word_rows([t for _, t in bad]), word_rows([t for _, t in good])
    bad, good = [b for b, _ in bad], [b for b, _ in good]
    random = np.random.default_rng(seed)
    in_bad, in_good = Counter(s for b in bad for s in b), Counter(s for b in good for s in b)
    # First witnesses: parts of words that far more toxic texts than clean ones hold.
    parts_bad = Counter(p for b in bad for p in {s[:n] for s in b for n in (4, 5, 6)} | set(b))
    parts_good = Counter(p for b in good for p in {s[:n] for s in b for n in (4, 5, 6)} | set(b))

    def excess(part: str) -> float:
        """How far more toxic texts hold the part than clean texts let expect, in deviations."""
        expected = len(bad) * (parts_good[part] + 0.5) / len(good)
        return (parts_bad[part] - expected) / np.sqrt(expected + 1)

    def evidence(span: str) -> float:
        return max(excess(span), *(excess(span[:n]) for n in (4, 5, 6)))

    known = {s: evidence(s) for s in in_bad}
    clean = sorted(in_good)
    clean_sample = [clean[i] for i in random.permutation(len(clean))[:12_000]]
    clean_sample += _joined_sample(rows_good, random, 4000)
    # A toxic text without a telling span teaches nothing yet.
    best = [max(b, key=lambda s: (known[s], s)) for b in bad]
    sure = min(SURE, max(known[s] for s in best))
    # Spans that many toxic texts and no clean one hold stay, also beside worse ones.
    firm = {s for s in known if not in_good[s] and excess(s) >= sure}
    witness = {s for s in best if known[s] >= sure} | firm
    model = None
    for turn in range(4):
        found = Counter({s: in_bad[s] for s in witness})
        toxic_spans = [s for s, _ in sorted(found.items(), key=lambda x: (-x[1], x[0]))[:4000]]
        # The commonest toxic spans, others at random, and clean spans.
        rest = LANDMARKS // 4 + random.permutation(max(0, len(toxic_spans) - LANDMARKS // 4))
        landmarks = toxic_spans[: LANDMARKS // 4] + [toxic_spans[i] for i in rest[: LANDMARKS // 4]]
        landmarks += [clean_sample[i] for i in random.permutation(len(clean_sample))[: LANDMARKS - len(landmarks)]]
        noisy = [_noisy(s, random) for s in toxic_spans[:1500]]
        spans = toxic_spans + noisy + clean_sample
        y = np.r_[np.ones(len(toxic_spans) + len(noisy)), -np.ones(len(clean_sample))]
        row, table = landmark_table(landmarks)
        values, vectors = np.linalg.eigh(kernel(landmarks, row, table).astype(np.float64))
        keep = values > 1e-6 * values.max()
        root = vectors[:, keep] / np.sqrt(values[keep])
        w = _svm(kernel(spans, row, table) @ root, y)
        weights = (table @ (root @ w[:-1]))[row]
        model = ToxicModel(weights, float(w[-1]))
        if turn == 3:
            break
        # The hardest clean spans join, and every toxic text names its worst span anew.
        scores = model.span_scores(clean)
        hard = np.argsort(-scores, kind="stable")[:4000]
        clean_sample = sorted(set(clean_sample) | {clean[i] for i in hard})
        ranked = dict(zip(known, model.span_scores(list(known)), strict=True))
        usual = dict(zip(clean, scores, strict=True))
        limit = np.quantile([max(map(usual.__getitem__, b)) for b in good], 0.95)
        witness = set(firm)
        for b in bad:
            top = sorted(b, key=ranked.__getitem__, reverse=True)[:3]
            witness.update(s for i, s in enumerate(top) if ranked[s] > max(limit, 0.5 * i) and not in_good[s])
        joined, usual_windows = _worst_windows(model, *rows_good, len(good), 4000)
        clean_sample = sorted(set(clean_sample) | set(joined))
        # A window names a toxic text only where it is worse than all of the text's words.
        worst = [max(map(ranked.__getitem__, b)) for b in bad]
        limit = max(limit, np.quantile(usual_windows, 0.95))
        of_text, values = _worst_windows(model, *rows_bad, len(bad), 0)
        shared = in_good.keys() | set(joined)
        witness.update(w for w, v, least in zip(of_text, values, worst, strict=True) if v > max(limit, least) and w not in shared)
        if not witness:
            break
    _calibrate(model, apart_bad, apart_good)
    return model


def _joined_sample(rows: tuple[list[str], np.ndarray], random: np.random.Generator, number: int) -> list[str]:
    """Joined words of random windows."""
    words, owner = rows
    first, many = _windows(np.array([len(w) for w in words], dtype=np.int64), owner)
    some = random.permutation(len(first))[:number]
    return sorted({"".join(words[first[i] : first[i] + many[i]]) for i in some})


def _worst_windows(
    model: ToxicModel, words: list[str], owner: np.ndarray, texts: int, number: int
) -> tuple[list[str], np.ndarray]:
    """The joined words of the ``number`` worst windows of all texts, or for 0 of the worst one of
    each text, and the worst value of each."""
    most, best = np.full(texts, -np.inf), [""] * texts
    held: list[tuple[float, str]] = []
    for first, many, values in model.window_scores(words, owner):
        order = np.argsort(-values, kind="stable")
        if number:
            held += [(values[i], "".join(words[first[i] : first[i] + many[i]])) for i in order[:number]]
            held = sorted(held, reverse=True)[:number]
        texts_of, at = np.unique(owner[first[order]], return_index=True)
        for text, i in zip(texts_of, order[at], strict=True):
            if values[i] > most[text]:
                most[text], best[text] = values[i], "".join(words[first[i] : first[i] + many[i]])
    return ([w for _, w in held] if number else best), most


def _calibrate(model: ToxicModel, bad: list[tuple[list[str], str]], good: list[tuple[list[str], str]]) -> None:
    """What values of spans tell, by how often toxic and clean texts hold such spans; then the cut between texts."""
    spans = sorted({s for b, _ in (*bad, *good) for s in b})
    value = dict(zip(spans, model.span_scores(spans), strict=True))
    of_bad, of_good = (np.sort([value[s] for b, _ in bags for s in b]) for bags in (bad, good))
    marks = np.arange(-1.0, 1.65, 0.05)

    def rate(values: np.ndarray, texts: int) -> np.ndarray:
        near = np.searchsorted(values, marks + 0.15) - np.searchsorted(values, marks - 0.15)
        return (near + 0.5) / (texts + 1)

    def told(of_good: np.ndarray) -> np.ndarray:
        gains = np.log(rate(of_bad, len(bad))) - np.log(rate(of_good, len(good)))
        gains[marks + 0.15 > max(of_bad[-1], of_good[-1])] = -np.inf
        return np.maximum(np.maximum.accumulate(gains), 0.0)

    model.marks, model.gains = marks, told(of_good)
    model.sure = float(np.quantile([max(map(value.__getitem__, b)) for b, _ in good], 0.95))
    scorer = TextScorer(model)
    joined = scorer.worse_windows([t for _, t in good], marks[0])
    # Single letters are rarer in clean texts than words that happen to make another.
    for name, of_windows in (("window_gains", joined[0]), ("spelled_gains", joined[1])):
        setattr(model, name, np.minimum(model.gains, told(np.sort(np.r_[of_good, of_windows]))))
    scorer = TextScorer(model)
    model.middle, model.slope = _cut(*(scorer.totals([t for _, t in bags]) for bags in (bad, good)))


def _cut(bad: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Where the two classes are told apart best, in the middle of the gap, and a slope for the gap's width."""
    values = np.unique(np.r_[bad, good])
    cuts = np.r_[values[0] - 1, (values[1:] + values[:-1]) / 2, values[-1] + 1]
    bad, good = np.sort(bad), np.sort(good)
    wrong = np.searchsorted(bad, cuts) / len(bad) + CLEAN * (len(good) - np.searchsorted(good, cuts)) / len(good)
    best = np.nonzero(wrong == wrong.min())[0]
    best = best[best - best[0] == np.arange(len(best))]
    low, high = max(values[0], cuts[best[0]]), min(values[-1], cuts[best[-1]])
    return float((low + high) / 2), 6.0 / max(0.5, float(np.median(bad) - np.median(good)))


class TextScorer:
    """Scores of texts, with a bounded store of what words with punctuation in them are worth."""

    def __init__(self, model: ToxicModel):
        self.model = model
        # The bare form of such a word, and the value of its worst span unless that is the bare form.
        self.odd: dict[str, tuple[str, float]] = {}
        # The least values that tell anything, of windows of words and of single characters.
        before = np.r_[-np.inf, model.marks]
        telling = [np.nonzero(gains)[0] for gains in (model.window_gains, model.spelled_gains)]
        self.least = tuple(float(before[t[0]]) if len(t) else np.inf for t in telling)

    def _values(self, words: list[str]) -> list[float]:
        spans, owner = [], []
        for at, word in enumerate(words):
            for span in pieces(word):
                spans.append(span)
                owner.append(at)
        most = np.full(len(words), -np.inf)
        if spans:
            np.maximum.at(most, owner, self.model.span_scores(spans))
        return most.tolist()

    def _learn(self, words: set[str]) -> None:
        """Store ``words``, which one call looks up, making room before any of them is stored."""
        new = [w for w in words if w not in self.odd]
        if len(self.odd) + len(new) > STORED:
            self.odd.clear()
            new = list(words)
        bare = [bare_form(w) for w in new]
        several = [w for w, b in zip(new, bare, strict=True) if b and pieces(w) != [b]]
        own = dict(zip(several, self._values(several), strict=True))
        self.odd.update((w, (b, own.get(w, np.nan))) for w, b in zip(new, bare, strict=True))

    def _rows(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """The bare words of the texts, their texts, their lengths, and the values of words of several spans."""
        rows = [t.split() for t in texts]
        words = list(chain.from_iterable(rows))
        owner = np.repeat(np.arange(len(rows)), [len(row) for row in rows])
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        plain = np.fromiter(map(str.isalnum, words), dtype=bool, count=len(words)) & (lengths <= LONGEST)
        own = np.full(len(words), np.nan)
        places = np.nonzero(~plain)[0]
        if len(places):
            found = [words[i] for i in places.tolist()]
            self._learn(set(found))
            for at, word in zip(places.tolist(), found, strict=True):
                words[at], own[at] = self.odd[word]
            lengths[places] = [len(words[i]) for i in places.tolist()]
            held = lengths > 0
            if not held.all():
                words = [w for w in words if w]
                owner, lengths, own = owner[held], lengths[held], own[held]
        return words, owner, lengths, own

    def _worse(
        self, words: list[str], owner: np.ndarray, lengths: np.ndarray, own: np.ndarray, least: tuple[float, float]
    ) -> Iterator[tuple[np.ndarray, list[tuple[int, int, float, bool]]]]:
        """For each block of words: their values, and first word, number of words and value of each window
        above ``least`` that is worse than each of its words, and whether it is spelled in single characters."""
        single = np.r_[0, np.cumsum(lengths == 1)]
        for start, first, many, values, of_words in self.model.word_and_window_scores(words, owner, lengths):
            given = own[start : start + len(of_words)]
            of_words = np.where(np.isnan(given), of_words, given)
            spelled = single[start + first + many] - single[start + first] == many
            hot = values > np.where(spelled, least[1], least[0])
            if hot.any():
                at = first[hot]
                hot[hot] = values[hot] > np.maximum(of_words[at], of_words[at + 1])
            found = []
            for at, number, value, one in zip(*(x[hot].tolist() for x in (first, many, values, spelled)), strict=True):
                if number == 2 or value > of_words[at + 2 : at + number].max():
                    found.append((start + at, number, value, one))
            yield of_words[:BLOCK], found

    def worse_windows(self, texts: list[str], least: float) -> tuple[list[float], list[float]]:
        """The values of all such windows: of words, and of single characters."""
        values: tuple[list[float], list[float]] = [], []
        for start in range(0, len(texts), 50):
            for _, found in self._worse(*self._rows(texts[start : start + 50]), (least, least)):
                for _, _, value, spelled in found:
                    values[spelled].append(value)
        return values

    def _telling(self, texts: list[str]) -> list[list[tuple[float, int, int, str]]]:
        """Gain, first word, number of words and, if repeats do not count, name of each telling span."""
        model, told = self.model, [[] for _ in texts]
        words, owner, lengths, own = self._rows(texts)
        start = 0
        for of_words, found in self._worse(words, owner, lengths, own, self.least):
            gains = np.interp(of_words, model.marks, model.gains)
            for at in np.nonzero(gains)[0].tolist():
                name = "" if of_words[at] > model.sure else words[start + at]
                told[owner[start + at]].append((float(gains[at]), start + at, 1, name))
            start += len(of_words)
            for at, number, value, spelled in found:
                gain = float(np.interp(value, model.marks, model.spelled_gains if spelled else model.window_gains))
                if gain > 0:
                    name = "" if value > model.sure else "".join(words[at : at + number])
                    told[owner[at]].append((gain, at, number, name))
        return told

    def totals(self, texts: list[str]) -> np.ndarray:
        """Of lower-case texts, the sums of the gains of their ``WORST`` worst spans that share no word."""
        totals = np.zeros(len(texts))
        for start in range(0, len(texts), 50):
            for at, found in enumerate(self._telling(texts[start : start + 50]), start):
                used: set[int] = set()
                names: set[str] = set()
                left = WORST
                for gain, first, number, name in sorted(found, key=lambda x: (-x[0], x[2], x[1])):
                    span = range(first, first + number)
                    if name not in names and used.isdisjoint(span):
                        used.update(span)
                        if name:
                            names.add(name)
                        totals[at] += gain
                        left -= 1
                        if not left:
                            break
        return totals

    def scores(self, texts: list[str | None]) -> np.ndarray:
        return self.model.probability(self.totals([(t or "").lower() for t in texts]))


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic"
) -> ToxicModel | None:
    """The model from labelled texts; ``labels`` holds the rows that may be learnt from."""
    usable = labels.filter(F.col(label_col).isin(0, 1))
    return trained(labelled_texts(docs, usable, id_col, text_col, label_col, SAMPLE_TEXTS), train)


_SCORERS: dict[str, TextScorer] = {}


def _worker_scorer(name: str, model: ToxicModel) -> TextScorer:
    """The scorer of a worker process, with the words it knows from earlier tasks of the same model."""
    if name not in _SCORERS:
        _SCORERS.clear()
        _SCORERS[name] = TextScorer(model)
    return _SCORERS[name]


def score_texts(
    docs: DataFrame,
    model: ToxicModel | None,
    text_col: str = "text",
    cut: float = 0.5,
    keep: list[str] | None = None,
    names: tuple[str, str] = ("score", "predicted"),
) -> DataFrame:
    """Add ``score`` (0 to 1, higher: more toxic) and ``predicted`` (1 from ``cut`` on)."""

    name = uuid.uuid4().hex

    def make():
        scorer = _worker_scorer(name, model) if model else None

        def work(texts: list[str | None]) -> tuple[list[float], list[int]]:
            scores = scorer.scores(texts).tolist() if scorer else [0.0] * len(texts)
            return scores, [int(s >= cut) for s in scores]

        return work

    return add_columns(docs, [text_col], f"{names[0]} double, {names[1]} int", make, keep)


def worst_sentences(texts: list[str | None], model: ToxicModel) -> list[tuple[str, float]]:
    """The most toxic sentence of each text and its score, for explanations."""
    scorer, found = TextScorer(model), []
    for text in texts:
        parts = sentences(text or "") or [""]
        scores = scorer.scores(parts)
        found.append((parts[int(scores.argmax())], float(scores.max())))
    return found
