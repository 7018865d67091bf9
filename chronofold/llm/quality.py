"""Quality classifier: naive Bayes support vectors.

A text's n-grams (words and pairs of words, byte trigrams to five-grams, and
word 1-3-grams that come up again and again) are indicators, hashed to a fixed
number of columns. Each column is scaled by its log-count ratio between the
two classes, r = log((p / |p|) / (q / |q|)) with smoothed counts, and a linear
model with hinge loss is fitted on the scaled, length-normalised indicators by
dual coordinate descent: one dual variable at a time, with its box constraint,
keeping the weight vector up to date. The margin becomes a score from 0 to 1
through a logistic curve fitted on margins of rows that the model of the
other half has not seen, so that 0.3 is a usable cut.

Learning takes at most `rows` labelled rows, half of either label (all, where
there are no more), and runs on the driver; scoring is a map over all documents, whole texts, with a
broadcast of 2**bits weights. Labels, lang, source and id are no inputs.

Defined results: null and empty texts get the score of an empty indicator
set; without labels of both classes every score is the share of label 1 (0.5
without any); of contradicting labels of one id the 1 counts; a null id isn't
learned from and counts as held out; repeated rows are scored alike; an empty
table stays empty; other columns, whatever their names, are untouched.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .features import keep_scored, labelled_sample, score_all
from .textvec import WORD_NOT_SPACE, TextSlice, find_words, mix64, text_slices, word_hashes

BITS = 18
ROWS = 2400
FOLDS, HELD = 5, 0
THRESHOLD = 0.3
GRAMS = (3, 4, 5)


def columns_of(part: TextSlice, bits: int = BITS) -> list[np.ndarray]:
    """The distinct columns of each document's indicators."""
    words = find_words(part, WORD_NOT_SPACE)
    hashes = word_hashes(part, words)
    shift = np.uint64(64 - bits)
    pairs = mix64(hashes[:-1] * np.uint64(3) + hashes[1:]) if len(hashes) > 1 else hashes[:0]
    triples = mix64(pairs[:-1] * np.uint64(5) + hashes[2:]) if len(hashes) > 2 else hashes[:0]
    data = part.data.astype(np.uint64)
    grams, gram = [], data
    for n in range(2, max(GRAMS) + 1):
        gram = (gram[:-1] << np.uint64(8)) | data[n - 1 :] if len(gram) > 1 else gram[:0]
        if n in GRAMS:
            grams.append(((gram * np.uint64(0x9E3779B97F4A7C15 + 2 * n)) >> shift).astype(np.int64))
    singles_at, pairs_at = (hashes >> shift).astype(np.int64), (pairs >> shift).astype(np.int64)
    seen = np.zeros(1 << bits, dtype=bool)
    out = []
    for d in range(len(part)):
        a, b = words.bounds[d], words.bounds[d + 1]
        x, y = part.offsets[d], part.offsets[d + 1] - 2  # without the end mark
        own = [singles_at[a:b], pairs_at[a : max(a, b - 1)], *(g[x : max(x, y - n + 1)] for n, g in zip(GRAMS, grams, strict=True)), _repeats(hashes[a:b], pairs[a : max(a, b - 1)], triples[a : max(a, b - 2)], shift)]
        at = np.concatenate(own)
        seen[at] = True
        at = at[_first(seen, at)]
        out.append(at)
    return out


def _first(seen: np.ndarray, at: np.ndarray) -> np.ndarray:
    """One position of each value, and `seen` cleared for the next document."""
    place = _place(len(seen))
    place[at] = np.arange(len(at))
    keep = np.flatnonzero(place[at] == np.arange(len(at)))
    seen[at] = False
    return keep


_places: dict[int, np.ndarray] = {}


def _place(n: int) -> np.ndarray:
    if n not in _places:
        _places[n] = np.zeros(n, dtype=np.int64)
    return _places[n]


def _repeats(singles: np.ndarray, pairs: np.ndarray, triples: np.ndarray, shift: np.uint64) -> np.ndarray:
    """Indicators of how much of the text's n-grams are repeated ones, in tenths."""
    out = []
    for n, x in enumerate((singles, pairs, triples)):
        if len(x) >= 4:
            tenth = int(10 * (1 - len(np.unique(x)) / len(x)))
            out += [(n, t) for t in range(tenth + 1)]
    if not out:
        return np.zeros(0, dtype=np.int64)
    return (mix64(np.array([7919 * (100 * n + t + 1) for n, t in out], dtype=np.uint64)) >> shift).astype(np.int64)


def dual_coordinate_descent(rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, width: int, c: np.ndarray, rounds: int = 30, seed: int = 7) -> np.ndarray:
    """Weights (the last one is the bias) of a linear model with hinge loss. c: each row's cost; y: -1 or 1."""
    w = np.zeros(width + 1)
    alpha = np.zeros(len(rows))
    square = np.array([v @ v + 1 for v in values])
    random = np.random.default_rng(seed)
    for _ in range(rounds):
        most = 0.0
        for i in random.permutation(len(rows)):
            gradient = y[i] * (w[rows[i]] @ values[i] + w[-1]) - 1
            new = min(max(alpha[i] - gradient / square[i], 0.0), c[i])
            step = new - alpha[i]
            if step:
                alpha[i] = new
                w[rows[i]] += step * y[i] * values[i]
                w[-1] += step * y[i]
                most = max(most, abs(step) * square[i])
        if most < 1e-3:
            break
    return w


def logistic_curve(margin: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 100) -> tuple[float, float]:
    """(a, b) of 1 / (1 + exp(-(a margin + b))), by Newton steps with a small ridge; a step that doesn't help is halved."""

    def loss(ab: np.ndarray) -> float:
        z = ab[0] * margin + ab[1]
        return float((weight * (np.logaddexp(0, z) - y * z)).sum() + 5e-3 * ((ab[0] - 1) ** 2 + ab[1] ** 2))

    ab = np.array([1.0, 0.0])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(ab[0] * margin + ab[1], -40, 40)))
        g = np.array([(weight * (p - y) * margin).sum() + 1e-2 * (ab[0] - 1), (weight * (p - y)).sum() + 1e-2 * ab[1]])
        h = weight * p * (1 - p)
        step = np.linalg.solve(np.array([[(h * margin * margin).sum() + 1e-2, (h * margin).sum()], [(h * margin).sum(), h.sum() + 1e-2]]), g)
        now = loss(ab)
        while loss(ab - step) > now and abs(step).max() > 1e-9:
            step /= 2
        ab = ab - step
        if abs(step).max() < 1e-6:
            break
    return float(ab[0]), float(ab[1])


@dataclass
class NbSvm:
    weights: np.ndarray  # of the columns, log-count ratios included
    bias: float
    ratio: np.ndarray
    a: float
    b: float
    bits: int = BITS

    def margin(self, at: np.ndarray) -> float:
        if not len(at):
            return self.bias
        r = self.ratio[at].astype(np.float64)
        size = np.sqrt(r @ r)
        return float(self.weights[at] @ r / size + self.bias) if size else self.bias

    def __call__(self, column: pa.Array) -> np.ndarray:
        out = [self.margin(at) for part in text_slices(column) for at in columns_of(part, self.bits)]
        return 1 / (1 + np.exp(-np.clip(self.a * np.array(out, dtype=np.float64) + self.b, -40, 40)))


def _fit_plain(rows: list[np.ndarray], y: np.ndarray, bits: int, cost: float) -> NbSvm:
    counts = [np.ones(1 << bits), np.ones(1 << bits)]
    for at, k in zip(rows, y, strict=True):
        counts[k][at] += 1
    ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    values = []
    for at in rows:
        v = ratio[at]
        size = np.sqrt(v @ v)
        values.append(v / size if size else v)
    each = np.where(y == 1, cost * len(y) / max(1, 2 * y.sum()), cost * len(y) / max(1, 2 * (1 - y).sum()))
    w = dual_coordinate_descent(rows, values, 2 * y - 1, 1 << bits, each)
    return NbSvm(w[:-1].astype(np.float32), float(w[-1]), ratio.astype(np.float32), 1.0, 0.0, bits)


def fit(texts: list[str], y: np.ndarray, weight: np.ndarray | None = None, bits: int = BITS, cost: float = 1.0) -> NbSvm:
    """weight: how many labelled rows each one stands for, for the scores' curve."""
    weight = np.ones(len(y)) if weight is None else weight
    rows = [at for part in text_slices(pa.array(texts, pa.string())) for at in columns_of(part, bits)]
    if len(set(y.tolist())) < 2:
        share = float(y.mean()) if len(y) else 0.5
        share = min(max(share, 1e-6), 1 - 1e-6)
        return NbSvm(np.zeros(1 << bits, np.float32), 0.0, np.zeros(1 << bits, np.float32), 0.0, float(np.log(share / (1 - share))), bits)
    half = np.arange(len(rows)) % 2
    unseen = np.zeros(len(rows))
    for k in (0, 1):
        learn = np.flatnonzero(half != k)
        if len(set(y[learn].tolist())) < 2:
            learn = np.arange(len(rows))
        part = _fit_plain([rows[i] for i in learn], y[learn], bits, cost)
        for i in np.flatnonzero(half == k):
            unseen[i] = part.margin(rows[i])
    model = _fit_plain(rows, y, bits, cost)
    model.a, model.b = logistic_curve(unseen, y, weight)
    return model


def train(docs: DataFrame, labels: DataFrame, rows: int = ROWS) -> NbSvm:
    return fit(*labelled_sample(docs, labels, "quality", FOLDS, HELD, rows))


def score_quality(docs: DataFrame, labels: DataFrame, rows: int = ROWS) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    return score_all(docs, train(docs, labels, rows), FOLDS, HELD, THRESHOLD)


def drop_poor(docs: DataFrame, labels: DataFrame, rows: int = ROWS) -> DataFrame:
    """The documents that the classifier doesn't reject, all columns."""
    return keep_scored(docs, train(docs, labels, rows), THRESHOLD)
