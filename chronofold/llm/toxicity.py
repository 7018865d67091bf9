"""Toxicity: subword-bag embeddings averaged into a linear softmax.

A word's vector is the mean of the embeddings of its character n-grams (three
to six, with word boundary marks) and of the word itself, all hashed to a
fixed number of rows; a text's vector is the mean of the vectors of its
distinct words, weighted by how telling a word is (learned too: the weight is a
softmax over the text's words of their own evidence, with a learned
temperature); a linear softmax over two classes gives the score. Embeddings,
class vectors and temperature are trained jointly by Adam in numpy. A
misspelled word shares most n-grams with its original and so most of its
vector. The plain mean was tried and misses texts with a few telling words
among many (figures in the README).

Learning takes at most `rows` labelled rows, half of either label (all, where
there are no more), on the driver. The curve that turns margins into scores is
the best rising one through the labels (isotonic regression) over margins of
rows by models of the other rows, with a slight slope where it is flat. Scoring is a map over
all documents and whole texts: as only a word's projection on the class
direction matters, the trained embeddings are folded into one number a row
before the broadcast, which is of fixed size.

Defined results: a text without words, null too, gets the share of label 1;
without labels of both classes every score is the share of label 1 (0.5
without any); of contradicting labels of one id the 1 counts; a null id isn't
learned from and counts as held out; repeated rows are scored alike; words are
of any length; an empty table stays empty; other columns, whatever their
names, are untouched.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .features import keep_scored, labelled_sample, score_all
from .textvec import WORD_ALNUM, TextSlice, Words, find_words, text_slices, word_hashes

BITS, WIDTH = 17, 6
ROWS = 2000
FOLDS, HELD = 4, 2
THRESHOLD = 0.3
NGRAMS = (3, 4, 5, 6)
#: Rounds over the rows, and Adam steps, at least; the rate falls by this factor in the course of a sixth of them.
ROUNDS, STEPS, RATE, DECAY, BATCH = 6, 200, 0.02, 0.8, 64
CHECKS = 3
#: The part of the score that rises everywhere.
SLOPE = 0.02


def distinct_words(part: TextSlice) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray]:
    """The words, the position of one occurrence of each distinct word of the slice, each document's distinct words by number, and how many they are."""
    words = find_words(part, WORD_ALNUM)
    _, first, number = np.unique(word_hashes(part, words), return_index=True, return_inverse=True)
    own = np.unique(words.doc_of() * max(1, len(first)) + number)
    doc, number = np.divmod(own, max(1, len(first)))
    return words, first, number, np.bincount(doc, minlength=len(part))


def subwords(part: TextSlice, words: Words, which: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(rows, how many for each word) of the n-grams of some words, the words themselves included."""
    size = words.ends[which] - words.starts[which] + 2
    edge = np.concatenate([[0], np.cumsum(size)])
    data = np.empty(edge[-1], dtype=np.uint64)
    inner = np.ones(edge[-1], dtype=bool)
    inner[edge[:-1]] = inner[edge[1:] - 1] = False
    data[edge[:-1]], data[edge[1:] - 1] = 0x3C, 0x3E
    place = np.arange(edge[-1]) - np.repeat(edge[:-1], size) - 1 + np.repeat(words.starts[which], size)
    data[inner] = part.data[place[inner]]
    owner = np.repeat(np.arange(len(which)), size)
    last = np.repeat(edge[1:], size)
    shift = np.uint64(64 - bits)
    rows, owners = [], []
    gram = data
    for n in range(2, max(NGRAMS) + 1):
        if len(gram) < 2:
            break
        gram = (gram[:-1] << np.uint64(8)) | data[n - 1 :]
        if n in NGRAMS:
            ok = np.arange(len(gram)) + n <= last[: len(gram)]
            rows.append((((gram[ok] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)) >> shift).astype(np.int64))
            owners.append(owner[: len(gram)][ok])
    whole = word_hashes(part, Words(words.starts[which], words.ends[which], np.array([0, len(which)]))) if len(which) else np.zeros(0, np.uint64)
    rows.append((whole >> shift).astype(np.int64))
    owners.append(np.arange(len(which)))
    rows, owners = np.concatenate(rows), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return rows[order], np.bincount(owners, minlength=len(which))


def mean_by(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Means of consecutive groups, none of them empty."""
    starts = np.cumsum(counts) - counts
    return np.add.reduceat(values, starts, axis=0) / counts.reshape(-1, *[1] * (values.ndim - 1))


@dataclass
class ToxicModel:
    evidence: np.ndarray  # of each n-gram row: its embedding times the class direction
    heat: float
    bias: float
    curve: tuple[np.ndarray, np.ndarray]  # margins, and the share of label 1 at each one
    bits: int = BITS
    share: float = 0.5  # of label 1: the score of a text without words

    def margins(self, column: pa.Array) -> np.ndarray:
        out = []
        for part in text_slices(column):
            words, first, number, counts = distinct_words(part)
            if not len(first):
                out.append(np.full(len(part), np.nan))
                continue
            own = mean_by(self.evidence[(x := subwords(part, words, first, self.bits))[0]].astype(np.float64), x[1])[number]
            have = counts > 0
            score = np.full(len(part), np.nan)
            score[have] = self.bias + _pooled(own, counts[have], self.heat)[0]
            out.append(score)
        return np.concatenate(out) if out else np.zeros(0)

    def __call__(self, column: pa.Array) -> np.ndarray:
        margin = self.margins(column)
        rising = 0.5 + margin / (1 + np.abs(margin)) / 2
        return np.where(np.isnan(margin), self.share, (1 - SLOPE) * np.interp(margin, *self.curve) + SLOPE * rising)


def isotonic_curve(margin: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(margins, shares of label 1) of the rising step function of least weighted squared error: neighbours that fall are pooled."""
    margins, which = np.unique(margin, return_inverse=True)
    pools: list[list[float]] = []  # weight, weight of label 1, least and largest margin
    for m, n, ones in zip(margins.tolist(), np.bincount(which, weights=weight).tolist(), np.bincount(which, weights=weight * y).tolist(), strict=True):
        pools.append([n, ones, m, m])
        while len(pools) > 1 and pools[-2][1] * pools[-1][0] >= pools[-1][1] * pools[-2][0]:
            last = pools.pop()
            pools[-1] = [pools[-1][0] + last[0], pools[-1][1] + last[1], pools[-1][2], last[3]]
    at = [(edge, pool[1] / pool[0]) for pool in pools for edge in pool[2:]]
    return np.array([m for m, _ in at]), np.array([p for _, p in at])


def _pooled(own: np.ndarray, counts: np.ndarray, heat: float) -> tuple[np.ndarray, np.ndarray]:
    """The weighted mean of the words' evidence in each text, and the words' weights."""
    starts = np.cumsum(counts) - counts
    top = np.repeat(np.maximum.reduceat(heat * own, starts), counts)
    weight = np.exp(heat * own - top)
    weight /= np.repeat(np.add.reduceat(weight, starts), counts)
    return np.add.reduceat(weight * own, starts), weight


def _fit_plain(rows: np.ndarray, sizes: np.ndarray, texts: list[np.ndarray], y: np.ndarray, bits: int, width: int, rounds: int, seed: int) -> ToxicModel:
    """texts: each one's words as numbers of the distinct words, whose n-gram rows are rows/sizes."""
    random = np.random.default_rng(seed)
    table = random.normal(0, 0.1, (1 << bits, width))
    head = random.normal(0, 0.5, (width, 2))
    offset = np.zeros(2)
    heat = np.array([2.0])
    ends = np.cumsum(sizes)
    spans = np.stack([ends - sizes, ends], axis=1)
    state = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in (("table", table), ("head", head), ("offset", offset), ("heat", heat))}
    have = np.array([i for i, t in enumerate(texts) if len(t)], dtype=np.int64)
    rounds = max(rounds, -(-STEPS // max(1, -(-len(have) // BATCH))))
    step, rate = 0, RATE
    weight = np.where(y == 1, len(y) / (2 * max(1, y.sum())), len(y) / (2 * max(1, (1 - y).sum())))
    for _ in range(rounds):
        order = random.permutation(have)
        for at in range(0, len(order), BATCH):
            batch = order[at : at + BATCH]
            words, number = np.unique(np.concatenate([texts[i] for i in batch]), return_inverse=True)
            counts = np.array([len(texts[i]) for i in batch])
            size = sizes[words]
            gram = np.concatenate([rows[a:b] for a, b in spans[words].tolist()])
            vector = mean_by(table[gram], size)
            direction = head[:, 1] - head[:, 0]
            own = (vector @ direction)[number]
            pooled, share = _pooled(own, counts, heat[0])
            text = np.add.reduceat(share[:, None] * vector[number], np.cumsum(counts) - counts)
            logit = text @ head + offset
            logit -= logit.max(1, keepdims=True)
            p = np.exp(logit)
            p /= p.sum(1, keepdims=True)
            error = p.copy()
            error[np.arange(len(batch)), y[batch]] -= 1
            error *= (weight[batch] / len(batch))[:, None]
            g_text = error @ head.T
            spread = np.repeat(g_text, counts, axis=0)
            # through the mean, and through the weights, which depend on the words' evidence
            along = (spread * vector[number]).sum(1)
            mean_along = np.repeat(np.add.reduceat(share * along, np.cumsum(counts) - counts), counts)
            g_logit = share * (along - mean_along)
            g_vector = np.zeros_like(vector)
            for j in range(width):
                g_vector[:, j] = np.bincount(number, weights=share * spread[:, j] + g_logit * heat[0] * direction[j], minlength=len(words))
            g_direction = heat[0] * (g_logit[:, None] * vector[number]).sum(0)
            g_head = text.T @ error
            g_head[:, 1] += g_direction
            g_head[:, 0] -= g_direction
            g_rows = np.repeat(g_vector / size[:, None], size, axis=0)
            touched = np.flatnonzero(np.bincount(gram, minlength=len(table)))
            g_table = np.stack([np.bincount(gram, weights=g_rows[:, j], minlength=len(table))[touched] for j in range(width)], axis=1)
            step += 1
            _adam(table, g_table, state["table"], step, rate, touched)
            _adam(head, g_head, state["head"], step, rate)
            _adam(offset, error.sum(0), state["offset"], step, rate)
            _adam(heat, np.array([(g_logit * own).sum()]), state["heat"], step, rate)
            heat = np.clip(heat, 0.0, 20.0)
        rate *= DECAY ** (ROUNDS / rounds)
    return ToxicModel((table @ (head[:, 1] - head[:, 0])).astype(np.float32), float(heat[0]), float(offset[1] - offset[0]), (np.array([0.0]), np.array([0.5])), bits)


def _adam(x: np.ndarray, g: np.ndarray, state: tuple[np.ndarray, np.ndarray], step: int, rate: float, rows: np.ndarray | slice = slice(None)) -> None:
    m, v = state
    m[rows] = 0.9 * m[rows] + 0.1 * g
    v[rows] = 0.99 * v[rows] + 0.01 * g * g
    x[rows] -= rate * (m[rows] / (1 - 0.9**step)) / (np.sqrt(v[rows] / (1 - 0.99**step)) + 1e-8)


def fit(texts: list[str], y: np.ndarray, weight: np.ndarray | None = None, bits: int = BITS, width: int = WIDTH, rounds: int = ROUNDS, seed: int = 11) -> ToxicModel:
    """weight: how many labelled rows each one stands for, for the scores' curve."""
    weight = np.ones(len(y)) if weight is None else weight
    if len(set(y.tolist())) < 2:
        share = min(max(float(y.mean()) if len(y) else 0.5, 1e-6), 1 - 1e-6)
        return ToxicModel(np.zeros(1 << bits, np.float32), 0.0, 0.0, (np.array([0.0]), np.array([share])), bits, share)
    column = pa.array(texts, pa.string())
    rows, sizes, docs, base = [], [], [], 0
    for part in text_slices(column):
        words, first, number, counts = distinct_words(part)
        r, s = subwords(part, words, first, bits)
        rows.append(r)
        sizes.append(s)
        docs += [base + x for x in np.split(number, np.cumsum(counts)[:-1])]
        base += len(first)
    rows, sizes = np.concatenate(rows), np.concatenate(sizes)
    fold, unseen = np.zeros(len(y), dtype=np.int64), np.full(len(y), np.nan)
    for k in (0, 1):  # either label is spread over the folds
        own = np.flatnonzero(y == k)
        fold[own] = np.arange(len(own)) % CHECKS
    for k in range(CHECKS):
        rest, own = np.flatnonzero(fold != k), np.flatnonzero(fold == k)
        if len(set(y[rest].tolist())) == 2 and len(own):
            part = _fit_plain(rows, sizes, [docs[i] for i in rest], y[rest], bits, width, rounds, seed + k)
            unseen[own] = part.margins(pa.array([texts[i] for i in own], pa.string()))
    model = _fit_plain(rows, sizes, docs, y, bits, width, rounds, seed)
    known = ~np.isnan(unseen)
    if len(set(y[known].tolist())) == 2:
        model.curve = isotonic_curve(unseen[known], y[known], weight[known])
    model.share = float((weight * y).sum() / weight.sum())
    return model


def train(docs: DataFrame, labels: DataFrame, rows: int = ROWS) -> ToxicModel:
    return fit(*labelled_sample(docs, labels, "toxic", FOLDS, HELD, rows))


def score_toxicity(docs: DataFrame, labels: DataFrame, rows: int = ROWS) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    return score_all(docs, train(docs, labels, rows), FOLDS, HELD, THRESHOLD)


def drop_toxic(docs: DataFrame, labels: DataFrame, rows: int = ROWS) -> DataFrame:
    """The documents that score below the threshold, all columns."""
    return keep_scored(docs, train(docs, labels, rows), THRESHOLD, below=True)
