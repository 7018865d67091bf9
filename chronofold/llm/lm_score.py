"""Language-model scores from a probabilistic suffix tree.

The tree's symbols are bytes: the text with A-Z lower-cased, one space after
each word, and an end mark. Its contexts have variable length, up to `depth`
bytes (six at most, so that a context and its next byte fit into 64 bits). A
context stays if it was seen often enough and its next-byte distribution
diverges from that of the context one byte shorter - n times their
Kullback-Leibler divergence reaches a cutoff - or if a longer one of its
extensions stays. Each distribution is smoothed towards that of the next
shorter context (by as many counts as it has kinds of next bytes), the empty
one's towards the uniform one. A byte is scored in the longest suffix of its
past that is a state, so `score` is the tree's probability of the text alone.

1. Counting: tasks sum the codes of context and next byte, and word hashes, of
   all training documents; the sums are added up by hashed groups, then brought
   together by a context's latest two bytes, where the divergence tests are
   made. All contexts that pass are kept, as a table.
2. Asking: documents are cut into chunks of some MB; each chunk's distinct
   codes and words are sent, once, to the parts of the tree and of the word
   table that know them. The parts are copied for latest pairs of bytes that
   many codes share, so no pair is worked on by one task.
3. Scoring: a chunk's answers meet its texts, and every document is scored.

Only tables whose size is bounded by the alphabet are broadcast (distributions
of contexts of up to two bytes, 255**2 * 256 numbers at most). Words are told
apart by 64-bit hashes; each kept table is split by the session's number of
shuffle partitions. Nothing that is shuffled or kept depends on the order in
which rows are read: a chunk's texts and questions are written together.

Defined results: a null text is empty and has one token, the end; a null id
isn't learned from and counts as held out; without training documents all
counts are 0 and the tree is uniform; repeated rows are scored separately; an
empty table gives an empty result; other columns, whatever their names, are
not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import durable, fold, forget, frugal, opened, release, sealed, small_batches, squeezed, steps, unsealed
from .textvec import END, WORD_NOT_SPACE, TextSlice, Words, find_words, mix64, text_slices, word_hashes

DEPTH = 6
MIN_COUNT = 4
CUTOFF = 4.0
HELD_OUT = (7, 2)  # folds, the one that isn't learned from
#: Text that is asked for and scored together; codes that a counting task holds.
CHUNK_BYTES, HELD_CODES = 16 << 20, 3_000_000
#: Parts of the kept tables for each shuffle partition.
PARTS = 2
PAD, STOP = 0, END
#: byte -> symbol: PAD takes the place of the zero byte, which moves to one that UTF-8 never has.
SYMBOL = np.arange(256, dtype=np.int64)
SYMBOL[PAD] = 0xFE
SYMBOLS = 255
#: Kinds of rows. What is known comes before what is asked.
CODES, WORDS, TOTALS, ASKED_CODES, ASKED_WORDS, TEXTS = range(6)
COUNTED = "kind int, bucket bigint, blob binary, tokens bigint, kinds bigint"
ROWS = "kind int, to bigint, bucket bigint, chunk bigint, blob binary"


def merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sums counts of equal keys; sorted by key."""
    k, c = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(k, kind="stable")
    k, c = k[order], c[order]
    first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.zeros(0, dtype=np.int64)
    return k[first], np.add.reduceat(c, first) if len(k) else c


def runs(sorted_keys: np.ndarray) -> Iterator[tuple[int, int]]:
    """(start, end) of the runs of equal keys."""
    edges = np.flatnonzero(np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1], [True]])) if len(sorted_keys) else np.zeros(1, dtype=np.int64)
    return zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)


def distinct(x: np.ndarray) -> np.ndarray:
    """The distinct values, sorted; x is sorted in place."""
    x.sort()
    return x[np.concatenate([[True], x[1:] != x[:-1]])] if len(x) else x


class Sum:
    """Counts by key in bounded memory: `full` tells when to hand them on."""

    def __init__(self, kind: type, limit: int = HELD_CODES):
        self.kind, self.limit = kind, limit
        self.clear()

    def clear(self) -> None:
        self.keys, self.counts, self.size = [np.zeros(0, dtype=self.kind)], [np.zeros(0, dtype=np.int64)], 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.keys.append(keys)
        self.counts.append(counts)
        self.size += len(keys)
        if self.size > self.limit:
            self.get()

    def full(self) -> bool:
        return self.size > self.limit // 2

    def get(self) -> tuple[np.ndarray, np.ndarray]:
        k, c = merged(self.keys, self.counts)
        self.keys, self.counts, self.size = [k], [c], len(k)
        return k, c


def symbols(part: TextSlice, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """The symbols, with one space after each word and STOP after each document; where each document begins."""
    inside = WORD_NOT_SPACE[part.data]
    keep = inside | (part.data == END)
    keep[words.ends] = True
    out = np.where(inside | (part.data == END), part.data, np.uint8(0x20))[keep]
    return SYMBOL[out], np.concatenate([[0], np.cumsum(keep)[part.offsets[1:] - 1]])


def context_codes(symbol: np.ndarray, depth: int) -> np.ndarray:
    """Of each position: its past, the latest symbol in the highest byte, then the symbol itself in the lowest. The past ends at its document's begin: STOP, then PAD."""
    code, alive = symbol.copy(), np.ones(len(symbol), dtype=bool)
    for k in range(1, depth + 1):
        past = np.zeros(len(symbol), dtype=np.int64)
        past[k:] = symbol[:-k]
        past[k - 1 : k] = STOP  # what precedes the first document
        past *= alive
        code |= past << (8 * (depth - k + 1))
        alive &= past != STOP
    return code


Levels = list[tuple[np.ndarray, np.ndarray]]


def by_context(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of sorted codes: the contexts, where each one begins, its count, its kinds of next symbols."""
    context = codes >> 8
    first = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]])) if len(codes) else np.zeros(0, dtype=np.int64)
    return context[first], first, np.add.reduceat(counts, first) if len(first) else counts, np.diff(np.append(first, len(codes)))


def kept_levels(codes: np.ndarray, counts: np.ndarray, depth: int, min_count: int, cutoff: float) -> Levels:
    """Of length 2, 3 ... `depth`: (context and next symbol, count) of the contexts that stay, out of all counts of contexts with the same latest two symbols. Those two are all there: the test of contexts that short is made elsewhere."""
    levels = []
    for k in range(2, depth + 1):
        own = (codes, counts) if k == depth else merged([(codes >> (8 * (depth - k + 1)) << 8) | (codes & 255)], [counts])
        contexts, first, total, kinds = by_context(*own)
        levels.append((*own, contexts, total, np.repeat(np.arange(len(first)), kinds), first))
    gains = [np.full(len(levels[0][2]), np.inf)]
    for (up_codes, up_counts, _, up_total, up_group, _), (own, n, contexts, total, group, first) in zip(levels[:-1], levels[1:], strict=True):
        if not len(first):
            gains.append(np.zeros(0))
            continue
        at = np.searchsorted(up_codes, (own >> 16 << 8) | (own & 255))
        gain = np.add.reduceat(n * np.log((n / total[group]) / (up_counts[at] / up_total[up_group[at]])), first)
        gain[(total < min_count) | (gain < cutoff) | (contexts & 255 == PAD)] = 0
        gains.append(gain)
    for j in range(len(levels) - 1, 0, -1):  # a context is worth as much as its best extension
        at = np.searchsorted(levels[j - 1][2], levels[j][2] >> 8)
        np.maximum.at(gains[j - 1], at, gains[j])
    return [(x[0][stays], x[1][stays]) for x, gain in zip(levels, gains, strict=True) for stays in [gain[x[4]] > 0]]


def count_table(docs: DataFrame, text_column: str, train: Column, depth: int, parts: int) -> DataFrame:
    """COUNTED rows over the training documents: codes and counts by latest two symbols (several rows each), words and counts by hash bucket (one row each), and totals of the words of each bucket."""
    lead = 8 * max(0, depth - 3)  # below a code's latest four symbols

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, words = Sum(np.int64), Sum(np.uint64)
        for batch in batches:
            for part in text_slices(batch.column(0)):
                found = find_words(part, WORD_NOT_SPACE)
                words.add(*np.unique(word_hashes(part, found), return_counts=True))
                code = context_codes(symbols(part, found)[0], depth)
                code.sort()
                first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
                codes.add(code[first], np.diff(np.append(first, len(code))))
                if codes.full() or words.full():
                    yield handed_on(codes, words)
        yield handed_on(codes, words)

    def handed_on(codes: Sum, words: Sum) -> pa.RecordBatch:
        out = []
        keys, counts = codes.get()
        group = (mix64((keys >> lead).view(np.uint64)) % np.uint64(parts)).astype(np.int64)
        order = np.argsort(group, kind="stable")
        keys, counts, group = keys[order], counts[order], group[order]
        out += [(CODES, int(group[a]), squeezed(steps(keys[a:b]), counts[a:b]), None, None) for a, b in runs(group)]
        keys, counts = words.get()
        out += [(WORDS, b, squeezed(steps(keys[x:y]), counts[x:y]), None, None) for x, y, b in _by_hash(keys, parts)]
        codes.clear()
        words.clear()
        return _batch(out, COUNTED)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, total = None, None
        for batch in batches:
            for kind, bucket, blob in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if (kind, bucket) != last:
                    if last:
                        yield summed(*last, total)
                    last, total = (kind, bucket), Sum(np.int64 if kind == CODES else np.uint64)
                keys, counts = opened(blob)
                total.add(np.cumsum(keys, dtype=keys.dtype), counts)
        if last:
            yield summed(*last, total)

    def summed(kind: int, bucket: int, total: Sum) -> pa.RecordBatch:
        keys, counts = total.get()
        if kind == WORDS:
            return _batch([(WORDS, bucket, squeezed(steps(keys), counts), None, None), (TOTALS, bucket, None, int(counts.sum()), len(keys))], COUNTED)
        pair = keys >> (8 * (depth - 1))
        return _batch([(CODES, int(pair[a]), squeezed(steps(keys[a:b]), counts[a:b]), None, None) for a, b in runs(pair)], COUNTED)

    counted = docs.where(F.coalesce(train, F.lit(False))).select(text_column).mapInArrow(frugal(count), COUNTED)
    return counted.repartition(parts // PARTS, "kind", "bucket").sortWithinPartitions("kind", "bucket").mapInArrow(frugal(add), COUNTED)


def tree_table(counted: DataFrame, depth: int, min_count: int, cutoff: float, partitions: int) -> DataFrame:
    """(bucket, blob, pair, longer): for each two latest symbols the contexts that stay, then by themselves the counts of the context of these two, and whether a longer one stays."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, total = None, Sum(np.int64)
        for batch in batches:
            for bucket, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if bucket != last and last is not None:
                    yield row(last, total)
                    total.clear()
                last = bucket
                keys, counts = opened(blob)
                total.add(np.cumsum(keys), counts)
        if last is not None:
            yield row(last, total)

    def row(bucket: int, total: Sum) -> pa.RecordBatch:
        levels = kept_levels(*total.get(), depth, min_count, cutoff)
        codes, counts = levels[0]
        blobs = squeezed(*(x for level in levels[1:] for x in level)), squeezed((codes & 255).astype(np.uint8), counts)
        return pa.RecordBatch.from_arrays([pa.array([bucket], pa.int64()), *(pa.array([x], pa.binary()) for x in blobs), pa.array([len(levels) > 1 and len(levels[1][0]) > 0])], names=["bucket", "blob", "pair", "longer"])

    pairs = counted.where(F.col("kind") == CODES).select("bucket", "blob").repartition(partitions, "bucket").sortWithinPartitions("bucket")
    return pairs.mapInArrow(frugal(keep), "bucket bigint, blob binary, pair binary, longer boolean")


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    columns = zip(*rows, strict=True) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(x, kinds[t]) for x, (_, t) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])


def _by_hash(keys: np.ndarray, parts: int) -> Iterator[tuple[int, int, int]]:
    """(start, end, bucket) of sorted 64-bit hashes; buckets are ranges of hashes."""
    bucket = ((keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
    return ((a, b, int(bucket[a])) for a, b in runs(bucket))


@dataclass
class Shared:
    """What every task knows: the distributions of short contexts, the word totals, and how the rest is dealt out."""

    depth: int
    parts: int
    first: np.ndarray  # latest symbol -> its distribution, or the empty context's where it isn't a state
    pairs: np.ndarray  # latest two symbols that are states, sorted
    second: np.ndarray  # their distributions
    copies: np.ndarray  # of each pair's part of the tree
    documents: int
    tokens: int
    kinds: int

    @classmethod
    def of(cls, rows: list[tuple[int, bytes, bool]], words: tuple[int, int], depth: int, parts: int, min_count: int, cutoff: float) -> Shared:
        """rows: (pair, next symbols and counts, whether a longer context stays); words: how many there are, and how many kinds."""
        by_pair = {}
        for pair, blob, longer in sorted(rows):
            symbol, n = opened(blob)
            by_pair[pair] = np.zeros(256)
            by_pair[pair][symbol] = n
        longer = {pair for pair, _, more in rows if more}
        ones = np.zeros((256, 256))
        for pair, x in by_pair.items():
            ones[pair >> 8] += x
        zero = ones.sum(0)
        uniform = np.full(256, 1 / SYMBOLS)
        uniform[PAD] = 0
        stays = lambda x, up: x.sum() >= min_count and (x[x > 0] * np.log(x[x > 0] / x.sum() / (up[x > 0] / up.sum()))).sum() >= cutoff
        smooth = lambda x, up: (x + np.count_nonzero(x) * up) / max(1.0, x.sum() + np.count_nonzero(x)) if x.any() else up
        two = [p for p, x in by_pair.items() if p & 255 != PAD and (p in longer or stays(x, ones[p >> 8]))]
        leads = {p >> 8 for p in two}
        empty = smooth(zero, uniform)
        first = np.stack([smooth(x, empty) if k in leads or x.any() and stays(x, zero) else empty for k, x in enumerate(ones)])
        second = np.stack([smooth(by_pair[p], first[p >> 8]) for p in two]) if two else np.zeros((0, 256))
        copies = np.ones(1 << 16, dtype=np.int64)
        for p, x in by_pair.items():
            copies[p] = min(parts, 1 + int(x.sum() / zero.sum() * parts))
        documents = int(zero[STOP])
        return cls(depth, parts, first, np.array(two, dtype=np.int64), second.astype(np.float32), copies, documents, words[0] + documents, words[1] + (documents > 0))

    def part_of(self, pair: np.ndarray, copy: np.ndarray | int) -> np.ndarray:
        """The part that answers for a pair; `copy` chooses among the copies of frequent ones."""
        return ((mix64(pair.astype(np.uint64)) % np.uint64(self.parts)).astype(np.int64) + copy % self.copies[pair]) % self.parts

    def base(self, count: np.ndarray | int) -> np.ndarray:
        return np.log10((count + 1) / (self.tokens + self.kinds + 1))

    def log10(self, codes: np.ndarray, levels: list[tuple[np.ndarray, ...]]) -> np.ndarray:
        """Of sorted codes with the same latest two symbols: log10 probability of the symbol in the longest suffix of its past that is a state. levels: of contexts of three symbols and more: codes, counts, contexts, their counts and kinds."""
        symbol, pair = codes & 255, int(codes[0] >> (8 * (self.depth - 1)))
        at = int(np.searchsorted(self.pairs, pair))
        p = (self.second[at] if at < len(self.pairs) and self.pairs[at] == pair else self.first[pair >> 8])[symbol].astype(np.float64)
        live = np.arange(len(codes))
        for k, (own, counts, contexts, total, kinds) in enumerate(levels, 3):
            if not len(contexts) or not len(live):
                break
            wanted = codes[live] >> (8 * (self.depth - k + 1))
            at = np.minimum(np.searchsorted(contexts, wanted), len(contexts) - 1)
            hit = contexts[at] == wanted
            live, at = live[hit], at[hit]
            wanted = (contexts[at] << 8) | symbol[live]
            i = np.minimum(np.searchsorted(own, wanted), len(own) - 1)
            p[live] = (np.where(own[i] == wanted, counts[i], 0) + kinds[at] * p[live]) / (total[at] + kinds[at])
        return np.log10(p)


def questions(shared: Callable[[], Shared]) -> Callable:
    """Documents (text, id, held out) -> ROWS: each chunk's texts, and its distinct codes and words, each to a part that knows them."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, chunk = shared(), TaskContext.get().partitionId() << 24
        codes, words, texts, size = [], [], [], 0
        for batch in batches:
            for part in text_slices(batch.column(0)):
                found = find_words(part, WORD_NOT_SPACE)
                words.append(np.unique(word_hashes(part, found)))
                codes.append(distinct(context_codes(symbols(part, found)[0], own.depth)))
                texts.append(sealed(batch.slice(part.first, len(part))))
                size += len(part.data)
                if size >= CHUNK_BYTES:
                    yield rows(own, chunk, codes, words, texts)
                    chunk, codes, words, texts, size = chunk + 1, [], [], [], 0
        if texts:
            yield rows(own, chunk, codes, words, texts)

    def rows(own: Shared, chunk: int, codes: list[np.ndarray], words: list[np.ndarray], texts: list[bytes]) -> pa.RecordBatch:
        copy = int(mix64(np.array([chunk], dtype=np.uint64))[0] >> np.uint64(16))
        out = [(TEXTS, 0, k, chunk, x) for k, x in enumerate(texts)]
        keys = distinct(np.concatenate(codes))
        pairs = keys >> (8 * (own.depth - 1))
        to = own.part_of(pairs, copy)
        order = np.argsort(to, kind="stable")
        keys, to = keys[order], to[order]
        out += [(ASKED_CODES, int(to[a]), int(to[a]), chunk, squeezed(steps(keys[a:b]))) for a, b in runs(to)]
        keys = distinct(np.concatenate(words))
        out += [(ASKED_WORDS, -1 - bucket, bucket, chunk, squeezed(steps(keys[a:b]))) for a, b, bucket in _by_hash(keys, own.parts)]
        return _batch(out, ROWS)

    return ask


def copies(shared: Callable[[], Shared]) -> Callable:
    """The tree's parts (pair, blob) -> ROWS, one for each copy."""

    def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared()
        for batch in batches:
            for pair, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                n = int(own.copies[pair])
                to = own.part_of(np.full(n, pair), np.arange(n))
                yield _batch([(CODES, int(t), pair, 0, blob) for t in to], ROWS)

    return copy


def answers(shared: Callable[[], Shared]) -> Callable:
    """ROWS sorted by (to, kind): what is known, then what is asked -> ROWS (chunk; keys and the tree's log10 probabilities or the words' counts)."""

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, last, tree, keys, counts = shared(), None, {}, np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
        for batch in batches:
            out = []
            for kind, to, bucket, chunk, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if to != last:
                    last, tree, keys, counts = to, {}, keys[:0], counts[:0]
                arrays = opened(blob)
                if kind == CODES:
                    tree[bucket] = [(c, n, x, total, kinds) for c, n in zip(arrays[::2], arrays[1::2], strict=True) for x, _, total, kinds in [by_context(c, n)]]
                elif kind == WORDS:
                    keys, counts = np.cumsum(arrays[0], dtype=np.uint64), arrays[1]
                elif kind == ASKED_CODES:
                    codes = np.cumsum(arrays[0])
                    pairs = codes >> (8 * (own.depth - 1))
                    found = [own.log10(codes[a:b], tree.get(int(pairs[a]), [])) for a, b in runs(pairs)]
                    out.append((kind, 0, bucket, chunk, squeezed(arrays[0], np.concatenate(found).astype(np.float32))))
                else:
                    wanted = np.cumsum(arrays[0], dtype=np.uint64)
                    at = np.minimum(np.searchsorted(keys, wanted), max(0, len(keys) - 1))
                    found = np.where(keys[at] == wanted, counts[at], 0) if len(keys) else np.zeros(len(wanted), dtype=np.int64)
                    out.append((kind, 0, bucket, chunk, squeezed(arrays[0], found)))
            yield _batch(out, ROWS)

    return answer


def scorer(shared: Callable[[], Shared], id_column: str) -> Callable:
    """ROWS sorted by (chunk, kind, bucket): a chunk's answers, then its texts -> a row for each document."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, last, known, ready = shared(), None, {}, {}
        for batch in batches:
            for kind, _, _, chunk, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if chunk != last:
                    last, known, ready = chunk, {ASKED_CODES: ([], []), ASKED_WORDS: ([], [])}, {}
                if kind != TEXTS:
                    keys, values = opened(blob)
                    known[kind][0].append(np.cumsum(keys, dtype=keys.dtype))
                    known[kind][1].append(values)
                    continue
                if not ready:
                    ready = {k: _sorted(*pair) for k, pair in known.items()}
                    known = {}
                yield from scored(own, unsealed(blob), ready)

    def scored(own: Shared, texts: pa.RecordBatch, ready: dict) -> Iterator[pa.RecordBatch]:
        for part in text_slices(texts.column(0)):
            found, n = find_words(part, WORD_NOT_SPACE), len(part)
            symbol, begins = symbols(part, found)
            total = np.add.reduceat(_looked_up(context_codes(symbol, own.depth), *ready[ASKED_CODES]), begins[:-1], dtype=np.float64)
            count = _looked_up(word_hashes(part, found), *ready[ASKED_WORDS])
            doc = found.doc_of()
            sums = [np.bincount(doc, weights=x, minlength=n) for x in (count > 0, own.base(count))]
            yield pa.RecordBatch.from_arrays(
                [
                    texts.column(1).slice(part.first, n), texts.column(2).slice(part.first, n), pa.array(np.diff(found.bounds) + 1, pa.int64()), pa.array(sums[0].astype(np.int64) + (own.documents > 0), pa.int64()),
                    pa.array(np.full(n, own.tokens), pa.int64()), pa.array(sums[1] + own.base(own.documents), pa.float64()), pa.array(total, pa.float64()),
                ],
                names=[id_column, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    return score


def _sorted(keys: list[np.ndarray], values: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    if not keys:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    k, v = np.concatenate(keys), np.concatenate(values)
    order = np.argsort(k, kind="stable")
    return k[order], v[order]


def _looked_up(wanted: np.ndarray, keys: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Values of keys that are all there. In sorted order: a search for each one by itself misses the caches."""
    order = np.argsort(wanted)
    w = wanted[order]
    first = np.flatnonzero(np.concatenate([[True], w[1:] != w[:-1]])) if len(w) else np.zeros(0, dtype=np.int64)
    out = np.empty(len(w), dtype=values.dtype)
    out[order] = np.repeat(values[np.searchsorted(keys, w[first])], np.diff(np.append(first, len(w)))) if len(w) else values[:0]
    return out


def score_documents(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", held_out: tuple[int, int] = HELD_OUT, depth: int = DEPTH, min_count: int = MIN_COUNT, cutoff: float = CUTOFF) -> DataFrame:
    """One row per document: id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10 of the text's probability in the tree)."""
    if not 2 <= depth <= 6:
        raise ValueError("depth must be from 2 to 6")
    folds, out_fold = held_out
    spark = docs.sparkSession
    docs = small_batches(docs)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = PARTS * partitions
    counted = durable(count_table(docs, text_column, fold(id_column, folds) != out_fold, depth, parts))
    tree = durable(tree_table(counted, depth, min_count, cutoff, partitions))
    totals = counted.where(F.col("kind") == TOTALS).agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("kinds"), F.lit(0))).first()
    pairs = [tuple(r) for r in tree.select("bucket", "pair", "longer").collect()]  # 255 ** 2 at most, of 256 counts at most
    known = Shared.of(pairs, tuple(totals), depth, parts, min_count, cutoff)
    broadcast = spark.sparkContext.broadcast(known)
    shared = lambda: broadcast.value

    is_held_out = F.coalesce(fold(id_column, folds) == out_fold, F.lit(True))
    asked = durable(docs.select(F.col(text_column), F.col(id_column), is_held_out.alias("held_out")).mapInArrow(frugal(questions(shared)), ROWS))
    words = durable(counted.where(F.col("kind") == WORDS).select("bucket", "blob"))
    forget(counted)
    del counted
    release(spark)
    part_of_tree = tree.select("bucket", "blob").mapInArrow(frugal(copies(shared)), ROWS)
    none = F.lit(0).cast("bigint").alias("chunk")
    told = part_of_tree.unionAll(words.select(F.lit(WORDS).alias("kind"), (-1 - F.col("bucket")).alias("to"), "bucket", none, "blob"))
    met = told.unionAll(asked.where(F.col("kind") != TEXTS)).repartition(partitions, "to").sortWithinPartitions("to", "kind")
    answered = met.mapInArrow(frugal(answers(shared)), ROWS)
    whole = answered.unionAll(asked.where(F.col("kind") == TEXTS)).repartition(partitions, "chunk").sortWithinPartitions("chunk", "kind", "bucket")
    kind = docs.schema[id_column].dataType.simpleString()
    return whole.mapInArrow(frugal(scorer(shared, id_column)), f"`{id_column}` {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")
