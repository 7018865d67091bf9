"""Benchmark decontamination with suffix arrays of the training text.

The documents are cut into shards, each shard's words are numbered by the
benchmark's vocabulary (0: not in it), and the shard's suffixes that begin with
a benchmark word are sorted by their first `window` words or more. Every
suffix of the benchmark that is a window long is binary-searched in every shard
(those that begin with the same window at once): the range of the shard's
suffixes that begin with its next `window` words are the places where it
occurs. A place's longest verbatim match is with one of its neighbours in the
sorted suffixes of the benchmark, which a second binary search finds. Suffixes
that begin with other words can't match and aren't sorted.

A shard is a few MB of text within one task, so nothing is shuffled and a
document's rows never meet. The benchmark is sent to the tasks in blocks of
bounded size (`block_bytes`); the driver and a task hold one block at a time.

Defined results: a null text has no words; an item without words matches
nothing; an item of fewer words than a window is one window; repeated items
count by id; a null item id is written as an empty string; an empty benchmark
leaves all documents clean; documents with null or repeated ids are looked at
row by row; an empty table gives an empty result; other columns, whatever their
names, are untouched, and not read unless `keep` is set.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import frugal, small_batches
from .textvec import WORD_ALNUM, TextSlice, Words, find_words, text_slices, word_hashes

WINDOW = 10
BLOCK_BYTES = 16 << 20
SHARD_BYTES = 2 << 20


class Benchmark:
    """One block of items, as numbers of their own vocabulary."""

    def __init__(self, ids: list[str], texts: list[str | None], window: int = WINDOW):
        self.window, self.ids = window, ids
        parts = [(p, w, word_hashes(p, w)) for p in text_slices(pa.array(texts, pa.string())) for w in [find_words(p, WORD_ALNUM)]]
        hashes = [h[a:b] for _, w, h in parts for a, b in zip(w.bounds[:-1], w.bounds[1:], strict=True)]
        self.vocabulary = np.unique(np.concatenate(hashes)) if hashes else np.zeros(0, dtype=np.uint64)
        self.items = [np.searchsorted(self.vocabulary, h) + 1 for h in hashes]
        self.bits = max(1, int(len(self.vocabulary)).bit_length())
        self.per_key = max(1, min(window, 62 // self.bits))  # the key past the last one fits too
        #: The whole text with a 0 after each item, and the suffixes in order: compared as words up to the item's end.
        self.flat = np.concatenate([np.append(item, 0) for item in self.items]) if self.items else np.zeros(0, dtype=np.int64)
        ends = np.cumsum([len(item) + 1 for item in self.items]) if self.items else np.zeros(0, dtype=np.int64)
        self.item_of = np.repeat(np.arange(len(self.items)), np.diff(ends, prepend=0))
        self.end = ends[self.item_of] - 1 if len(ends) else ends
        self.order = _suffix_order(self.flat)
        #: distinct windows: (words) -> their suffixes' places in `order`, first and past
        self.windows: dict[tuple, tuple[int, int]] = {}
        short: dict[tuple, list[int]] = {}  # items of fewer words than a window: they match wherever they stand
        for at, where in enumerate(self.order.tolist()):
            if self.end[where] - where >= window:
                words = tuple(self.flat[where : where + window].tolist())
                self.windows[words] = (self.windows.get(words, (at,))[0], at + 1)
        for k, item in enumerate(self.items):
            if 0 < len(item) < window:
                short.setdefault(tuple(item.tolist()), []).append(k)
        #: window -> the items that hold it
        self.owners = {words: np.unique(self.item_of[self.order[a:b]]) for words, (a, b) in self.windows.items()}
        self.owners |= {words: np.array(items) for words, items in short.items()}
        self.searched = list(self.owners)
        self.first_key = np.array([self._key(w, 0)[0] for w in self.searched], dtype=np.int64)
        self.first_past = np.array([self._key(w, 0)[1] for w in self.searched], dtype=np.int64)

    def longest(self, words: tuple, text: np.ndarray, place: int) -> tuple[int, int]:
        """(length, item) of the longest match of the text from this place on, which begins with these words."""
        if words not in self.windows:
            return len(words), int(self.owners[words][0])
        low, high = self.windows[words]
        best = (0, 0)
        while low < high:  # towards the suffix that follows the text's in order; the longest match is met on the way or beside it
            middle = (low + high) // 2
            where = int(self.order[middle])
            n = min(int(self.end[where]) - where, len(text) - place)
            differs = np.flatnonzero(self.flat[where : where + n] != text[place : place + n])
            same = int(differs[0]) if len(differs) else n
            best = max(best, (same, -int(self.item_of[where])))
            if same == int(self.end[where]) - where or same < n and self.flat[where + same] < text[place + same]:
                low = middle + 1
            else:
                high = middle
        return best[0], -best[1]

    def _key(self, words: tuple, level: int) -> tuple[int, int]:
        """The least key of suffixes that begin with these words, and the first one beyond, at a level."""
        own = words[level * self.per_key : (level + 1) * self.per_key]
        key = 0
        for j in range(self.per_key):
            key = key << self.bits | (own[j] if j < len(own) else 0)
        return key, key + (1 << self.bits * (self.per_key - len(own)))


class SuffixArray:
    """A shard's suffixes in order of their first words."""

    def __init__(self, numbers: np.ndarray, benchmark: Benchmark):
        self.numbers, self.b = numbers, benchmark
        per, bits, n = benchmark.per_key, benchmark.bits, len(numbers)
        levels = -(-benchmark.window // per)
        padded = np.concatenate([numbers, np.zeros(levels * per + 1, dtype=np.int64)])
        key = np.zeros(n + (levels - 1) * per, dtype=np.int64)
        for j in range(per):
            key = key << bits | padded[j : j + len(key)]
        place = np.flatnonzero(numbers)
        place = place[np.argsort(key[place], kind="stable")]
        tied = key[place]
        for level in range(1, levels):  # only suffixes that are still tied are sorted further
            same = tied[1:] == tied[:-1]
            member = np.flatnonzero(np.concatenate([[False], same]) | np.concatenate([same, [False]]))
            if not len(member):
                break
            group, nxt = tied[member], key[place[member] + level * per]
            order = np.lexsort((nxt, group))
            place[member] = place[member][order]
            change = np.concatenate([[True], (group[order][1:] != group[order][:-1]) | (nxt[order][1:] != nxt[order][:-1])])
            tied = np.full(len(place), -1, dtype=np.int64)
            tied[member] = np.cumsum(change)
            alone = tied < 0
            tied[alone] = -1 - np.flatnonzero(alone)
        self.place, self.key, self.keys = place, key, key[place]

    def occurrences(self) -> Iterator[tuple[tuple, np.ndarray]]:
        """(window, the places where it occurs) of every window that does."""
        lows = np.searchsorted(self.keys, self.b.first_key, side="left")
        highs = np.searchsorted(self.keys, self.b.first_past, side="left")
        for k in np.flatnonzero(highs > lows).tolist():
            low, high, words = lows[k], highs[k], self.b.searched[k]
            for level in range(1, -(-len(words) // self.b.per_key)):
                below = self.key[self.place[low:high] + level * self.b.per_key]
                a, b = np.searchsorted(below, self.b._key(words, level))
                low, high = low + a, low + b
                if low >= high:
                    break
            if low < high:
                yield words, self.place[low:high]


def _suffix_order(flat: np.ndarray) -> np.ndarray:
    """The suffixes' places in order, each compared up to its item's end (the next 0). By doubling: ranks of 1, 2, 4 ... words."""
    n = len(flat)
    rank = np.unique(flat, return_inverse=True)[1] if n else flat
    zero = np.flatnonzero(flat == 0)
    end = zero[np.searchsorted(zero, np.arange(n))] if n else zero
    size = 1
    while n:
        past = np.arange(n) + size
        after = np.where(past <= end, rank[np.minimum(past, n - 1)], -1)  # beyond the item's end nothing follows
        order = np.lexsort((after, rank))
        change = (rank[order][1:] != rank[order][:-1]) | (after[order][1:] != after[order][:-1])
        new = np.empty(n, dtype=np.int64)
        new[order] = np.concatenate([[0], np.cumsum(change)])
        if new.max() == rank.max() or 2 * size > n:
            return order[flat[order] > 0]
        rank, size = new, 2 * size
    return np.zeros(0, dtype=np.int64)


def _numbered(benchmark: Benchmark, words: Words, hashes: np.ndarray) -> tuple:
    """Per document of the slice: its words, the place of the first one; and the slice's suffix array."""
    at = np.minimum(np.searchsorted(benchmark.vocabulary, hashes), max(0, len(benchmark.vocabulary) - 1))
    known = benchmark.vocabulary[at] == hashes if len(benchmark.vocabulary) else np.zeros(len(hashes), dtype=bool)
    counts = np.diff(words.bounds)
    begin = words.bounds[:-1] + np.arange(len(counts))  # a 0 stands after each document
    numbers = np.zeros(len(hashes) + len(counts), dtype=np.int64)
    numbers[np.arange(len(hashes)) + words.doc_of()] = np.where(known, at + 1, 0)
    return counts, begin, SuffixArray(numbers, benchmark)


def _matches(array: SuffixArray, begin: np.ndarray) -> tuple[np.ndarray, dict[int, np.ndarray], dict[int, tuple[int, int, int]]]:
    """Hit words, items by document, and (length, item, word offset) of each document's longest match."""
    steps = np.zeros(len(array.numbers) + 1, dtype=np.int64)
    owners: dict[int, list[np.ndarray]] = {}
    longest: dict[int, tuple[int, int, int]] = {}
    for words, places in array.occurrences():
        np.add.at(steps, places, 1)
        np.add.at(steps, places + len(words), -1)
        docs = np.searchsorted(begin, places, side="right") - 1
        for d in np.unique(docs).tolist():
            owners.setdefault(d, []).append(array.b.owners[words])
        for d, p in zip(docs.tolist(), places.tolist(), strict=True):
            n, item = array.b.longest(words, array.numbers, p)
            longest[d] = max(longest.get(d, (0, 0, 0)), (n, -item, -(p - int(begin[d]))))
    return np.cumsum(steps[:-1]) > 0, {d: np.unique(np.concatenate(x)) for d, x in owners.items()}, {d: (n, -k, -a) for d, (n, k, a) in longest.items()}


def benchmark_blocks(benchmark: DataFrame, id_column: str = "item_id", text_column: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> Iterator[Benchmark]:
    """The items in blocks of about `block_bytes`; one block is on the driver at a time."""
    size = benchmark.agg(F.sum(F.octet_length(text_column))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    for k in range(blocks):
        rows = benchmark.where(F.pmod(F.xxhash64(id_column, text_column), F.lit(blocks)) == k).select(F.col(id_column).cast("string").alias("id"), F.col(text_column).alias("text")).collect()
        yield Benchmark([r.id or "" for r in rows], [r.text for r in rows], window)


def _let_go(block: Broadcast) -> None:
    """This process forgets the block's content; its next use reads it from the executor's copy again."""
    if getattr(block, "_path", None) and hasattr(block, "_value"):
        del block._value


def find_contamination(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id", window: int = WINDOW, block_bytes: int = BLOCK_BYTES, keep: bool = False) -> DataFrame:
    """One row per document: id, n_words, n_hit, n_items, items_sha256, contaminated, longest_match, match_item, match_at.

    keep: only documents without a hit, with the columns of `docs` instead.
    """
    context = docs.sparkSession.sparkContext
    blocks = [context.broadcast(b) for b in benchmark_blocks(benchmark, item_column, "text", window, block_bytes)]

    def look(part: TextSlice) -> tuple:
        hit, found, best, counts, begin = None, {}, {}, None, None
        words = find_words(part, WORD_ALNUM)
        hashes = word_hashes(part, words)
        for block in blocks:
            counts, begin, array = _numbered(block.value, words, hashes)
            marks, items, longest = _matches(array, begin)
            hit = marks if hit is None else hit | marks
            for d, own in items.items():
                found.setdefault(d, set()).update(block.value.ids[i] for i in own.tolist())
            for d, (n, i, a) in longest.items():
                if n > best.get(d, (0, "", 0))[0]:
                    best[d] = n, block.value.ids[i], a
            if len(blocks) > 1:
                _let_go(block)
        total = np.concatenate([[0], np.cumsum(hit)])
        return counts, total[begin + counts] - total[begin], found, best

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = hashlib.sha256(b"").hexdigest()
        for batch in batches:
            for part in text_slices(batch.column(0), SHARD_BYTES):
                counts, hits, found, best = look(part)
                n = len(part)
                items = [sorted(found.get(d, ())) for d in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(1).slice(part.first, n), pa.array(counts, pa.int64()), pa.array(hits, pa.int64()), pa.array([len(x) for x in items], pa.int64()),
                        pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() if x else none for x in items], pa.string()), pa.array(hits > 0),
                        pa.array([best.get(d, (0,))[0] for d in range(n)], pa.int64()), pa.array([best[d][1] if d in best else None for d in range(n)], pa.string()), pa.array([best[d][2] if d in best else None for d in range(n)], pa.int64()),
                    ],
                    names=[id_column, *(c.split()[0] for c in found_columns.split(", "))],
                )

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch.column(position), SHARD_BYTES):
                hits = look(part)[1]
                if (hits == 0).any():
                    yield batch.slice(part.first, len(part)).filter(pa.array(hits == 0))

    found_columns = "n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean, longest_match bigint, match_item string, match_at bigint"
    position = docs.columns.index(text_column)
    if keep:
        return small_batches(docs).mapInArrow(frugal(clean), docs.schema)
    kind = docs.schema[id_column].dataType.simpleString()
    return small_batches(docs).select(text_column, id_column).mapInArrow(frugal(report), f"`{id_column}` {kind}, {found_columns}")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_column: str = "text", window: int = WINDOW) -> DataFrame:
    """The documents that hold no window of any item, all columns."""
    return find_contamination(docs, benchmark, text_column=text_column, window=window, keep=True)
