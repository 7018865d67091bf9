"""Near-duplicate documents by T-occurrence search over word shingles.

Two documents link when their sets of k-word shingles have a Jaccard
similarity of `percent` / 100 or more; documents that links connect are one
component. The join is exact as far as 64-bit hashes tell words, shingles and
whole sets apart.

1. It is counted in how many documents each shingle is, by 40 bits of its hash:
   chunks of text send their sets' sorted shingles to the parts of the hash
   range, and get back those that are in more than one set, with their counts.
   That defines one global order of shingles, rare ones first. Any fixed order
   gives right results; this one keeps passages that many documents share out
   of the prefixes, and knows the shingles of a single set, which link nothing.
   The counts are exact at any size, and no table of them is gathered anywhere.
2. Documents with equal sets become one. Two linked sets of which the smaller
   has n shingles share one among the first n - ceil(t n) + 1 of either in the
   global order, so sets that share no such prefix shingle can't link. Most sets
   have that many shingles of their own and are settled. Shared prefix shingles
   give candidate edges: a star for each shingle, not all its
   pairs. Tasks merge their own sets' postings first, so a shingle of a third
   of all rows sends one row a task.
3. Connected candidates form buckets (a distributed component search over
   ids); no link crosses buckets. The whole sets of bucketed documents are
   brought together by bucket.
4. In a bucket the links are found breadth first. Each set reached is a query
   against an inverted index of the sets not reached yet: the short lists are
   merged by a heap that skips what too few of them hold, the survivors are
   probed in the long lists by binary search (DivideSkip), and sets with the required overlap are retained, reached, and
   taken out of the index. So a family of near copies is reached by its first
   member, without its pairs.
   Buckets of more than `bucket_sets` sets are first cut finer by the candidates
   of another order, made from the counts of their sets only (no link crosses
   these buckets either). What stays larger is split: sets are compared with a
   pivot, in parallel; Jaccard distance is a metric, so sets far enough from
   the pivot can't link to those near it, and each part goes on by itself.
   What is still larger after that is cut into blocks of sets, and each pair of
   its blocks is searched by itself. So no task holds more than a bucket's
   bound, and every link is found.

Defined results: null, empty and blank texts have no shingles and stand alone;
a text of fewer than k words has its whole sequence as one shingle; repeated
rows share a set; null ids are ignored as component ids unless there is no
other; rows that share an id are one document to drop_near_copies(), which
keeps or drops all of them; an empty table gives an empty result; other
columns, whatever their names, are not read.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from hashlib import blake2b
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import durable, forget, frugal, opened, release, sealed, small_batches, squeezed, steps, unsealed
from .components import connected_components
from .textvec import WORD_NOT_SPACE, find_words, mix64, shingle_sets, text_slices, word_hashes

SHINGLE, PERCENT = 4, 85
#: Bits of a shingle's hash by which it is counted: two that fall together count as more frequent. With its set's number in the chunk they make 64 bits.
KEY_BITS, SET_BITS = 40, 24
#: Bytes of text whose sets are sent as one chunk, and the parts of the hash range: at least so many.
CHUNK_BYTES, PARTS = 16 << 20, 256
#: Candidate sets whose ids are broadcast (24 bytes each, 48 MB in all); beyond, they are joined by a shuffle.
BROADCAST_SETS = 2_000_000
BUCKET_SETS = 256
#: Sets of more copies than this, and than a part of all rows, are dealt over SALTS tasks when rows learn their component.
SALTS, MANY_COPIES, MANY_SHARE = 16, 1024, 10_000
#: Bits of shingles and sets in the search for candidates: two that fall together make a bucket larger, never a link.
NODE = (1 << 48) - 1
#: Rounds that cut large buckets finer.
REFINEMENTS = 2
#: Rounds that split large buckets by pivots. A round of either kind that settles less than this share of the sets is the last one of its kind.
PIVOTS, WORTH = 6, 0.2
#: DivideSkip's balance between merging short lists and probing long ones.
MU = 0.01


def required(n: int, percent: int) -> int:
    """The least overlap of a set of n with any set that links to it."""
    return -(-percent * n // 100)


def prefix_size(n: int, percent: int) -> int:
    return n - required(n, percent) + 1 if n else 0


def fingerprint(shingles: np.ndarray) -> int:
    return int.from_bytes(blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def document_sets(column: pa.Array, k: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(first row, the sets of the rows from there on)."""
    for part in text_slices(column):
        words = find_words(part, WORD_NOT_SPACE)
        yield part.first, shingle_sets(part, words, word_hashes(part, words), k)


#: Kinds of rows: a chunk's shingles in a part of the hash range, those of them that other sets have too, its documents.
ASKED, SHARED, DOCS = range(3)
COUNTED = "kind int, part int, chunk bigint, blob binary"


def _counted(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int32(), pa.int32(), pa.int64(), pa.binary()), strict=True)], names=["kind", "part", "chunk", "blob"])


def prefixes(docs: DataFrame, id_column: str, text_column: str, k: int, percent: int, bits: int = KEY_BITS, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(id, n, set, prefix) of every document: its set's size, fingerprint, and those of its first shingles in the global order that other sets have too."""
    partitions = _partitions(docs)
    parts = max(PARTS, partitions)
    bounds = [(i << bits) // parts for i in range(parts + 1)]  # less than 2**32 apart

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 24
        known: dict[int, int] = {}
        sets, rows, size = [], [], 0
        for batch in batches:
            for first, found in document_sets(batch.column(0), k):
                names = [fingerprint(s) if len(s) else None for s in found]
                for f, s in zip(names, found, strict=True):
                    if f is not None and f not in known:
                        known[f] = len(sets)
                        sets.append(mix64(s) >> np.uint64(64 - bits))
                        size += 8 * len(s)
                ids = batch.column(1).slice(first, len(found))
                rows.append(pa.RecordBatch.from_arrays([ids, pa.array([len(s) for s in found], pa.int64()), pa.array(names, pa.int64()), pa.array([-1 if f is None else known[f] for f in names], pa.int32())], names=["id", "n", "set", "at"]))
                size += 16 * len(found)
                if size > chunk_bytes:
                    yield packed(chunk, sets, rows)
                    chunk, known, sets, rows, size = chunk + 1, {}, [], [], 0
        if rows:
            yield packed(chunk, sets, rows)

    def packed(chunk: int, sets: list[np.ndarray], rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        out = [(DOCS, int(mix64(np.array([chunk], dtype=np.uint64))[0]) % parts, chunk, sealed(pa.Table.from_batches(rows).combine_chunks().to_batches()[0]))]
        both = np.concatenate([np.zeros(0, np.uint64), *sets]) << np.uint64(SET_BITS)
        both |= np.repeat(np.arange(len(sets), dtype=np.uint64), [len(s) for s in sets])
        both.sort()
        keys, owners = both >> np.uint64(SET_BITS), (both & np.uint64((1 << SET_BITS) - 1)).astype(np.uint32)
        edges = np.searchsorted(keys, np.array(bounds, dtype=np.uint64)).tolist()
        out += [(ASKED, i, chunk, squeezed(_offsets(keys[a:b], bounds[i]), owners[a:b])) for i, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)) if b > a]
        return _counted(out)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, asked = None, []
        for batch in batches:
            for kind, part, chunk, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if part != last and asked:
                    yield from shared(last, asked)
                    asked = []
                last = part
                if kind == DOCS:
                    yield _counted([(kind, part, chunk, blob)])
                else:
                    keys, owners = opened(blob)
                    asked.append((chunk, np.cumsum(keys, dtype=np.uint64), owners))
        if asked:
            yield from shared(last, asked)

    def shared(part: int, asked: list[tuple[int, np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        every = np.concatenate([keys for _, keys, _ in asked])
        every.sort()
        first = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
        count = np.diff(np.append(first, len(every)))
        several = count > 1
        kinds, count = every[first[several]], np.minimum(count[several], (1 << 32) - 1).astype(np.uint32)
        del every, first, several
        if not len(kinds):
            return
        for chunk, keys, owners in asked:
            at = np.minimum(np.searchsorted(kinds, keys), len(kinds) - 1)
            own = kinds[at] == keys
            if own.any():
                yield _counted([(SHARED, part, chunk, squeezed(_offsets(keys[own], 0), owners[own], count[at[own]]))])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, found = None, []
        for batch in batches:
            for kind, part, chunk, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if chunk != last:
                    last, found = chunk, []
                if kind == SHARED:
                    keys, owners, count = opened(blob)
                    found.append((np.cumsum(keys, dtype=np.uint64) + np.uint64(bounds[part]), owners, count))
                else:  # the last row of its chunk
                    yield first_of(unsealed(blob), found)

    def first_of(rows: pa.RecordBatch, found: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        at = rows.column(3).to_numpy()
        n = np.zeros(int(at.max(initial=-1)) + 1, dtype=np.int64)
        n[at[at >= 0]] = rows.column(1).to_numpy()[at >= 0]
        keys, owners, count = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.uint64), np.zeros(0, np.uint32), np.zeros(0, np.uint32))
        # a set's own shingles come first; the prefix has room for so many of the others
        room = n + (-percent * n // 100) + 1 - (n - np.bincount(owners, minlength=len(n)))
        some = room[owners] > 0
        keys, owners, count = keys[some], owners[some], count[some]
        order = np.lexsort((keys, count, owners))
        keys, owners = keys[order], owners[order]
        place = np.arange(len(owners)) - np.searchsorted(owners, owners)
        taken = place < room[owners]
        keys, owners = (keys[taken] << np.uint64(NODE.bit_length() - bits)).view(np.int64), owners[taken]
        ends = np.concatenate([[0], np.cumsum(np.bincount(owners, minlength=len(n)))]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(keys))
        return pa.RecordBatch.from_arrays([*rows.columns[:3], lists.take(pa.array(at, mask=at < 0))], names=["id", "n", "set", "prefix"])

    kind = docs.schema[id_column].dataType.simpleString()
    asked = docs.select(text_column, id_column).mapInArrow(frugal(ask), COUNTED)
    answered = asked.repartition(partitions, "part").sortWithinPartitions("part").mapInArrow(frugal(answer), COUNTED)
    return answered.repartition(partitions, "chunk").sortWithinPartitions("chunk", "kind").mapInArrow(frugal(cut), f"id {kind}, n bigint, set bigint, prefix array<bigint>")


def _offsets(keys: np.ndarray, base: int) -> np.ndarray:
    """Sorted keys of one part as steps from its begin."""
    return steps(keys - np.uint64(base)).astype(np.uint32)


def node_of(name: Column) -> Column:
    return name.bitwiseAND(F.lit(NODE))


def candidate_edges(sets: DataFrame, block: int = 600_000) -> DataFrame:
    """(u, v) of nodes: a connected graph over the sets that share a prefix shingle. sets: (set, prefix); equal rows fall together within each task."""
    partitions = int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def stars(shingles: np.ndarray, heads: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The distinct shingles, the least head of each one, and edges from it to the others."""
        order = np.lexsort((heads, shingles))
        s, h = shingles[order], heads[order]
        new = np.concatenate([[True], s[1:] != s[:-1]]) if len(s) else np.zeros(0, dtype=bool)
        first = np.flatnonzero(new)
        head = h[first][np.cumsum(new) - 1]
        edge = np.unique(np.stack([head[~new], h[~new]], axis=1), axis=0)
        edge = edge[edge[:, 0] != edge[:, 1]]
        return s[first], h[first], edge[:, 0], edge[:, 1]

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        part, postings, u, v = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(postings, pa.binary()), pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["part", "postings", "u", "v"])

    def own(shingles: list[np.ndarray], heads: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        s, h, u, v = stars(np.concatenate(shingles), np.concatenate(heads))
        edges = np.searchsorted(s, (np.arange(1, partitions) * (NODE + 1)) // partitions)  # shingles are hashes: parts are even
        bounds = [0, *edges.tolist(), len(s)]
        out = [(k, squeezed(steps(s[a:b]), h[a:b]), None, None) for k, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)) if b > a]
        yield packed(out + [(int(x) % partitions, None, int(x), int(y)) for x, y in zip(u.tolist(), v.tolist(), strict=True)])

    def postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, heads, size = [], [], 0
        for batch in batches:
            column = batch.column(1)
            lengths = np.diff(column.offsets.to_numpy())
            shingles.append(column.flatten().to_numpy() & NODE)
            heads.append(np.repeat(batch.column(0).to_numpy() & NODE, lengths))
            size += len(heads[-1])
            if size > block:
                yield from own(shingles, heads)
                shingles, heads, size = [], [], 0
        if size:
            yield from own(shingles, heads)

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, keys, heads = None, [], []
        for batch in batches:
            known = batch.column(2).is_valid()
            yield pa.RecordBatch.from_arrays([batch.column(2).filter(known), batch.column(3).filter(known)], names=["u", "v"])
            for part, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if blob is None:
                    continue
                if part != last and keys:
                    yield edges_of(keys, heads)
                    keys, heads = [], []
                last = part
                s, h = opened(blob)
                keys.append(np.cumsum(s))
                heads.append(h)
                if sum(map(len, keys)) > 2 * block:  # what is settled leaves one head a shingle
                    s, h, u, v = stars(np.concatenate(keys), np.concatenate(heads))
                    yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])
                    keys, heads = [s], [h]
        if keys:
            yield edges_of(keys, heads)

    def edges_of(keys: list[np.ndarray], heads: list[np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in stars(np.concatenate(keys), np.concatenate(heads))[2:]], names=["u", "v"])

    made = sets.select("set", "prefix").mapInArrow(frugal(postings), "part int, postings binary, u bigint, v bigint")
    return made.repartition(partitions, "part").sortWithinPartitions("part").mapInArrow(frugal(link), "u bigint, v bigint").where("u != v").distinct()


def heap_merge(lists: list[list[int]], least: int) -> Iterator[tuple[int, int]]:
    """(number, in how many of the sorted lists it is) of every number that `least` lists or more hold. What fewer can hold is skipped."""
    at = [0] * len(lists)
    heap = [(own[0], i) for i, own in enumerate(lists) if own]
    heapify(heap)

    def go_on(popped: list[int], to: int) -> None:
        for i in popped:
            at[i] = bisect_left(lists[i], to, at[i])
            if at[i] < len(lists[i]):
                heappush(heap, (lists[i][at[i]], i))

    while len(heap) >= least:
        top, popped = heap[0][0], []
        while heap and heap[0][0] == top:
            popped.append(heappop(heap)[1])
        if len(popped) >= least:
            yield top, len(popped)
            go_on(popped, top + 1)
            continue
        while heap and len(popped) < least - 1:
            popped.append(heappop(heap)[1])
        if not heap:
            return  # fewer than `least` lists are left
        go_on(popped, heap[0][0])


class Index:
    """Inverted lists over sets of one bucket. Shingles of a single set are left out: they are in no overlap."""

    def __init__(self, sets: list[np.ndarray], percent: int):
        self.percent = percent
        self.size = np.array([len(s) for s in sets], dtype=np.int64)
        flat = np.concatenate(sets) if sets else np.zeros(0, dtype=np.uint64)
        kinds, number, count = np.unique(flat, return_inverse=True, return_counts=True)
        owner = np.repeat(np.arange(len(sets)), self.size)
        keep = count[number] > 1
        self.tokens = [t.copy() for t in np.split(number[keep], np.cumsum(np.bincount(owner[keep], minlength=len(sets)))[:-1])] if sets else []
        order = np.argsort(number[keep], kind="stable")
        self.lists = owner[keep][order]
        self.at = np.concatenate([[0], np.cumsum(np.bincount(number[keep], minlength=len(kinds)))])
        self.live = np.ones(len(sets), dtype=bool)

    def drop(self, gone: np.ndarray) -> None:
        """Takes sets out; the lists are rebuilt when half of their entries are out."""
        self.live[gone] = False
        entries = self.live[self.lists]
        if entries.sum() * 2 < len(self.lists):
            number = np.repeat(np.arange(len(self.at) - 1), np.diff(self.at))[entries]
            self.lists = self.lists[entries]
            self.at = np.concatenate([[0], np.cumsum(np.bincount(number, minlength=len(self.at) - 1))])

    def search(self, q: int) -> np.ndarray:
        """The live sets that link to set q."""
        tokens, n = self.tokens[q], int(self.size[q])
        need = required(n, self.percent)
        length = self.at[tokens + 1] - self.at[tokens]
        tokens, length = tokens[length > 0], length[length > 0]
        if len(tokens) < need:
            return np.zeros(0, dtype=np.int64)
        order = np.argsort(length, kind="stable")
        longest = int(length[order[-1]])
        long_lists = min(need - 1, int(need / (MU * np.log2(longest + 1) + 1)))
        short, long = tokens[order[: len(order) - long_lists]], tokens[order[len(order) - long_lists :]]
        merged = [x for x in heap_merge([self.lists[self.at[t] : self.at[t + 1]].tolist() for t in short.tolist()], need - long_lists)]
        if not merged:
            return np.zeros(0, dtype=np.int64)
        found, seen = (np.array(x, dtype=np.int64) for x in zip(*merged, strict=True))
        # overlap o links if 100 o >= percent (n + m - o)
        least = -(-self.percent * (n + self.size[found]) // (100 + self.percent))
        ok = self.live[found] & (seen + long_lists >= least) & (least <= np.minimum(n, self.size[found]))
        found, seen, least = found[ok], seen[ok], least[ok]
        for left, t in zip(range(len(long) - 1, -1, -1), long.tolist(), strict=True):
            if not len(found):
                break
            own = self.lists[self.at[t] : self.at[t + 1]]
            at = np.minimum(np.searchsorted(own, found), len(own) - 1)
            seen = seen + (own[at] == found)
            ok = seen + left >= least
            found, seen, least = found[ok], seen[ok], least[ok]
        return found[seen >= least]


def link_components(sets: list[np.ndarray], percent: int = PERCENT) -> np.ndarray:
    """Each set's component, as the number of its first set."""
    index = Index(sets, percent)
    label = np.full(len(sets), -1, dtype=np.int64)
    for start in range(len(sets)):
        if label[start] >= 0:
            continue
        label[start] = start
        index.drop(np.array([start]))
        queue = [start]
        while queue:
            found = index.search(queue.pop())
            if len(found):
                label[found] = start
                index.drop(found)
                queue.extend(found.tolist())
    return label


def _similar(shingles: np.ndarray, pivot: np.ndarray) -> tuple[int, int]:
    both = len(np.intersect1d(shingles, pivot, assume_unique=True))
    return both, len(shingles) + len(pivot) - both


def _bucketed_sets(docs: DataFrame, id_column: str, text_column: str, members: DataFrame, k: int, broadcast_sets: int) -> DataFrame:
    """(bucket, set, shingles) of the sets in `members` (set, id, bucket); each from the document of that id."""
    count = members.count()
    spark = docs.sparkSession
    if count <= broadcast_sets:
        rows = members.select("set", "bucket", F.xxhash64("id").alias("id")).toArrow()
        order = np.argsort(rows["set"].to_numpy())
        shared = spark.sparkContext.broadcast([rows[c].to_numpy()[order] for c in ("set", "bucket", "id")])

        def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known, bucket, owner = shared.value
            names = np.sort(owner)
            for batch in batches:
                ids = batch.column(1).to_numpy()
                at = np.minimum(np.searchsorted(names, ids), max(0, len(names) - 1))
                own = pa.array(names[at] == ids if len(names) else np.zeros(len(ids), dtype=bool))
                part = batch.filter(own)
                ids = part.column(1).to_numpy()
                for first, sets in document_sets(part.column(0), k):
                    out = []
                    for j, s in enumerate(sets):
                        f = fingerprint(s)
                        a = int(np.searchsorted(known, f))
                        if a < len(known) and known[a] == f and owner[a] == ids[first + j]:
                            out.append((int(bucket[a]), f, s.view(np.int64)))
                    if out:
                        b, f, s = zip(*out, strict=True)
                        yield pa.RecordBatch.from_arrays([pa.array(b, pa.int64()), pa.array(f, pa.int64()), pa.array(s, pa.list_(pa.int64()))], names=["bucket", "set", "shingles"])

        return docs.select(text_column, F.xxhash64(id_column)).mapInArrow(frugal(pick), "bucket bigint, set bigint, shingles array<bigint>")
    joined = docs.select(F.col(text_column).alias("text"), F.xxhash64(id_column).alias("id")).join(members.select("set", "bucket", F.xxhash64("id").alias("id")), "id")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            want, bucket = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            for first, sets in document_sets(batch.column(0), k):
                out = [(bucket[first + j], f, s.view(np.int64)) for j, s in enumerate(sets) if (f := fingerprint(s)) == want[first + j]]
                if out:
                    b, f, s = zip(*out, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(b, pa.int64()), pa.array(f, pa.int64()), pa.array(s, pa.list_(pa.int64()))], names=["bucket", "set", "shingles"])

    return joined.select("text", "set", "bucket").mapInArrow(frugal(cut), "bucket bigint, set bigint, shingles array<bigint>")


def _refined(docs: DataFrame, id_column: str, text_column: str, members: DataFrame, k: int, percent: int, bucket_sets: int, broadcast_sets: int, bits: int) -> DataFrame:
    """members (set, id, n, bucket) with buckets of more than `bucket_sets` sets cut finer, by other orders of shingles.

    Linked sets share a prefix shingle in every order. A round counts the
    shingles of the sets of large buckets and of no others, so that what is rare
    among them leads; sets that then share no prefix shingle with another are
    settled, and sets go on together if they were together before and still are.
    """
    last = None
    for turn in range(REFINEMENTS):
        large = durable(members.groupBy("bucket").agg(F.count(F.lit(1)).alias("sets")).where(F.col("sets") > bucket_sets))
        sets = large.agg(F.sum("sets")).first()[0]
        if not sets or last and sets > (1 - WORTH) * last:
            break
        last = sets
        marked = members.join(F.broadcast(large.select("bucket", F.lit(True).alias("large"))), "bucket", "left")  # at most (sets / bucket_sets) rows
        settled, own = marked.where("large is null").drop("large"), durable(marked.where("large").drop("large"))
        ids = own.select(F.col("id").alias("_id")).distinct()
        theirs = docs.select(id_column, text_column).join(F.broadcast(ids) if sets <= broadcast_sets else ids, F.col(id_column).eqNullSafe(F.col("_id")), "left_semi")
        leads = durable(prefixes(theirs, id_column, text_column, k, percent, bits).where("size(prefix) > 0").select("set", "prefix"))
        release(docs.sparkSession)
        parts = connected_components(candidate_edges(leads))
        finer = own.join(parts, node_of(F.col("set")) == F.col("node")).withColumn("bucket", F.xxhash64("bucket", "component", F.lit(turn)))
        before, members = members, durable(settled.select("set", "id", "n", "bucket").unionAll(finer.select("set", "id", "n", "bucket")).coalesce(_partitions(docs)))
        forget(before, own, leads, large)
        del before, own, finer, parts, leads, theirs, ids, large
        release(docs.sparkSession)
    return members


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _split_large(sets: DataFrame, percent: int, bucket_sets: int, most: int = PIVOTS) -> tuple[DataFrame, DataFrame]:
    """(edges between sets, sets that are left), after splitting buckets of more than `bucket_sets` sets.

    A large bucket's pivot is its smallest fingerprint. Its sets fall into: near
    (they link to the pivot, so they are one component), and the rest. Sets of
    the rest whose distance from the pivot is at most twice the limit may link
    to near ones: they go on with the rest, and are also searched, in blocks of
    bounded size, against the near ones that are close enough. All others are
    settled by the triangle inequality.
    """
    edges = sets.select(F.col("set").alias("u"), F.col("set").alias("v")).where("false")
    last = None
    for _ in range(most):
        large = durable(sets.groupBy("bucket").agg(F.count_distinct("set").alias("n"), F.min("set").alias("pivot")).where(F.col("n") > bucket_sets))
        left = large.agg(F.sum("n")).first()[0]
        if not left or last and left > (1 - WORTH) * last:
            break
        last = left
        # one pivot a large bucket: at most (sets / bucket_sets) rows
        pivots = durable(sets.join(F.broadcast(large.select("bucket", F.col("pivot").alias("set"))), ["bucket", "set"]).dropDuplicates(["bucket", "set"]).select("bucket", F.col("set").alias("pivot"), F.col("shingles").alias("pivot_shingles")))
        hot = sets.join(F.broadcast(pivots), "bucket", "left")
        both = F.size(F.array_intersect("shingles", "pivot_shingles"))
        hot = hot.withColumn("both", both).withColumn("all", F.size("shingles") + F.size("pivot_shingles") - F.col("both")).drop("pivot_shingles")
        is_near = F.coalesce(F.col("both") * 100 >= F.col("all") * percent, F.lit(False))
        away = F.col("all") - F.col("both")  # distance = away / all
        shell = F.col("pivot").isNotNull() & ~F.col("near") & (F.col("both") * 100 >= F.col("all") * (2 * percent - 100))
        hot = durable(hot.withColumn("near", F.col("pivot").isNotNull() & is_near).withColumn("away", away / F.col("all")))
        forget(sets, pivots, large)  # what is next written finds one other copy of the sets on disk
        near = hot.where("near")
        # a near set can link to a shell set only if its distance is at least the shell's nearest distance less the limit
        closest = hot.where(shell).groupBy("bucket").agg(F.min("away").alias("least"))
        outer = near.join(F.broadcast(closest), "bucket").where(F.col("away") + (100 - percent) / 100 + 1e-9 >= F.col("least"))
        crossing = _cross_links(outer.select("bucket", "set", "shingles"), hot.where(shell).select("bucket", "set", "shingles"), percent, bucket_sets)
        found = near.select(F.col("pivot").alias("u"), F.col("set").alias("v")).where("u != v").unionAll(crossing)
        edges = durable(edges.unionAll(found).coalesce(_partitions(sets)))
        sets = durable(hot.where(~F.col("near")).select(F.when(F.col("pivot").isNull(), F.col("bucket")).otherwise(F.xxhash64("bucket", F.lit(1))).alias("bucket"), "set", "shingles"))
        forget(hot)
        del large, pivots, hot, near, closest, outer, crossing, found
        release(sets.sparkSession)
    return edges, _in_pairs(sets, bucket_sets)


def _in_pairs(sets: DataFrame, bucket_sets: int) -> DataFrame:
    """Sets (bucket, set, shingles); each pair of blocks of a large bucket is a bucket of its own, of about `bucket_sets` sets. So any two sets still meet."""
    large = sets.groupBy("bucket").agg(F.count_distinct("set").alias("n")).where(F.col("n") > bucket_sets)
    large = durable(large.select("bucket", F.ceil(F.col("n") * 2 / bucket_sets).cast("bigint").alias("blocks")))
    if large.isEmpty():
        return sets
    marked = sets.join(F.broadcast(large), "bucket", "left")  # at most (sets / bucket_sets) rows
    a, b = F.pmod(F.xxhash64("set"), F.col("blocks")), F.col("other")
    pairs = marked.where("blocks is not null").withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
    pairs = pairs.select(F.xxhash64("bucket", F.least(a, b), F.greatest(a, b)).alias("bucket"), "set", "shingles")
    return marked.where("blocks is null").select("bucket", "set", "shingles").unionAll(pairs)


def _cross_links(near: DataFrame, shell: DataFrame, percent: int, block: int) -> DataFrame:
    """(u, v): one near set for each shell set of its bucket that links to some. Shell sets meet the near sets block by block."""
    blocks = max(1, -(-(near.groupBy("bucket").count().agg(F.max("count")).first()[0] or 0) // block))
    sides = near.withColumn("side", F.lit(0)).withColumn("block", F.pmod(F.xxhash64("set"), F.lit(blocks))).unionAll(
        shell.withColumn("side", F.lit(1)).withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))))
    )

    def search(t: pa.Table) -> pa.Table:
        side = t["side"].to_numpy()
        names, flat = t["set"].to_numpy(), t["shingles"].combine_chunks()
        sets = [np.unique(x.values.to_numpy()).view(np.uint64) for x in flat]
        index = Index(sets, percent)
        index.drop(np.flatnonzero(side == 1))
        u, v = [], []
        for q in np.flatnonzero(side == 1).tolist():
            found = index.search(q)
            if len(found):
                u.append(int(names[found[0]]))
                v.append(int(names[q]))
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    return sides.groupBy("bucket", "block").applyInArrow(search, "u bigint, v bigint")


def link_edges(sets: DataFrame, percent: int) -> DataFrame:
    """(u, v) for every set that some link connects to another; u is the first of its component. sets: (bucket, set, shingles)."""

    def search(t: pa.Table) -> pa.Table:
        names, at = np.unique(t["set"].to_numpy(), return_index=True)
        lists = t["shingles"].combine_chunks()
        label = link_components([np.sort(lists[i].values.to_numpy().view(np.uint64)) for i in at.tolist()], percent)
        other = label != np.arange(len(names))
        return pa.table({"u": pa.array(names[label[other]], pa.int64()), "v": pa.array(names[other], pa.int64())})

    return sets.groupBy("bucket").applyInArrow(search, "u bigint, v bigint")


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", k: int = SHINGLE, percent: int = PERCENT, bucket_sets: int = BUCKET_SETS, broadcast_sets: int = BROADCAST_SETS, sketch_bits: int = KEY_BITS) -> DataFrame:
    """One row per document: id, n_shingles, component_id (the smallest id that links reach). Shingles are counted by `sketch_bits` bits, 40 at most."""
    if not 50 < percent <= 100:
        raise ValueError("percent must be over 50 and at most 100")
    if not 0 < sketch_bits <= KEY_BITS:
        raise ValueError(f"sketch_bits must be from 1 to {KEY_BITS}")
    docs = small_batches(docs)
    whole = durable(prefixes(docs, id_column, text_column, k, percent, sketch_bits))
    release(docs.sparkSession)  # what was shuffled for it; again after the steps that follow
    buckets = connected_components(candidate_edges(whole.where("size(prefix) > 0")))
    own = durable(whole.select("id", "n", "set"))
    forget(whole)
    ids = durable(own.where("n > 0").groupBy("set").agg(F.min("id").alias("id"), F.first("n").alias("n"), F.count(F.lit(1)).alias("copies")))
    members = durable(ids.join(buckets.withColumnRenamed("component", "bucket"), node_of(F.col("set")) == F.col("node")).select("set", "id", "n", "bucket"))
    del buckets, whole
    release(docs.sparkSession)
    members = _refined(docs, id_column, text_column, members, k, percent, bucket_sets, broadcast_sets, sketch_bits)
    large = durable(members.groupBy("bucket").count().where(F.col("count") > bucket_sets).select("bucket", F.lit(True).alias("large")))
    edges = None
    if not large.isEmpty():  # at most (sets / bucket_sets) rows
        members = durable(members.join(F.broadcast(large), "bucket", "left"))
        edges, left = _split_large(durable(_bucketed_sets(docs, id_column, text_column, members.where("large"), k, broadcast_sets)), percent, bucket_sets)
        edges = edges.unionAll(link_edges(left, percent))
        members = members.where("large is null")
        release(docs.sparkSession)
    found = link_edges(_bucketed_sets(docs, id_column, text_column, members, k, broadcast_sets), percent)
    linked = connected_components(found if edges is None else edges.unionAll(found))
    release(docs.sparkSession)
    named = ids.join(linked.withColumnRenamed("node", "set"), "set", "left").withColumn("component", F.coalesce("component", "set"))
    least = named.groupBy("component").agg(F.min("id").alias("component_id"))
    named = durable(named.join(least, "component").select("set", "component_id", "copies"))
    many = max(MANY_COPIES, own.count() // MANY_SHARE)
    hot = F.broadcast(named.where(F.col("copies") > many).select("set", F.lit(True).alias("hot")))  # MANY_SHARE rows at most
    salts = F.when(F.col("copies") > many, SALTS).otherwise(1)
    named = named.select("set", "component_id", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"))
    salted = own.join(hot, "set", "left").withColumn("salt", F.when(F.col("hot"), F.pmod(F.xxhash64("id"), F.lit(SALTS))).otherwise(0).cast("int"))
    found = salted.join(named, ["set", "salt"], "left")
    return found.select(F.col("id").alias(id_column), F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id"))


def drop_near_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The documents without those that aren't the first of their component. Ids must be unique; the ids that go are shuffled, or broadcast where they are few."""
    gone = durable(near_duplicates(docs, id_column, text_column, k, percent).where(F.col("component_id") != F.col(id_column)).select(id_column).distinct())
    if gone.count() <= BROADCAST_SETS:
        gone = F.broadcast(gone)
    return docs.join(gone, id_column, "left_anti").select(*docs.columns)
