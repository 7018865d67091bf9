"""Byte-level BPE through a minimal acyclic transducer of frequent words.

1. All documents are counted into words (the tokenizer's pre-tokens). The most
   frequent ones - a bounded number, the operator's feature - are merged once
   and compiled into a minimal acyclic automaton over bytes: equal suffixes
   share their states, and each arc carries a number, so that the numbers on a
   word's path add up to the word's index in a table of id sequences.
2. The compiled arrays are broadcast (bounded by the word limit) and mapped
   into memory from a file that each worker process makes for itself.
3. Every text is cut into words; distinct words of a block of texts run
   through the automaton together, one byte a step. A word that isn't in it is
   merged exactly: always the adjacent pair of lowest rank, found with a heap,
   so a word of any length takes O(n log n).

Ids are those of the tokenizers library for the same vocabulary file without
added special tokens; an added token's text (such as <|endoftext|>) becomes its
id, as there. Decoding joins the ids' bytes and reads them as UTF-8.

A vocabulary file with other settings than those is refused.

Defined results: a null or empty text has no ids and decodes to an empty text;
rows are kept as they are, repeated ones too; an empty table stays empty; an
input column with the name of an added one gives way to it.
"""

from __future__ import annotations

import gc
import hashlib
import heapq
import json
import re
import tempfile
from array import array
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable, frugal, give_back, small_batches

#: Words compiled into the lexicon at most.
LEXICON_WORDS = 1 << 17
#: Chunks that a worker remembers, within a task, before it starts anew.
CACHE_CHUNKS = 320_000
BLOCK_CHARS, WRITTEN_IDS = 1_000_000, 1 << 18
NEVER = 1 << 30

#: Fixed value: the byte-level vocabulary's way to cut texts into words.
WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: White space and what follows it. No word spans two chunks. re's white space has four separators more than the pattern above.
CHUNK = re.compile(r"[^\S\x1c-\x1f]*[\S\x1c-\x1f]+|[^\S\x1c-\x1f]+")


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies -> the byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def _settings(data: dict) -> Iterator[tuple[str, dict, str, object]]:
    """(part, its settings, a setting, the value that the encoder is built for)."""
    for part, key in (("normalizer", "type"), ("post_processor", "type")):
        yield part, data.get(part) or {}, key, None
    for key, right in (("type", "BPE"), ("dropout", None), ("unk_token", None), ("continuing_subword_prefix", None), ("end_of_word_suffix", None), ("byte_fallback", False), ("ignore_merges", False)):
        yield "model", data["model"], key, right
    for part in ("pre_tokenizer", "decoder"):
        yield part, data.get(part) or {"type": None}, "type", "ByteLevel"
    yield "pre_tokenizer", data.get("pre_tokenizer") or {}, "add_prefix_space", False
    yield "pre_tokenizer", data.get("pre_tokenizer") or {}, "use_regex", True
    for token in data.get("added_tokens", []):
        for key in ("single_word", "lstrip", "rstrip"):
            yield f"added token {token['content']}", token, key, False


@dataclass
class Vocabulary:
    """A byte-level BPE vocabulary: what each id spells, and which pairs merge, best first."""

    spell: dict[int, bytes]
    rank: dict[tuple[int, int], int]
    merged: list[int]  # rank -> id
    byte_ids: list[int]
    special: dict[str, int] = field(default_factory=dict)

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        wrong = [f"{part}: {key}" for part, own, key, right in _settings(data) if own.get(key, right) != right]
        if wrong:
            raise ValueError(f"{path} isn't cut and merged in the way that is built here ({', '.join(wrong)})")
        to_byte, ids = byte_alphabet(), data["model"]["vocab"]
        spell = {i: bytes(to_byte[c] for c in t) for t, i in ids.items()}
        pairs = [tuple(p.split(" ") if isinstance(p, str) else p) for p in data["model"]["merges"]]
        rank = {(ids[a], ids[b]): k for k, (a, b) in enumerate(pairs)}
        special = {t["content"]: t["id"] for t in data.get("added_tokens", [])}
        spell |= {i: t.encode() for t, i in special.items()}
        of_byte = {v: k for k, v in to_byte.items()}
        return cls(spell, rank, [ids[a + b] for a, b in pairs], [ids[of_byte[b]] for b in range(256)], special)

    def merge(self, word: bytes) -> list[int]:
        """The ids of a word: merges the pair of lowest rank, the leftmost first, until none is left."""
        ids, rank, merged = [self.byte_ids[b] for b in word], self.rank, self.merged
        ranks = [rank.get(p, NEVER) for p in zip(ids, ids[1:])]  # noqa: B905
        if len(ids) > 100:
            return self._merge_long(ids, ranks)
        while ranks:
            best = min(ranks)
            if best == NEVER:
                break
            k = ranks.index(best)
            ids[k] = merged[best]
            del ids[k + 1], ranks[k]
            if k:
                ranks[k - 1] = rank.get((ids[k - 1], ids[k]), NEVER)
            if k < len(ranks):
                ranks[k] = rank.get((ids[k], ids[k + 1]), NEVER)
        return ids

    def _merge_long(self, ids: list[int], ranks: list[int]) -> list[int]:
        """The same with a heap of pairs and linked neighbours."""
        n, rank, merged = len(ids), self.rank, self.merged
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        heap = [(r, k, ids[k], ids[k + 1]) for k, r in enumerate(ranks) if r != NEVER]
        heapq.heapify(heap)
        while heap:
            r, k, a, b = heapq.heappop(heap)
            j = after[k] if ids[k] == a else -1
            if j < 0 or ids[j] != b:
                continue  # one of the two has been merged meanwhile
            ids[k], ids[j], after[k] = merged[r], -1, after[j]
            if after[j] >= 0:
                before[after[j]] = k
            for x, y in ((before[k], k), (k, after[k])):
                if x >= 0 and y >= 0 and (r := rank.get((ids[x], ids[y]), NEVER)) != NEVER:
                    heapq.heappush(heap, (r, x, ids[x], ids[y]))
        return [i for i in ids if i >= 0]


class Transducer:
    """word -> index, as a minimal acyclic automaton whose arcs carry numbers that add up along a path."""

    def __init__(self, arc_keys: np.ndarray, arc_to: np.ndarray, arc_add: np.ndarray, final: np.ndarray):
        self.arc_keys, self.arc_to, self.arc_add, self.final = arc_keys, arc_to, arc_add, final  # keys: state * 256 + byte, sorted

    @classmethod
    def compile(cls, words: list[bytes]) -> Transducer:
        """words: sorted, distinct. Word k gets index k."""
        register: dict[tuple, int] = {}
        frozen: list[tuple[bool, tuple]] = []  # state -> final, arcs
        reach: list[int] = []  # words from the state on

        def freeze(node: list) -> int:
            key = (node[0], tuple(node[1]))
            if key not in register:
                register[key] = len(frozen)
                frozen.append(key)
                reach.append(node[0] + sum(reach[t] for _, t in node[1]))
            return register[key]

        path: list[list] = [[False, []]]  # of the last word: [final, [(byte, state)]]; its arcs come when the next node is frozen
        last = b""
        for word in words:
            same = next((k for k, (a, b) in enumerate(zip(last, word)) if a != b), min(len(last), len(word)))  # noqa: B905
            while len(path) > same + 1:
                state = freeze(path.pop())
                path[-1][1].append((last[len(path) - 1], state))
            path.extend([False, []] for _ in word[same:])
            path[-1][0] = True
            last = word
        while len(path) > 1:
            state = freeze(path.pop())
            path[-1][1].append((last[len(path) - 1], state))
        root = freeze(path[0])
        number = {root: 0}
        number |= {s: k + 1 for k, s in enumerate(s for s in range(len(frozen)) if s != root)}
        keys, to, add = [], [], []
        for s, (is_final, arcs) in enumerate(frozen):
            below = int(is_final)
            for byte, t in arcs:
                keys.append(number[s] * 256 + byte)
                to.append(number[t])
                add.append(below)
                below += reach[t]
        final = np.zeros(len(frozen), dtype=bool)
        final[[number[s] for s, (is_final, _) in enumerate(frozen) if is_final]] = True
        order = np.argsort(np.array(keys, dtype=np.int64))
        pick = lambda x, kind: np.array(x, dtype=kind)[order]
        return cls(pick(keys, np.int64), pick(to, np.int32), pick(add, np.int32), final)

    def lookup(self, words: list[bytes]) -> np.ndarray:
        """The index of each word, -1 for those that aren't in it. One step a byte for all words together."""
        index = np.full(len(words), -1, dtype=np.int64)
        if not words or not len(self.arc_keys):
            return index
        size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        data = np.frombuffer(b"".join(words), dtype=np.uint8)
        start = np.cumsum(size) - size
        live, state, total, step = np.flatnonzero(size > 0), np.zeros(len(words), dtype=np.int64), np.zeros(len(words), dtype=np.int64), 0
        while len(live):
            key = state[live] * 256 + data[start[live] + step]
            at = np.minimum(np.searchsorted(self.arc_keys, key), len(self.arc_keys) - 1)
            hit = self.arc_keys[at] == key
            live, at = live[hit], at[hit]
            state[live] = self.arc_to[at]
            total[live] += self.arc_add[at]
            step += 1
            done = live[size[live] == step]
            done = done[self.final[state[done]]]
            index[done] = total[done]
            live = live[size[live] > step]
        return index

    def arrays(self) -> dict[str, np.ndarray]:
        return {"arc_keys": self.arc_keys, "arc_to": self.arc_to, "arc_add": self.arc_add, "final": self.final}


def pack(arrays: dict[str, np.ndarray]) -> bytes:
    """Arrays one after the other behind a JSON header of their places."""
    head, at = {}, 0
    for name, x in arrays.items():
        head[name] = [x.dtype.str, len(x), at]
        at += -(-x.nbytes // 16) * 16
    text = json.dumps(head).encode()
    text += b" " * (-(len(text) + 8) % 16)
    return len(text).to_bytes(8, "little") + text + b"".join(x.tobytes().ljust(-(-x.nbytes // 16) * 16, b"\0") for x in arrays.values())


def unpack_mapped(blob: bytes) -> dict[str, np.ndarray]:
    """The arrays of pack(), mapped from an unnamed file of this process."""
    f = tempfile.TemporaryFile()  # noqa: SIM115  the map keeps it
    f.write(blob)
    f.flush()
    mapped = np.memmap(f, dtype=np.uint8, mode="r").view(np.ndarray)
    first = 8 + int.from_bytes(blob[:8], "little")
    head = json.loads(blob[8:first])
    return {name: mapped[first + at : first + at + n * np.dtype(kind).itemsize].view(kind) for name, (kind, n, at) in head.items()}


def compile_lexicon(vocabulary: Vocabulary, words: Iterable[str]) -> bytes:
    """The transducer of the words and their id sequences, packed."""
    sorted_words = sorted({w.encode() for w in words if w})
    ids = Merger(vocabulary).merge(sorted_words)
    ends = np.cumsum([len(x) // 4 for x in ids], dtype=np.int64) if ids else np.zeros(0, dtype=np.int64)
    flat = np.frombuffer(b"".join(ids), dtype=np.int32)
    return pack(Transducer.compile(sorted_words).arrays() | {"ends": ends, "ids": flat})


class Merger:
    """Exact merging of many words at once: in each round every word merges its best pair."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.base = 1 + max(vocabulary.spell)
        pairs = np.array([(a * self.base + b, r) for (a, b), r in vocabulary.rank.items()], dtype=np.int64).reshape(-1, 2)
        # a hash table of pairs, a tenth full: most lookups end at their first slot
        bits = max(4, (10 * len(pairs)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.ranks = np.full(1 << bits, -1, dtype=np.int64), np.full(1 << bits, NEVER, dtype=np.int32)
        for at, key, rank in zip(self._slot(pairs[:, 0]).tolist(), pairs[:, 0].tolist(), pairs[:, 1].tolist(), strict=True):
            while self.keys[at] >= 0:
                at = (at + 1) & self.mask
            self.keys[at], self.ranks[at] = key, rank
        self.any = len(pairs) > 0
        self.merged = np.array(vocabulary.merged, dtype=np.int32)
        self.byte_ids = np.array(vocabulary.byte_ids, dtype=np.int32)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return (key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = (a.astype(np.int64) * self.base + b).ravel()
        at = self._slot(key)
        found = self.keys[at]
        out = np.where(found == key, self.ranks[at], np.int32(NEVER))
        other = np.flatnonzero((found != key) & (found >= 0))
        at = at[other]
        while len(other):  # the slot is another pair's: on to the next one
            at = (at + 1) & self.mask
            found = self.keys[at]
            hit = found == key[other]
            out[other[hit]] = self.ranks[at[hit]]
            on = ~hit & (found >= 0)
            other, at = other[on], at[on]
        return out.reshape(a.shape)

    def merge(self, words: list[bytes], longest: int = 48, rows: int = 16384) -> list[bytes]:
        """Each word's ids, as the bytes of int32 values."""
        out: list[bytes] = [b""] * len(words)
        if not self.any:
            return [self.byte_ids[np.frombuffer(w, dtype=np.uint8)].tobytes() for w in words]
        order = sorted(range(len(words)), key=lambda k: len(words[k]))
        short = [k for k in order if 0 < len(words[k]) <= longest]
        for k in order[len(order) - sum(len(w) > longest for w in words) :]:
            out[k] = array("i", self.vocabulary.merge(words[k])).tobytes()
        for first in range(0, len(short), rows):
            part = np.array(short[first : first + rows])
            size = np.array([len(words[k]) for k in part])
            width = int(size[-1])
            data = np.frombuffer(b"".join([words[k].ljust(width, b"\0") for k in part]), dtype=np.uint8).reshape(-1, width)
            ids = self.byte_ids[data]
            rank = self._rank(ids[:, :-1], ids[:, 1:])
            columns = np.arange(width)
            rank[columns[None, :-1] >= size[:, None] - 1] = NEVER
            while len(part):
                best = rank.argmin(1) if rank.shape[1] else np.zeros(len(part), dtype=np.int64)
                value = np.take_along_axis(rank, best[:, None], 1)[:, 0] if rank.shape[1] else np.full(len(part), NEVER)
                done = value == NEVER
                if done.any():
                    flat = ids[done].tobytes()
                    starts = np.arange(int(done.sum())) * (4 * ids.shape[1])
                    for k, start, end in zip(part[done].tolist(), starts.tolist(), (starts + 4 * size[done]).tolist(), strict=True):
                        out[k] = flat[start:end]
                    go = ~done
                    part, ids, rank, size, best, value = part[go], ids[go], rank[go], size[go], best[go], value[go]
                    if not len(part):
                        break
                width = int(size.max())
                ids, rank, columns = ids[:, :width], rank[:, : width - 1], columns[:width]
                r = np.arange(len(part))
                ids[r, best] = self.merged[value]
                size -= 1
                ids = np.take_along_axis(ids, np.minimum(columns + (columns > best[:, None]), width - 1), 1)
                narrow = columns[: width - 1]
                rank = np.take_along_axis(rank, np.minimum(narrow + (narrow >= best[:, None]), width - 2), 1)
                rank[narrow >= size[:, None] - 1] = NEVER
                left = np.flatnonzero(best > 0)
                rank[left, best[left] - 1] = self._rank(ids[left, best[left] - 1], ids[left, best[left]])
                right = np.flatnonzero(best < size - 1)
                rank[right, best[right]] = self._rank(ids[right, best[right]], ids[right, best[right] + 1])
        return out


class Encoder:
    """Of one worker process. It remembers what the chunks it has seen stand for, up to a bound."""

    def __init__(self, vocabulary: Vocabulary, lexicon: bytes):
        self.merger = Merger(vocabulary)
        x = unpack_mapped(lexicon)
        self.lexicon = Transducer(*(x[k] for k in ("arc_keys", "arc_to", "arc_add", "final")))
        self.bounds, self.ids = np.concatenate([[0], x["ends"]]) * 4, x["ids"].view(np.uint8).data
        self.special = {(s,): array("i", [i]).tobytes() for s, i in vocabulary.special.items()}
        self.split_special = re.compile("(" + "|".join(re.escape(s) for s in sorted(vocabulary.special, key=len, reverse=True)) + ")") if vocabulary.special else None
        self.forget()

    def forget(self) -> None:
        self.known: dict = dict(self.special)

    def word_ids(self, words: list[str]) -> list[bytes]:
        raw = [w.encode() for w in words]
        index = self.lexicon.lookup(raw)
        out: list = [b""] * len(words)
        seen, unseen = np.flatnonzero(index >= 0), np.flatnonzero(index < 0).tolist()
        for k, start, end in zip(seen.tolist(), self.bounds[index[seen]].tolist(), self.bounds[index[seen] + 1].tolist(), strict=True):
            out[k] = bytes(self.ids[start:end])
        for k, ids in zip(unseen, self.merger.merge([raw[k] for k in unseen]), strict=True):
            out[k] = ids
        return out

    def _learn(self, chunks: list[str]) -> None:
        whole = [c for c in chunks if (c[1:] if c[0] == " " else c).isalpha()]
        rest = [*set(chunks).difference(whole)]
        cut = list(map(WORD.findall, rest))
        words = [*set(whole).union(*cut)]
        ids = dict(zip(words, self.word_ids(words), strict=True))
        get = ids.__getitem__
        self.known.update(zip(whole, map(get, whole), strict=True))
        self.known.update(zip(rest, [b"".join(map(get, found)) for found in cut], strict=True))

    def _cut(self, text: str) -> list:
        if self.split_special and self.split_special.search(text):
            return [key for k, part in enumerate(self.split_special.split(text)) for key in ([(part,)] if k % 2 else CHUNK.findall(part))]
        return CHUNK.findall(text)

    def encode(self, texts: list[str]) -> Iterator[list[bytes]]:
        """Blocks of texts, in order; of each text the bytes of its ids as int32 values."""
        at = 0
        while at < len(texts):
            to, size = at, 0
            while to < len(texts) and (to == at or size < BLOCK_CHARS):
                size += len(texts[to])
                to += 1
            gc.disable()  # millions of small objects and no cycles
            try:
                out = self._block(texts[at:to])
            finally:
                gc.enable()
            yield out
            at = to

    def _block(self, texts: list[str]) -> list[bytes]:
        block = [self._cut(t) for t in texts]
        if len(self.known) > CACHE_CHUNKS:
            self.forget()
        if new := set().union(*block).difference(self.known):
            self._learn([*new])
        get = self.known.__getitem__
        return [b"".join(map(get, row)) for row in block]


class Spelling:
    """A piece of bytes for each id, to write out many ids at once."""

    def __init__(self, pieces: dict[int, bytes]):
        self.size = np.zeros(1 + max(pieces), dtype=np.int64)
        for i, p in pieces.items():
            self.size[i] = len(p)
        self.first = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(pieces[i] for i in sorted(pieces)), dtype=np.uint8)

    def write(self, raw: list[bytes], most: int = WRITTEN_IDS) -> Iterator[bytes]:
        """The pieces of each id sequence, joined. About `most` ids are worked on at a time, or one sequence."""
        at = 0
        while at < len(raw):
            to, tokens = at, 0
            while to < len(raw) and (to == at or tokens + len(raw[to]) // 4 <= most):
                tokens += len(raw[to]) // 4
                to += 1
            ids = np.frombuffer(b"".join(raw[at:to]), dtype=np.int32)
            size = self.size[ids]
            ends = np.concatenate([[0], np.cumsum(size)])
            out = self.data[np.arange(ends[-1]) + np.repeat(self.first[ids] - ends[:-1], size)].tobytes()
            bounds = ends[np.concatenate([[0], np.cumsum([len(r) // 4 for r in raw[at:to]])])].tolist()
            yield from (out[a:b] for a, b in zip(bounds, bounds[1:]))  # noqa: B905
            at = to


_workers: dict[str, tuple[Encoder, Spelling, Spelling]] = {}


def _worker(vocabulary: Vocabulary, lexicon: bytes, key: str) -> tuple[Encoder, Spelling, Spelling]:
    """This process's encoder and the spellings of ids as decimals (each with a comma before it) and as text."""
    if key not in _workers:
        _workers.clear()
        _workers[key] = Encoder(vocabulary, lexicon), Spelling({i: b",%d" % i for i in vocabulary.spell}), Spelling(vocabulary.spell)
    return _workers[key]


def count_words(docs: DataFrame, text_column: str = "text", flush: int = 400_000) -> DataFrame:
    """(word, n) over all documents. Each task sums before the shuffle, in bounded memory."""

    def words_of(chunks: Counter) -> pa.RecordBatch:
        words: dict[str, int] = {}
        get = words.get
        for chunk, n in chunks.items():
            if (chunk[1:] if chunk[0] == " " else chunk).isalpha():  # letters only: one word
                words[chunk] = get(chunk, 0) + n
            else:
                for w in WORD.findall(chunk):
                    words[w] = get(w, 0) + n
        return pa.RecordBatch.from_pydict({"word": pa.array(words.keys(), pa.string()), "n": pa.array(words.values(), pa.int64())})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text:
                    chunks.update(CHUNK.findall(text))
                if len(chunks) > flush:
                    yield words_of(chunks)
                    chunks.clear()
        if chunks:
            yield words_of(chunks)

    return small_batches(docs).select(text_column).mapInArrow(frugal(count), "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def build_lexicon(docs: DataFrame, vocabulary: Vocabulary, text_column: str = "text", words: int = LEXICON_WORDS, longest: int = 64) -> bytes:
    """The lexicon of the most frequent words: from the top down all words of a frequency class, while they number `words` at most.

    A class is one count up to 1024, and 1/64 of a power of two beyond. So no task sends the driver more than its share of the chosen words.
    """
    counts = durable(count_words(docs, text_column).where(F.length("word") <= longest))
    counts = counts.withColumn("class", F.when(F.col("n") <= 1024, F.col("n")).otherwise(F.floor(F.log2(F.col("n").cast("double")) * 64) + 1024 - 640).cast("bigint"))
    left, least = words, None
    for row in counts.groupBy("class").agg(F.count(F.lit(1)).alias("words")).orderBy(F.desc("class")).collect():  # some thousand classes
        if row.words > left:
            break
        left, least = left - row.words, row["class"]
    chosen = [] if least is None else counts.where(F.col("class") >= least).select("word").toArrow()["word"].to_pylist()
    lexicon = compile_lexicon(vocabulary, chosen)
    del chosen
    give_back()
    return lexicon


def _encoded(docs: DataFrame, text_column: str, path: str, lexicon: bytes | None, columns: list[str], schema: str, build: Callable[..., list[pa.Array]]) -> DataFrame:
    vocabulary = Vocabulary.read(path)
    if lexicon is None:
        lexicon = build_lexicon(docs, vocabulary, text_column)
    key = hashlib.sha256(lexicon).hexdigest()
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary, lexicon))
    names = [part.split()[0] for part in schema.split(", ")]
    columns = [c for c in columns if c.lower() not in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decimal, decoded = _worker(*shared.value, key)
        encoder.forget()
        for batch in batches:
            at = 0
            for raw in encoder.encode([t or "" for t in batch.column(0).to_pylist()]):
                part = batch.slice(at, len(raw))
                yield pa.RecordBatch.from_arrays([*part.columns[1:], *build(raw, decimal, decoded)], names=[*columns, *names])
                at += len(raw)
        encoder.forget()

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*[F.col(f"`{c}`") for c in columns]).schema)
    return small_batches(docs).select(text_column, *[F.col(f"`{c}`") for c in columns]).mapInArrow(frugal(run), f"{kept}, {schema}" if kept else schema)


def _id_lists(raw: list[bytes]) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(p) // 4 for p in raw], dtype=np.int64)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(raw), dtype=np.int32), pa.int32()))


def encode_documents(docs: DataFrame, path: str, text_column: str = "text", columns: list[str] | None = None, lexicon: bytes | None = None) -> DataFrame:
    """`columns` (all but the text by default) and `ids`, an array of token ids. `path`: the vocabulary file."""

    def build(raw: list[bytes], decimal: Spelling, decoded: Spelling) -> list[pa.Array]:
        return [_id_lists(raw)]

    columns = [c for c in docs.columns if c != text_column] if columns is None else columns
    return _encoded(docs, text_column, path, lexicon, columns, "ids array<int>", build)


def decode_documents(encoded: DataFrame, path: str, ids_column: str = "ids", text_column: str = "text") -> DataFrame:
    """The texts of id sequences, in place of them."""
    shared = encoded.sparkSession.sparkContext.broadcast(Vocabulary.read(path).spell)
    rest = [c for c in encoded.columns if c.lower() not in (ids_column.lower(), text_column.lower())]
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.select(*[F.col(f"`{c}`") for c in rest]).schema) if rest else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spell = shared.value
        for batch in batches:
            texts = [b"".join([spell[i] for i in ids]).decode("utf-8", "replace") if ids is not None else "" for ids in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(texts, pa.string())], names=[*rest, text_column])

    return encoded.select(ids_column, *[F.col(f"`{c}`") for c in rest]).mapInArrow(frugal(run), f"{kept + ', ' if kept else ''}`{text_column}` string")


def encode_digests(docs: DataFrame, path: str, text_column: str = "text", columns: list[str] | None = None, lexicon: bytes | None = None, with_ids: bool = False) -> DataFrame:
    """`columns`, n_tokens, the SHA-256 of the comma-joined decimal ids and of the text decoded from them, and the ids if wanted."""

    def build(raw: list[bytes], decimal: Spelling, decoded: Spelling) -> list[pa.Array]:
        ids = [hashlib.sha256(x[1:]).hexdigest() for x in decimal.write(raw)]
        texts = [hashlib.sha256(x.decode("utf-8", "replace").encode()).hexdigest() for x in decoded.write(raw)]
        out = [pa.array([len(x) // 4 for x in raw], pa.int64()), pa.array(ids, pa.string()), pa.array(texts, pa.string())]
        return [*out, _id_lists(raw)] if with_ids else out

    columns = [c for c in docs.columns if c != text_column] if columns is None else columns
    schema = "n_tokens bigint, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if with_ids else "")
    return _encoded(docs, text_column, path, lexicon, columns, schema, build)
