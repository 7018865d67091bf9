"""Vectorised text primitives shared by the operators of this subpackage.

Everything works on the UTF-8 bytes of a whole Arrow batch at once: one byte
buffer, document offsets, word starts and ends, and one 64-bit hash a word.
No Python object is made per word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are worked on at a time (a longer document is a slice of its own).
SLICE_BYTES = 1 << 20
#: Ends each document in the joined buffer; never part of valid UTF-8.
END = 0xFF

#: ASCII white space: 0x20 and 0x09-0x0D. Everything else belongs to a word.
WORD_NOT_SPACE = np.ones(256, dtype=bool)
WORD_NOT_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D, END]] = False
#: ASCII letters, ASCII digits and every byte of a non-ASCII character.
WORD_ALNUM = np.zeros(256, dtype=bool)
WORD_ALNUM[0x30:0x3A] = WORD_ALNUM[0x61:0x7B] = WORD_ALNUM[0x41:0x5B] = WORD_ALNUM[0x80:0xFF] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_MULT = np.uint64(0x9E3779B97F4A7C15)
_STEP = 0xD1342543DE82EF95
_MASK = (1 << 64) - 1


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose output bits all depend on all input bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


#: A random 64-bit value for each byte, the same in every process.
_BYTE_VALUE = mix64((np.arange(1, 257, dtype=np.uint64) * _MULT) ^ np.uint64(0x5851F42D4C957F2D))
_powers: dict[str, np.ndarray] = {}


def _power(step: int, n: int, name: str) -> np.ndarray:
    """step**0 .. step**(n-1) modulo 2**64, grown on demand."""
    have = _powers.get(name)
    if have is None or len(have) < n:
        size = max(n, SLICE_BYTES + 4096)
        have = np.full(size, np.uint64(step & _MASK))
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if size > 4 * SLICE_BYTES:
            return have  # for one huge document only: not kept
        _powers[name] = have
    return have[:n]


@dataclass
class TextSlice:
    """Some documents, one after the other, each ended by a space and END."""

    first: int  # row of the first document in its batch
    data: np.ndarray  # uint8
    offsets: np.ndarray  # int64, documents + 1

    def __len__(self) -> int:
        return len(self.offsets) - 1


def text_slices(column: pa.Array | pa.ChunkedArray, limit: int = SLICE_BYTES, lower: bool = True) -> Iterator[TextSlice]:
    """Cuts a string column into slices of about `limit` bytes; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return
    raw = pc.fill_null(column.cast(pa.large_string()), "").cast(pa.large_binary())
    ends = np.cumsum(pc.binary_length(raw).to_numpy(zero_copy_only=False).astype(np.int64) + 2)
    at = 0
    while at < len(raw):
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + limit, side="right")))
        part = pc.binary_join_element_wise(raw.slice(at, to - at), pa.scalar(b"\xff", pa.large_binary()), pa.scalar(b" ", pa.large_binary()))
        offsets = np.frombuffer(part.buffers()[1], dtype=np.int64)[part.offset : part.offset + len(part) + 1]
        data = np.frombuffer(part.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
        if lower:
            data = LOWER[data]
        yield TextSlice(at, data, offsets - offsets[0])
        at = to


@dataclass
class Words:
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray  # words before each document, documents + 1

    def doc_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def find_words(part: TextSlice, table: np.ndarray) -> Words:
    """Maximal runs of bytes that `table` marks."""
    inside = table[part.data].view(np.int8)
    edge = np.flatnonzero(np.diff(inside, prepend=np.int8(0)))
    starts, ends = edge[0::2], edge[1::2]
    return Words(starts, ends, np.searchsorted(starts, part.offsets))


def word_hashes(part: TextSlice, words: Words) -> np.ndarray:
    """A 64-bit hash of each word's bytes; equal words have equal hashes everywhere."""
    n = len(part.data)
    if not len(words.starts):
        return np.zeros(0, dtype=np.uint64)
    run = _BYTE_VALUE[part.data]
    run *= _power(_STEP, n, "up")
    np.cumsum(run, out=run)
    before = np.where(words.starts > 0, run[words.starts - 1], np.uint64(0))
    value = run[words.ends - 1] - before
    value *= _power(pow(_STEP, -1, 1 << 64), n, "down")[words.starts]
    value += (words.ends - words.starts).astype(np.uint64) * _MULT
    return mix64(value)


def hash_word(word: bytes) -> int:
    """word_hashes() of a single word."""
    part = TextSlice(0, np.frombuffer(word, dtype=np.uint8), np.array([0, len(word)]))
    return int(word_hashes(part, Words(np.array([0]), np.array([len(word)]), np.array([0, 1])))[0])


def shingle_sets(part: TextSlice, words: Words, hashes: np.ndarray, k: int) -> list[np.ndarray]:
    """Each document's sorted distinct k-word shingles, as hashes; a shorter text is one shingle, no words give none."""
    n = len(hashes)
    odd = [np.uint64(pow(0xA0761D6478BD642F, j + 1, 1 << 64) | 1) for j in range(k)]
    rolled = np.zeros(max(0, n - k + 1), dtype=np.uint64)
    for j in range(k):
        rolled += hashes[j : n - k + 1 + j] * odd[j] if n >= k else np.uint64(0)
    rolled = mix64(rolled)
    out = []
    for a, b in zip(words.bounds[:-1], words.bounds[1:], strict=True):
        if b - a >= k:
            out.append(np.unique(rolled[a : b - k + 1]))
        elif b > a:
            short = np.uint64(b - a)
            for j, h in enumerate(hashes[a:b]):
                short = np.uint64((int(short) + int(h) * int(odd[j])) & _MASK)
            out.append(mix64(np.array([short ^ np.uint64(0x1234567)], dtype=np.uint64)))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out
