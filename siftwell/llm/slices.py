"""Arrow text columns as byte slices, and vectorised words, lines and hashes over them.

Texts are handled in chunks of whole documents, about ``CHUNK_BYTES`` each (one document more at
most), so the memory of a task does not follow the size of its partition. 64-bit hashes are
polynomials over a fixed random table of the bytes, taken modulo 2**64 and mixed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 2 << 20
#: Words hashed together lie within so many bytes, unless a single word is longer.
SEGMENT_BYTES = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTE_VALUES = np.random.default_rng(20240131).integers(1, 1 << 63, 256, dtype=np.uint64)
#: A-Z to a-z, every other byte unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: The separators of words: blank, and the control characters from tab to carriage return.
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Bytes that begin a code point.
IS_LEAD = (np.arange(256) & 0xC0) != 0x80

_powers = np.ones(1, np.uint64)
_inverse_powers = np.ones(1, np.uint64)


@dataclass
class Chunk:
    """Some consecutive rows of a batch: their range, bytes, and where each text begins and ends."""

    first: int
    last: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def docs(self) -> int:
        return self.last - self.first


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its offsets; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """The rows of ``column`` in order, in chunks of about ``limit`` bytes."""
    if len(column) == 0:
        return
    data, offsets = text_bytes(column)
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), n)
        own = offsets[first : last + 1]
        yield Chunk(first, last, data[own[0] : own[-1]], own - own[0])
        first = last


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _grow_powers(n: int) -> None:
    global _powers, _inverse_powers
    if len(_powers) < n:
        with np.errstate(over="ignore"):
            _powers = np.multiply.accumulate(np.r_[np.uint64(1), np.full(n - 1, _BASE)])
            _inverse_powers = np.multiply.accumulate(np.r_[np.uint64(1), np.full(n - 1, _BASE_INVERSE)])


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span; spans are in order and do not overlap."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        to = int(np.searchsorted(ends, starts[at] + SEGMENT_BYTES, side="right"))
        to = max(to, at + 1)
        base, top = int(starts[at]), int(ends[to - 1])
        _grow_powers(top - base + 1)
        sums = np.zeros(top - base + 1, np.uint64)
        np.cumsum(_BYTE_VALUES[data[base:top]] * _powers[: top - base], out=sums[1:])
        s, e = starts[at:to] - base, ends[at:to] - base
        out[at:to] = mix((sums[e] - sums[s]) * _inverse_powers[s] + (e - s).astype(np.uint64) * _BASE)
        at = to
    return out


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of ``inside`` bytes within each text: starts, ends, and the text's number."""
    if len(inside) == 0:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    edge = np.zeros(len(inside) + 1, bool)
    edge[offsets] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    final = inside.copy()
    final[:-1] &= ~inside[1:] | edge[1:-1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(final) + 1, np.searchsorted(offsets, starts, side="right") - 1


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and text numbers of the words."""
    return spans(~IS_SPACE[data], offsets)


def lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and text numbers of all lines between line feeds; an empty text has one, empty."""
    feeds = np.flatnonzero(data == 10)
    doc = np.searchsorted(offsets, feeds, side="right") - 1
    docs = np.arange(len(offsets) - 1)
    starts = np.r_[offsets[:-1], feeds + 1]
    ends = np.r_[offsets[1:], feeds]
    owner = np.r_[docs, doc]
    order = np.lexsort((starts, owner))
    starts, owner = starts[order], owner[order]
    order = np.lexsort((ends, np.r_[docs, doc]))
    return starts, ends[order], owner


def per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many bytes of each text are flagged."""
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def windows(hashes: np.ndarray, doc: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all windows of ``size`` consecutive items of one text, and the windows' hashes."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.flatnonzero(doc[:n] == doc[size - 1 :])
    total = np.zeros(len(at), np.uint64)
    for k in range(size):
        total = total * _BASE + hashes[at + k]
    return at, mix(total + np.uint64(size))


def shingles(hashes: np.ndarray, doc: np.ndarray, docs: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Window hashes and text numbers, in order; a text of 1 to ``size`` - 1 words is one window."""
    at, found = windows(hashes, doc, size)
    owner = doc[at]
    count = np.bincount(doc, minlength=docs)
    short = np.flatnonzero((count > 0) & (count < size))
    if len(short):
        first = np.searchsorted(doc, short)
        whole = np.zeros(len(short), np.uint64)
        for k in range(size - 1):
            has = count[short] > k
            whole[has] = whole[has] * _BASE + hashes[first[has] + k]
        found = np.r_[found, mix(whole + count[short].astype(np.uint64))]
        owner = np.r_[owner, short]
        order = np.argsort(owner, kind="stable")
        found, owner = found[order], owner[order]
    return found, owner


def ragged(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Runs of ``flat`` from each start, of the given lengths, one after the other."""
    if len(starts) == 0:
        return flat[:0]
    ends = np.cumsum(lengths)
    at = np.repeat(starts - (ends - lengths), lengths)
    at += np.arange(len(at))
    return flat[at]


def gather(lists: np.ndarray, offsets: np.ndarray) -> pa.ListArray:
    """A list column over a flat array."""
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(lists))
