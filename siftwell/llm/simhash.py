"""SimHash near-duplicates, found through tables of distances to reference fingerprints.

1. A text's fingerprint has 64 bits. Its 3-word shingles (repeats included, words joined by one blank) are hashed by
   XXH64; a bit is set if it is set in over half the hashes. Words are separated by ASCII white space and A-Z are lowered. A
   text of one or two words has one shingle, all of its words; null, empty and blank texts have the fingerprint zero.
2. Equal fingerprints are one node. For every node the Hamming distances to 72 references are tabulated: eight base
   references, whose bytes are the rows of a Hadamard matrix, and each of these with one of its eight bytes inverted. The
   distance to a base reference less that to one of its inversions depends on that byte of the fingerprint alone, and the eight
   differences of a byte determine it, as the matrix is regular.
3. Two fingerprints that differ in at most ``bits`` bits differ in at most ``bits`` bytes. So each node is filed under the table's
   differences for all bytes but ``bits``, once for every choice of the bytes left out. Nodes filed together differ in those
   bytes only: 8 * ``bits`` binary digits, so with two bits no file ever holds more than 65,536 nodes, whatever the data.
4. In a file, pairs are discarded by the largest difference between their rows of the table (it never exceeds the distance of
   the two): first between cells, the nodes that agree in some columns, then between nodes. Survivors are verified on the
   fingerprints. A file gives as many links as join its parts. Links give components.

Rows without an identifier are linked like others, but name no component: theirs is null where no linked row has one. Rows
that repeat an identifier are rows of their own. Only the two named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwell.llm import slices
from siftwell.llm.links import components
from siftwell.session import cut_lineage

SIZE = 3
SEED = 42
#: Shingles whose bits are counted at once, and pairs compared at once.
SLICE = 1 << 17
PAIRS = 1 << 19
#: Files of more nodes are compared by cells first, which agree in so many columns of the table.
SMALL = 24
CELL_COLUMNS = 6

# The constants of XXH64: fixed values.
PRIME_1 = 0x9E3779B185EBCA87
PRIME_2 = 0xC2B2AE3D27D4EB4F
PRIME_3 = 0x165667B19E3779F9
PRIME_4 = 0x85EBCA77C2B2AE63
PRIME_5 = 0x27D4EB2F165667C5

_P1, _P2, _P3, _P4, _P5 = (np.uint64(p) for p in (PRIME_1, PRIME_2, PRIME_3, PRIME_4, PRIME_5))


def _rotate(x: np.ndarray, n: int) -> np.ndarray:
    return (x << np.uint64(n)) | (x >> np.uint64(64 - n))


def _round(state: np.ndarray, lane: np.ndarray) -> np.ndarray:
    return _rotate(state + lane * _P2, 31) * _P1


def xxh64(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, seed: int = SEED) -> np.ndarray:
    """XXH64 of spans of ``data``, which may overlap; all spans advance together, the longest first."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    words = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    halves = np.ndarray((len(data) + 1,), "<u4", padded, strides=(1,))
    order = np.argsort(-lengths, kind="stable")
    at, left = starts[order].astype(np.int64), lengths[order].astype(np.int64)
    sizes = left.copy()
    out = np.full(len(order), np.uint64(seed)) + _P5
    n = int(np.searchsorted(-left, -32, side="right"))
    if n:
        state = [np.full(n, np.uint64(x & (1 << 64) - 1)) for x in (seed + PRIME_1 + PRIME_2, seed + PRIME_2, seed, seed - PRIME_1)]
        m = n
        while m:
            for k in range(4):
                state[k][:m] = _round(state[k][:m], words[at[:m] + 8 * k])
            at[:m] += 32
            left[:m] -= 32
            # Spans stay in order of their lengths, so those with another stripe come first.
            m = int(np.searchsorted(-left[:m], -32, side="right"))
        total = _rotate(state[0], 1) + _rotate(state[1], 7) + _rotate(state[2], 12) + _rotate(state[3], 18)
        for k in range(4):
            total = (total ^ _round(np.zeros(n, np.uint64), state[k])) * _P1 + _P4
        out[:n] = total
    out += sizes.astype(np.uint64)
    none = np.zeros(1, np.uint64)
    while len(has := np.flatnonzero(left >= 8)):
        out[has] = _rotate(out[has] ^ _round(none, words[at[has]]), 27) * _P1 + _P4
        at[has] += 8
        left[has] -= 8
    if len(has := np.flatnonzero(left >= 4)):
        out[has] = _rotate(out[has] ^ halves[at[has]].astype(np.uint64) * _P1, 23) * _P2 + _P3
        at[has] += 4
        left[has] -= 4
    while len(has := np.flatnonzero(left >= 1)):
        out[has] = _rotate(out[has] ^ padded[at[has]].astype(np.uint64) * _P5, 11) * _P1
        at[has] += 1
        left[has] -= 1
    out ^= out >> np.uint64(33)
    out *= _P2
    out ^= out >> np.uint64(29)
    out *= _P3
    out ^= out >> np.uint64(32)
    hashes = np.empty_like(out)
    hashes[order] = out
    return hashes


def chunk_fingerprints(chunk: slices.Chunk) -> np.ndarray:
    """The fingerprint of every text of a chunk."""
    data = slices.LOWER[chunk.data]
    starts, ends, doc = slices.words(data, chunk.offsets)
    count = np.bincount(doc, minlength=chunk.docs)
    if len(doc) == 0:
        return np.zeros(chunk.docs, np.uint64)
    # Words with one blank after each, so that a shingle is one span.
    lengths = ends - starts + 1
    at = np.cumsum(lengths) - lengths
    joined = np.full(int(lengths.sum()), 32, np.uint8)
    spans = np.repeat(starts - at, lengths) + np.arange(len(joined))
    blank = np.zeros(len(joined), bool)
    blank[at + lengths - 1] = True
    joined[~blank] = data[spans[~blank]]
    first = np.cumsum(count) - count
    begin = np.flatnonzero(np.arange(len(doc)) - first[doc] <= np.maximum(count[doc] - SIZE, 0))
    final = np.minimum(begin + SIZE, (first + count)[doc[begin]]) - 1
    owner = doc[begin]
    bits = np.zeros((chunk.docs, 64), np.int64)
    for k in range(0, len(begin), SLICE):
        b, e, o = begin[k : k + SLICE], final[k : k + SLICE], owner[k : k + SLICE]
        base, top = int(at[b[0]]), int(at[e[-1]] + lengths[e[-1]])
        hashes = xxh64(joined[base:top], at[b] - base, at[e] + lengths[e] - 1 - at[b])
        flags = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        edges = np.flatnonzero(np.r_[True, o[1:] != o[:-1]])
        bits[o[edges]] += np.add.reduceat(flags, edges, axis=0, dtype=np.int32)
    total = np.bincount(owner, minlength=chunk.docs)
    return np.packbits(2 * bits > total[:, None], axis=1, bitorder="little").view("<u8").ravel()


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id, print`` (as a signed long) for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in slices.chunks(batch.column(1)):
                found = chunk_fingerprints(chunk).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(chunk.first, chunk.docs), pa.array(found)], ["id", "print"]
                )

    texts = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    return texts.mapInArrow(run, "id long, print long")


def reference_prints() -> np.ndarray:
    """72 references: row 0 of the result has the eight base references, row 1 + b the same with byte b inverted."""
    rows = [sum((bin(i & j).count("1") & 1) << j for j in range(8)) for i in range(8)]
    base = np.array([int.from_bytes(bytes([row] * 8), "little") for row in rows], np.uint64)
    inverted = np.array([0xFF << 8 * b for b in range(8)], np.uint64)
    return np.vstack([base, base ^ inverted[:, None]])


REFERENCES = reference_prints()
_FILE_KEYS = np.random.default_rng(64).integers(1, 1 << 63, (8, 8), dtype=np.uint64)


def distance_table(prints: np.ndarray) -> np.ndarray:
    """Hamming distances to all references, a row for each fingerprint."""
    return np.bitwise_count(prints[:, None] ^ REFERENCES.ravel())


def file_keys(prints: np.ndarray, bits: int) -> np.ndarray:
    """For each choice of ``bits`` bytes to leave out, a key of what the table says of the other bytes."""
    table = distance_table(prints).reshape(-1, 9, 8)
    # Distances to a reference and its inversion add up to more the fewer bits the byte has in common with it.
    differ = (table[:, :1] + np.uint8(8) - table[:, 1:]).astype(np.uint64)
    of_byte = (differ * _FILE_KEYS).sum(axis=2, dtype=np.uint64)
    whole = of_byte.sum(axis=1, dtype=np.uint64)
    keys = [
        slices.mix(whole - of_byte[:, list(left)].sum(axis=1, dtype=np.uint64) + np.uint64(k))
        for k, left in enumerate(combinations(range(8), bits))
    ]
    return np.stack(keys, axis=1)


def filed(nodes: DataFrame, bits: int) -> DataFrame:
    """``key, print``: every node in all of its files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            keys = file_keys(prints.view(np.uint64), bits)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.view(np.int64).ravel()), pa.array(np.repeat(prints, keys.shape[1]))], ["key", "print"]
            )

    return nodes.select("print").mapInArrow(run, "key long, print long")


def join_labels(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Give linked nodes one label, the smallest; before and after, every label is its own."""
    while len(a):
        high, low = np.maximum(labels[a], labels[b]), np.minimum(labels[a], labels[b])
        differ = high != low
        a, b, high, low = a[differ], b[differ], high[differ], low[differ]
        np.minimum.at(labels, high, low)
        while not np.array_equal(above := labels[labels], labels):
            labels[:] = above


def survivors(prints: np.ndarray, table: np.ndarray, a: np.ndarray, b: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that no column of the table discards, verified."""
    for columns in (slice(0, 8), slice(8, None)):
        x, y = table[a, columns], table[b, columns]
        near = (np.maximum(x, y) - np.minimum(x, y)).max(axis=1) <= bits
        a, b = a[near], b[near]
    near = np.bitwise_count(prints[a] ^ prints[b]) <= bits
    return a[near], b[near]


def small_pairs(starts: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of rows of each of the small files."""
    for size in np.unique(sizes):
        first = starts[sizes == size]
        x, y = np.triu_indices(int(size), 1)
        step = max(1, PAIRS // len(x))
        for k in range(0, len(first), step):
            some = first[k : k + step, None]
            yield (some + x).ravel(), (some + y).ravel()


def cell_pairs(table: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of one file, without those of cells that are too far apart; in slices of about ``PAIRS``."""
    cells, which, sizes = np.unique(table[:, :CELL_COLUMNS], axis=0, return_inverse=True, return_counts=True)
    rows = np.argsort(which.ravel(), kind="stable")
    begin = np.cumsum(sizes) - sizes
    cells = cells.astype(np.int16)
    step = max(1, PAIRS // len(cells))
    for k in range(0, len(cells), step):
        near = np.ones((len(cells[k : k + step]), len(cells)), bool)
        for column in range(CELL_COLUMNS):
            near &= np.abs(cells[k : k + step, column, None] - cells[None, :, column]) <= bits
        p, q = np.nonzero(near)
        p += k
        p, q = p[p <= q], q[p <= q]
        # A row of a cell against the rows of the other, or against the later rows of its own.
        left = slices.ragged(np.arange(len(rows)), begin[p], sizes[p])
        to = np.repeat(q, sizes[p])
        own = np.repeat(p == q, sizes[p])
        low = np.where(own, left + 1, begin[to])
        length = begin[to] + sizes[to] - low
        ends = np.cumsum(length)
        at = 0
        while at < len(left):
            upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS, side="right")))
            part = slice(at, upto)
            yield (
                rows[np.repeat(left[part], length[part])],
                rows[slices.ragged(np.arange(len(rows)), low[part], length[part])],
            )
            at = upto


def file_links(keys: np.ndarray, prints: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of whole files, sorted by key: a node and the first node of its part of the file."""
    edges = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1], True])
    starts, sizes = edges[:-1], np.diff(edges)
    labels = np.arange(len(keys))
    several = sizes > 1
    rows = slices.ragged(np.arange(len(keys)), starts[several], sizes[several])
    own = prints[rows]
    table = distance_table(own)
    starts, sizes = np.cumsum(sizes[several]) - sizes[several], sizes[several]
    labels = np.arange(len(own))
    little = sizes <= SMALL
    for a, b in small_pairs(starts[little], sizes[little]):
        join_labels(labels, *survivors(own, table, a, b, bits))
    for start, size in zip(starts[~little], sizes[~little], strict=True):
        within = slice(start, start + size)
        part = np.arange(size)
        for a, b in cell_pairs(table[within], bits):
            join_labels(part, *survivors(own[within], table[within], a, b, bits))
        labels[within] = part + start
    linked = labels != np.arange(len(own))
    return own[linked], own[labels[linked]]


def print_links(nodes: DataFrame, bits: int) -> DataFrame:
    """``a, b``: links of fingerprints that differ in at most ``bits`` bits, as many as join what is linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, prints = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            keys = np.r_[keys, batch.column(0).to_numpy(zero_copy_only=False)]
            prints = np.r_[prints, batch.column(1).to_numpy(zero_copy_only=False)]
            # The last file may go on in the next batch.
            whole = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0
            if whole:
                a, b = file_links(keys[:whole], prints[:whole].view(np.uint64), bits)
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])
                keys, prints = keys[whole:], prints[whole:]
        if len(keys):
            a, b = file_links(keys, prints.view(np.uint64), bits)
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    together = filed(nodes, bits).repartition("key").sortWithinPartitions("key")
    return together.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", bits: int = 2) -> DataFrame:
    """One row per document: id, ``fingerprint`` (16 hexadecimal digits) and ``component_id``, the smallest id that links of at
    most ``bits`` bits reach."""
    if not 0 <= bits <= 2:
        raise ValueError("bits must be 0, 1 or 2")
    prints = cut_lineage(fingerprints(docs, id_column, text_column))
    nodes = prints.groupBy("print").agg(F.min("id").alias("least"))
    labels = components(print_links(nodes, bits))
    owned = nodes.join(labels.withColumnRenamed("node", "print"), "print", "left").select(
        "print", "least", F.coalesce("component", "print").alias("component")
    )
    named = owned.groupBy("component").agg(F.min("least").alias("component_id"))
    of_print = owned.select("print", "component").join(named, "component").select("print", "component_id")
    return prints.join(of_print, "print").select(
        F.col("id").alias(id_column), F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id"
    )
