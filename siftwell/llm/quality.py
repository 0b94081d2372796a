"""Quality rules by compression bands.

A text is rejected when it has too few words, when too many of its words lie in repeated three-word
windows, or when Zstandard says that it is too repetitive or hardly compressible: the ratio of
compressed to plain bytes must lie in a band that depends on the length, both for the whole text and
for its fixed chunks. Short texts compress badly, so their bands are wide. A text fails by its chunks only if more
than ``bad_chunks`` of them lie outside the band of a chunk, so that one table or code block in a
long text does no harm.

Null and empty texts have no words and are rejected by the first rule. Rows are judged one by one:
repeated rows get equal verdicts, and columns of the input other than the two named are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from siftwell.llm import slices

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True

SCHEMA = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, ratio double, chunks_outside double, kept boolean"
)


@dataclass(frozen=True)
class Bands:
    """Ratios of compressed to plain bytes that pass, by length: (least bytes, lowest, highest)."""

    by_length: tuple[tuple[int, float, float], ...] = (
        (0, 0.0, 9.0),
        (256, 0.25, 0.90),
        (1024, 0.22, 0.78),
        (4096, 0.20, 0.70),
        (32768, 0.18, 0.66),
    )
    chunk_bytes: int = 4096
    bad_chunks: float = 0.5
    level: int = 3

    def limits(self, n_bytes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        least = np.array([b[0] for b in self.by_length])
        at = np.searchsorted(least, n_bytes, side="right") - 1
        return np.array([b[1] for b in self.by_length])[at], np.array([b[2] for b in self.by_length])[at]


@dataclass(frozen=True)
class Rules:
    min_words: int = 50
    max_repeat_percent: int = 50
    bands: Bands = field(default_factory=Bands)


def compression(chunk: slices.Chunk, bands: Bands) -> tuple[np.ndarray, np.ndarray]:
    """Each text's ratio, and the share of its fixed chunks outside their band."""
    press = zstandard.ZstdCompressor(level=bands.level, write_checksum=False, write_content_size=False)
    view, size = memoryview(chunk.data), bands.chunk_bytes
    ratio, outside = np.ones(chunk.docs), np.zeros(chunk.docs)
    for k in range(chunk.docs):
        start, end = int(chunk.offsets[k]), int(chunk.offsets[k + 1])
        if start == end:
            continue
        ratio[k] = len(press.compress(view[start:end])) / (end - start)
        if end - start > size:
            lengths = np.array([min(size, end - at) for at in range(start, end, size)])
            packed = np.array([len(press.compress(view[at : min(at + size, end)])) for at in range(start, end, size)])
            low, high = bands.limits(lengths)
            outside[k] = np.mean((packed < low * lengths) | (packed > high * lengths))
    return ratio, outside


def measures(chunk: slices.Chunk, rules: Rules) -> dict[str, np.ndarray]:
    data, offsets, docs = chunk.data, chunk.offsets, chunk.docs
    starts, ends, doc = slices.words(data, offsets)
    n_words = np.bincount(doc, minlength=docs)
    lead = slices.IS_LEAD[data] & ~slices.IS_SPACE[data]

    first, last, line_doc = slices.lines(data, offsets)
    inside = np.zeros(len(data) + 1, np.int64)
    np.cumsum(~slices.IS_SPACE[data], out=inside[1:])
    has_word = inside[last] > inside[first]
    line_doc = line_doc[has_word]
    own = slices.hash_spans(data, first[has_word], last[has_word])
    distinct = np.unique(slices.mix(own + line_doc.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03)), return_index=True)[1]
    n_lines = np.bincount(line_doc, minlength=docs)
    n_distinct = np.bincount(line_doc[distinct], minlength=docs)

    at, window = slices.windows(slices.hash_spans(data, starts, ends), doc, 3)
    keyed = slices.mix(window + doc[at].astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
    _, which, times = np.unique(keyed, return_inverse=True, return_counts=True)
    again = at[times[which] > 1]
    repeated = np.zeros(len(starts) + 2, bool)
    for k in range(3):
        repeated[again + k] = True
    n_repeat = np.bincount(doc[repeated[: len(starts)]], minlength=docs)

    base_failed = (n_words < rules.min_words) | (100 * n_repeat > rules.max_repeat_percent * n_words)
    ratio, outside = compression(chunk, rules.bands)
    low, high = rules.bands.limits(np.diff(offsets))
    passed = (ratio >= low) & (ratio <= high) & (outside <= rules.bands.bad_chunks)
    return {
        "n_words": n_words,
        "word_chars": slices.per_text(lead, offsets),
        "n_symbols": slices.per_text(SYMBOLS[data], offsets),
        "n_dup_lines": n_lines - n_distinct,
        "n_repeat_words": n_repeat,
        "base_failed": base_failed,
        "ratio": ratio,
        "chunks_outside": outside,
        "kept": passed & ~base_failed,
    }


def judge(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", rules: Rules | None = None) -> DataFrame:
    """One row per document: its id, the measures and the verdict. No shuffle."""
    rules = rules or Rules()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in slices.chunks(batch.column(1)):
                found = measures(chunk, rules)
                ids = batch.column(0).slice(chunk.first, chunk.docs)
                yield pa.RecordBatch.from_arrays(
                    [ids, *(pa.array(v.astype(np.int64) if v.dtype.kind in "iu" else v) for v in found.values())],
                    [id_column, *found],
                )

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(id_column, text_column).mapInArrow(run, f"`{id_column}` {kind}, {SCHEMA}")


def keep_good(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", rules: Rules | None = None) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns, in one pass and without a join."""
    rules = rules or Rules()
    at = docs.columns.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in slices.chunks(batch.column(at)):
                kept = measures(chunk, rules)["kept"]
                yield batch.slice(chunk.first, chunk.docs).filter(pa.array(kept))

    return docs.mapInArrow(run, docs.schema)
