"""Exact token counts of every prefix of a text, by dynamic programming over a sentencepiece BPE vocabulary.

White space is escaped, and no piece of the vocabulary holds white space after another character (this is checked
on loading). So a text falls into units, each a run of blanks and the characters after it, and its encoding is that
of its units one after the other. Within a unit, the encoding of a prefix ends with the only token whose
neighbour on the left is a last token that it does not merge with: for each position the last token and the number of tokens follow from
an earlier position. Whether two adjacent tokens stay apart is found once by merging the two and remembered. Characters
outside the vocabulary count as many tokens as they have bytes.

Units of a chunk are told apart by vectorised hashes, and each distinct one is counted once. The counts at unit
ends, with the counts inside a unit, answer how many tokens any prefix has and where a token budget
ends, without encoding again. Null and empty texts have no tokens. Special strings inside texts are
ordinary text. The caches are emptied when full; results do not depend on them.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from siftwell.llm import slices

BLANK = "▁"
CACHE_UNITS = 300_000
CACHE_PAIRS = 1_000_000
NEVER = float("-inf")


class PrefixCounter:
    def __init__(self, model_path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        if model.normalize("A  Å\n") != f"{BLANK}A{BLANK}{BLANK}Å\n":
            raise ValueError("Only models that leave text as it is, with a blank in front, can be counted by units.")
        plain = (
            k
            for k in range(model.get_piece_size())
            if not (model.is_control(k) or model.is_unknown(k) or model.is_byte(k) or model.is_unused(k))
        )
        self.scores = {model.id_to_piece(k): model.get_score(k) for k in plain}
        if any(BLANK in piece.lstrip(BLANK) for piece in self.scores):
            raise ValueError("A piece goes on after a blank, so units cannot be counted apart.")
        # Pieces that merging never makes from their own characters end no prefix.
        self.tokens = {p for p in self.scores if len(p) == 1 or self.merge(p) == [p]}
        finder = ahocorasick.Automaton()
        for token in self.tokens:
            finder.add_word(token, token)
        finder.make_automaton()
        #: All tokens inside a text: by where they end, the longest first.
        self.matches = finder.iter
        self.pairs: dict[tuple[str, str], bool] = {}
        self.units: dict[tuple[bool, bytes], tuple[int, ...]] = {}

    def merge(self, text: str) -> list[str]:
        """The pieces of a short text: the pair of the best score is joined first, the leftmost of equals."""
        parts, get = list(text), self.scores.get
        scores = [get(a + b, NEVER) for a, b in zip(parts, parts[1:])]
        while scores:
            best = max(scores)
            if best == NEVER:
                break
            k = scores.index(best)
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
            del scores[k]
            if k < len(scores):
                scores[k] = get(parts[k] + parts[k + 1], NEVER)
            if k:
                scores[k - 1] = get(parts[k - 1] + parts[k], NEVER)
        return parts

    def apart(self, left: str, right: str) -> bool:
        """Whether two tokens stay as they are when they are neighbours."""
        found = self.merge(left + right) == [left, right]
        if len(self.pairs) >= CACHE_PAIRS:
            self.pairs.clear()
        self.pairs[left, right] = found
        return found

    def prefixes(self, unit: str) -> tuple[int, ...]:
        """Token counts of the first 0, 1, 2, ... characters of a unit."""
        n, pairs = len(unit), self.pairs
        counts, last = [0] * (n + 1), [""] * (n + 1)
        done = 0
        for end, token in self.matches(unit):
            end += 1
            if end <= done:
                continue
            while end > done + 1:
                self._outside(unit, done + 1, counts, last)
                done += 1
            start = end - len(token)
            before = last[start]
            if before:
                apart = pairs.get((before, token))
                if not (self.apart(before, token) if apart is None else apart):
                    continue
            counts[end], last[end] = counts[start] + 1, token
            done = end
        for end in range(done + 1, n + 1):
            self._outside(unit, end, counts, last)
        return tuple(counts)

    def _outside(self, unit: str, end: int, counts: list[int], last: list[str]) -> None:
        """A position that no token ends: its character is outside the vocabulary and merges with nothing."""
        if unit[end - 1] in self.tokens:
            raise ValueError(f"No token ends the prefix {unit[:end]!r}.")
        counts[end] = counts[end - 1] + len(unit[end - 1].encode())
        last[end] = ""

    def unit(self, key: tuple[bool, bytes]) -> tuple[int, ...]:
        """Counts at the prefixes of a unit; the first of a text has a blank put in front, which is not a position."""
        first, raw = key
        text = raw.decode().replace(" ", BLANK)
        counts = self.prefixes(BLANK + text)[1:] if first else self.prefixes(text)
        if len(raw) <= 64:
            if len(self.units) >= CACHE_UNITS:
                self.units.clear()
            self.units[key] = counts
        return counts

    def chunk(self, chunk: slices.Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[tuple[int, ...]]]:
        """Unit starts and ends, tokens before each unit in its text, the distinct unit of each, and their counts."""
        data, offsets = chunk.data, chunk.offsets
        blank = data == 0x20
        if (data == 0xE2).any():
            found = np.flatnonzero((data[:-2] == 0xE2) & (data[1:-1] == 0x96) & (data[2:] == 0x81))
            for k in range(3):
                blank[found + k] = True
        opens = blank.copy()
        opens[1:] &= ~blank[:-1]
        begin = offsets[:-1][np.diff(offsets) > 0]
        opens[begin] = True
        starts = np.flatnonzero(opens)
        ends = np.r_[starts[1:], len(data)][: len(starts)]
        first = np.zeros(len(data), bool)
        first[begin] = True
        first = first[starts]
        keys = slices.hash_spans(data, starts, ends) ^ np.where(first, np.uint64(0x5851F42D4C957F2D), np.uint64(0))
        _, one, which = np.unique(keys, return_index=True, return_inverse=True)
        raw = data.tobytes()
        known, unit = self.units.get, self.unit
        distinct = []
        for f, a, b in zip(first[one].tolist(), starts[one].tolist(), ends[one].tolist()):
            key = (f, raw[a:b])
            distinct.append(known(key) or unit(key))
        total = np.fromiter((c[-1] for c in distinct), np.int64, len(distinct))[which]
        running = np.cumsum(total) - total
        edges = np.searchsorted(starts, offsets[:-1])
        doc = np.searchsorted(offsets, starts, side="right") - 1
        at_start = np.r_[running, 0][np.minimum(edges, len(running))]
        return starts, ends, running - at_start[doc], which, distinct

    def count(self, text: str | None) -> int:
        return self.prefix_counts(text)[-1]

    def prefix_counts(self, text: str | None) -> list[int]:
        """Token counts of all prefixes of a text, by characters."""
        part = next(slices.chunks(pa.array([text or ""])))
        _, _, before, which, distinct = self.chunk(part)
        out = [0]
        for base, k in zip(before.tolist(), which.tolist()):
            out += [base + c for c in distinct[k][1:]]
        return out


@lru_cache(2)
def load(model_path: str) -> PrefixCounter:
    return PrefixCounter(model_path)


def prefix_table(docs: DataFrame, model_path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Id, ``ends`` (the byte at which each unit of the text ends) and ``tokens`` (of the prefix up to there)."""
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = load(model_path)
        for batch in batches:
            for chunk in slices.chunks(batch.column(1)):
                starts, ends, before, which, distinct = counter.chunk(chunk)
                own = np.fromiter((c[-1] for c in distinct), np.int64, len(distinct))[which]
                edges = np.searchsorted(starts, chunk.offsets)
                doc = np.searchsorted(chunk.offsets, starts, side="right") - 1
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(chunk.first, chunk.docs),
                        slices.gather(ends - chunk.offsets[doc], edges),
                        slices.gather(before + own, edges),
                    ],
                    [id_column, "ends", "tokens"],
                )

    return docs.select(id_column, text_column).mapInArrow(run, f"`{id_column}` {kind}, ends array<long>, tokens array<long>")


def budget(
    docs: DataFrame, model_path: str, limit: int, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Per document: id, ``n_bytes``, ``n_tokens``, ``over_limit``, and ``bytes_within``, the longest prefix of whole
    characters that has at most ``limit`` tokens. No shuffle."""
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = load(model_path)
        for batch in batches:
            for chunk in slices.chunks(batch.column(1)):
                starts, ends, before, which, distinct = counter.chunk(chunk)
                own = np.fromiter((c[-1] for c in distinct), np.int64, len(distinct))[which]
                edges = np.searchsorted(starts, chunk.offsets)
                size = np.diff(chunk.offsets)
                n_tokens = np.zeros(chunk.docs, np.int64)
                has = edges[1:] > edges[:-1]
                n_tokens[has] = (before + own)[edges[1:][has] - 1]
                within = size.copy()
                for d in np.flatnonzero(n_tokens > limit).tolist():
                    units = slice(edges[d], edges[d + 1])
                    k = edges[d] + int(np.searchsorted((before + own)[units], limit, side="right"))
                    a, b = int(starts[k]), int(ends[k])
                    fits = [c for c, n in enumerate(distinct[which[k]]) if before[k] + n <= limit]
                    inside = len(chunk.data[a:b].tobytes().decode()[: fits[-1]].encode()) if fits else 0
                    within[d] = a - chunk.offsets[d] + inside
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(chunk.first, chunk.docs),
                        pa.array(size),
                        pa.array(n_tokens),
                        pa.array(n_tokens > limit),
                        pa.array(within),
                    ],
                    [id_column, "n_bytes", "n_tokens", "over_limit", "bytes_within"],
                )

    schema = f"`{id_column}` {kind}, n_bytes long, n_tokens long, over_limit boolean, bytes_within long"
    return docs.select(id_column, text_column).mapInArrow(run, schema)


def truncate(docs: DataFrame, model_path: str, limit: int, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with each text cut to its longest prefix of at most ``limit`` tokens; null stays null, other columns as they are."""
    at = docs.columns.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = load(model_path)
        for batch in batches:
            cut = []
            for text in batch.column(at).to_pylist():
                counts = counter.prefix_counts(text) if text else [0]
                cut.append(text and text[: max(k for k, n in enumerate(counts) if n <= limit)])
            yield batch.set_column(at, batch.schema.field(at), pa.array(cut, batch.schema.field(at).type))

    return docs.mapInArrow(run, docs.schema)
