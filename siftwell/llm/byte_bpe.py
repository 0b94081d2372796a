"""Byte-level BPE encoding and decoding.

Pre-tokenisation runs over all code points of a chunk at once. Every code point gets a symbol: letter,
number, other, blank or further white space from a class table, with two kinds of apostrophe (one that a one- or
two-letter contraction follows) and two kinds of white space (the last of a run before a word, or not) told apart
by looking at the next code points. A finite automaton over these symbols says where a token begins. Its
transitions are functions from state to state, and composing functions is associative: the text is cut
into short rows, the functions of all rows are composed side by side, the rows' functions are chained, and then
all rows are run again from their true states. No regular expression runs over text.

The slices between boundaries are looked up in a cache of merged tokens; missing ones are merged pair by pair, the
lowest rank first. Every text keeps the offsets of its tokens' bytes, so that any range of ids can be
decoded to its range of bytes. Null and empty texts have no ids. The cache is emptied when full, so memory stays
bounded; results do not depend on it. A text that is not valid UTF-8 cannot occur in a Spark string.
"""

from __future__ import annotations

import base64
import sys
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame

from siftwell.llm import slices

CACHE_TOKENS = 400_000
#: Pre-tokens of up to so many bytes are merged in batches.
BATCHED_BYTES = 48
NO_RANK = (1 << 31) - 1
ROW = 256

# Symbols of the automaton, then its states. LETTER..SPACE serve as both.
LETTER, NUMBER, OTHER, BLANK, SPACE, LAST_BLANK, LAST_SPACE, QUOTE1, QUOTE2 = range(9)
AWAIT1, AWAIT2, CONTRACTED, START = 5, 6, 7, 8
STATES = 9
#: Added to the symbol of a text's first code point: whatever the state, go on as from START.
FIRST = 9


def _automaton() -> tuple[np.ndarray, np.ndarray]:
    """Next state, and whether a token begins, by symbol and state."""
    step = np.zeros((2 * FIRST, STATES), np.uint8)
    begins = np.ones((2 * FIRST, STATES), bool)
    for state in range(STATES):
        for symbol in range(9):
            to, new = symbol, True
            if state in (AWAIT1, AWAIT2):
                to, new = (CONTRACTED if state == AWAIT1 else AWAIT1), False
            elif symbol in (LETTER, NUMBER, OTHER):
                new = state not in (symbol, BLANK)
            elif symbol in (BLANK, SPACE):
                to, new = SPACE, state != SPACE
            elif symbol == LAST_BLANK:
                to = BLANK
            elif symbol == LAST_SPACE:
                to = START
            else:
                after_blank_or_other = state in (BLANK, OTHER)
                to = OTHER if after_blank_or_other else (AWAIT1 if symbol == QUOTE1 else AWAIT2)
                new = not after_blank_or_other
            step[symbol, state], begins[symbol, state] = to, new
    step[FIRST:] = step[:FIRST, START, None]
    return step, begins


STEP, BEGINS = _automaton()


@lru_cache(1)
def code_point_classes() -> np.ndarray:
    """LETTER, NUMBER, BLANK, SPACE or OTHER for every code point.

    Unicode versions differ in their newest letters, so the properties are those that tiktoken is built with: a
    byte-wise encoding of a class gives back the bytes that belong to it.
    """
    table = np.full(sys.maxunicode + 1, OTHER, np.uint8)
    every = "".join(chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000)
    byte_ranks = {bytes([b]): b for b in range(256)}
    for kind, name in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        found = bytes(tiktoken.Encoding("class", pat_str=name, mergeable_ranks=byte_ranks, special_tokens={}).encode_ordinary(every))
        table[np.frombuffer(found.decode().encode("utf-32-le"), np.uint32)] = kind
    table[0x20] = BLANK
    return table


def symbols(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The automaton's input; ``first`` flags the first code point of every text."""
    kinds = code_point_classes()[points]
    n = len(points)
    white = kinds >= BLANK
    ahead = np.zeros(n, bool)
    ahead[:-1] = ~white[1:] & ~first[1:]
    out = kinds + (white & ahead).view(np.uint8) * np.uint8(LAST_BLANK - BLANK)

    quotes = np.flatnonzero(points == 39)
    if len(quotes):
        padded = np.r_[points, np.zeros(2, points.dtype)]
        starts = np.r_[first, [True, True]]
        one, two = padded[quotes + 1], padded[quotes + 2]
        has_one = ~starts[quotes + 1]
        has_two = has_one & ~starts[quotes + 2]
        single = has_one & np.isin(one, [ord(c) for c in "stmd"])
        pairs = [(ord(a), ord(b)) for a, b in ("re", "ve", "ll")]
        double = has_two & np.logical_or.reduce([(one == a) & (two == b) for a, b in pairs])
        out[quotes[single]] = QUOTE1
        out[quotes[double]] = QUOTE2
    out[first] += FIRST
    return out


def token_starts(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Which code points begin a pre-token."""
    n = len(points)
    if n == 0:
        return np.zeros(0, bool)
    rows = -(-n // ROW)
    grid = np.zeros(rows * ROW, np.intp)
    grid[:n] = symbols(points, first)
    grid = np.ascontiguousarray(grid.reshape(rows, ROW).T) * STATES
    step = STEP.reshape(-1)
    # The transition function of every row, composed symbol by symbol over all rows at once.
    function = np.tile(np.arange(STATES, dtype=np.uint8), (rows, 1))
    for k in range(ROW):
        function = step[grid[k][:, None] + function]
    state = np.empty(rows, np.uint8)
    now = START
    for r, f in enumerate(function.tolist()):
        state[r] = now
        now = f[now]
    begins = BEGINS.reshape(-1)
    out = np.empty((ROW, rows), bool)
    for k in range(ROW):
        at = grid[k] + state
        out[k] = begins[at]
        state = step[at]
    return np.ascontiguousarray(out.T).reshape(-1)[:n]


class ByteBPE:
    """Encoder and decoder over a file of ranks, one "base64 rank" pair per line."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            pairs = (line.split() for line in lines if line.strip())
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.tokens: list[bytes] = [b""] * (max(self.ranks.values(), default=-1) + 1)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        splits = (
            (self.ranks[t[:k]] * len(self.tokens) + self.ranks[t[k:]], rank)
            for t, rank in self.ranks.items()
            for k in range(1, len(t))
            if t[:k] in self.ranks and t[k:] in self.ranks
        )
        pairs = np.array(sorted(splits), np.int64).reshape(-1, 2)
        self.pair_keys, self.pair_values = np.r_[pairs[:, 0], np.iinfo(np.int64).max], np.r_[pairs[:, 1], NO_RANK]
        self.token_lengths = np.array([len(t) for t in self.tokens], np.int64)
        self.token_starts = np.cumsum(self.token_lengths) - self.token_lengths
        self.token_bytes = np.frombuffer(b"".join(self.tokens), np.uint8)
        written = [b"%d," % k for k in range(len(self.tokens))]
        self.decimal_lengths = np.array([len(w) for w in written], np.int64)
        self.decimal_starts = np.cumsum(self.decimal_lengths) - self.decimal_lengths
        self.decimal_bytes = np.frombuffer(b"".join(written), np.uint8)
        self.cache: dict[bytes, tuple[int, ...]] = {}

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair of ids joined, or NO_RANK."""
        key = left.astype(np.int64) * len(self.tokens) + right
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where((self.pair_keys[at] == key) & (left >= 0) & (right >= 0), self.pair_values[at], NO_RANK).astype(np.int32)

    def merge_all(self, pieces: list[bytes]) -> list[tuple[int, ...]]:
        """The ids of pre-tokens of like length: one merge in each per step, the lowest rank and then the leftmost."""
        lengths = np.array([len(p) for p in pieces])
        width, rows = int(lengths.max()), np.arange(len(pieces))
        ids = np.full((len(pieces), width + 1), -1, np.int32)
        flat = np.frombuffer(b"".join(pieces), np.uint8)
        ids[np.arange(width + 1)[None, :] < lengths[:, None]] = self.byte_ids[flat]
        ranks = self.pair_ranks(ids[:, :-1], ids[:, 1:])
        columns = np.arange(width + 1)
        live = rows
        while True:
            at = ranks[live].argmin(axis=1)
            best = ranks[live, at]
            has = best < NO_RANK
            if not has.any():
                break
            live, at, best = live[has], at[has], best[has]
            k, part, old = np.arange(len(live)), ids[live], ranks[live]
            after = columns[None, :] > at[:, None]
            part[:, :-1] = np.where(after[:, :-1], part[:, 1:], part[:, :-1])
            part[k, at] = best
            old[:, :-1] = np.where(after[:, :-2], old[:, 1:], old[:, :-1])
            old[:, -1] = NO_RANK
            old[k, at] = self.pair_ranks(best, part[k, at + 1])
            before = np.maximum(at - 1, 0)
            old[k, before] = np.where(at > 0, self.pair_ranks(part[k, before], best), old[k, before])
            ids[live], ranks[live] = part, old
        return [tuple(r[r >= 0].tolist()) for r in ids]

    def merge(self, piece: bytes) -> tuple[int, ...]:
        rank = self.ranks.get(piece)
        return (rank,) if rank is not None else self._merge_long([piece[k : k + 1] for k in range(len(piece))])

    def _merge_long(self, parts: list[bytes]) -> tuple[int, ...]:
        """The same with a heap, for pre-tokens of thousands of bytes."""
        from heapq import heapify, heappop, heappush

        n, get = len(parts), self.ranks.get
        right = list(range(1, n + 1))
        left = list(range(-1, n - 1))
        heap = [(r, k, 2) for k in range(n - 1) if (r := get(parts[k] + parts[k + 1])) is not None]
        heapify(heap)
        while heap:
            _, k, size = heappop(heap)
            if parts[k] is None or right[k] >= n or len(parts[k]) + len(parts[right[k]]) != size:
                continue
            j = right[k]
            parts[k] += parts[j]
            parts[j] = None
            right[k] = right[j]
            if right[j] < n:
                left[right[j]] = k
                if (r := get(parts[k] + parts[right[k]])) is not None:
                    heappush(heap, (r, k, len(parts[k]) + len(parts[right[k]])))
            if left[k] >= 0:
                p = left[k]
                if (r := get(parts[p] + parts[k])) is not None:
                    heappush(heap, (r, p, len(parts[p]) + len(parts[k])))
        return tuple(self.ranks[p] for p in parts if p is not None)

    def learn(self, pieces: list[bytes]) -> list[tuple[int, ...]]:
        """The ids of pre-tokens that the cache does not have; they are put into it."""
        out: list = [None] * len(pieces)
        short = []
        for k, piece in enumerate(pieces):
            if (rank := self.ranks.get(piece)) is not None:
                out[k] = (rank,)
            elif len(piece) <= BATCHED_BYTES:
                short.append(k)
            else:
                out[k] = self.merge(piece)
        short.sort(key=lambda k: len(pieces[k]))
        for at in range(0, len(short), 2048):
            block = short[at : at + 2048]
            for k, ids in zip(block, self.merge_all([pieces[k] for k in block])):
                out[k] = ids
        if len(self.cache) + len(pieces) > CACHE_TOKENS:
            self.cache.clear()
        self.cache.update(zip(pieces, out))
        return out

    def ids_of(self, pieces: list[bytes]) -> list[tuple[int, ...]]:
        """The ids of distinct pre-tokens, from the cache where it has them."""
        found = list(map(self.cache.get, pieces))
        missing = [k for k, ids in enumerate(found) if ids is None]
        for k, ids in zip(missing, self.learn([pieces[k] for k in missing])):
            found[k] = ids
        return found

    def encode_chunk(self, chunk: slices.Chunk) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the chunk's texts, and where each text's ids begin (and the last end)."""
        raw = chunk.data.tobytes()
        points = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), np.uint32)
        lead = np.flatnonzero(slices.IS_LEAD[chunk.data])
        first = np.zeros(len(points), bool)
        place = np.searchsorted(lead, chunk.offsets[:-1])
        first[place[place < len(points)]] = True
        starts = lead[token_starts(points, first)]
        ends = np.r_[starts[1:], len(raw)]
        # Equal slices are looked up once.
        _, one, which = np.unique(slices.hash_spans(chunk.data, starts, ends), return_index=True, return_inverse=True)
        pieces = [raw[a:b] for a, b in zip(starts[one].tolist(), ends[one].tolist())]
        found = self.ids_of(pieces)
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        table = np.fromiter(chain.from_iterable(found), np.int32, int(lengths.sum()))
        own = lengths[which]
        ids = slices.ragged(table, (np.cumsum(lengths) - lengths)[which], own)
        per_piece = np.r_[0, np.cumsum(own)]
        return ids, per_piece[np.searchsorted(starts, chunk.offsets)]

    def encode(self, text: str | None) -> list[int]:
        return self.encode_chunk(next(slices.chunks(pa.array([text or ""]))))[0].tolist()

    def decode_flat(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of all ids, one after the other."""
        return slices.ragged(self.token_bytes, self.token_starts[ids], self.token_lengths[ids])

    def decimals(self, ids: np.ndarray) -> np.ndarray:
        """All ids in decimal digits, a comma after each."""
        return slices.ragged(self.decimal_bytes, self.decimal_starts[ids], self.decimal_lengths[ids])

    def decode(self, ids) -> bytes:
        return self.decode_flat(np.asarray(ids, np.int64)).tobytes()

    def offsets(self, ids) -> np.ndarray:
        """Where each token begins in the text's bytes, and the end."""
        return np.r_[0, np.cumsum(self.token_lengths[np.asarray(ids, np.int64)])]

    def decode_range(self, ids: list[int], offsets: np.ndarray, start: int, end: int) -> tuple[bytes, int, int]:
        """The bytes of ``ids[start:end]`` and their range in the text."""
        return self.decode(ids[start:end]), int(offsets[start]), int(offsets[end])


@lru_cache(2)
def load(path: str) -> ByteBPE:
    """One encoder per worker and file."""
    return ByteBPE(path)


def encode(docs: DataFrame, ranks_path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Id, ``ids`` and ``starts`` (the byte offset of each token) per document. No shuffle."""
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(ranks_path)
        for batch in batches:
            for chunk in slices.chunks(batch.column(1)):
                ids, edges = bpe.encode_chunk(chunk)
                starts = bpe.offsets(ids)[:-1] - np.repeat(chunk.offsets[:-1], np.diff(edges))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(chunk.first, chunk.docs),
                        slices.gather(ids, edges),
                        slices.gather(starts, edges),
                    ],
                    [id_column, "ids", "starts"],
                )

    return docs.select(id_column, text_column).mapInArrow(run, f"`{id_column}` {kind}, ids array<int>, starts array<long>")


def decode(encoded: DataFrame, ranks_path: str, id_column: str = "doc_id", ids_column: str = "ids") -> DataFrame:
    """Id and ``text`` from ids. Ids that end inside a character give U+FFFD there; null ids give a null text."""
    kind = encoded.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(ranks_path)
        for batch in batches:
            texts = [None if i is None else bpe.decode(i).decode("utf-8", "replace") for i in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], [id_column, "text"])

    return encoded.select(id_column, ids_column).mapInArrow(run, f"`{id_column}` {kind}, text string")


def round_trip(docs: DataFrame, ranks_path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per document: id, number of tokens, and digests of the ids and of the text decoded from them."""
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(ranks_path)
        for batch in batches:
            for chunk in slices.chunks(batch.column(1)):
                ids, edges = bpe.encode_chunk(chunk)
                text, decimal = memoryview(bpe.decode_flat(ids)), memoryview(bpe.decimals(ids))
                in_text = np.r_[0, np.cumsum(bpe.token_lengths[ids])][edges].tolist()
                in_decimal = np.r_[0, np.cumsum(bpe.decimal_lengths[ids])][edges].tolist()
                text_sha = [sha256(text[a:b]).hexdigest() for a, b in zip(in_text, in_text[1:])]
                # Without the comma after the last id.
                ids_sha = [sha256(decimal[a : max(a, b - 1)]).hexdigest() for a, b in zip(in_decimal, in_decimal[1:])]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(chunk.first, chunk.docs),
                        pa.array(np.diff(edges)),
                        pa.array(ids_sha),
                        pa.array(text_sha),
                    ],
                    [id_column, "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    schema = f"`{id_column}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select(id_column, text_column).mapInArrow(run, schema)


def encode_documents(docs: DataFrame, ranks_path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Every column of ``docs`` but the text, which is replaced by its ``ids``, ``n_tokens`` and the SHA-256 of the
    bytes that the ids decode to. A row that decodes to other bytes than its text had is an error. Columns of ``docs``
    with one of these three names give way."""
    added = ["ids", "n_tokens", "decoded_sha256"]
    kept = [c for c in docs.columns if c not in (text_column, *added)]
    fields = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(ranks_path)
        for batch in batches:
            for chunk in slices.chunks(batch.column(len(kept))):
                ids, edges = bpe.encode_chunk(chunk)
                plain = bpe.decode_flat(ids)
                if not np.array_equal(plain, chunk.data):
                    raise ValueError("Decoding does not give back the text.")
                view = memoryview(plain)
                digests = [sha256(view[a:b]).hexdigest() for a, b in zip(chunk.offsets.tolist(), chunk.offsets[1:].tolist())]
                rest = batch.slice(chunk.first, chunk.docs)
                yield pa.RecordBatch.from_arrays(
                    [*(rest.column(k) for k in range(len(kept))), slices.gather(ids, edges), pa.array(np.diff(edges)), pa.array(digests)],
                    [*kept, *added],
                )

    schema = ", ".join([*fields, "ids array<int>", "n_tokens long", "decoded_sha256 string"])
    return docs.select(*kept, text_column).mapInArrow(run, schema)
