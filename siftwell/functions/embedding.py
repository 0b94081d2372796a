"""Default embedding: signed feature hashing of word tokens."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

# What lies between two words: everything that is in none.
BETWEEN_WORDS = "[^a-z0-9]+"
# The bytes of a token's SHA-256 that tell its position, most significant first, and the one that tells its sign.
POSITION_BYTES = slice(0, 4)
SIGN_BYTE = 4


def _component(token: str, dim: int) -> tuple[int, float]:
    """Position and sign of a token; the sign is plus where its byte is even."""
    digest = hashlib.sha256(token.encode("utf-8")).digest()
    position = int.from_bytes(digest[POSITION_BYTES], "big") % dim
    if digest[SIGN_BYTE] % 2 == 0:
        return position, 1.0
    return position, -1.0


def hash_vectors(lowered: pa.Array, dim: int) -> np.ndarray:
    """One row per text: summed components at unit length, or zeros for a text without tokens. Each
    distinct token of a batch is hashed once."""
    lists = pc.split_pattern_regex(pc.fill_null(lowered, ""), BETWEEN_WORDS)
    row = pc.list_parent_indices(lists).to_numpy()
    coded = lists.flatten().dictionary_encode()
    names = coded.dictionary.to_pylist()
    parts = [_component(name, dim) if name else (0, 0.0) for name in names]
    place = np.array([p for p, _ in parts], np.int64)
    sign = np.array([s for _, s in parts])
    code = coded.indices.to_numpy()
    cells = np.bincount(row * np.int64(dim) + place[code], sign[code], len(lowered) * dim)
    vectors = cells.reshape(len(lowered), dim)
    norms = np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
    return vectors / np.where(norms == 0, 1.0, norms)


def hash_embedding(text: Column, dim: int) -> Column:
    """Vector of a text, computed per Arrow batch where the text lies; nothing is shuffled."""

    @F.arrow_udf("array<float>")
    def embed(lowered: pa.Array) -> pa.Array:
        vectors = hash_vectors(lowered, dim).astype(np.float32)
        offsets = np.arange(len(lowered) + 1, dtype=np.int32) * dim
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(vectors.ravel()))

    return embed(F.lower(text))
