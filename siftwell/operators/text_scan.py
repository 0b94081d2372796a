"""BM25 top-k in one scan of the texts, with nothing shuffled but the best k per query.

The query terms go to every task, which their measured size has to allow. Tasks count them in each text, and
the counts are written; from these come the weights and, without opening a text again, the scores of a batch against all queries at once,
of which a task keeps the best k per query. Texts arrive lower-cased by Spark, so both ways of searching cut the same tokens.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwell.operators.knn import Hits, best_hits, top_candidates
from siftwell.operators.sizing import spread
from siftwell.session import scratch_path

SCORES = "qid long, doc_id long, score double, ceiling double"
COUNTS = "term string, df long, tokens long"
COUNTED = "doc_id long, eligible boolean, length long, terms array<int>, counts array<int>, held array<int>"
# What lies between two words: everything that is in none.
BETWEEN_WORDS = "[^a-z0-9]+"
SLICE_CELLS = 1 << 20
SLICE_ROWS = 1024
#: Texts cut into words together, unless one is longer.
SLICE_BYTES = 2 << 20


def text_slices(batch: pa.RecordBatch, rows: int) -> Iterator[pa.RecordBatch]:
    """A batch with ``lowered`` texts in slices of at most ``rows`` rows and about ``SLICE_BYTES``: words take many times their bytes."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column("lowered")), 0).to_numpy().astype(np.int64))
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        fits = int(np.searchsorted(ends, before + SLICE_BYTES, side="right"))
        end = min(max(fits, start + 1), start + rows)
        yield batch.slice(start, end - start)
        start = end


def term_counts(lowered: pa.Array, terms: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, term and count of every wanted term in every text, and the length of each text in tokens."""
    lists = pc.split_pattern_regex(pc.fill_null(lowered, ""), BETWEEN_WORDS)
    tokens, row = lists.flatten(), pc.list_parent_indices(lists).to_numpy()
    length = np.bincount(row[pc.not_equal(tokens, "").to_numpy(zero_copy_only=False)], minlength=len(lowered))
    term = pc.fill_null(pc.index_in(tokens, value_set=terms), -1).to_numpy()
    wanted = term >= 0
    pairs, counts = np.unique(row[wanted] * np.int64(len(terms)) + term[wanted], return_counts=True)
    return pairs // len(terms), pairs % len(terms), counts, length


def count_texts(texts: DataFrame, terms: list[str], phrases: list[str]) -> DataFrame:
    """Of each of ``texts(doc_id, eligible, lowered)`` its length (null for no text), the places of the wanted terms in it with their
    counts, and the places of the phrases it holds. Written to the shared folder, so that texts are read and moved once."""
    wanted = texts.sparkSession.sparkContext.broadcast((terms, phrases))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, phrases = wanted.value
        names = pa.array(terms, pa.string())
        for batch in batches:
            for part in text_slices(batch, batch.num_rows):
                lowered = part.column("lowered")
                row, term, tf, length = term_counts(lowered, names)
                edges = pa.array(np.r_[0, np.cumsum(np.bincount(row, minlength=len(lowered)))].astype(np.int32))
                filled = pc.fill_null(lowered, "")
                holds = [pc.match_substring(filled, phrase).to_numpy(zero_copy_only=False) for phrase in phrases]
                at, held = np.nonzero(np.stack(holds, axis=1)) if holds else (np.zeros(0, np.int64), np.zeros(0, np.int64))
                held_edges = pa.array(np.r_[0, np.cumsum(np.bincount(at, minlength=len(lowered)))].astype(np.int32))
                yield pa.record_batch(
                    [
                        part.column("doc_id"),
                        part.column("eligible"),
                        pa.array(length.astype(np.int64), mask=lowered.is_null().to_numpy(zero_copy_only=False)),
                        pa.ListArray.from_arrays(edges, pa.array(term.astype(np.int32))),
                        pa.ListArray.from_arrays(edges, pa.array(tf.astype(np.int32))),
                        pa.ListArray.from_arrays(held_edges, pa.array(held.astype(np.int32))),
                    ],
                    names=["doc_id", "eligible", "length", "terms", "counts", "held"],
                )

    path = scratch_path(texts.sparkSession, "counted-texts")
    texts.select("doc_id", "eligible", "lowered").mapInArrow(count, COUNTED).write.parquet(path)
    return texts.sparkSession.read.schema(COUNTED).parquet(path)


def scan_frequencies(counted: DataFrame, terms: list[str]) -> DataFrame:
    """``(term, df, tokens)`` of the given terms. The row without a term is about the whole corpus:
    its ``df`` is the number of texts, its ``tokens`` all of their tokens."""
    wanted = counted.sparkSession.sparkContext.broadcast(terms)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = pa.array(wanted.value, pa.string())
        df, n_texts, total = np.zeros(len(names), np.int64), 0, 0
        for batch in batches:
            if batch.num_rows:
                df += np.bincount(batch.column("terms").flatten().to_numpy(), minlength=len(names))
                n_texts += batch.num_rows - batch.column("length").null_count
                total += pc.sum(batch.column("length")).as_py() or 0
        yield pa.record_batch(
            [pa.concat_arrays([names, pa.nulls(1, pa.string())]), pa.array([*df, n_texts], pa.int64()),
             pa.array([0] * len(names) + [total], pa.int64())],
            names=["term", "df", "tokens"],
        )

    parts = counted.select("length", "terms").mapInArrow(count, COUNTS)
    return parts.groupBy("term").agg(F.sum("df").alias("df"), F.sum("tokens").alias("tokens"))


@dataclass(frozen=True)
class Weights:
    """Query terms as arrays: the entries of a term lie together, ``starts`` says where."""

    qids: np.ndarray
    terms: list[str]
    starts: np.ndarray
    query: np.ndarray
    idf: np.ndarray
    mean_length: float
    phrases: list[tuple[int, int]]
    ceilings: np.ndarray

    def scores(self, part: pa.RecordBatch, k1: float, b: float) -> np.ndarray:
        """Score of every query for every counted text; NaN where no term, or not every phrase, occurs."""
        n, lists = part.num_rows, part.column("terms")
        row = np.repeat(np.arange(n), np.diff(lists.offsets.to_numpy()))
        term, tf = lists.flatten().to_numpy(), part.column("counts").flatten().to_numpy()
        length = pc.fill_null(part.column("length"), 0).to_numpy()
        norm = k1 * (1 - b + b * length[row] / self.mean_length)
        saturation = tf * (k1 + 1) / (tf + norm)
        fan = self.starts[term + 1] - self.starts[term]
        first = np.repeat(self.starts[term] - np.r_[0, np.cumsum(fan)[:-1]], fan) if len(fan) else fan
        entry = first + np.arange(fan.sum())
        cell = np.repeat(row, fan) * len(self.qids) + self.query[entry]
        size = n * len(self.qids)
        score = np.bincount(cell, np.repeat(saturation, fan) * self.idf[entry], size).astype(np.float64)
        score[np.bincount(cell, minlength=size) == 0] = np.nan
        score = score.reshape(n, len(self.qids)).T
        if self.phrases:
            of = np.repeat(np.arange(n), np.diff(part.column("held").offsets.to_numpy()))
            held = part.column("held").flatten().to_numpy()
            for query, phrase in self.phrases:
                lacks = np.ones(n, bool)
                lacks[of[held == phrase]] = False
                score[query, lacks] = np.nan
        return np.round(score, 6)


def pack_weights(weights: pa.Table, mean_length: float, phrases: list[tuple[int, int]], most: float) -> Weights:
    """``phrases`` are places of phrases, terms are numbered as they first occur. ``weights`` has one row per (qid, term) with its idf, terms that occur nowhere included. A term adds at most ``most`` times its idf."""
    qid, idf = (weights[c].to_numpy() for c in ("qid", "idf"))
    qids, query = np.unique(qid, return_inverse=True)
    coded = weights["term"].combine_chunks().dictionary_encode()
    code = coded.indices.to_numpy(zero_copy_only=False)
    order = np.argsort(code, kind="stable")
    starts = np.r_[0, np.cumsum(np.bincount(code, minlength=len(coded.dictionary)))]
    place = {q: i for i, q in enumerate(qids.tolist())}
    known = [(place[q], phrase) for q, phrase in phrases if q in place]
    ceilings = most * np.bincount(query, idf, len(qids))
    return Weights(qids, coded.dictionary.to_pylist(), starts, query[order], idf[order], mean_length, known, ceilings)


def one_column_per_id(score: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows that share an id become one column with the best of their scores."""
    order = np.argsort(ids, kind="stable")
    sorted_ids = ids[order]
    first = np.flatnonzero(np.r_[True, sorted_ids[1:] != sorted_ids[:-1]])
    if len(first) == len(ids):
        return score, ids
    score = np.where(np.isnan(score), -np.inf, score)
    return np.maximum.reduceat(score[:, order], first, axis=1), sorted_ids[first]


def one_hit_per_id(hits: Hits) -> Hits:
    q, d, s = hits
    order = np.lexsort((-s, d, q))
    q, d, s = q[order], d[order], s[order]
    first = np.ones(len(q), bool)
    first[1:] = (q[1:] != q[:-1]) | (d[1:] != d[:-1])
    return q[first], d[first], s[first]


def scan_scores(counted: DataFrame, weights: Weights, k: int, k1: float, b: float) -> DataFrame:
    """``(qid, doc_id, score)``: the best k of every partition of counted texts."""
    shared = counted.sparkSession.sparkContext.broadcast(weights)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        best: Hits = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        step = max(1, min(SLICE_ROWS, SLICE_CELLS // max(1, len(w.qids))))
        for batch in batches:
            for start in range(0, batch.num_rows if len(w.qids) else 0, step):
                part = batch.slice(start, step)
                ids = part.column("doc_id").to_numpy()
                new = top_candidates(*one_column_per_id(w.scores(part, k1, b), ids), k)
                real = ~np.isneginf(new[2])
                joined = tuple(np.concatenate((o, n[real])) for o, n in zip(best, new))
                best = best_hits(one_hit_per_id(joined), k)
        yield pa.record_batch(
            [w.qids[best[0]], best[1], best[2], w.ceilings[best[0]]], names=["qid", "doc_id", "score", "ceiling"]
        )

    return counted.where("eligible").mapInArrow(scan, SCORES)


def lowered_texts(docs: DataFrame, id_col: str, text_col: str, eligible: Column | None = None) -> DataFrame:
    rule = F.lit(True) if eligible is None else F.coalesce(eligible, F.lit(False))
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), rule.alias("eligible"), F.col(text_col).alias("_text"))
    return spread(texts).select("doc_id", "eligible", F.lower("_text").alias("lowered"))
