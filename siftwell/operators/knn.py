"""Exact nearest rows: score eligible store rows against every query vector, keep the best k.

Scoring is a matrix product per Arrow batch inside the task. What leaves a task is the best k per
query, never a row per (query, document) pair. Vectors of the queries reach the tasks in one of two
ways, chosen by their measured size:

* at most ``budget`` bytes and ``SCAN_QUERIES`` queries: sent to every task once, and the store is scanned
  where it lies, without a shuffle;
* more: store and queries are dealt into a grid of blocks (rows to stripes by hash, so that no block
  is hot) and each block is scored on its own, in a task of its own. Content never travels, only ids and vectors.

Inside a task queries and rows meet in slices. Once a query has k hits, only pairs that may reach its k-th score are
rounded and sorted; for cosine, products in single precision tell which, and those pairs are multiplied again in double precision.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwell.config import METRICS, one_of
from siftwell.operators.sizing import BROADCAST_BYTES, rows_for
from siftwell.operators.topk import top_n

HITS = "tier int, qid long, doc_id long, score double"
BLOCK_ROWS = 65536
#: Queries in one block, and so many at most that are sent to all tasks: their number and that of the rows bound a task's work.
QUERY_ROWS = 16384
SCAN_QUERIES = 8192
#: Blocks of small inputs are cut down to so many rows and queries until there are so many blocks, so that every core has some.
LEAST_ROWS = 1024
LEAST_BLOCKS = 48
#: Blocks have a partition each while they are at most so many.
BLOCK_PARTITIONS = 4096
SLICE_QUERIES = 512
SLICE_ROWS = 4096
FIRST_ROWS = 256
#: Pairs multiplied again at once.
PAIRS = 1 << 16
#: Rounding to six decimals moves a score by less; so do single-precision products of unit vectors, per dimension a part of it.
ROUNDING = 1e-6
Hits = tuple[np.ndarray, np.ndarray, np.ndarray]


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Rows of a list column as one double matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    matrix = values.reshape(len(column), -1) if len(column) else values.reshape(0, 0)
    if len(column) and (np.diff(column.offsets.to_numpy()) != matrix.shape[1]).any():
        raise ValueError("All vectors must have one dimension.")
    return matrix


def _ids(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False) if isinstance(column, pa.Array) else column.to_numpy()


def _unit(matrix: np.ndarray) -> np.ndarray:
    norms = np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))
    with np.errstate(invalid="ignore", divide="ignore"):
        return matrix / norms


def _scores(queries: np.ndarray, rows: np.ndarray, metric: str) -> np.ndarray:
    """``1 - distance`` of every query to every row, rounded so that equal scores tie; for metrics other than cosine."""
    if metric == "dot":
        score = 1.0 + queries @ rows.T
    else:
        score = 1.0 - np.stack([_spread(rows, q, metric) for q in queries])
    return np.where(np.isnan(score), -np.inf, np.round(score, 6))


def _spread(rows: np.ndarray, query: np.ndarray, metric: str) -> np.ndarray:
    if metric == "hamming":
        return (rows != query).sum(axis=1).astype(np.float64)
    if metric == "jaccard":
        either = ((rows != 0) | (query != 0)).sum(axis=1)
        both = ((rows != 0) & (query != 0)).sum(axis=1)
        return np.where(either == 0, 0.0, 1.0 - both / np.maximum(either, 1))
    gap = rows - query
    if metric == "manhattan":
        return np.abs(gap).sum(axis=1)
    squared = (gap * gap).sum(axis=1)
    return np.sqrt(squared) if metric == "euclidean" else squared


def best_hits(hits: Hits, k: int) -> Hits:
    """The k best of each query: score descending, then id."""
    q, d, s = hits
    order = np.lexsort((d, -s, q))
    q, d, s = q[order], d[order], s[order]
    index = np.arange(len(q))
    first = np.r_[True, q[1:] != q[:-1]] if len(q) else np.zeros(0, bool)
    keep = index - np.maximum.accumulate(np.where(first, index, 0)) < k
    return q[keep], d[keep], s[keep]


def top_candidates(score: np.ndarray, ids: np.ndarray, k: int) -> Hits:
    """Pairs at or above each query's k-th score in this slice."""
    score = np.where(np.isnan(score), -np.inf, score)
    if score.shape[1] > k:
        floor = np.partition(score, score.shape[1] - k, axis=1)[:, [score.shape[1] - k]]
        q, r = np.nonzero(score >= floor)
    else:
        q, r = (a.ravel() for a in np.indices(score.shape))
    return best_hits((q, ids[r], score[q, r]), k)


class _Scorer:
    """Running best k per query and tier over the rows one task sees."""

    def __init__(self, qids: np.ndarray, vectors: np.ndarray, ks: list[int], metric: str, least: np.ndarray | None = None):
        """``least`` is a score of each query below which hits are of no use."""
        self.qids, self.ks, self.metric = qids, ks, metric
        self.vectors = _unit(vectors) if metric == "cosine" else vectors
        self.single = self.vectors.astype(np.float32) if metric == "cosine" else None
        self.least = np.full(len(qids), -np.inf) if least is None else least
        self.parts = [slice(at, at + SLICE_QUERIES) for at in range(0, len(qids), SLICE_QUERIES)]
        # Places of queries count within their slice.
        none = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        self.best: list[list[Hits]] = [[none for _ in self.parts] for _ in ks]
        self.floors = [self.least.copy() for _ in ks]
        self.seen = 0

    def add(self, ids: np.ndarray, rows: np.ndarray, eligible: list[np.ndarray], asking: np.ndarray | None = None) -> None:
        """Rows for all queries, or for those that are ``asking``."""
        if not len(self.qids) or not len(ids):
            return
        single = self.metric == "cosine"
        rows = _unit(rows) if single else rows
        # Unit vectors that are not numbers: what they meet has no score.
        odd, odd_asked = (~np.isfinite(side).all(axis=1) for side in (rows, self.vectors))
        start = 0
        while start < len(ids):
            # Few pairs reach a score that is the k-th of as many rows as the slice has.
            part = slice(start, min(start + min(SLICE_ROWS, max(FIRST_ROWS, self.seen)), len(ids)))
            start, self.seen = part.stop, self.seen + part.stop - part.start
            masks = [flags[part] for flags in eligible]
            if not any(mask.any() for mask in masks):
                continue
            own = rows[part].astype(np.float32) if single else rows[part]
            for n, asked in enumerate(self.parts):
                who = np.arange(asked.start, min(asked.stop, len(self.qids)))
                if asking is not None:
                    who = who[asking[asked]]
                    if not len(who):
                        continue
                if single:
                    score, slack = self.single[who] @ own.T, ROUNDING * (1 + own.shape[1] / 4)
                    score[:, odd[part]] = score[odd_asked[who]] = -np.inf
                else:
                    score, slack = _scores(self.vectors[who], own, self.metric), 0.0
                for tier, mask in enumerate(masks):
                    if mask.all():
                        self._keep(tier, n, who, score, slack, ids[part], rows[part], single)
                    elif mask.any():
                        self._keep(tier, n, who, score[:, mask], slack, ids[part][mask], rows[part][mask], single)

    def _keep(
        self, tier: int, n: int, who: np.ndarray, score: np.ndarray, slack: float, ids: np.ndarray, rows: np.ndarray, single: bool
    ) -> None:
        """Take over the pairs of one slice that may be among the best; ``score`` of the queries ``who`` is right up to ``slack``."""
        asked, k = self.parts[n], self.ks[tier]
        floor = self.floors[tier][who]
        least = floor
        if score.shape[1] > k and np.isneginf(floor).any():
            # So many rows of this slice score no less.
            least = np.maximum(floor, np.partition(score, score.shape[1] - k, axis=1)[:, score.shape[1] - k] - slack)
        pairs = np.flatnonzero(score >= (least - slack).astype(score.dtype)[:, None])
        if not len(pairs):
            return
        q, r = np.divmod(pairs, score.shape[1])
        if single:
            value = np.empty(len(pairs))
            for at in range(0, len(pairs), PAIRS):
                some = slice(at, at + PAIRS)
                value[some] = np.einsum("ij,ij->i", self.vectors[who[q[some]]], rows[r[some]])
            value = np.where(np.isnan(value), -np.inf, np.round(value, 6))
        else:
            value = score[q, r]
        high = value >= floor[q]
        if not high.any():
            return
        held, own = self.best[tier][n], who[q[high]] - asked.start
        q, d, s = best_hits(tuple(np.concatenate(p) for p in zip(held, (own, ids[r[high]], value[high]))), k)
        self.best[tier][n] = (q, d, s)
        least = self.least[asked]
        count = np.bincount(q, minlength=len(least))
        full = count == k
        self.floors[tier][asked] = np.where(full, np.maximum(s[np.maximum(np.cumsum(count) - 1, 0)], least), least)

    def table(self) -> pa.Table:
        none = (np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        found = [
            (np.full(len(d), tier, np.int32), q + asked.start, d, s)
            for tier, best in enumerate(self.best)
            for asked, (q, d, s) in zip(self.parts, best)
        ]
        tiers, q, d, s = (np.concatenate(columns) for columns in zip(none, *found))
        scores = pa.array(s, mask=np.isneginf(s))
        return pa.table({"tier": tiers, "qid": self.qids[q], "doc_id": d, "score": scores})


def _eligible_rows(
    store: DataFrame, tiers: list[tuple[Column, int]], id_col: str, vec_col: str
) -> DataFrame:
    """Ids and vectors of rows that some tier may return, with one flag per tier."""
    flags = [F.coalesce(rule, F.lit(False)) for rule, _ in tiers]
    some = flags[0]
    for flag in flags[1:]:
        some = some | flag
    return store.filter(F.col(vec_col).isNotNull() & some).select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(vec_col).cast("array<float>").alias("vec"),
        *[flag.alias(f"t{i}") for i, flag in enumerate(flags)],
    )


def _stripe(column: str, n: int) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(n)).cast("int")


def _copies(n: int) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))


def score_blocks(
    rows: DataFrame, queries: DataFrame, keys: list[str], ks: list[int], metric: str, blocks: int
) -> DataFrame:
    """Score rows and queries that share block ``keys``; emits the best k of each block.

    There are about ``blocks`` of them; a single key numbers them from 0. Their work is the product of their sides and has little
    to do with their bytes, by which partitions would be put together, so the number of partitions is given.
    """

    def one_block(left: pa.Table, right: pa.Table) -> pa.Table:
        q = right if right.num_rows else right.slice(0, 0)
        scorer = _Scorer(_ids(q["qid"]), _matrix(q["qvec"]), ks, metric)
        for start in range(0, left.num_rows if q.num_rows else 0, SLICE_ROWS):
            some = left.slice(start, SLICE_ROWS)
            flags = [_ids(some[f"t{i}"]).astype(bool) for i in range(len(ks))]
            scorer.add(_ids(some["doc_id"]), _matrix(some["vec"]), flags)
        return scorer.table()

    def dealt(side: DataFrame) -> DataFrame:
        if len(keys) == 1 and blocks <= BLOCK_PARTITIONS:
            return side.repartitionById(blocks, F.col(keys[0]))
        return side.repartition(max(1, min(blocks, BLOCK_PARTITIONS)), *keys)

    rows, queries = dealt(rows), dealt(queries)
    return rows.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInArrow(one_block, HITS)


def _scan_scored(rows: DataFrame, q: DataFrame, ks: list[int], metric: str) -> DataFrame:
    packed = q.toArrow()
    shared = rows.sparkSession.sparkContext.broadcast((_ids(packed["qid"]), _matrix(packed["qvec"])))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(*shared.value, ks, metric)
        for batch in batches:
            if batch.num_rows:
                flags = [_ids(batch.column(f"t{i}")).astype(bool) for i in range(len(ks))]
                scorer.add(_ids(batch.column("doc_id")), _matrix(batch.column("vec")), flags)
        yield from scorer.table().to_batches()

    return rows.mapInArrow(scan, HITS)


def knn_tiers(
    store: DataFrame,
    queries: DataFrame,
    tiers: list[tuple[Column, int]],
    metric: str = "cosine",
    id_col: str = "doc_id",
    vec_col: str = "embeddings",
    budget: int = BROADCAST_BYTES,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``(tier, qid, rank, doc_id, score)``: the best k of each tier's rows for every query.

    All tiers are scored in one scan of the store, whatever the number of tiers.
    """
    one_of(metric, METRICS, "metric")
    spark = store.sparkSession
    wanted = [(i, rule, k) for i, (rule, k) in enumerate(tiers) if k >= 1]
    nothing = spark.createDataFrame([], "tier int, qid long, rank int, doc_id long, score double")
    if not wanted:
        return nothing
    ks = [k for _, _, k in wanted]
    rows = _eligible_rows(store, [(rule, k) for _, rule, k in wanted], id_col, vec_col)
    q = queries.filter(F.col("qvec").isNotNull()).select(
        F.col("qid").cast("long"), F.col("qvec").cast("array<float>").alias("qvec")
    )
    n_queries, q_bytes = q.agg(
        F.count("*"), F.coalesce(F.sum(F.size("qvec").cast("long") * 8 + 8), F.lit(0))
    ).first()
    if n_queries == 0:
        return nothing
    if q_bytes <= budget and n_queries <= SCAN_QUERIES:
        scored = _scan_scored(rows, q, ks, metric)
    else:
        n_rows = rows.count()
        bands = max(math.ceil(q_bytes / budget), math.ceil(n_queries / QUERY_ROWS), min(math.isqrt(LEAST_BLOCKS), n_queries // LEAST_ROWS))
        stripes = max(1, math.ceil(n_rows / block_rows), min(math.ceil(LEAST_BLOCKS / bands), n_rows // LEAST_ROWS))
        block = F.col("row_block") * bands + F.col("q_block")
        scored = score_blocks(
            rows.withColumn("row_block", _stripe("doc_id", stripes)).withColumn("q_block", _copies(bands)).withColumn("block", block),
            q.withColumn("q_block", _stripe("qid", bands)).withColumn("row_block", _copies(stripes)).withColumn("block", block),
            ["block"],
            ks,
            metric,
            stripes * bands,
        )
    numbered = top_n(
        scored, ["tier", "qid"], [F.desc_nulls_last("score"), F.asc("doc_id")], max(ks)
    )
    limit = F.element_at(F.array(*[F.lit(k) for k in ks]), F.col("tier") + 1)
    original = F.element_at(F.array(*[F.lit(i) for i, _, _ in wanted]), F.col("tier") + 1)
    return numbered.filter(F.col("rank") <= limit).select(
        original.alias("tier"), "qid", "rank", "doc_id", "score"
    )


def knn(
    store: DataFrame,
    queries: DataFrame,
    k: int,
    metric: str = "cosine",
    eligible: Column | None = None,
    **options,
) -> DataFrame:
    """``(qid, rank, doc_id, score)``: the best ``k`` eligible rows of each query; k < 1 gives none."""
    rule = F.lit(True) if eligible is None else eligible
    return knn_tiers(store, queries, [(rule, k)], metric, **options).drop("tier")


def nearest_similarity(
    candidates: DataFrame, store: DataFrame, eligible: Column | None = None, **options
) -> DataFrame:
    """``(qid, similarity)``: the best cosine score of each candidate; no row if nothing is eligible."""
    best = knn(store, candidates, 1, eligible=eligible, **options)
    return best.select("qid", F.col("score").alias("similarity"))


def attach_content(
    hits: DataFrame, store: DataFrame, id_col: str = "doc_id", columns: tuple[str, ...] = ("content",)
) -> DataFrame:
    """Late materialisation: ranked ids first, wide columns joined to the few that remain."""
    wide = store.select(F.col(id_col).cast("long").alias("doc_id"), *columns)
    return rows_for(hits, wide, "doc_id")


def project_local(hits: DataFrame) -> DataFrame:
    return hits.select("qid", "rank", "doc_id", "content", "score", F.lit("local").alias("origin"))


def project_foreign(foreign: DataFrame) -> DataFrame:
    return foreign.select(
        "qid",
        "rank",
        F.lit(None).cast("long").alias("doc_id"),
        "content",
        "score",
        F.lit("foreign").alias("origin"),
    )
