"""Retrieval flows: every query of a table answered in one plan.

Each flow returns ``(qid, rank, doc_id, content, score, origin)``. ``now`` is an argument, ``foreign``
is a table of ranked results per query (a corpus search or stored responses).
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftwell.config import RetrievalConfig
from siftwell.functions.vectors import distance, score_from_distance
from siftwell.operators import filters
from siftwell.operators.knn import attach_content, knn, knn_tiers, project_foreign, project_local
from siftwell.operators.sizing import rows_for
from siftwell.operators.text_blocks import TextIndex, index_search
from siftwell.operators.text_index import text_search
from siftwell.operators.topk import rank_by_score, top_n, topk_per_query
from siftwell.session import cut_lineage

# Scopes each tier accepts.
CACHE_SCOPES = ("cache_only", "cache_plus_memory")
MEMORY_SCOPES = ("cache_plus_memory",)
RESULT_COLUMNS = ["qid", "rank", "doc_id", "content", "score", "origin"]
LAST_TIER = 99

Ranker = Callable[[DataFrame, int], DataFrame]


def fuse_scores(candidates: DataFrame) -> DataFrame:
    """``max(vector_score) + max(text_score)`` per query and document over unioned candidates."""
    return candidates.groupBy("qid", "doc_id").agg(
        F.round(F.max("vector_score") + F.max("text_score"), 6).alias("score")
    )


def vector_scores(pairs: DataFrame, store: DataFrame, queries: DataFrame, metric: str) -> DataFrame:
    """Vector score of given (qid, doc_id) pairs, by two equi joins."""
    score = score_from_distance(distance(metric, F.col("qvec"), F.col("embeddings")))
    return (
        rows_for(pairs, store.select(F.col("doc_id"), "embeddings"), "doc_id")
        .join(queries.select("qid", "qvec"), "qid")
        .withColumn("vector_score", F.round(score, 6))
        .drop("embeddings", "qvec")
    )


def hybrid_candidates(
    store: DataFrame,
    queries: DataFrame,
    k: int,
    metric: str = "cosine",
    eligible: Column | None = None,
    index: TextIndex | None = None,
) -> DataFrame:
    """Union of the best k by vector and the best k by text; a document may come from both.

    With an ``index`` of the store's texts no text is read; without one they are scanned."""
    rule = F.col("embeddings").isNotNull() if eligible is None else eligible & F.col("embeddings").isNotNull()
    by_vector = knn(store, queries, k, metric, rule).select(
        "qid", "doc_id", F.col("score").alias("vector_score"), F.lit(0.0).alias("text_score")
    )
    if index is None:
        hits = text_search(store, queries, k, rule)
    else:
        hits = index_search(index, queries, k, store.filter(rule).select("doc_id"))
    hits = hits.withColumnRenamed("score", "text_score")
    by_text = vector_scores(hits, store, queries, metric)
    return by_vector.unionByName(by_text.select("qid", "doc_id", "vector_score", "text_score"))


def native_hybrid_hits(
    store: DataFrame,
    queries: DataFrame,
    k: int,
    metric: str = "cosine",
    eligible: Column | None = None,
    index: TextIndex | None = None,
) -> DataFrame:
    """``(qid, rank, doc_id, score)`` by fused score. A query without words is answered by vector."""
    if k < 1:
        return knn(store, queries, k, metric)
    return topk_per_query(fuse_scores(hybrid_candidates(store, queries, k, metric, eligible, index)), k)


def native_hybrid(
    queries: DataFrame,
    store: DataFrame,
    cfg: RetrievalConfig,
    now: datetime | None = None,
    index: TextIndex | None = None,
) -> DataFrame:
    hits = native_hybrid_hits(
        store, queries, cfg.local_limit, cfg.metric, filters.matches_metadata(cfg.metadata_filters), index
    )
    return project_local(attach_content(hits, store))


def local_tiers(
    queries: DataFrame,
    store: DataFrame,
    cfg: RetrievalConfig,
    tiers: list[tuple[Column, int]],
    index: TextIndex | None = None,
) -> DataFrame:
    """``(tier, qid, rank, doc_id, score)`` for each tier's rule and k; one scan when by vector."""
    metadata = filters.matches_metadata(cfg.metadata_filters)
    tiers = [(rule & metadata, k) for rule, k in tiers]
    if not cfg.native_hybrid:
        return knn_tiers(store, queries, tiers, cfg.metric)
    parts = [
        native_hybrid_hits(store, queries, k, cfg.metric, rule, index).withColumn("tier", F.lit(i))
        for i, (rule, k) in enumerate(tiers)
    ]
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    return merged


def capped_foreign(foreign: DataFrame, n: int) -> DataFrame:
    """The first ``n`` foreign results of each query in arrival order; 0 turns foreign results off."""
    return top_n(foreign.withColumnRenamed("rank", "source_rank"), ["qid"], [F.asc("source_rank")], n)


def merge_local_foreign(local: DataFrame, foreign: DataFrame) -> DataFrame:
    return local.unionByName(foreign)


def hybrid_search(
    queries: DataFrame,
    store: DataFrame,
    cfg: RetrievalConfig,
    now: datetime,
    foreign: DataFrame,
    ranker: Ranker | None = None,
    index: TextIndex | None = None,
) -> DataFrame:
    """Local and foreign results ranked together, best ``max_results``.

    The default ranker needs only scores, so content is joined to the returned rows. Another ranker
    sees whole candidates.
    """
    hits = local_tiers(queries, store, cfg, [(F.lit(True), cfg.local_limit)], index).drop("tier")
    fetched = project_foreign(capped_foreign(foreign, cfg.foreign_limit))
    if ranker is not None:
        merged = merge_local_foreign(project_local(attach_content(hits, store)), fetched)
        return top_n(
            ranker(merged, cfg.max_results).withColumnRenamed("rank", "source_rank"),
            ["qid"],
            [F.asc("source_rank")],
            cfg.max_results,
        ).select(RESULT_COLUMNS)
    local = project_local(hits.withColumn("content", F.lit(None).cast("string")))
    return with_store_content(rank_by_score(merge_local_foreign(local, fetched), cfg.max_results), store)


def with_store_content(results: DataFrame, store: DataFrame) -> DataFrame:
    """Fill the content of local rows after ranking, when only the returned rows are left.

    Foreign rows bring their content and stay out of the join; the ids of local rows go to the store, not the store to them.
    """
    ranked = cut_lineage(results.select(RESULT_COLUMNS))
    is_local = F.col("origin") == "local"
    local = ranked.filter(is_local).drop("content")
    filled = rows_for(local, store.select("doc_id", "content"), "doc_id").select(RESULT_COLUMNS)
    return filled.unionByName(ranked.filter(~is_local))


def pandas_ranker(rank: Callable[[pd.DataFrame, int], pd.DataFrame]) -> Ranker:
    """A ranker from a function over the candidates of one query, which are at most its local and
    foreign limits; it returns them in order and may change the score."""

    def ranked(merged: DataFrame, n: int) -> DataFrame:
        def one_query(candidates: pd.DataFrame) -> pd.DataFrame:
            best = rank(candidates.sort_values(["origin", "rank"], ascending=[False, True]), n).head(n)
            return best.assign(rank=range(1, len(best) + 1))

        return merged.groupBy("qid").applyInPandas(one_query, merged.schema)

    return ranked


def first_answering_tier(hits: DataFrame) -> DataFrame:
    """Of each query keep the rows of its lowest ``tier``: one hit ends the search."""
    lowest = F.min("tier").over(Window.partitionBy("qid"))
    return hits.withColumn("_lowest", lowest).filter(F.col("tier") == F.col("_lowest")).drop("_lowest")


def tier_fallback(queries: DataFrame, hits: DataFrame) -> DataFrame:
    """Queries that a tier left unanswered."""
    return queries.join(hits.select("qid").distinct(), "qid", "left_anti")


def cache_tiers(
    store: DataFrame, cfg: RetrievalConfig, now: datetime
) -> list[tuple[Column, int, float]]:
    """Rule, number of rows and least score of each local tier of a cache mode.

    ``freshness_cache`` looks at fresh rows of any scope; ``cache_then_memory`` at fresh scoped rows,
    then at durable rows of any age.
    """
    fresh = filters.is_fresh(store.columns, cfg.cache_ttl_seconds, now, cfg.timestamp_column)
    if cfg.retrieval_mode == "freshness_cache":
        return [(fresh, cfg.local_limit, cfg.cache_score_threshold)]
    scoped = fresh & filters.in_scopes(store.columns, CACHE_SCOPES)
    durable = filters.in_scopes(store.columns, MEMORY_SCOPES)
    return [
        (scoped, cfg.local_limit, cfg.cache_score_threshold),
        (durable, cfg.memory_limit, cfg.memory_score_threshold),
    ]


def tier_hits(
    queries: DataFrame, store: DataFrame, cfg: RetrievalConfig, now: datetime, index: TextIndex | None = None
) -> DataFrame:
    """``(tier, qid, rank, doc_id, score)``: rows of every local tier that score enough. The cut to
    the tier's k comes before the threshold."""
    tiers = cache_tiers(store, cfg, now)
    floor = F.element_at(F.array(*[F.lit(least) for _, _, least in tiers]), F.col("tier") + 1)
    hits = local_tiers(queries, store, cfg, [(rule, k) for rule, k, _ in tiers], index)
    return hits.filter(F.col("score") >= floor)


def tiered_results(
    queries: DataFrame, store: DataFrame, cfg: RetrievalConfig, hits: DataFrame, foreign: DataFrame
) -> DataFrame:
    """Rows of each query's first tier that answers, foreign results being the last one.

    Every part holds at most its k rows per query, so the tier choice and the final cut are windows
    over small groups and share one exchange on ``qid``. Nothing is topped up or ranked again.
    """
    asked = queries.select("qid").distinct()
    fallback = capped_foreign(foreign.join(asked, "qid", "left_semi"), cfg.foreign_limit)
    columns = [*RESULT_COLUMNS, "tier"]
    local = hits.withColumn("content", F.lit(None).cast("string")).withColumn("origin", F.lit("local"))
    merged = local.select(columns).unionByName(
        project_foreign(fallback).withColumn("tier", F.lit(LAST_TIER)).select(columns)
    )
    answered = first_answering_tier(merged).withColumnRenamed("rank", "source_rank")
    cut = top_n(answered, ["qid"], [F.asc("source_rank")], cfg.max_results)
    return with_store_content(cut, store)


def freshness_cache(
    queries: DataFrame,
    store: DataFrame,
    cfg: RetrievalConfig,
    now: datetime,
    foreign: DataFrame,
    index: TextIndex | None = None,
) -> DataFrame:
    """Fresh rows scoring enough, else foreign results in arrival order."""
    return tiered_results(queries, store, cfg, tier_hits(queries, store, cfg, now, index), foreign)


def cache_then_memory(
    queries: DataFrame,
    store: DataFrame,
    cfg: RetrievalConfig,
    now: datetime,
    foreign: DataFrame,
    index: TextIndex | None = None,
) -> DataFrame:
    """Fresh cache, then durable memory of any age, then foreign results."""
    return tiered_results(queries, store, cfg, tier_hits(queries, store, cfg, now, index), foreign)
