"""Top-n per key, and the ranked outputs built on it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftwell.functions.text import preview_text, token_count

# Catalyst trims each partition before the shuffle for limits up to this size
# (spark.sql.optimizer.windowGroupLimitThreshold); larger limits are trimmed in a salted stage.
GROUP_LIMIT = 1000
SALTS = 64


def top_n(
    df: DataFrame, keys: list[str], order: list[Column], n: int, rank_col: str = "rank"
) -> DataFrame:
    """The first ``n`` rows of each key, numbered from 1.

    A key may hold most of the rows, so no task sorts a whole key: up to ``GROUP_LIMIT`` Catalyst
    plans a WindowGroupLimit below the exchange, and beyond it each key is first cut in ``SALTS``
    parts. Both are exact, as a row in the first n overall is in the first n of its part.
    """
    if n < 1:
        return df.withColumn(rank_col, F.lit(0)).filter(F.lit(False))
    if n > GROUP_LIMIT:
        salt = F.pmod(F.xxhash64(*[F.col(c) for c in _hashable(df)]), F.lit(SALTS))
        part = Window.partitionBy(*keys, "_salt").orderBy(*order)
        df = (
            df.withColumn("_salt", salt)
            .withColumn("_pos", F.row_number().over(part))
            .filter(F.col("_pos") <= n)
            .drop("_salt", "_pos")
        )
    whole = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(whole)).filter(F.col(rank_col) <= n)


def _hashable(df: DataFrame) -> list[str]:
    return [c for c, t in df.dtypes if not t.startswith("map")]


def topk_per_query(scored: DataFrame, n: int, id_col: str = "doc_id") -> DataFrame:
    """Nearest first: by score, ties by id. A row without a score comes last."""
    return top_n(scored, ["qid"], [F.desc_nulls_last("score"), F.asc(id_col)], n)


def rank_by_score(results: DataFrame, n: int) -> DataFrame:
    """Default ranker over merged results: a missing score counts as 0, and ties keep local rows
    before foreign ones, each in their own order."""
    ordered = results.withColumnRenamed("rank", "source_rank").withColumn(
        "_origin", F.when(F.col("origin") == "local", 0).otherwise(1)
    )
    order = [F.desc(F.coalesce("score", F.lit(0.0))), F.asc("_origin"), F.asc("source_rank")]
    return top_n(ordered, ["qid"], order, n).drop("_origin", "source_rank")


def token_prefix(
    items: DataFrame, max_tokens: int, tokens: Column | None = None, order: str = "rank"
) -> DataFrame:
    """Longest run of items, in rank order, whose tokens fit the budget; stops at the first overflow.

    ``tokens`` defaults to the count over the JSON of (url, content). Every item costs at least one
    token, so only the first ``max_tokens`` items of a query can matter and the running sum sees no
    more than those.
    """
    if tokens is None:
        tokens = token_count(F.to_json(F.struct("url", "content")))
    counted = items.withColumn("tokens", F.greatest(tokens.cast("long"), F.lit(1)))
    head = top_n(counted, ["qid"], [F.asc(order)], max_tokens, "_pos").drop("_pos")
    running = Window.partitionBy("qid").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        head.withColumn("total_tokens", F.sum("tokens").over(running))
        .filter(F.col("total_tokens") <= max_tokens)
    )


def persist_select(foreign: DataFrame, threshold: float | None, cap: int | None) -> DataFrame:
    """Rows to save: those scoring enough, and of them the first ``cap`` in arrival order."""
    if threshold is not None:
        foreign = foreign.filter(F.col("score") >= threshold)
    if cap is None:
        return foreign
    return top_n(foreign, ["qid"], [F.asc("rank")], cap, "_pos").drop("_pos")


def company_info(foreign: DataFrame, topics: tuple[str, ...], n: int) -> DataFrame:
    """Best ``n`` results over several topics; ties keep topic order, then arrival order."""
    position = F.array_position(F.array(*[F.lit(t) for t in topics]), F.col("topic"))
    fanned = (
        foreign.filter(F.col("topic").isin(list(topics)))
        .withColumnRenamed("rank", "source_rank")
        .withColumn("_topic", position)
    )
    order = [F.desc_nulls_last("score"), F.asc("_topic"), F.asc("source_rank")]
    return top_n(fanned, ["qid"], order, n).drop("_topic", "source_rank")


def persisted_listing(store: DataFrame, n: int = 10, keys: tuple[str, ...] = ("retrieval_query",)) -> DataFrame:
    """The most recently seen rows of each retrieval query, with previews."""
    order = [F.desc_nulls_last("last_seen_at"), F.desc_nulls_last("retrieval_timestamp"), F.asc("doc_id")]
    listed = top_n(store, list(keys), order, n)
    return listed.select(
        *keys,
        "rank",
        "memory_scope",
        "retrieval_mode",
        "cache_hit",
        "query_count",
        preview_text(F.coalesce("source_title", F.lit("")), 40).alias("source_title"),
        preview_text(F.substring(F.coalesce("content", F.lit("")), 1, 120), 90).alias("preview"),
    )


def result_preview(results: DataFrame, n: int = 5) -> DataFrame:
    """Display rows: rank, origin, the score with four decimals ('' if missing), one-line content."""
    shown = top_n(results.withColumnRenamed("rank", "source_rank"), ["qid"], [F.asc("source_rank")], n)
    return shown.select(
        "qid",
        "rank",
        F.coalesce("origin", F.lit("")).alias("origin"),
        F.when(F.col("score").isNotNull(), F.format_string("%.4f", "score")).otherwise("").alias("score"),
        preview_text(F.coalesce("content", F.lit(""))).alias("preview"),
    )
