"""Outputs made from result rows: contexts, optional columns, scored chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwell.config import CONTEXT_RESULTS, CONTEXT_TOKENS
from siftwell.functions import html, urls
from siftwell.functions.text import chunk_text, words
from siftwell.operators.topk import token_prefix, top_n


def search_context(
    results: DataFrame,
    max_tokens: int = CONTEXT_TOKENS,
    tokens: Column | None = None,
    max_results: int | None = CONTEXT_RESULTS,
) -> DataFrame:
    """``(qid, context)``: JSON array of (url, content) of the first ``max_results`` items that fit the token budget.

    A query whose first item does not fit gets ``[]``. What is gathered per query is bounded by the
    budget, as every item costs tokens.
    """
    first = results if max_results is None else results.where(F.col("rank") <= max_results)
    fitting = token_prefix(first, max_tokens, tokens).select(
        "qid", F.struct("rank", F.struct("url", "content").alias("item")).alias("entry")
    )
    entries = fitting.groupBy("qid").agg(F.array_sort(F.collect_list("entry")).alias("entries"))
    asked = results.select("qid").distinct()
    items = F.to_json(F.transform("entries", lambda e: e["item"]), {"ignoreNullFields": "false"})
    return asked.join(entries, "qid", "left").select("qid", F.coalesce(items, F.lit("[]")).alias("context"))


def with_optional(
    pages: DataFrame,
    raw_content: str | None = None,
    images: bool = False,
    favicon: bool = False,
    html_col: str = "html",
) -> DataFrame:
    """Adds the result columns that were asked for; what is not asked for is never computed."""
    page = F.col(html_col)
    added = []
    if raw_content is not None:
        added.append(html.html_extract(page, raw_content).getField("content").alias("raw_content"))
    if images:
        added.append(html.html_images(page).alias("images"))
    if favicon:
        added.append(F.concat(urls.origin(F.col("url")), F.lit("/favicon.ico")).alias("favicon"))
    return pages.select("*", *added).drop(html_col)


def chunks_per_source(
    extracted: DataFrame, n: int, words_per_chunk: int = 100, keys: tuple[str, ...] = ("qid", "url")
) -> DataFrame:
    """Best ``n`` chunks of each page for its query, by the share of query words they hold."""
    held = F.size(F.array_intersect(words(F.col("chunk")), F.col("_asked")))
    score = F.when(F.size("_asked") > 0, F.round(held / F.size("_asked"), 6)).otherwise(0.0)
    chunks = (
        extracted.select(
            *keys,
            F.array_distinct(words(F.col("query"))).alias("_asked"),
            chunk_text(F.col("content"), words_per_chunk).alias("_chunks"),
        )
        .select(*keys, "_asked", F.posexplode_outer("_chunks").alias("chunk_no", "chunk"))
        .filter(F.col("chunk").isNotNull())
        .withColumn("score", score)
    )
    best = top_n(chunks, list(keys), [F.desc("score"), F.asc("chunk_no")], n)
    return best.select(*keys, "rank", "chunk_no", "chunk", "score")
