"""Search over a corpus table: filters first, then lexical ranking."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwell.operators import filters
from siftwell.operators.results import with_optional
from siftwell.operators.sizing import rows_for
from siftwell.operators.text_index import text_search


@dataclass(frozen=True)
class SearchParams:
    max_results: int = 5
    topic: str | list[str] | None = None
    country: str | None = None
    time_range: str | None = None
    days: int | None = None
    start: datetime | None = None
    end: datetime | None = None
    include_domains: list[str] = field(default_factory=list)
    exclude_domains: list[str] = field(default_factory=list)
    exact_match: bool = False
    raw_content: str | None = None
    images: bool = False
    favicon: bool = False


def eligible_pages(corpus: DataFrame, params: SearchParams, now: datetime) -> DataFrame:
    return corpus.filter(
        filters.has_facets(params.topic, params.country)
        & filters.published_within(now, params.time_range, params.start, params.end, params.days)
        & filters.in_domains("url", params.include_domains, params.exclude_domains)
    )


def exact_match(queries: DataFrame, results: DataFrame) -> DataFrame:
    """Results, per query, holding every quoted phrase of it; a query without quotes keeps all."""
    asked = queries.select("qid", F.col("query").alias("_asked"))
    kept = results.join(asked, "qid").filter(filters.contains_phrases(F.col("_asked"), F.col("content")))
    return kept.drop("_asked")


def table_search(queries: DataFrame, corpus: DataFrame, params: SearchParams, now: datetime) -> DataFrame:
    """``(qid, rank, url, title, content, score)``: best matches among pages passing the filters.

    Statistics cover the pages that pass. Phrases are tested before the cut to ``max_results``. Raw content ('text' or 'markdown'),
    images and favicons are made from the ``html`` of the pages returned, where they are asked for.
    """
    pages = eligible_pages(corpus, params, now)
    ranked = text_search(pages, queries, params.max_results, phrases=params.exact_match)
    columns = ["doc_id", "url", "title", "content"]
    if params.raw_content is None and not params.images and not params.favicon:
        return rows_for(ranked, pages.select(columns), "doc_id").select("qid", "rank", *columns, "score")
    whole = rows_for(ranked, pages.select(*columns, "html"), "doc_id").select("qid", "rank", *columns, "score", "html")
    return with_optional(whole, params.raw_content, params.images, params.favicon)
