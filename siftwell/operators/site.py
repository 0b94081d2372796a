"""Pages as a site: link edges, URL lookup, breadth-first crawls and site maps."""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwell.functions import html, urls
from siftwell.functions.text import LOWER_WORD, best_chunks, words
from siftwell.operators.filters import follows_url_rules
from siftwell.operators.sizing import rows_for, spread
from siftwell.operators.topk import top_n
from siftwell.session import cut_lineage


#: Pages that hold less of a crawl's instructions, by weight, are left out.
LEAST_RELEVANCE = 0.25


def page_links(pages: DataFrame) -> DataFrame:
    """``(page_id, url, link_pos, dst_url)``: every web link of every page, in absolute form, relative to the page's own base."""
    links = F.posexplode_outer(html.html_links(F.col("html"))).alias("link_pos", "href")
    return (
        spread(pages.select("page_id", "url", "html"))
        .select("page_id", "url", html.html_base(F.col("html")).alias("base"), links)
        .filter(F.col("href").isNotNull())
        .withColumn("base", F.coalesce(urls.resolve(F.col("url"), F.col("base")), F.col("url")))
        .withColumn("dst_url", urls.resolve(F.col("base"), F.col("href")))
        .filter(F.col("dst_url").rlike("^https?://"))
        .drop("href", "base")
    )


def known_urls(pages: DataFrame) -> DataFrame:
    """``(match_url, page_id)``: one page per normalised URL, without reading page bodies."""
    return (
        pages.select(urls.normalize(F.col("url")).alias("match_url"), "page_id")
        .groupBy("match_url")
        .agg(F.min("page_id").alias("page_id"))
    )


def link_edges(pages: DataFrame) -> DataFrame:
    """Links with the page they lead to, where there is one."""
    known = known_urls(pages).withColumnRenamed("page_id", "dst_page_id")
    links = page_links(pages).withColumn("match_url", urls.normalize(F.col("dst_url")))
    return links.join(known, "match_url", "left").select(
        F.col("url").alias("src_url"), "link_pos", "dst_url", "dst_page_id"
    )


def discover_urls(pages: DataFrame) -> DataFrame:
    """Distinct known and linked URLs of each host."""
    found = pages.select(urls.without_fragment(F.col("url")).alias("url")).unionByName(
        page_links(pages).select(F.col("dst_url").alias("url"))
    )
    return found.distinct().select(urls.host(F.col("url")).alias("host"), "url")


def extract_match(requested: DataFrame, pages: DataFrame) -> DataFrame:
    """``requested`` with ``page_id`` and ``status``: ok where the URL is known, else failed."""
    wanted = requested.withColumn("match_url", urls.normalize(F.col("url")))
    asked = pages.withColumn("match_url", urls.normalize(F.col("url"))).join(
        wanted.select("match_url").distinct(), "match_url", "left_semi"
    )
    return wanted.join(known_urls(asked), "match_url", "left").drop("match_url").withColumn(
        "status", F.when(F.col("page_id").isNotNull(), "ok").otherwise("failed")
    )


def extract(
    requested: DataFrame,
    pages: DataFrame,
    format: str = "text",
    images: bool = False,
    favicon: bool = False,
    chunks: int | None = None,
    words_per_chunk: int = 100,
) -> DataFrame:
    """Content of requested URLs. Matching reads no bodies; a page that matches is parsed once,
    however often it was requested.

    ``images`` and ``favicon`` add columns of that name. With ``chunks``, requests that have a ``query`` get that many chunks of
    the page for it, the best first; they are chosen where the content lies.
    """
    body = html.html_extract(F.col("html"), format)
    columns = [body.getField("title").alias("title"), body.getField("content").alias("raw_content")]
    if images:
        columns.append(body.getField("images").alias("images"))
    matched = cut_lineage(extract_match(requested, pages))
    needed = matched.filter("page_id IS NOT NULL").select("page_id").distinct()
    parsed = rows_for(needed, pages.select("page_id", "html"), "page_id").select("page_id", *columns)
    names = [name for name in parsed.columns if name != "page_id"]
    found = matched.join(parsed, "page_id", "left").select(*requested.columns, "page_id", "status", *names)
    if favicon:
        icon = F.concat(urls.origin(F.col("url")), F.lit("/favicon.ico"))
        found = found.withColumn("favicon", F.when(F.col("status") == "ok", icon))
    if chunks is not None:
        if chunks < 1:
            raise ValueError("chunks must be at least 1.")
        found = found.withColumn("chunks", best_chunks(F.col("raw_content"), F.col("query"), chunks, words_per_chunk))
    return found


@dataclass(frozen=True)
class CrawlRules:
    """Limits and URL rules of a crawl."""

    max_depth: int = 1
    max_breadth: int = 20
    limit: int = 50
    select_paths: list[str] = field(default_factory=list)
    exclude_paths: list[str] = field(default_factory=list)
    select_domains: list[str] = field(default_factory=list)
    exclude_domains: list[str] = field(default_factory=list)
    allow_external: bool = True

    def __post_init__(self) -> None:
        for name in ("max_depth", "max_breadth", "limit"):
            if getattr(self, name) < 1:
                raise ValueError(f"{name} must be at least 1.")


def crawl_breadth(edges: DataFrame, rules: CrawlRules) -> DataFrame:
    """``(src, dst)``: of each page the first ``max_breadth`` links that the rules allow.

    Links are cut before they meet any crawl, so a hub page adds at most ``max_breadth`` rows per visit.
    """
    allowed = follows_url_rules(
        F.col("dst"),
        rules.select_paths,
        rules.exclude_paths,
        rules.select_domains,
        rules.exclude_domains,
        urls.host(F.col("src")),
        rules.allow_external,
    )
    first = edges.filter(allowed & (F.col("src") != F.col("dst"))).groupBy("src", "dst").agg(
        F.min("link_pos").alias("link_pos")
    )
    return top_n(first, ["src"], [F.asc("link_pos"), F.asc("dst")], rules.max_breadth).select("src", "dst")


def site_map(seeds: DataFrame, edges: DataFrame, rules: CrawlRules) -> DataFrame:
    """``(seed, depth, url)``: breadth-first from every seed, first ``limit`` pages by depth and URL.

    One join per level for all seeds together. A crawl that has its ``limit`` pages leaves the
    frontier, so a seed never holds more rows than that. Levels are checkpointed, which keeps the plan
    short and survives lost executors.
    """
    links = cut_lineage(crawl_breadth(edges, rules))
    visited = seeds.select("seed", F.lit(0).alias("depth"), F.col("seed").alias("url")).distinct()
    frontier = visited
    for depth in range(1, rules.max_depth + 1):
        reached = (
            frontier.join(links, frontier.url == links.src)
            .select("seed", F.col("dst").alias("url"))
            .distinct()
            .join(visited.select("seed", "url"), ["seed", "url"], "left_anti")
        )
        held = visited.groupBy("seed").agg(F.count("*").alias("held"))
        kept = top_n(reached, ["seed"], [F.asc("url")], rules.limit, "_pos").join(held, "seed")
        kept = kept.filter(F.col("_pos") <= F.lit(rules.limit) - F.col("held"))
        frontier = cut_lineage(kept.select("seed", F.lit(depth).alias("depth"), "url"))
        if frontier.isEmpty():
            break
        visited = visited.unionByName(frontier)
    return visited


def with_relevance(found: DataFrame, instructions: str, text: str = "raw_content") -> DataFrame:
    """``relevance`` in [0, 1]: the share of the instructions' words that a page holds, each weighed by how few of the found pages
    hold it; words that no page holds do not count. So a page that shares only 'the' is hardly relevant."""
    asked = sorted(set(re.findall(LOWER_WORD, instructions.lower())))
    if not asked:
        return found.withColumn("relevance", F.lit(1.0))
    held = F.array_intersect(F.array_distinct(words(F.col(text))), F.array(*map(F.lit, asked)))
    found = cut_lineage(found.withColumn("_held", held))
    pages = found.select("page_id", "_held").dropDuplicates(["page_id"])
    # As many rows as the instructions have words.
    df = dict(pages.select(F.explode("_held").alias("word")).groupBy("word").count().collect())
    n = pages.count()
    weights = {word: math.log(1 + (n - k + 0.5) / (k + 0.5)) for word, k in sorted(df.items())}
    if not weights:
        return found.withColumn("relevance", F.lit(0.0)).drop("_held")
    weight = F.create_map(*[F.lit(x) for pair in weights.items() for x in pair])
    total = F.aggregate("_held", F.lit(0.0), lambda so_far, word: so_far + F.element_at(weight, word))
    return found.withColumn("relevance", F.round(total / sum(weights.values()), 6)).drop("_held")


def crawl(
    seeds: DataFrame,
    pages: DataFrame,
    edges: DataFrame,
    rules: CrawlRules,
    format: str = "text",
    instructions: str | None = None,
    least_relevance: float = LEAST_RELEVANCE,
    images: bool = False,
    favicon: bool = False,
    chunks: int | None = None,
    words_per_chunk: int = 100,
) -> DataFrame:
    """``(seed, depth, url, content)`` of crawled pages that exist, with the columns asked for.

    With ``instructions``, only pages that are relevant enough to them, with their ``relevance`` and, if ``chunks`` is given, the best
    chunks for them.
    """
    reached = site_map(seeds, edges, rules)
    if instructions is None:
        chunks = None
    else:
        reached = reached.withColumn("query", F.lit(instructions))
    found = extract(reached, pages, format, images, favicon, chunks, words_per_chunk).filter(F.col("status") == "ok")
    names = [name for name in ("images", "favicon", "chunks") if name in found.columns]
    if instructions is not None:
        found = with_relevance(found, instructions).where(F.col("relevance") >= least_relevance)
        names.append("relevance")
    return found.select("seed", "depth", "url", F.col("raw_content").alias("content"), *names)


def relevant_site_map(
    seeds: DataFrame,
    pages: DataFrame,
    edges: DataFrame,
    rules: CrawlRules,
    instructions: str,
    least_relevance: float = LEAST_RELEVANCE,
) -> DataFrame:
    """``(seed, depth, url, relevance)`` of a site map's pages that are relevant enough to the instructions."""
    found = crawl(seeds, pages, edges, rules, instructions=instructions, least_relevance=least_relevance)
    return found.select("seed", "depth", "url", "relevance")
