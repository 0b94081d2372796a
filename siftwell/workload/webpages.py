"""Registered queries: responses, corpus search, contexts, extraction, crawls and request logs."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from siftwell.config import COMPANY_TOPICS
from siftwell.functions import html, text
from siftwell.operators import filters, metrics, results, site, topk
from siftwell.plans import corpus as cp
from siftwell.sources import responses as rs
from siftwell.workload import fixtures as fx
from siftwell.workload import retrieval as rt
from siftwell.workload.expressions import sql_markdown
from siftwell.workload.fixtures import F_, NOW
from siftwell.workload.registry import check

# --- raw responses --------------------------------------------------------------------------------

PAGE = 20
PAGED = "(rank - 1) // 20 AS page, (rank - 1) % 20 + 1 AS pos"


def _paged(spark, sf):
    """Foreign results as response pages of at most ``PAGE`` results, so that no group is unbounded."""
    rank = F.col("rank") - 1
    return fx.foreign(spark, sf).withColumn("page", fx.div(rank, F.lit(PAGE))).withColumn("pos", rank % PAGE + 1)


def _grouped(df, item, name: str, keys=("qid", "page")):
    entry = F.struct("pos", item.alias("item"))
    listed = F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["item"])
    return df.groupBy(*keys).agg(F.first("query").alias("query"), listed.alias(name))


@check(
    "search_responses_flatten",
    F_ + f"SELECT qid, page, query, pos AS rank, title, url, content, score, NULL AS raw_content FROM (SELECT *, {PAGED} FROM foreign_results) WHERE qid % 7 <> 3",
)
def search_responses_flatten(spark, sf):
    """A seventh of the responses lacks ``results``."""
    item = F.struct("title", "url", "content", "score")
    grouped = _grouped(_paged(spark, sf), item, "results")
    body = F.struct("query", F.when(F.col("qid") % 7 != 3, F.col("results")).alias("results"))
    return rs.flatten_search(grouped.select("qid", "page", F.to_json(body).alias("response")))


@check(
    "extract_responses_flatten",
    F_
    + f"""SELECT qid, page, CASE WHEN score >= 0.2 THEN 'ok' ELSE 'failed' END AS status, url,
  CASE WHEN score >= 0.2 THEN content END AS raw_content, CASE WHEN score >= 0.2 THEN 0 END AS n_images,
  CASE WHEN score < 0.2 THEN 'not found' END AS error FROM (SELECT *, {PAGED} FROM foreign_results)""",
)
def extract_responses_flatten(spark, sf):
    item = F.struct("url", F.col("content").alias("raw_content"), F.array().cast("array<string>").alias("images"), "score")
    grouped = _grouped(_paged(spark, sf), item, "all")
    failed = F.transform(
        F.filter("all", lambda x: x["score"] < 0.2), lambda x: F.struct(x["url"].alias("url"), F.lit("not found").alias("error"))
    )
    body = F.struct(F.filter("all", lambda x: x["score"] >= 0.2).alias("results"), failed.alias("failed_results"))
    return rs.flatten_extract(grouped.select("qid", "page", F.to_json(body).alias("response")))


@check(
    "crawl_responses_flatten",
    F_ + f"SELECT qid, page, 'https://site' || qid || '.example' AS base_url, url, content AS raw_content, 1 AS n_images FROM (SELECT *, {PAGED} FROM foreign_results)",
)
def crawl_responses_flatten(spark, sf):
    item = F.struct("url", F.col("content").alias("raw_content"), F.array("title").alias("images"))
    grouped = _grouped(_paged(spark, sf), item, "results")
    base = F.concat(F.lit("https://site"), F.col("qid").cast("string"), F.lit(".example")).alias("base_url")
    flat = rs.flatten_crawl(grouped.select("qid", "page", F.to_json(F.struct(base, "results")).alias("response")))
    return flat.withColumn("n_images", F.size("images")).drop("images")


@check("map_responses_flatten", F_ + f"SELECT qid, page, query AS base_url, url FROM (SELECT *, {PAGED} FROM foreign_results)")
def map_responses_flatten(spark, sf):
    grouped = _grouped(_paged(spark, sf), F.col("url"), "results")
    body = F.to_json(F.struct(F.col("query").alias("base_url"), "results"))
    return rs.flatten_map(grouped.select("qid", "page", body.alias("response")))


@check(
    "research_log_latest",
    """WITH polled AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n,
  count(*) OVER (PARTITION BY user_id) AS polls FROM events)
SELECT 'r' || user_id AS request_id, polls, CASE event_id % 3 WHEN 0 THEN 'pending' WHEN 1 THEN 'in_progress' ELSE 'completed' END AS status,
  'mini' AS model, CASE WHEN event_id % 3 = 2 THEN floor(value)::BIGINT END AS duration_s,
  CASE WHEN event_id % 3 = 2 THEN event_id % 5 ELSE 0 END AS n_sources FROM polled WHERE n = 1""",
)
def research_log_latest(spark, sf):
    e = F.col("event_id")
    done = e % 3 == 2
    source = F.struct(F.lit("t").alias("title"), F.lit("u").alias("url"))
    log = fx.table(spark, sf, "events").select(
        F.concat(F.lit("r"), F.col("user_id").cast("string")).alias("request_id"),
        F.struct("ts", "event_id").alias("poll_ts"),
        F.when(e % 3 == 0, "pending").when(e % 3 == 1, "in_progress").otherwise("completed").alias("status"),
        F.lit("mini").alias("model"),
        F.lit("2024-01-01T00:00:00Z").alias("created_at"),
        F.when(
            done,
            F.concat(
                F.date_format(
                    F.lit(datetime(2024, 1, 1)).cast("timestamp_ntz") + F.make_dt_interval(secs=F.floor("value")),
                    "yyyy-MM-dd'T'HH:mm:ss",
                ),
                F.lit("Z"),
            ),
        ).alias("completed_at"),
        F.when(done, F.array_repeat(source, (e % 5).cast("int"))).alias("sources"),
    )
    return rs.research_latest(log)


@check(
    "error_classify",
    """WITH log AS (SELECT event_id, [200, 400, 401, 403, 429, 432, 433, 500][event_id % 8 + 1] AS status, event_id % 3 = 0 AS keyless,
  CASE event_id // 8 % 4 WHEN 0 THEN '{"detail":{"error":"e' || event_id || '"}}' WHEN 1 THEN '{"error":{"code":"limit","message":"m"}}'
    WHEN 2 THEN '"plain text"' END AS body FROM events)
SELECT event_id, CASE WHEN status < 300 THEN 'ok' WHEN keyless AND event_id // 8 % 4 = 1 THEN 'keyless_limit' WHEN status = 429 THEN 'usage_limit'
  WHEN status IN (403, 432, 433) THEN 'forbidden' WHEN status = 401 THEN 'invalid_key' WHEN status = 400 THEN 'bad_request' ELSE 'http_error' END AS error_class,
  CASE event_id // 8 % 4 WHEN 0 THEN 'e' || event_id WHEN 2 THEN 'plain text' ELSE '' END AS detail FROM log""",
)
def error_classify(spark, sf):
    e = F.col("event_id")
    statuses = F.array(*[F.lit(s) for s in (200, 400, 401, 403, 429, 432, 433, 500)])
    kind = fx.div(e, F.lit(8)) % 4
    log = fx.table(spark, sf, "events").select(
        "event_id",
        F.element_at(statuses, (e % 8 + 1).cast("int")).alias("status"),
        (e % 3 == 0).alias("keyless"),
        F.when(kind == 0, F.concat(F.lit('{"detail":{"error":"e'), e.cast("string"), F.lit('"}}')))
        .when(kind == 1, F.lit('{"error":{"code":"limit","message":"m"}}'))
        .when(kind == 2, F.lit('"plain text"')).alias("body"),
    )
    return rs.classify_response(log).select("event_id", "error_class", "detail")


# --- corpus filters and search --------------------------------------------------------------------

C = fx.with_tables(fx.CORPUS)


def _corpus(name: str, where: str, rule) -> None:
    def run(spark, sf):
        return fx.corpus(spark, sf).filter(rule()).select("doc_id", "url")

    check(name, C + f"SELECT doc_id, url FROM corpus WHERE {where}")(run)


HOST = fx.SQL_HOST.format("url")
_corpus(
    "filter_domains",
    f"({HOST} LIKE '%.example.org' OR {HOST} LIKE '%.example.net') AND {HOST} <> 'blog.tionsh.example.net'",
    lambda: filters.in_domains("url", ["example.org", "example.net"], ["blog.tionsh.example.net"]),
)
_corpus(
    "filter_published_window",
    "published_at >= TIMESTAMP '2023-01-31' AND published_at < TIMESTAMP '2024-01-01'",
    lambda: filters.published_within(NOW, time_range="year", end=datetime(2024, 1, 1)),
)
_corpus("filter_facets", "topic IN ('general', 'news') AND country = 'en'", lambda: filters.has_facets(["general", "news"], "en"))
_corpus(
    "filter_url_rules",
    f"regexp_matches({fx.SQL_PATH.format('url')}, '^/(en|fr)/') AND NOT regexp_matches({fx.SQL_PATH.format('url')}, '\\.html$') AND NOT regexp_matches({HOST}, '^m\\.')",
    lambda: filters.follows_url_rules(F.col("url"), ["^/(en|fr)/"], ["\\.html$"], exclude_domains=["^m\\."]),
)

QUOTED = """quoted AS (SELECT item_id AS qid, 'find "' || regexp_extract(text, '^[A-Za-z]+') || '" in ' || text AS query FROM benchmark)"""


def _quoted(spark, sf):
    """Benchmark texts with their first word quoted."""
    first = F.regexp_extract("text", "^[A-Za-z]+", 0)
    return fx.table(spark, sf, "benchmark").select(
        F.col("item_id").alias("qid"), F.concat(F.lit('find "'), first, F.lit('" in '), "text").alias("query")
    )


@check(
    "filter_exact_phrase",
    F_
    + f""", {QUOTED}
SELECT f.qid, rank, url FROM foreign_results f JOIN quoted q ON f.qid = q.qid
WHERE len(list_filter(regexp_extract_all(q.query, '"([^"]+)"', 1), lambda p: NOT contains(lower(content), lower(p)))) = 0""",
)
def filter_exact_phrase(spark, sf):
    return cp.exact_match(_quoted(spark, sf), fx.foreign(spark, sf)).select("qid", "rank", "url")


SEARCHED = (
    C
    + f""", {QUOTED}, searched AS (SELECT * FROM corpus WHERE topic IN ('general', 'news')
  AND published_at >= TIMESTAMP '2023-01-31' AND NOT ({HOST} = 'example.org' OR {HOST} LIKE '%.example.org')),"""
    + rt.POSTINGS.format(docs="searched", text="content")[1:]
    + ","
    + rt.BM25.format(queries="quoted")[1:]
)


@check(
    "table_search",
    SEARCHED
    + ","
    + rt.text_hits(
        5,
        """(qid, doc_id) IN (SELECT qid, doc_id FROM quoted, searched WHERE
    len(list_filter(regexp_extract_all(query, '"([^"]+)"', 1), lambda p: NOT contains(lower(content), lower(p)))) = 0)""",
    )
    + " SELECT qid, rank, doc_id, url, title, content, score FROM text_hits JOIN searched USING (doc_id)",
)
def table_search(spark, sf):
    params = cp.SearchParams(
        topic=["general", "news"], time_range="year", exclude_domains=["example.org"], exact_match=True
    )
    return cp.table_search(_quoted(spark, sf), fx.corpus(spark, sf), params, NOW)


@check(
    "table_search_with_pages",
    SEARCHED
    + ","
    + rt.text_hits(3)
    + f""" SELECT qid, rank, s.doc_id, s.url, score, {sql_markdown()} AS raw_content, len(regexp_extract_all(html, '{fx.SQL_IMAGE}', 1)) AS n_images,
  regexp_extract(s.url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1) || '/favicon.ico' AS favicon
FROM text_hits t JOIN searched s USING (doc_id) JOIN pages p ON p.page_id = s.doc_id""",
)
def table_search_with_pages(spark, sf):
    """Results with the markdown, the images and the favicon of their pages."""
    params = cp.SearchParams(
        max_results=3, topic=["general", "news"], time_range="year", exclude_domains=["example.org"],
        raw_content="markdown", images=True, favicon=True,
    )
    found = cp.table_search(_quoted(spark, sf), fx.corpus_from(fx.table(spark, sf, "pages"), "html"), params, NOW)
    return found.select("qid", "rank", "doc_id", "url", "score", "raw_content", F.size("images").alias("n_images"), "favicon")


# --- outputs --------------------------------------------------------------------------------------

JSON_ITEM = "json_object('url', url, 'content', content)::VARCHAR"
BUDGET = 2000
PREFIX = (
    F_
    + f""", counted AS (SELECT qid, rank, url, content,
  len(regexp_extract_all({JSON_ITEM}, '{text.COUNTED_TOKEN}')) AS tokens FROM foreign_results),
running AS (SELECT *, (sum(tokens) OVER (PARTITION BY qid ORDER BY rank ROWS UNBOUNDED PRECEDING))::BIGINT AS total_tokens FROM counted)"""
)


@check("token_budget_prefix", PREFIX + f" SELECT qid, rank, url, tokens, total_tokens FROM running WHERE total_tokens <= {BUDGET}")
def token_budget_prefix(spark, sf):
    kept = topk.token_prefix(fx.foreign(spark, sf), BUDGET)
    return kept.select("qid", "rank", "url", "tokens", "total_tokens")


@check(
    "search_context",
    PREFIX
    + f""" SELECT qid, coalesce('[' || string_agg({JSON_ITEM}, ',' ORDER BY rank) FILTER (total_tokens <= {BUDGET}) || ']', '[]') AS context
FROM running GROUP BY qid""",
)
def search_context(spark, sf):
    """Contexts of as many results as fit."""
    return results.search_context(fx.foreign(spark, sf), BUDGET, max_results=None)


@check(
    "search_context_default",
    PREFIX
    + f""" SELECT qid, coalesce('[' || string_agg({JSON_ITEM}, ',' ORDER BY rank) FILTER (total_tokens <= 4000 AND rank <= 5) || ']', '[]') AS context
FROM running GROUP BY qid""",
)
def search_context_default(spark, sf):
    """Contexts of the first five results, in the default budget."""
    return results.search_context(fx.foreign(spark, sf))


TOPICS = """(SELECT qid, pos AS rank, topic, url, score FROM (SELECT *, row_number() OVER (PARTITION BY qid
  ORDER BY score DESC, array_position(['news', 'general', 'finance'], topic), rank) AS pos FROM foreign_results) WHERE pos <= {})"""


@check("topic_fanout_topn", F_ + "SELECT * FROM " + TOPICS.format(3))
def topic_fanout_topn(spark, sf):
    return topk.company_info(fx.foreign(spark, sf), COMPANY_TOPICS, 3).select("qid", "rank", "topic", "url", "score")


@check("company_info", F_ + "SELECT qid, rank, topic, url, score FROM " + TOPICS.format(5))
def company_info(spark, sf):
    return topk.company_info(fx.foreign(spark, sf), COMPANY_TOPICS, 5).select("qid", "rank", "topic", "url", "score")


@check(
    "result_preview",
    rt.RANKED
    + """ SELECT qid, rank, origin, printf('%.4f', score) AS score,
  CASE WHEN length(line) <= 120 THEN line ELSE regexp_extract(line, '^(.{0,117}) ', 1) || '...' END AS preview
FROM (SELECT *, trim(regexp_replace(content, '\\s+', ' ', 'g')) AS line FROM best)""",
)
def result_preview(spark, sf):
    return topk.result_preview(rt.hybrid_search(spark, sf))


@check(
    "origin_counts",
    rt.RANKED
    + """ SELECT qid, count(*) FILTER (origin = 'local') AS n_local, count(*) FILTER (origin = 'foreign') AS n_foreign,
  0 AS n_unknown FROM best GROUP BY 1""",
)
def origin_counts(spark, sf):
    return metrics.origin_counts(rt.hybrid_search(spark, sf))


@check(
    "project_optional",
    f"""SELECT page_id, url, {sql_markdown()} AS raw_content, 0 AS n_images,
  regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1) || '/favicon.ico' AS favicon FROM pages""",
)
def project_optional(spark, sf):
    full = results.with_optional(fx.table(spark, sf, "pages"), "markdown", images=True, favicon=True)
    return full.withColumn("n_images", F.size("images")).drop("images")


# --- pages as a site ------------------------------------------------------------------------------

LINKS = f"""raw_links AS (SELECT page_id, url, unnest(regexp_extract_all(html, '{fx.SQL_LINK}', 1)) AS href,
  unnest(range(len(regexp_extract_all(html, '{fx.SQL_LINK}', 1)))) AS link_pos FROM pages),
links AS (SELECT page_id, url, link_pos, regexp_replace(CASE WHEN href LIKE '/%' THEN regexp_extract(url, '^([A-Za-z]+://[^/?#]*)', 1) || href
  ELSE href END, '#.*$', '') AS dst_url FROM raw_links)"""


@check(
    "link_edges",
    f"""WITH {LINKS}, known AS (SELECT {fx.sql_normalize('url')} AS match_url, min(page_id) AS dst_page_id FROM pages GROUP BY 1)
SELECT url AS src_url, link_pos, dst_url, dst_page_id FROM links LEFT JOIN known ON {fx.sql_normalize('dst_url')} = match_url""",
)
def link_edges(spark, sf):
    return site.link_edges(fx.table(spark, sf, "pages"))


@check(
    "discover_urls",
    f"""WITH {LINKS} SELECT DISTINCT {HOST} AS host, url FROM (
  SELECT regexp_replace(url, '#.*$', '') AS url FROM pages UNION ALL SELECT dst_url FROM links)""",
)
def discover_urls(spark, sf):
    return site.discover_urls(fx.table(spark, sf, "pages"))


REQUESTED = """requested AS (SELECT qid, CASE WHEN rank % 4 = 0 THEN url || '/missing' WHEN rank % 4 = 1 THEN url || '#part' ELSE url END AS url,
  query FROM foreign_results)"""
MATCHED = f"""known AS (SELECT {fx.sql_normalize('url')} AS match_url, min(page_id) AS page_id FROM pages GROUP BY 1),
matched AS (SELECT r.qid, r.url, r.query, k.page_id, CASE WHEN k.page_id IS NULL THEN 'failed' ELSE 'ok' END AS status
  FROM requested r LEFT JOIN known k ON {fx.sql_normalize('r.url')} = match_url)"""


def _requested(spark, sf):
    """Every foreign URL asked for; some with a fragment, some that do not exist."""
    rank = F.col("rank")
    url = F.when(rank % 4 == 0, F.concat("url", F.lit("/missing"))).when(
        rank % 4 == 1, F.concat("url", F.lit("#part"))
    ).otherwise(F.col("url"))
    return fx.foreign(spark, sf).select("qid", url.alias("url"), "query")


@check("extract_match", F_ + f", {REQUESTED}, {MATCHED} SELECT qid, url, page_id, status FROM matched")
def extract_match(spark, sf):
    return site.extract_match(_requested(spark, sf), fx.table(spark, sf, "pages")).select("qid", "url", "page_id", "status")


@check(
    "extract",
    F_
    + f""", {REQUESTED}, {MATCHED} SELECT qid, m.url, m.page_id, status, {fx.SQL_TITLE} AS title, {fx.sql_text('html')} AS raw_content
FROM matched m LEFT JOIN pages p ON m.page_id = p.page_id""",
)
def extract(spark, sf):
    found = site.extract(_requested(spark, sf), fx.table(spark, sf, "pages"))
    return found.select("qid", "url", "page_id", "status", "title", "raw_content")


@check(
    "extract_chunks",
    F_
    + f""", {REQUESTED}, {MATCHED},
read AS (SELECT row_number() OVER () AS row, m.qid, m.url, m.page_id, m.status, r.query, {fx.sql_text('html')} AS content
  FROM matched m JOIN (SELECT item_id AS qid, text AS query FROM benchmark) r USING (qid) LEFT JOIN pages p ON m.page_id = p.page_id),
parts AS (SELECT *, list_filter(string_split_regex(content, '\\s+'), lambda w: w <> '') AS words,
  list_distinct(regexp_extract_all(lower(query), '[a-z0-9]+')) AS asked FROM read),
numbered AS (SELECT *, unnest(range(((len(words) - 1) // 60) + 1)) AS chunk_no FROM parts WHERE len(words) > 0),
chunks AS (SELECT row, chunk_no, asked, array_to_string(words[chunk_no*60+1 : chunk_no*60+60], ' ') AS chunk FROM numbered),
placed AS (SELECT row, chunk, row_number() OVER (PARTITION BY row ORDER BY
  len(list_intersect(list_distinct(regexp_extract_all(lower(chunk), '[a-z0-9]+')), asked)) DESC, chunk_no) AS place FROM chunks),
best AS (SELECT row, string_agg(chunk, ' | ' ORDER BY place) AS chunks FROM placed WHERE place <= 2 GROUP BY row)
SELECT qid, url, page_id, status, CASE WHEN status = 'ok' THEN regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1) || '/favicon.ico' END AS favicon,
  CASE WHEN status = 'ok' THEN coalesce(chunks, '') END AS chunks FROM read LEFT JOIN best USING (row)""",
)
def extract_chunks(spark, sf):
    """The two best chunks of every requested page for its query, and its favicon."""
    found = site.extract(_requested(spark, sf), fx.table(spark, sf, "pages"), favicon=True, chunks=2, words_per_chunk=60)
    joined = F.when(F.col("status") == "ok", F.array_join("chunks", " | "))
    return found.select("qid", "url", "page_id", "status", "favicon", joined.alias("chunks"))


@check(
    "chunks_per_source",
    F_
    + """, parts AS (SELECT qid, url, query, list_filter(string_split_regex(content, '\\s+'), lambda w: w <> '') AS words FROM foreign_results),
numbered AS (SELECT *, unnest(range(((len(words) - 1) // 60) + 1)) AS chunk_no FROM parts WHERE len(words) > 0),
chunks AS (SELECT qid, url, query, chunk_no, array_to_string(words[chunk_no*60+1 : chunk_no*60+60], ' ') AS chunk FROM numbered),
scored AS (SELECT qid, url, chunk_no, chunk, round(len(list_intersect(list_distinct(regexp_extract_all(lower(chunk), '[a-z0-9]+')), asked)) / len(asked)::DOUBLE, 6) AS score
  FROM (SELECT *, list_distinct(regexp_extract_all(lower(query), '[a-z0-9]+')) AS asked FROM chunks))
SELECT qid, url, rank, chunk_no, chunk, score FROM (
  SELECT *, row_number() OVER (PARTITION BY qid, url ORDER BY score DESC, chunk_no) AS rank FROM scored) WHERE rank <= 3""",
)
def chunks_per_source(spark, sf):
    return results.chunks_per_source(fx.foreign(spark, sf), 3, 60)


RULES = site.CrawlRules(max_depth=3, max_breadth=3, limit=8, exclude_paths=["^/fr/"])
EDGES = f"""{LINKS}, edges AS (SELECT l.url AS src, p.url AS dst, link_pos FROM links l
  JOIN pages p ON p.page_id = (l.page_id * 7 + link_pos * 13 + 1) % (SELECT count(*) FROM pages)),
followed AS (SELECT src, dst FROM (SELECT *, row_number() OVER (PARTITION BY src ORDER BY link_pos, dst) AS n FROM (
  SELECT src, dst, min(link_pos) AS link_pos FROM edges WHERE src <> dst
    AND NOT regexp_matches({fx.SQL_PATH.format('dst')}, '^/fr/') GROUP BY 1, 2)) WHERE n <= 3)"""


def sql_levels(depth: int, limit: int) -> str:
    """CTEs of a breadth-first walk from every page, one per level."""
    parts = ["v0 AS (SELECT DISTINCT url AS seed, 0 AS depth, url FROM pages)", "l0 AS (SELECT * FROM v0)"]
    for d in range(1, depth + 1):
        parts.append(
            f"""l{d} AS (SELECT seed, {d} AS depth, url FROM (
  SELECT seed, url, row_number() OVER (PARTITION BY seed ORDER BY url) AS pos FROM (
    SELECT DISTINCT seed, dst AS url FROM l{d-1} f JOIN followed ON f.url = src
    WHERE NOT EXISTS (SELECT 1 FROM v{d-1} v WHERE v.seed = f.seed AND v.url = dst)))
  JOIN (SELECT seed, count(*) AS held FROM v{d-1} GROUP BY 1) USING (seed) WHERE pos <= {limit} - held),
v{d} AS (SELECT * FROM v{d-1} UNION ALL SELECT * FROM l{d})"""
        )
    return ",".join(parts)


WALK = f"WITH {EDGES}, {sql_levels(3, 8)}"


def _edges(spark, sf):
    """Every page's real links, led to other pages: targets in the given pages resolve to none."""
    pages = fx.table(spark, sf, "pages")
    total = pages.agg(F.count("*")).scalar()
    target = (F.col("page_id") * 7 + F.col("link_pos") * 13 + 1) % total
    links = site.page_links(pages).select(F.col("url").alias("src"), "link_pos", target.alias("dst_id"))
    return links.join(pages.select(F.col("page_id").alias("dst_id"), F.col("url").alias("dst")), "dst_id")


def _seeds(spark, sf):
    return fx.table(spark, sf, "pages").select(F.col("url").alias("seed"))


@check("crawl_breadth", f"WITH {EDGES} SELECT src, dst FROM followed")
def crawl_breadth(spark, sf):
    return site.crawl_breadth(_edges(spark, sf), RULES)


@check("site_map", WALK + " SELECT seed, depth, url FROM v3")
def site_map(spark, sf):
    """Every page is the seed of its own crawl."""
    return site.site_map(_seeds(spark, sf), _edges(spark, sf), RULES)


@check(
    "crawl",
    WALK
    + f""", known AS (SELECT {fx.sql_normalize('url')} AS match_url, min(page_id) AS page_id FROM pages GROUP BY 1)
SELECT seed, depth, v.url, {fx.sql_text('html')} AS content FROM v3 v JOIN known ON {fx.sql_normalize('v.url')} = match_url
JOIN pages p USING (page_id)""",
)
def crawl(spark, sf):
    return site.crawl(_seeds(spark, sf), fx.table(spark, sf, "pages"), _edges(spark, sf), RULES)


INSTRUCTIONS = "the news of the day about a river and prices"
RELEVANT = (
    WALK
    + f""", known AS (SELECT {fx.sql_normalize('url')} AS match_url, min(page_id) AS page_id FROM pages GROUP BY 1),
found AS (SELECT seed, depth, v.url, p.page_id, {fx.sql_text('html')} AS content, len(regexp_extract_all(html, '{fx.SQL_IMAGE}', 1)) AS n_images
  FROM v3 v JOIN known ON {fx.sql_normalize('v.url')} = match_url JOIN pages p USING (page_id)),
held AS (SELECT DISTINCT page_id, w FROM (SELECT page_id, any_value(content) AS content FROM found GROUP BY 1),
  (SELECT DISTINCT unnest(regexp_extract_all(lower('{INSTRUCTIONS}'), '[a-z0-9]+')) AS w)
  WHERE list_contains(regexp_extract_all(lower(content), '[a-z0-9]+'), w)),
weights AS (SELECT w, ln(1 + (n - df + 0.5) / (df + 0.5)) AS weight FROM (SELECT w, count(*) AS df FROM held GROUP BY 1),
  (SELECT count(DISTINCT page_id) AS n FROM found)),
relevant AS (SELECT page_id, round(sum(weight) / (SELECT sum(weight) FROM weights), 6) AS relevance FROM held JOIN weights USING (w)
  GROUP BY 1 HAVING round(sum(weight) / (SELECT sum(weight) FROM weights), 6) >= 0.25)"""
)


@check(
    "crawl_instructed",
    RELEVANT
    + """ SELECT seed, depth, url, sha256(content) AS content_hash, n_images, regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1) || '/favicon.ico' AS favicon, relevance
FROM found JOIN relevant USING (page_id)""",
)
def crawl_instructed(spark, sf):
    """Crawls that keep the pages relevant to instructions, with images, favicons and chunks."""
    found = site.crawl(
        _seeds(spark, sf), fx.table(spark, sf, "pages"), _edges(spark, sf), RULES, instructions=INSTRUCTIONS,
        images=True, favicon=True, chunks=2,
    )
    return found.select(
        "seed", "depth", "url", F.sha2("content", 256).alias("content_hash"), F.size("images").alias("n_images"), "favicon", "relevance"
    )


@check("site_map_instructed", RELEVANT + " SELECT seed, depth, url, relevance FROM found JOIN relevant USING (page_id)")
def site_map_instructed(spark, sf):
    return site.relevant_site_map(
        _seeds(spark, sf), fx.table(spark, sf, "pages"), _edges(spark, sf), RULES, INSTRUCTIONS
    )


# --- request log ----------------------------------------------------------------------------------

LOG = """log AS (SELECT event_id, ts, user_id, CASE event_id % 3 WHEN 0 THEN 'hybrid_search' WHEN 1 THEN 'freshness_cache' ELSE 'cache_then_memory' END AS mode,
  user_id % 2 AS run, value AS latency_ms, event_id % 4 AS local, 3 - event_id % 4 AS "foreign" FROM events)"""
RATES = """count(*) AS requests, round(avg(latency_ms), 6) AS avg_latency_ms, max(latency_ms) AS max_latency_ms,
  sum(local)::BIGINT AS local, sum("foreign")::BIGINT AS "foreign", max((local > 0)::BIGINT) AS reused, round(avg((local > 0)::INT), 6) AS hit_rate"""


def request_log(events):
    """A request log derived row by row from events."""
    e = F.col("event_id")
    return events.select(
        "event_id",
        "ts",
        "user_id",
        F.when(e % 3 == 0, "hybrid_search").when(e % 3 == 1, "freshness_cache").otherwise("cache_then_memory").alias("mode"),
        (F.col("user_id") % 2).alias("run"),
        F.col("value").alias("latency_ms"),
        (e % 4).alias("local"),
        (3 - e % 4).alias("foreign"),
    )


@check("mode_metrics", f"WITH {LOG} SELECT mode, run, {RATES} FROM log GROUP BY 1, 2")
def mode_metrics(spark, sf):
    return metrics.mode_metrics(request_log(fx.table(spark, sf, "events")))


def rank_errors(found, log, keys):
    """How far the rank of each percentile in the log itself is from what it should be: zero where the share lies between the
    shares of smaller and of not larger latencies."""
    met = found.withColumnRenamed("requests", "told").join(log, keys)
    counted = [F.count("*").alias("n")]
    for name in metrics.SHARES:
        counted += [F.count_if(F.col("latency_ms") < F.col(name)).alias(f"{name}_below"), F.count_if(F.col("latency_ms") <= F.col(name)).alias(f"{name}_upto")]
    ranks = met.groupBy(*keys, "told").agg(*counted)
    close = [
        (F.greatest(F.col(f"{name}_below") / F.col("n") - share, share - F.col(f"{name}_upto") / F.col("n"), F.lit(0.0)) <= 0.02).alias(f"{name}_close")
        for name, share in metrics.SHARES.items()
    ]
    return ranks.select(*keys, F.col("told").alias("requests"), *close)


@check(
    "mode_percentiles",
    f"WITH {LOG} SELECT mode, run, count(*) AS requests, true AS p50_latency_ms_close, true AS p95_latency_ms_close FROM log GROUP BY 1, 2",
)
def mode_percentiles(spark, sf):
    """Percentiles from sketches, and whether their ranks in the log are near enough."""
    log = request_log(fx.table(spark, sf, "events"))
    return rank_errors(metrics.mode_percentiles(log), log, ["mode", "run"])
