"""Registered queries: scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from siftwell.functions import html, payload, text, urls, vectors
from siftwell.workload import fixtures as fx
from siftwell.workload.fixtures import F_, NOW, stamp
from siftwell.workload.registry import check

# --- vectors: every vector against the next one ----------------------------------------------------

PAIRS = """WITH pairs AS (
  SELECT a.vec_id AS doc_id, a.embedding::DOUBLE[] AS a, b.embedding::DOUBLE[] AS b
  FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1),
flags AS (SELECT doc_id, list_transform(a, lambda x: CASE WHEN x > 0.05 THEN 1.0 ELSE 0.0 END) AS a,
  list_transform(b, lambda x: CASE WHEN x > 0.05 THEN 1.0 ELSE 0.0 END) AS b FROM pairs)
"""
EACH = "list_sum(list_transform(range(1, len(a)+1), lambda i: {}))"
SQL_DISTANCE = {
    "cosine": "1 - list_dot_product(a, b) / (sqrt(list_dot_product(a, a)) * sqrt(list_dot_product(b, b)))",
    "euclidean": "sqrt(" + EACH.format("(a[i] - b[i])^2") + ")",
    "l2_squared": EACH.format("(a[i] - b[i])^2"),
    "dot": "-list_dot_product(a, b)",
    "manhattan": EACH.format("abs(a[i] - b[i])"),
    "hamming": EACH.format("CASE WHEN a[i] <> b[i] THEN 1.0 ELSE 0.0 END"),
    "jaccard": "1 - "
    + EACH.format("CASE WHEN a[i] <> 0 AND b[i] <> 0 THEN 1.0 ELSE 0.0 END")
    + " / "
    + EACH.format("CASE WHEN a[i] <> 0 OR b[i] <> 0 THEN 1.0 ELSE 0.0 END"),
}


def _pairs(spark, sf, flagged: bool):
    v = fx.table(spark, sf, "embeddings")
    a = v.select(F.col("vec_id").alias("doc_id"), F.col("embedding").alias("a"))
    b = v.select((F.col("vec_id") - 1).alias("doc_id"), F.col("embedding").alias("b"))
    pairs = a.join(b, "doc_id")
    if not flagged:
        return pairs
    flag = lambda x: F.when(x > F.lit(0.05).cast("double"), 1.0).otherwise(0.0)
    return pairs.select(
        "doc_id", F.transform(F.col("a").cast("array<double>"), flag).alias("a"),
        F.transform(F.col("b").cast("array<double>"), flag).alias("b"),
    )


def _distance(metric: str) -> None:
    flagged = metric in ("hamming", "jaccard")

    def run(spark, sf):
        value = vectors.distance(metric, F.col("a"), F.col("b"))
        return _pairs(spark, sf, flagged).select("doc_id", F.round(value, 6).alias("distance"))

    source = "flags" if flagged else "pairs"
    check(f"dist_{metric}", PAIRS + f"SELECT doc_id, round({SQL_DISTANCE[metric]}, 6) AS distance FROM {source}")(run)


for name in SQL_DISTANCE:
    _distance(name)


@check("score_from_distance", PAIRS + f"SELECT doc_id, round(1 - ({SQL_DISTANCE['manhattan']}), 6) AS score FROM pairs")
def score_from_distance(spark, sf):
    value = vectors.score_from_distance(vectors.dist_manhattan(F.col("a"), F.col("b")))
    return _pairs(spark, sf, False).select("doc_id", F.round(value, 6).alias("score"))


# --- text -----------------------------------------------------------------------------------------


def _per_document(name: str, sql: str, column) -> None:
    def run(spark, sf):
        return fx.table(spark, sf, "documents").select("doc_id", column().alias("value"))

    check(name, f"SELECT doc_id, {sql} AS value FROM documents")(run)


_per_document("content_hash", "sha256(text)", lambda: text.content_hash(F.col("text")))
_per_document(
    "sanitize_text_query",
    "array_to_string(regexp_extract_all(text, '[A-Za-z0-9]+'), ' ')",
    lambda: text.sanitize_text_query(F.col("text")),
)
_per_document(
    "token_count",
    "len(regexp_extract_all(text, '[A-Za-z0-9]+|[^A-Za-z0-9\\s]'))",
    lambda: text.token_count(F.col("text")),
)
LINE = "trim(regexp_replace(text, '\\s+', ' ', 'g'))"
_per_document(
    "preview_text",
    f"CASE WHEN length({LINE}) <= 120 THEN {LINE} ELSE regexp_extract({LINE}, '^(.{{0,117}}) ', 1) || '...' END",
    lambda: text.preview_text(F.col("text")),
)

@check(
    "expiry_columns",
    """SELECT doc_id, '2024-01-31 01:00:00' AS expires_at, '2024-01-31 00:00:00' AS last_seen_at,
  'cache_only' AS memory_scope, 1 AS query_count FROM documents""",
)
def expiry_columns(spark, sf):
    set_ = payload.expiry_columns(NOW, 3600, "cache_only")
    return fx.table(spark, sf, "documents").select(
        "doc_id",
        *[(stamp(c) if name in ("expires_at", "last_seen_at") else c).alias(name) for name, c in set_.items()],
    )


@check(
    "quoted_phrases",
    """SELECT conv_id, turn, array_to_string(regexp_extract_all(text || ' "' || role || '" "x y"', '"([^"]+)"', 1), '|') AS phrases
FROM conversations""",
)
def quoted_phrases(spark, sf):
    quoted = F.concat("text", F.lit(' "'), "role", F.lit('" "x y"'))
    return fx.table(spark, sf, "conversations").select(
        "conv_id", "turn", F.array_join(text.quoted_phrases(quoted), "|").alias("phrases")
    )


@check(
    "chunk_text",
    """WITH parts AS (SELECT doc_id, list_filter(string_split_regex(text, '\\s+'), lambda w: w <> '') AS words FROM documents),
numbered AS (SELECT doc_id, words, unnest(range(((len(words) - 1) // 50) + 1)) AS chunk_no FROM parts WHERE len(words) > 0)
SELECT doc_id, chunk_no, array_to_string(words[chunk_no*50+1 : chunk_no*50+50], ' ') AS chunk FROM numbered""",
)
def chunk_text(spark, sf):
    return fx.table(spark, sf, "documents").select(
        "doc_id", F.posexplode_outer(text.chunk_text(F.col("text"), 50)).alias("chunk_no", "chunk")
    ).filter("chunk IS NOT NULL")


# --- payload --------------------------------------------------------------------------------------


def _payload(spark, sf):
    return fx.foreign(spark, sf).select(
        "qid",
        "rank",
        payload.payload_json(
            {c: F.col(c) for c in ("title", "url", "content", "score")} | {"raw_content": F.lit(None).cast("string")},
            {"source_url": F.col("url"), "retrieval_query": F.col("query"), "retrieval_mode": F.lit("hybrid_search"),
             "cache_hit": F.lit(False)},
        ).alias("payload"),
    )


@check(
    "payload_json",
    F_
    + """SELECT qid, rank, json_object('provenance', json_object('cache_hit', false, 'retrieval_mode', 'hybrid_search',
  'retrieval_query', query, 'source_url', url),
  'result', json_object('content', content, 'raw_content', NULL, 'score', score, 'title', title, 'url', url))::VARCHAR AS payload
FROM foreign_results""",
)
def payload_json(spark, sf):
    return _payload(spark, sf)


@check(
    "payload_extract",
    F_ + "SELECT qid, rank, 'hybrid_search' AS mode, url AS source_url, title, query AS asked FROM foreign_results",
)
def payload_extract(spark, sf):
    p = F.col("payload")
    return _payload(spark, sf).select(
        "qid",
        "rank",
        payload.payload_extract(p, "provenance.retrieval_mode").alias("mode"),
        payload.payload_extract(p, "provenance.source_url").alias("source_url"),
        payload.payload_extract(p, "result.title").alias("title"),
        payload.payload_extract(p, "provenance.retrieval_query").alias("asked"),
    )


# --- pages ----------------------------------------------------------------------------------------

BARE = "regexp_replace(regexp_replace(url, '#.*$', ''), '[?#].*$', '')"


@check(
    "url_parts",
    f"""WITH u AS (SELECT page_id, regexp_replace(url, '#.*$', '') AS absolute FROM pages)
SELECT page_id, {fx.SQL_HOST.format('absolute')} AS host, {fx.SQL_PATH.format('absolute')} AS path,
  regexp_replace(absolute, '[?#].*$', '') AS bare, absolute FROM u""",
)
def url_parts(spark, sf):
    parts = urls.url_parts(F.col("url"))
    return fx.table(spark, sf, "pages").select("page_id", parts.alias("p")).select("page_id", "p.*")


def sql_markdown() -> str:
    out = "html"
    for pattern in html.HIDDEN:
        out = f"regexp_replace({out}, '{pattern}', ' ', 'g')"
    for pattern, replacement in html.MARKDOWN:
        replacement = replacement.replace("$1", "\\1").replace("$2", "\\2")
        quoted = pattern.replace("'", "''")
        out = f"regexp_replace({out}, '{quoted}', '{replacement}', 'g')"
    out = fx.sql_decode(f"regexp_replace({out}, '{html.TAG}', '', 'g')")
    out = f"regexp_replace({out}, '[ \\t\\r]+', ' ', 'g')"
    return f"regexp_replace(regexp_replace({out}, ' ?\\n[ \\n]*', '\n', 'g'), '^\\n+|\\n+$', '', 'g')"


@check(
    "html_extract",
    f"""SELECT page_id, {fx.SQL_TITLE} AS title, {fx.sql_text('html')} AS content, {sql_markdown()} AS markdown,
  len(regexp_extract_all(html, '{fx.SQL_LINK}', 1)) AS n_links, len(regexp_extract_all(html, '{fx.SQL_IMAGE}', 1)) AS n_images FROM pages""",
)
def html_extract(spark, sf):
    plain, marked = html.html_extract(F.col("html")), html.html_extract(F.col("html"), "markdown")
    return fx.table(spark, sf, "pages").select("page_id", plain.alias("p"), marked.alias("m")).select(
        "page_id", "p.title", "p.content", F.col("m.content").alias("markdown"),
        F.size("p.links").alias("n_links"), F.size("p.images").alias("n_images"),
    )
