"""Input tables of the registered queries, derived from whole given tables.

Each is defined twice, as a DataFrame and as a SQL common table expression, with equal content.
Nothing reads the clock: ``NOW`` is fixed.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwell.functions import html, urls
from siftwell.operators.sizing import spread
from siftwell.operators.text_blocks import TextIndex, build_text_index
from siftwell.session import scratch_path

NOW = datetime(2024, 1, 31)
TAG = "web"
DIM = 64


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def div(a: Column, b: Column) -> Column:
    return F.floor(a / b).cast("long")


_indexes: dict[tuple[str, str, str], TextIndex] = {}


def text_index(spark: SparkSession, sf: str, name: str) -> TextIndex:
    """The text index of the documents or of the store, built when it is first asked for in a session."""
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _indexes:
        docs, column = (table(spark, sf, "documents"), "text") if name == "documents" else (store(spark, sf), "content")
        _indexes[key] = build_text_index(docs, scratch_path(spark, f"text-index-{name}"), text_col=column)
    return _indexes[key]


def stamp(c: str | Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def store(spark: SparkSession, sf: str) -> DataFrame:
    """All documents, with their vectors where they have one and lifecycle columns derived from the id."""
    vectors = table(spark, sf, "embeddings")
    docs = table(spark, sf, "documents")
    v = F.col("doc_id")
    now = F.lit(NOW).cast("timestamp_ntz")
    added = now - F.make_dt_interval(hours=F.pmod(v * 7, F.lit(72)).cast("int"))
    owner = F.when(v % 11 == 0, None).when(v % 5 == 0, "manual").otherwise("web")
    return (
        docs.join(vectors, vectors.vec_id == docs.doc_id, "left")
        .select(
            "doc_id",
            F.col("text").alias("content"),
            F.col("embedding").alias("embeddings"),
            F.col("label").cast("long").alias("label"),
            added.alias("added_at"),
            F.when(v % 3 == 0, "cache_only").when(v % 3 == 1, "cache_plus_memory").alias("memory_scope"),
            F.when(v % 7 != 0, added + F.expr("INTERVAL 24 HOURS")).alias("expires_at"),
            F.when(v % 4 == 0, "hybrid_search").when(v % 4 == 1, "freshness_cache")
            .otherwise("cache_then_memory").alias("retrieval_mode"),
            owner.alias("provider_name"),
            owner.alias("inserted_from"),
            F.concat(F.lit("https://"), "source", F.lit(".example/"), v.cast("string")).alias("source_url"),
            F.substring("text", 1, 40).alias("source_title"),
            F.concat(F.lit("query "), (v % 20).cast("string")).alias("retrieval_query"),
            added.alias("retrieval_timestamp"),
            F.when(v % 13 != 0, added).alias("last_seen_at"),
            F.when(v % 11 != 0, v % 6).alias("query_count"),
            F.lit(0).alias("cache_hit"),
            F.sha2("text", 256).alias("content_hash"),
        )
    )


STORE = """
store AS (
  SELECT doc_id, text AS content, embedding AS embeddings, label::BIGINT AS label,
    TIMESTAMP '2024-01-31' - to_hours((doc_id*7) % 72) AS added_at,
    CASE doc_id % 3 WHEN 0 THEN 'cache_only' WHEN 1 THEN 'cache_plus_memory' END AS memory_scope,
    CASE WHEN doc_id % 7 <> 0 THEN TIMESTAMP '2024-01-31' - to_hours((doc_id*7) % 72) + INTERVAL 24 HOURS END AS expires_at,
    CASE doc_id % 4 WHEN 0 THEN 'hybrid_search' WHEN 1 THEN 'freshness_cache' ELSE 'cache_then_memory' END AS retrieval_mode,
    CASE WHEN doc_id % 11 = 0 THEN NULL WHEN doc_id % 5 = 0 THEN 'manual' ELSE 'web' END AS provider_name,
    CASE WHEN doc_id % 11 = 0 THEN NULL WHEN doc_id % 5 = 0 THEN 'manual' ELSE 'web' END AS inserted_from,
    'https://' || source || '.example/' || doc_id AS source_url,
    substr(text, 1, 40) AS source_title,
    'query ' || (doc_id % 20) AS retrieval_query,
    TIMESTAMP '2024-01-31' - to_hours((doc_id*7) % 72) AS retrieval_timestamp,
    CASE WHEN doc_id % 13 <> 0 THEN TIMESTAMP '2024-01-31' - to_hours((doc_id*7) % 72) END AS last_seen_at,
    CASE WHEN doc_id % 11 <> 0 THEN doc_id % 6 END AS query_count,
    0 AS cache_hit,
    sha256(text) AS content_hash
  FROM documents LEFT JOIN embeddings ON vec_id = doc_id)"""


def queries(spark: SparkSession, sf: str) -> DataFrame:
    """Every benchmark item is a query; its vector is the embedding with the same id."""
    items = table(spark, sf, "benchmark")
    vectors = table(spark, sf, "embeddings")
    return items.join(vectors, items.item_id == vectors.vec_id).select(
        F.col("item_id").alias("qid"), F.col("text").alias("query"), F.col("embedding").alias("qvec")
    )


QUERIES = """
queries AS (
  SELECT item_id AS qid, text AS query, embedding AS qvec FROM benchmark JOIN embeddings ON item_id = vec_id)"""


def corpus(spark: SparkSession, sf: str) -> DataFrame:
    return corpus_from(table(spark, sf, "pages"))


def corpus_from(pages: DataFrame, *more: str) -> DataFrame:
    """Pages as a searchable corpus, with some of their own columns if wanted."""
    p = F.col("page_id")
    now = F.lit(NOW).cast("timestamp_ntz")
    return spread(pages).select(
        p.alias("doc_id"),
        "url",
        html.html_title(F.col("html")).alias("title"),
        html.html_text(F.col("html")).alias("content"),
        (now - F.make_dt_interval(days=F.pmod(p, F.lit(400)).cast("int"))).alias("published_at"),
        F.when(p % 3 == 0, "general").when(p % 3 == 1, "news").otherwise("finance").alias("topic"),
        F.regexp_extract("url", "^https?://[^/]+/([a-z]+)", 1).alias("country"),
        *more,
    )


def sql_text(column: str) -> str:
    """HTML to text, the SQL side of :func:`siftwell.functions.html.html_text`."""
    text = column
    for pattern in html.HIDDEN:
        text = f"regexp_replace({text}, '{pattern}', ' ', 'g')"
    text = f"regexp_replace({text}, '{html.TAG}', ' ', 'g')"
    return f"trim(regexp_replace({sql_decode(text)}, '[ \\t\\r\\n]+', ' ', 'g'))"


def sql_decode(text: str) -> str:
    for reference, character in html.ENTITIES:
        character = character.replace("'", "''")
        text = f"replace({text}, '{reference}', '{character}')"
    return text


SQL_TITLE = sql_decode(f"trim(regexp_extract(html, '{html.TITLE}', 1))")
# All links and images of the given pages are in double quotes.
SQL_LINK = '(?i)<a\\s[^>]*href="([^"]*)"'
SQL_IMAGE = '(?i)<img\\s[^>]*src="([^"]*)"'
SQL_HOST = "lower(regexp_extract({}, '" + urls.HOST + "', 1))"
SQL_PATH = "regexp_extract({}, '" + urls.PATH + "', 1)"


def sql_normalize(column: str) -> str:
    return f"regexp_replace(regexp_replace(trim({column}), '#.*$', ''), '^([A-Za-z]+://[^/?#]*)/$', '\\1')"


CORPUS = f"""
corpus AS (
  SELECT page_id AS doc_id, url, {SQL_TITLE} AS title, {sql_text('html')} AS content,
    TIMESTAMP '2024-01-31' - to_days((page_id % 400)::INT) AS published_at,
    CASE page_id % 3 WHEN 0 THEN 'general' WHEN 1 THEN 'news' ELSE 'finance' END AS topic,
    regexp_extract(url, '^https?://[^/]+/([a-z]+)', 1) AS country
  FROM pages)"""


def foreign(spark: SparkSession, sf: str) -> DataFrame:
    return foreign_from(table(spark, sf, "pages"), table(spark, sf, "benchmark"))


def foreign_from(pages: DataFrame, items: DataFrame) -> DataFrame:
    """Every page is a ranked result of one query, dealt out by id; rank needs no window."""
    total = items.agg(F.count("*")).scalar()
    p = F.col("doc_id")
    dealt = (
        corpus_from(pages)
        .withColumn("qid", p % total)
        .withColumn("rank", (div(p, total) + 1).cast("long"))
        .withColumn("score", ((p * 37 + F.col("qid") * 11) % 100) / F.lit(100.0))
    )
    texts = items.select(F.col("item_id").alias("qid"), F.col("text").alias("query"))
    return dealt.join(texts, "qid").select(
        "qid", "query", "rank", "url", "title", "content", "score", "published_at", "topic", "country"
    )


FOREIGN = """
dealt AS (
  SELECT *, doc_id % (SELECT count(*) FROM benchmark) AS qid,
    doc_id // (SELECT count(*) FROM benchmark) + 1 AS rank FROM corpus),
foreign_results AS (
  SELECT qid, text AS query, rank, url, title, content,
    ((doc_id*37 + qid*11) % 100) / 100.0::DOUBLE AS score, published_at, topic, country
  FROM dealt JOIN benchmark ON qid = item_id)"""


def with_tables(*parts: str) -> str:
    """``WITH a AS (...), b AS (...)`` from CTE texts."""
    return "WITH " + ",".join(parts) + "\n"


S = with_tables(STORE)
SQ = with_tables(STORE, QUERIES)
F_ = with_tables(CORPUS, FOREIGN)
SQF = with_tables(STORE, QUERIES, CORPUS, FOREIGN)
SIM = "round(list_dot_product({a}::DOUBLE[], {b}::DOUBLE[]) / (sqrt(list_dot_product({a}::DOUBLE[], {a}::DOUBLE[])) * sqrt(list_dot_product({b}::DOUBLE[], {b}::DOUBLE[]))), 6)"
COS = SIM.format(a="qvec", b="embeddings")
