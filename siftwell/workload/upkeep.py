"""Registered queries: store scans, filters, saving, merging and cleanup."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from siftwell.config import RetrievalConfig
from siftwell.functions.embedding import hash_embedding
from siftwell.operators import filters, lifecycle, topk
from siftwell.operators.sizing import spread
from siftwell.session import scratch_path
from siftwell.sources import store as st
from siftwell.workload import fixtures as fx
from siftwell.workload.fixtures import F_, NOW, S, SIM, TAG, stamp
from siftwell.workload.registry import check
from siftwell.workload.retrieval import DEDUP_SCOPE, FRESH

TTL = 86400
STAMP = "strftime({0}, '%Y-%m-%d %H:%M:%S') AS {0}"
EXPIRED = """(expires_at < TIMESTAMP '2024-01-31' OR (expires_at IS NULL
  AND added_at < TIMESTAMP '2024-01-31' - INTERVAL 24 HOURS))"""
UNSCOPED = """(retrieval_mode IN ('freshness_cache', 'cache_then_memory')
  AND provider_name = 'web' AND inserted_from = 'web')"""


# --- scans and columns ----------------------------------------------------------------------------


@check(
    "store_scan",
    S
    + """SELECT doc_id, label, content_hash, length(content) AS n_chars, round(list_sum(list_transform(embeddings, lambda x: x::DOUBLE)), 6) AS total,
  strftime(expires_at, '%Y-%m-%d %H:%M:%S') AS expires_at FROM store""",
)
def store_scan(spark, sf):
    """A written store opened by its own column names: checked, and its texts and vectors read."""
    path = scratch_path(spark, "opened-store")
    fx.store(spark, sf).withColumnsRenamed({"content": "body", "embeddings": "vector"}).write.parquet(path)
    opened = st.open_store(spark, path, {"body": "content", "vector": "embeddings"}, ("doc_id", "expires_at"))
    total = F.aggregate("embeddings", F.lit(0.0), lambda a, x: a + x)
    return opened.select(
        "doc_id", "label", F.sha2("content", 256).alias("content_hash"), F.length("content").cast("long").alias("n_chars"),
        F.round(total, 6).alias("total"), stamp("expires_at").alias("expires_at"),
    )


@check(
    "store_ensure_columns",
    """SELECT doc_id, NULL::VARCHAR AS raw_payload, NULL::VARCHAR AS memory_scope, NULL::BIGINT AS query_count,
  'added_at,cache_hit,content_hash,expires_at,inserted_from,last_seen_at,memory_scope,provider_name,query_count,raw_payload,retrieval_mode,retrieval_query,retrieval_timestamp,source_title,source_url' AS added
FROM documents""",
)
def store_ensure_columns(spark, sf):
    minimal = fx.store(spark, sf).select("doc_id", "content", "embeddings")
    full, added = st.ensure_columns(minimal)
    return full.select(
        "doc_id", "raw_payload", "memory_scope", "query_count", F.lit(",".join(sorted(added))).alias("added")
    )


@check(
    "store_append",
    fx.with_tables(fx.STORE, fx.CORPUS, fx.FOREIGN)
    + """SELECT doc_id, content, source_url, memory_scope, NULL::VARCHAR AS topic FROM store
UNION ALL SELECT NULL, content, url, NULL, topic FROM foreign_results""",
)
def store_append(spark, sf):
    docs = fx.foreign(spark, sf).select(
        "content", F.array().cast("array<float>").alias("embeddings"), F.col("url").alias("source_url"), "topic"
    )
    both = st.append(fx.store(spark, sf), docs)
    return both.select("doc_id", "content", "source_url", "memory_scope", "topic")


@check(
    "store_delete_where",
    S
    + """SELECT retrieval_query, count(*) FILTER (NOT gone) AS kept, count(*) FILTER (gone) AS deleted
FROM (SELECT retrieval_query, coalesce(retrieval_query = 'query 3' AND provider_name <> 'manual', false) AS gone FROM store)
GROUP BY 1""",
)
def store_delete_where(spark, sf):
    store = fx.store(spark, sf)
    doomed = (F.col("retrieval_query") == "query 3") & (F.col("provider_name") != "manual")
    survivors = st.delete_where(store, doomed).groupBy("retrieval_query").agg(F.count("*").alias("kept"))
    before = store.groupBy("retrieval_query").agg(F.count("*").alias("all"))
    kept = F.coalesce("kept", F.lit(0))
    return before.join(survivors, "retrieval_query", "left").select(
        "retrieval_query", kept.alias("kept"), (F.col("all") - kept).alias("deleted")
    )


# --- filters --------------------------------------------------------------------------------------


def _filter(name: str, where: str, rule, drop: tuple[str, ...] = ()) -> None:
    def run(spark, sf):
        store = fx.store(spark, sf).drop(*drop)
        return store.filter(rule(store.columns)).select("doc_id", "content_hash")

    check(name, S + f"SELECT doc_id, content_hash FROM store WHERE {where}")(run)


_filter("filter_has_embedding", "embeddings IS NOT NULL", lambda _c: F.col("embeddings").isNotNull())
_filter("filter_freshness", FRESH, lambda c: filters.is_fresh(c, TTL, NOW))
_filter(
    "filter_freshness_expiry_only",
    "expires_at > TIMESTAMP '2024-01-31'",
    lambda c: filters.is_fresh(c, TTL, NOW),
    ("added_at",),
)
_filter(
    "filter_freshness_age_only",
    "added_at >= TIMESTAMP '2024-01-30'",
    lambda c: filters.is_fresh(c, TTL, NOW),
    ("expires_at",),
)
_filter(
    "filter_metadata",
    "provider_name = 'web' AND memory_scope IS NULL AND retrieval_mode IN ('freshness_cache', 'hybrid_search')",
    lambda _c: filters.matches_metadata(
        {"provider_name": "web", "memory_scope": None, "retrieval_mode": ["freshness_cache", "hybrid_search"]}
    ),
)
_filter("filter_metadata_empty", "false", lambda _c: filters.matches_metadata({"provider_name": []}))
_filter(
    "filter_memory_scope",
    "memory_scope IN ('cache_only', 'cache_plus_memory')",
    lambda c: filters.in_scopes(c, ("cache_only", "cache_plus_memory")),
)
_filter("filter_dedup_scope", DEDUP_SCOPE, lambda c: filters.suppresses_duplicates(c, NOW, TAG))


# --- cleanup --------------------------------------------------------------------------------------


def _cleanup(name: str, doomed: str, drop: tuple[str, ...] = ()) -> None:
    def run(spark, sf):
        store = fx.store(spark, sf).drop(*drop)
        return lifecycle.cleanup_expired(store, TTL, NOW, TAG).select("doc_id", "content_hash")

    check(name, S + f"SELECT doc_id, content_hash FROM store WHERE NOT coalesce({doomed}, false)")(run)


SCOPED_DOOM = f"{EXPIRED} AND (memory_scope = 'cache_only' OR (memory_scope IS NULL AND {UNSCOPED}))"
AGED = "added_at < TIMESTAMP '2024-01-30'"
_cleanup("cleanup_expired", f"({SCOPED_DOOM})")
_cleanup("cleanup_expired_no_expiry", f"(memory_scope = 'cache_only' AND {AGED})", ("expires_at",))
_cleanup("cleanup_expired_no_scope", f"({AGED} AND {UNSCOPED})", ("memory_scope",))
_cleanup("cleanup_expired_no_mode", "false", ("memory_scope", "retrieval_mode"))


@check(
    "auto_cleanup",
    S
    + f"""SELECT 'due' AS run, count(*) AS kept FROM store WHERE NOT coalesce({SCOPED_DOOM}, false)
UNION ALL SELECT 'not due', count(*) FROM store""",
)
def auto_cleanup(spark, sf):
    cfg = RetrievalConfig("freshness_cache", auto_cleanup=True, cache_ttl_seconds=TTL)
    store = fx.store(spark, sf)
    due, _ = lifecycle.maintenance(store, cfg, NOW, NOW - timedelta(hours=2))
    early, _ = lifecycle.maintenance(store, cfg, NOW, NOW - timedelta(minutes=30))
    parts = [
        df.agg(F.count("*").alias("kept")).select(F.lit(name).alias("run"), "kept")
        for name, df in (("due", due), ("not due", early))
    ]
    return parts[0].unionByName(parts[1])


# --- near-duplicates ------------------------------------------------------------------------------

NEAR = 0.4


@check(
    "semantic_dedup",
    S
    + f""", nearest AS (SELECT e.vec_id, max({SIM.format(a='e.embedding', b='s.embeddings')}) AS similarity
  FROM embeddings e, store s WHERE {DEDUP_SCOPE} GROUP BY 1)
SELECT vec_id AS doc_id FROM embeddings WHERE vec_id % 6 <> 0
  AND vec_id NOT IN (SELECT vec_id FROM nearest WHERE similarity >= {NEAR})
UNION ALL SELECT vec_id FROM embeddings WHERE vec_id % 6 = 0""",
)
def semantic_dedup(spark, sf):
    """Every vector offered again; a sixth of the rows carry a merge key and bypass the check."""
    key = F.when(F.col("vec_id") % 6 == 0, F.col("vec_id").cast("string"))
    offered = fx.table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("doc_id"), F.col("embedding").alias("embeddings"), key.alias("source_url")
    )
    kept = lifecycle.semantic_dedup(offered, fx.store(spark, sf), NEAR, NOW, TAG, "source_url")
    return kept.select("doc_id")


HASHED = """
hash_tokens AS (SELECT doc_id, unnest(regexp_extract_all(lower(content), '[a-z0-9]+')) AS token FROM {docs}),
hash_parts AS (
  SELECT doc_id, ('0x' || substr(sha256(token), 1, 8))::BIGINT % 64 AS idx,
    sum(CASE WHEN ('0x' || substr(sha256(token), 9, 2))::BIGINT % 2 = 0 THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END) AS value
  FROM hash_tokens GROUP BY 1, 2),
hash_norms AS (SELECT doc_id, sqrt(sum(value * value)) AS norm FROM hash_parts GROUP BY 1),
hash_cells AS (
  SELECT d.doc_id, i.idx, (coalesce(CASE WHEN norm > 0 THEN value / norm END, 0))::FLOAT AS value
  FROM {docs} d CROSS JOIN (SELECT unnest(range(64)) AS idx) i
  LEFT JOIN hash_parts p ON p.doc_id = d.doc_id AND p.idx = i.idx LEFT JOIN hash_norms n ON n.doc_id = d.doc_id),
hash_vectors AS (SELECT doc_id, list(value ORDER BY idx) AS embeddings FROM hash_cells GROUP BY 1)"""


@check(
    "hash_embedding",
    "WITH docs AS (SELECT doc_id, text AS content FROM documents),"
    + HASHED.format(docs="docs")
    + " SELECT doc_id, idx, round(value::DOUBLE, 6) AS value FROM hash_cells",
)
def hash_embedding_query(spark, sf):
    docs = spread(fx.table(spark, sf, "documents").select("doc_id", "text"))
    vectors = docs.select("doc_id", hash_embedding(F.col("text"), fx.DIM).alias("embeddings"))
    return vectors.select("doc_id", F.posexplode_outer("embeddings").alias("idx", "value")).select(
        "doc_id", F.col("idx").cast("long").alias("idx"), F.round(F.col("value").cast("double"), 6).alias("value")
    )


# --- saving ---------------------------------------------------------------------------------------

SAVE = RetrievalConfig(
    "cache_then_memory",
    provenance=True,
    upsert_key="content_hash",
    persist_score_threshold=0.3,
    max_persisted_foreign=4,
    dedup_similarity_threshold=0.33,
)
SELECTED = """
chosen AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY qid ORDER BY rank) AS pos FROM foreign_results WHERE score >= 0.3)
  WHERE pos <= 4)"""
PREPARED = (
    SELECTED
    + """,
prepared AS (
  SELECT ('0x' || substr(sha256(concat_ws('|', qid, rank, url, query, content, '2024-01-31T00:00:00')), 1, 15))::BIGINT AS doc_id,
    qid, rank, content, url AS source_url, title AS source_title, query AS retrieval_query,
    'cache_then_memory' AS retrieval_mode, 0 AS cache_hit, 'web' AS provider_name, 'cache_plus_memory' AS memory_scope,
    TIMESTAMP '2024-01-31' AS last_seen_at, TIMESTAMP '2024-02-01' AS expires_at, 1 AS query_count,
    CASE WHEN content <> '' THEN sha256(content) END AS content_hash FROM chosen)"""
)


@check("persist_cap", F_ + "," + SELECTED[1:] + " SELECT qid, rank, url, score FROM chosen")
def persist_cap(spark, sf):
    chosen = topk.persist_select(fx.foreign(spark, sf), 0.3, 4)
    return chosen.select("qid", "rank", "url", "score")


@check(
    "persist_prepare",
    F_
    + ","
    + PREPARED[1:]
    + f""" SELECT doc_id, content, source_url, source_title, retrieval_query, retrieval_mode, cache_hit, provider_name,
  memory_scope, {STAMP.format('expires_at')}, query_count, content_hash FROM prepared""",
)
def persist_prepare(spark, sf):
    docs = lifecycle.persist_prepare(
        fx.foreign(spark, sf), SAVE, NOW, list(st.OPTIONAL_COLUMNS), lifecycle.hashing_embedder(fx.DIM)
    )
    return docs.select(
        "doc_id", "content", "source_url", "source_title", "retrieval_query", "retrieval_mode", "cache_hit",
        "provider_name", "memory_scope", stamp("expires_at").alias("expires_at"), "query_count", "content_hash",
    )


def sql_write_through() -> str:
    """Store after merging by content hash; a keyed row bypasses the similarity check."""
    return (
        fx.with_tables(fx.STORE, fx.CORPUS, fx.FOREIGN)
        + ","
        + PREPARED[1:]
        + """, merged AS (
  SELECT content_hash, arg_min(doc_id, (qid, rank)) AS doc_id, arg_max(content, (qid, rank)) AS content,
    arg_max(source_url, (qid, rank)) AS source_url, arg_max(last_seen_at, (qid, rank)) AS last_seen_at, count(*) AS n
  FROM prepared GROUP BY 1),
changed AS (
  SELECT s.doc_id, coalesce(m.content, s.content) AS content, CASE WHEN m.content_hash IS NULL THEN s.source_url ELSE m.source_url END AS source_url,
    CASE WHEN m.content_hash IS NULL THEN s.last_seen_at ELSE m.last_seen_at END AS last_seen_at,
    CASE WHEN m.content_hash IS NULL THEN s.query_count ELSE coalesce(s.query_count, 0) + n END AS query_count, s.content_hash
  FROM store s LEFT JOIN merged m USING (content_hash)),
saved AS (SELECT * FROM changed UNION ALL
  SELECT doc_id, content, source_url, last_seen_at, n, content_hash FROM merged
  WHERE content_hash NOT IN (SELECT content_hash FROM store))
SELECT doc_id, content, source_url, strftime(last_seen_at, '%Y-%m-%d %H:%M:%S') AS last_seen_at, query_count, content_hash FROM saved"""
    )


def saved_view(df):
    return df.select(
        "doc_id", "content", "source_url", stamp("last_seen_at").alias("last_seen_at"),
        F.col("query_count").cast("long").alias("query_count"), "content_hash",
    )


@check("write_through", sql_write_through())
def write_through(spark, sf):
    """All selected pages saved into the store, merged by content hash."""
    return saved_view(
        lifecycle.write_through(
            fx.store(spark, sf), fx.foreign(spark, sf), SAVE, NOW, lifecycle.hashing_embedder(fx.DIM)
        )
    )


@check(
    "write_through_dedup",
    fx.with_tables(fx.STORE, fx.CORPUS, fx.FOREIGN)
    + ","
    + PREPARED[1:]
    + ", docs AS (SELECT doc_id, content FROM prepared),"
    + HASHED.format(docs="docs")
    + f""", nearest AS (SELECT v.doc_id, max({SIM.format(a='v.embeddings', b='s.embeddings')}) AS similarity
  FROM hash_vectors v, store s WHERE {DEDUP_SCOPE} GROUP BY 1)
SELECT doc_id, content FROM store UNION ALL
SELECT doc_id, content FROM docs WHERE doc_id NOT IN (SELECT doc_id FROM nearest WHERE similarity >= 0.33)""",
)
def write_through_dedup(spark, sf):
    """Saved without a merge key, so that near-duplicates of stored rows are dropped."""
    cfg = RetrievalConfig(
        "cache_then_memory", persist_score_threshold=0.3, max_persisted_foreign=4, dedup_similarity_threshold=0.33
    )
    saved = lifecycle.write_through(
        fx.store(spark, sf), fx.foreign(spark, sf), cfg, NOW, lifecycle.hashing_embedder(fx.DIM)
    )
    return saved.select("doc_id", "content")


# --- merging --------------------------------------------------------------------------------------


def incoming(spark, sf):
    """Documents offered for merging, derived from every store row: one key in five is new, one in
    ten is NULL, one row in seven comes twice with other columns provided."""
    v = F.col("doc_id")
    key = F.when(v % 10 == 0, None).when(
        v % 5 == 1, F.concat(F.lit("https://new.example/"), v.cast("string"))
    ).otherwise(F.col("source_url"))
    repeats = F.explode(F.when(v % 7 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    first = F.col("turn") == 0
    return (
        fx.store(spark, sf)
        .withColumn("turn", repeats)
        .withColumn("seq", v * 10 + F.col("turn"))
        .select(
            (F.lit(1000000) + F.col("seq")).alias("doc_id"),
            F.when(first, F.concat(F.lit("updated "), "source_title"))
            .otherwise(F.concat(F.lit("again "), v.cast("string"))).alias("content"),
            "embeddings",
            key.alias("source_url"),
            F.when(first & (v % 4 != 0), F.concat(F.lit("title "), v.cast("string"))).alias("source_title"),
            F.lit(1).cast("long").alias("query_count"),
            F.when(
                first, F.array(*[F.lit(c) for c in ("content", "embeddings", "source_url", "source_title", "query_count")])
            ).otherwise(F.array(*[F.lit(c) for c in ("content", "source_url", "query_count")])).alias("provided"),
            "seq",
        )
    )


INCOMING = """
incoming AS (
  SELECT 1000000 + doc_id*10 + turn AS doc_id, doc_id*10 + turn AS seq, turn,
    CASE WHEN turn = 0 THEN 'updated ' || source_title ELSE 'again ' || doc_id END AS content,
    CASE WHEN doc_id % 10 = 0 THEN NULL WHEN doc_id % 5 = 1 THEN 'https://new.example/' || doc_id ELSE source_url END AS source_url,
    CASE WHEN turn = 0 AND doc_id % 4 <> 0 THEN 'title ' || doc_id END AS source_title
  FROM (SELECT *, unnest(CASE WHEN doc_id % 7 = 0 THEN [0, 1] ELSE [0] END) AS turn FROM store)),
last_write AS (
  SELECT source_url, min(doc_id) AS doc_id, count(*) AS n, last(content ORDER BY seq) AS content,
    last(source_title ORDER BY seq) FILTER (turn = 0) AS source_title
  FROM incoming WHERE source_url IS NOT NULL GROUP BY 1)"""


@check(
    "last_write_per_key",
    S + "," + INCOMING[1:] + " SELECT source_url, doc_id, content, source_title, n AS writes, n AS query_count, true AS has_title FROM last_write",
)
def last_write_per_key(spark, sf):
    merged = lifecycle.last_write_per_key(incoming(spark, sf).filter("source_url IS NOT NULL"), "source_url")
    return merged.select(
        "source_url", "doc_id", "content", "source_title", "writes", "query_count",
        F.col("has_source_title").alias("has_title"),
    )


@check(
    "store_upsert",
    S
    + ","
    + INCOMING[1:]
    + """SELECT s.doc_id, s.source_url, coalesce(w.content, s.content) AS content,
    CASE WHEN w.source_url IS NULL THEN s.source_title ELSE w.source_title END AS source_title,
    CASE WHEN w.source_url IS NULL THEN s.query_count ELSE coalesce(s.query_count, 0) + n END AS query_count, s.content_hash
  FROM store s LEFT JOIN last_write w USING (source_url)
UNION ALL SELECT doc_id, source_url, content, source_title, n, NULL FROM last_write
  WHERE source_url NOT IN (SELECT source_url FROM store)
UNION ALL SELECT doc_id, source_url, content, source_title, 1, NULL FROM incoming WHERE source_url IS NULL""",
)
def store_upsert(spark, sf):
    merged = lifecycle.upsert(fx.store(spark, sf), incoming(spark, sf), "source_url")
    return merged.select("doc_id", "source_url", "content", "source_title", "query_count", "content_hash")


@check(
    "rows_delta",
    fx.with_tables(fx.STORE, fx.CORPUS, fx.FOREIGN)
    + ","
    + PREPARED[1:]
    + """, counts AS (SELECT retrieval_query, count(*) AS before, 0 AS added FROM store GROUP BY 1
  UNION ALL SELECT retrieval_query, 0, count(DISTINCT content_hash) FROM prepared GROUP BY 1)
SELECT retrieval_query, sum(before)::BIGINT AS rows_before, sum(before + added)::BIGINT AS rows_after, sum(added)::BIGINT AS delta FROM counts GROUP BY 1""",
)
def rows_delta(spark, sf):
    from siftwell.operators.metrics import rows_delta as delta

    store = fx.store(spark, sf)
    after = lifecycle.write_through(
        store, fx.foreign(spark, sf), SAVE, NOW, lifecycle.hashing_embedder(fx.DIM)
    )
    return delta(store, after)


@check(
    "persisted_listing",
    S
    + """SELECT retrieval_query, rank, memory_scope, retrieval_mode, cache_hit, query_count,
  CASE WHEN length(t) <= 40 THEN t ELSE regexp_extract(t, '^(.{0,37}) ', 1) || '...' END AS source_title,
  CASE WHEN length(p) <= 90 THEN p ELSE regexp_extract(p, '^(.{0,87}) ', 1) || '...' END AS preview FROM (
  SELECT *, trim(regexp_replace(coalesce(source_title, ''), '\\s+', ' ', 'g')) AS t,
    trim(regexp_replace(substr(coalesce(content, ''), 1, 120), '\\s+', ' ', 'g')) AS p,
    row_number() OVER (PARTITION BY retrieval_query ORDER BY last_seen_at DESC NULLS LAST, retrieval_timestamp DESC NULLS LAST, doc_id) AS rank
  FROM store) WHERE rank <= 10""",
)
def persisted_listing(spark, sf):
    return topk.persisted_listing(fx.store(spark, sf))
