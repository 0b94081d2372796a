"""Registered queries: vector search, text search and the retrieval flows."""

from __future__ import annotations

from pyspark.sql import functions as F

from siftwell.config import RetrievalConfig
from siftwell.operators import filters, knn as nn, text_blocks, text_index, topk
from siftwell.plans import modes
from siftwell.workload import fixtures as fx
from siftwell.workload.fixtures import COS, NOW, S, SIM, SQ, SQF
from siftwell.workload.registry import check

K = 5
FLOOR = 0.4
TTL = 86400
FRESH = """(expires_at > TIMESTAMP '2024-01-31' OR (expires_at IS NULL
  AND added_at >= TIMESTAMP '2024-01-31' - INTERVAL 24 HOURS))"""


def ranked(source: str, k: int, where: str = "TRUE", name: str = "hits") -> str:
    """CTE: best k store rows per query by cosine among rows satisfying ``where``."""
    return f"""{name} AS (
  SELECT qid, rank, doc_id, score FROM (
    SELECT qid, doc_id, score, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id) AS rank
    FROM (SELECT qid, doc_id, {COS} AS score FROM queries, {source} WHERE embeddings IS NOT NULL AND {where}))
  WHERE rank <= {k})"""




@check(
    "knn_exact",
    f"""WITH scored AS (
  SELECT a.vec_id AS qid, b.vec_id AS doc_id, {SIM.format(a='a.embedding', b='b.embedding')} AS score
  FROM embeddings a, embeddings b)
SELECT qid, rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id) AS rank FROM scored)
WHERE rank <= {K}""",
)
def knn_exact(spark, sf):
    """Every vector asks for its nearest rows in the whole table."""
    vectors = fx.table(spark, sf, "embeddings")
    asked = vectors.select(F.col("vec_id").alias("qid"), F.col("embedding").alias("qvec"))
    return nn.knn(vectors, asked, K, id_col="vec_id", vec_col="embedding")


for metric, sql_distance in {
    "euclidean": "sqrt(list_sum(list_transform(range(1, len(qvec)+1), lambda i: (qvec[i]::DOUBLE - embeddings[i]::DOUBLE)^2)))",
    "manhattan": "list_sum(list_transform(range(1, len(qvec)+1), lambda i: abs(qvec[i]::DOUBLE - embeddings[i]::DOUBLE)))",
    "dot": "-list_dot_product(qvec::DOUBLE[], embeddings::DOUBLE[])",
}.items():

    def by_metric(spark, sf, metric=metric):
        return nn.knn(fx.store(spark, sf), fx.queries(spark, sf), K, metric)

    check(
        f"knn_exact_{metric}",
        SQ
        + f"""SELECT qid, rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id) AS rank FROM (
    SELECT qid, doc_id, round(1 - ({sql_distance}), 6) AS score FROM queries, store WHERE embeddings IS NOT NULL))
WHERE rank <= {K}""",
    )(by_metric)


@check(
    "project_local",
    SQ + "," + ranked("store", K) + "SELECT qid, content, score, 'local' AS origin FROM hits JOIN store USING (doc_id)",
)
def project_local(spark, sf):
    store = fx.store(spark, sf)
    hits = nn.knn(store, fx.queries(spark, sf), K)
    return nn.project_local(nn.attach_content(hits, store)).select("qid", "content", "score", "origin")


@check("project_foreign", fx.F_ + "SELECT qid, rank, content, score, 'foreign' AS origin FROM foreign_results")
def project_foreign(spark, sf):
    return nn.project_foreign(fx.foreign(spark, sf)).drop("doc_id")


@check(
    "filter_score_threshold",
    SQ + "," + ranked("store", 10) + f"SELECT qid, rank, doc_id, score FROM hits WHERE score >= {FLOOR}",
)
def filter_score_threshold(spark, sf):
    hits = nn.knn(fx.store(spark, sf), fx.queries(spark, sf), 10)
    return hits.filter(filters.scores_at_least(FLOOR))


@check(
    "topk_per_query",
    fx.F_
    + """SELECT qid, rank, url, score FROM (SELECT qid, url, score,
  row_number() OVER (PARTITION BY qid ORDER BY score DESC, url) AS rank FROM foreign_results) WHERE rank <= 5""",
)
def topk_per_query(spark, sf):
    scored = fx.foreign(spark, sf).select("qid", "url", "score")
    return topk.topk_per_query(scored, K, "url")


DEDUP_SCOPE = """provider_name = 'web' AND inserted_from = 'web' AND (memory_scope IS NULL
  OR memory_scope <> 'cache_only' OR expires_at IS NULL OR expires_at > TIMESTAMP '2024-01-31')"""
NEAREST = f"""nearest AS (
  SELECT e.vec_id AS qid, max({SIM.format(a='e.embedding', b='s.embeddings')}) AS similarity
  FROM embeddings e, store s WHERE {DEDUP_SCOPE} GROUP BY 1)"""


@check("nearest_similarity", S + "," + NEAREST + " SELECT qid, similarity FROM nearest")
def nearest_similarity(spark, sf):
    store = fx.store(spark, sf)
    rule = filters.suppresses_duplicates(store.columns, NOW, fx.TAG)
    asked = fx.table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("qid"), F.col("embedding").alias("qvec")
    )
    return nn.nearest_similarity(asked, store, rule)


# --- text -----------------------------------------------------------------------------------------

POSTINGS = """
tokens AS (SELECT doc_id, unnest(regexp_extract_all(lower({text}), '[a-z0-9]+')) AS term FROM {docs}),
lengths AS (SELECT doc_id, count(*) AS doc_length FROM tokens GROUP BY 1),
postings AS (SELECT doc_id, term, count(*) AS tf FROM tokens GROUP BY 1, 2),
frequencies AS (SELECT term, count(*) AS df FROM postings GROUP BY 1),
totals AS (SELECT (SELECT count({text}) FROM {docs}) AS n_docs,
  (SELECT sum(tf) FROM postings)::DOUBLE / (SELECT count({text}) FROM {docs}) AS mean_length)"""
BM25 = """
query_terms AS (SELECT DISTINCT qid, unnest(regexp_extract_all(lower(query), '[a-z0-9]+')) AS term FROM {queries}),
text_scores AS (
  SELECT qid, doc_id, round(sum(ln(1.0 + (n_docs - df + 0.5) / (df + 0.5)) *
    (tf * 2.2) / (tf + 1.2 * (0.25 + 0.75 * doc_length / mean_length))), 6) AS raw
  FROM query_terms JOIN postings USING (term) JOIN frequencies USING (term) JOIN lengths USING (doc_id), totals
  GROUP BY 1, 2),
ceilings AS (SELECT qid, 2.2 * sum(ln(1.0 + (n_docs - coalesce(df, 0) + 0.5) / (coalesce(df, 0) + 0.5))) AS ceiling
  FROM query_terms LEFT JOIN frequencies USING (term), totals GROUP BY 1)"""


def text_hits(k: int, where: str = "TRUE", name: str = "text_hits") -> str:
    return f"""{name} AS (
  SELECT qid, rank, doc_id, round(raw / ceiling, 6) AS score FROM (
    SELECT *, row_number() OVER (PARTITION BY qid ORDER BY raw DESC, doc_id) AS rank
    FROM text_scores WHERE {where}) JOIN ceilings USING (qid) WHERE rank <= {k})"""


DOC_POSTINGS = POSTINGS.format(docs="documents", text="text")
def _items(spark, sf):
    return fx.table(spark, sf, "benchmark").select(F.col("item_id").alias("qid"), F.col("text").alias("query"))


ITEMS = "items AS (SELECT item_id AS qid, text AS query FROM benchmark)"


@check("text_index_build", "WITH " + DOC_POSTINGS + " SELECT doc_id, term, tf, doc_length FROM postings JOIN lengths USING (doc_id)")
def text_index_build(spark, sf):
    return text_index.text_postings(fx.table(spark, sf, "documents"), "doc_id", "text")


@check(
    "corpus_stats",
    "WITH " + DOC_POSTINGS + " SELECT term, df, n_docs, round(mean_length, 6) AS mean_length FROM frequencies, totals",
)
def corpus_stats(spark, sf):
    stats = text_index.corpus_stats(fx.table(spark, sf, "documents"), "doc_id", "text")
    return stats.withColumn("mean_length", F.round("mean_length", 6))


@check(
    "text_search",
    f"WITH {ITEMS},{DOC_POSTINGS},{BM25.format(queries='items')},{text_hits(10)} SELECT * FROM text_hits",
)
def text_search(spark, sf):
    """Every benchmark item searched in all documents, by whole texts, from their stored index."""
    return text_blocks.index_search(fx.text_index(spark, sf, "documents"), _items(spark, sf), 10)


@check(
    "scan_text_search",
    f"WITH {ITEMS},{DOC_POSTINGS},{BM25.format(queries='items')},{text_hits(10)} SELECT * FROM text_hits",
)
def scan_text_search(spark, sf):
    """The same without an index: the texts are scanned."""
    return text_index.text_search(fx.table(spark, sf, "documents"), _items(spark, sf), 10, text_col="text")


def sql_tokens(text: str) -> str:
    return f"' ' || array_to_string(regexp_extract_all(lower({text}), '[a-z0-9]+'), ' ') || ' '"


QUOTED_ITEMS = """quoted_items AS (SELECT item_id AS qid,
  '"' || array_to_string(string_split(text, ' ')[2:4], ' ') || '" ' || text AS query FROM benchmark),
told AS (SELECT qid, unnest(regexp_extract_all(query, '"([^"]+)"', 1)) AS phrase FROM quoted_items),
phrase_hits AS (
  SELECT qid, doc_id FROM told, documents GROUP BY qid, doc_id
  HAVING bool_and(contains({text}, {phrase})))""".format(text=sql_tokens("coalesce(text, '')"), phrase=sql_tokens("phrase"))


def _quoted_items(spark, sf):
    """Every item with three of its words as a phrase before it."""
    phrase = F.array_join(F.slice(F.split("query", " "), 2, 3), " ")
    return _items(spark, sf).select("qid", F.concat(F.lit('"'), phrase, F.lit('" '), "query").alias("query"))


@check("phrase_matches", f"WITH {QUOTED_ITEMS} SELECT qid, doc_id FROM phrase_hits")
def phrase_matches(spark, sf):
    """Documents that hold a phrase, from the positions in the stored index."""
    return text_blocks.phrase_matches(fx.text_index(spark, sf, "documents"), _quoted_items(spark, sf))


@check(
    "phrase_search",
    f"WITH {QUOTED_ITEMS},{DOC_POSTINGS},{BM25.format(queries='quoted_items')},"
    + text_hits(10, "(qid, doc_id) IN (SELECT qid, doc_id FROM phrase_hits)") + " SELECT * FROM text_hits",
)
def phrase_search(spark, sf):
    """Best documents of each item among those that hold its phrase."""
    return text_blocks.index_search(fx.text_index(spark, sf, "documents"), _quoted_items(spark, sf), 10, phrases=True)


STORE_TEXT = POSTINGS.format(docs="store", text="content") + "," + BM25.format(queries="queries")
CANDIDATES = (
    STORE_TEXT
    + ","
    + text_hits(K, "doc_id IN (SELECT doc_id FROM store WHERE embeddings IS NOT NULL)")
    + ","
    + ranked("store", K, name="vector_hits")
    + f""", candidates AS (
  SELECT qid, doc_id, score AS vector_score, 0.0::DOUBLE AS text_score FROM vector_hits
  UNION ALL
  SELECT t.qid, t.doc_id, {COS} AS vector_score, t.score AS text_score
  FROM text_hits t JOIN store USING (doc_id) JOIN queries ON queries.qid = t.qid)"""
)
FUSED = CANDIDATES + """, fused AS (
  SELECT qid, doc_id, round(max(vector_score) + max(text_score), 6) AS score FROM candidates GROUP BY 1, 2),
fused_top AS (SELECT qid, rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id) AS rank FROM fused) WHERE rank <= 5)"""


@check("candidate_union", SQ + "," + CANDIDATES + " SELECT qid, doc_id, vector_score, text_score FROM candidates")
def candidate_union(spark, sf):
    return modes.hybrid_candidates(fx.store(spark, sf), fx.queries(spark, sf), K)


@check("fuse_scores", SQ + "," + FUSED + " SELECT qid, doc_id, score FROM fused")
def fuse_scores(spark, sf):
    return modes.fuse_scores(modes.hybrid_candidates(fx.store(spark, sf), fx.queries(spark, sf), K))


@check(
    "candidate_join_back",
    SQ + "," + FUSED + " SELECT qid, rank, doc_id, score, content, source_url FROM fused_top JOIN store USING (doc_id)",
)
def candidate_join_back(spark, sf):
    store = fx.store(spark, sf)
    hits = modes.native_hybrid_hits(store, fx.queries(spark, sf), K)
    return nn.attach_content(hits, store, columns=("content", "source_url"))


@check(
    "native_hybrid",
    SQ + "," + FUSED + " SELECT qid, rank, doc_id, content, score, 'local' AS origin FROM fused_top JOIN store USING (doc_id)",
)
def native_hybrid(spark, sf):
    cfg = RetrievalConfig(max_results=K, native_hybrid=True)
    return modes.native_hybrid(fx.queries(spark, sf), fx.store(spark, sf), cfg, index=fx.text_index(spark, sf, "store"))


# --- flows ----------------------------------------------------------------------------------------

FIRST_FOREIGN = """capped AS (SELECT qid, rank, NULL::BIGINT AS doc_id, content, score, 'foreign' AS origin FROM (
  SELECT *, row_number() OVER (PARTITION BY qid ORDER BY rank) AS pos FROM foreign_results) WHERE pos <= 5)"""
LOCAL = """local AS (SELECT qid, rank, doc_id, content, score, 'local' AS origin FROM hits JOIN store USING (doc_id))"""
MERGED = SQF + "," + ranked("store", K) + "," + LOCAL + "," + FIRST_FOREIGN + ", merged AS (SELECT * FROM local UNION ALL SELECT * FROM capped)"
RANKED = MERGED + """, best AS (SELECT qid, pos AS rank, doc_id, content, score, origin FROM (
  SELECT *, row_number() OVER (PARTITION BY qid ORDER BY coalesce(score, 0) DESC, origin = 'foreign', rank) AS pos
  FROM merged) WHERE pos <= 5)"""


def _merged(spark, sf):
    store = fx.store(spark, sf)
    hits = nn.knn(store, fx.queries(spark, sf), K)
    local = nn.project_local(nn.attach_content(hits, store))
    return modes.merge_local_foreign(
        local, nn.project_foreign(modes.capped_foreign(fx.foreign(spark, sf), K))
    )


@check("merge_local_foreign", MERGED + " SELECT * FROM merged")
def merge_local_foreign(spark, sf):
    return _merged(spark, sf)


@check("rank_merge", RANKED + " SELECT * FROM best")
def rank_merge(spark, sf):
    return topk.rank_by_score(_merged(spark, sf), K)


@check("hybrid_search", RANKED + " SELECT * FROM best")
def hybrid_search(spark, sf):
    cfg = RetrievalConfig(max_results=K)
    return modes.hybrid_search(
        fx.queries(spark, sf), fx.store(spark, sf), cfg, NOW, fx.foreign(spark, sf)
    )


BOTH_FLOOR = 0.75
BY_BOTH = SQF + "," + STORE_TEXT + "," + text_hits(K, f"doc_id IN (SELECT doc_id FROM store WHERE embeddings IS NOT NULL AND {FRESH})") + "," + ranked(
    "store", K, FRESH, "vector_hits"
) + f""", both_candidates AS (
  SELECT qid, doc_id, score AS vector_score, 0.0::DOUBLE AS text_score FROM vector_hits
  UNION ALL
  SELECT t.qid, t.doc_id, {COS} AS vector_score, t.score AS text_score
  FROM text_hits t JOIN store USING (doc_id) JOIN queries ON queries.qid = t.qid),
both_fused AS (SELECT qid, doc_id, round(max(vector_score) + max(text_score), 6) AS score FROM both_candidates GROUP BY 1, 2),
both_hits AS (SELECT qid, rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id) AS rank FROM both_fused) WHERE rank <= {K}),
""" + FIRST_FOREIGN


SCOPED = "memory_scope IN ('cache_only', 'cache_plus_memory')"
TIERS = (
    SQF
    + ","
    + ranked("store", K, FRESH, "fresh_hits")
    + ","
    + ranked("store", K, f"{FRESH} AND {SCOPED}", "cache_hits")
    + ","
    + ranked("store", K, "memory_scope = 'cache_plus_memory'", "memory_hits")
    + ","
    + FIRST_FOREIGN
)


def _tier_rows(tiers: list[str]) -> str:
    """Rows of the first tier that answers, per query."""
    parts = [
        f"""SELECT {i} AS tier, qid, rank, doc_id, content, score, 'local' AS origin
  FROM {name} JOIN store USING (doc_id) WHERE score >= {FLOOR}"""
        for i, name in enumerate(tiers)
    ]
    parts.append(f"SELECT {len(tiers)} AS tier, * FROM capped WHERE qid IN (SELECT qid FROM queries)")
    return f""", tiers AS ({' UNION ALL '.join(parts)})
SELECT qid, rank, doc_id, content, score, origin FROM tiers t
WHERE tier = (SELECT min(tier) FROM tiers u WHERE u.qid = t.qid)"""


@check(
    "tier_fallback",
    TIERS + f" SELECT qid FROM queries WHERE qid NOT IN (SELECT qid FROM cache_hits WHERE score >= {FLOOR})",
)
def tier_fallback(spark, sf):
    store, asked = fx.store(spark, sf), fx.queries(spark, sf)
    rule = filters.is_fresh(store.columns, TTL, NOW) & filters.in_scopes(store.columns, modes.CACHE_SCOPES)
    hits = nn.knn(store, asked, K, eligible=rule).filter(filters.scores_at_least(FLOOR))
    return modes.tier_fallback(asked, hits).select("qid")


@check("freshness_cache", TIERS + _tier_rows(["fresh_hits"]))
def freshness_cache(spark, sf):
    cfg = RetrievalConfig("freshness_cache", max_results=K, cache_ttl_seconds=TTL, cache_score_threshold=FLOOR)
    return modes.freshness_cache(
        fx.queries(spark, sf), fx.store(spark, sf), cfg, NOW, fx.foreign(spark, sf)
    )


@check("cache_then_memory", TIERS + _tier_rows(["cache_hits", "memory_hits"]))
def cache_then_memory(spark, sf):
    cfg = RetrievalConfig(
        "cache_then_memory",
        max_results=K,
        cache_ttl_seconds=TTL,
        cache_score_threshold=FLOOR,
        memory_score_threshold=FLOOR,
    )
    return modes.cache_then_memory(
        fx.queries(spark, sf), fx.store(spark, sf), cfg, NOW, fx.foreign(spark, sf)
    )


@check("freshness_cache_by_both", BY_BOTH + _tier_rows(["both_hits"]).replace(f"score >= {FLOOR}", f"score >= {BOTH_FLOOR}"))
def freshness_cache_by_both(spark, sf):
    """The cache searched by vector and text; a weak match of both falls back to foreign results."""
    cfg = RetrievalConfig(
        "freshness_cache", max_results=K, cache_ttl_seconds=TTL, cache_score_threshold=BOTH_FLOOR, native_hybrid=True
    )
    return modes.freshness_cache(
        fx.queries(spark, sf), fx.store(spark, sf), cfg, NOW, fx.foreign(spark, sf), fx.text_index(spark, sf, "store")
    )
