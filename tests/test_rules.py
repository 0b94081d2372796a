"""Small hand-made cases of rules that depend on columns, NULLs and order."""

from datetime import datetime, timedelta

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from siftwell.config import RetrievalConfig
from siftwell.functions import html, text, urls
from siftwell.operators import filters, lifecycle, results, site, sizing, text_index, text_scan, topk
from siftwell.operators.metrics import origin_counts
from siftwell.plans import modes
from siftwell.sources import responses as rs
from siftwell.sources import store as st
from siftwell.workload import fixtures as fx

NOW = datetime(2024, 1, 31)
HOUR = timedelta(hours=1)


def ids(df, column="doc_id"):
    return sorted(r[0] for r in df.select(column).collect())


# --- store ----------------------------------------------------------------------------------------


def test_store_checks(spark):
    good = spark.createDataFrame([], "content string, embeddings array<float>")
    assert st.check_store(good) is good
    with pytest.raises(ValueError, match="memory_scope, source_url"):
        st.check_store(good, ("source_url", "memory_scope"))
    for bad in (
        "content int, embeddings array<float>",
        "content string, embeddings string",
        "content string, embeddings array<float>, raw_payload binary",
        "content string, embeddings array<float>, expires_at string",
        "content string, embeddings array<float>, query_count string",
    ):
        with pytest.raises(ValueError):
            st.check_store(spark.createDataFrame([], bad))


def test_open_store_renames(spark, tmp_path):
    path = str(tmp_path / "store")
    spark.createDataFrame([("a", [1.0])], "body string, v array<float>").write.parquet(path)
    assert st.open_store(spark, path, {"body": "content", "v": "embeddings"}).columns == ["content", "embeddings"]


def test_append_unites_columns(spark):
    a = spark.createDataFrame([("a", [1.0], 1)], "content string, embeddings array<float>, query_count long")
    b = spark.createDataFrame([("b", [1.0], "u")], "content string, embeddings array<float>, source_url string")
    rows = {r["content"]: r.asDict() for r in st.append(a, b).collect()}
    assert rows["a"]["source_url"] is None and rows["b"]["query_count"] is None
    with pytest.raises(ValueError):
        st.append(a, b.drop("embeddings"))


def test_delete_keeps_unknown(spark):
    df = spark.createDataFrame([(1, "q"), (2, None), (3, "r")], "doc_id long, retrieval_query string")
    doomed = F.col("retrieval_query") == "q"
    assert ids(st.delete_where(df, doomed)) == [2, 3]
    assert st.count_where(df, doomed).first()[0] == 1


def test_index_is_built_once(spark, tmp_path):
    built = []
    assert st.ensure_index(spark, str(tmp_path / "index"), built.append) is True
    assert st.ensure_index(spark, str(tmp_path / "index"), built.append) is False
    assert built == [str(tmp_path / "index")]
    assert st.index_name("docs", "content", "text") == "DOCS_CONTENT_TEXT_IDX"


# --- filters --------------------------------------------------------------------------------------


def lifecycle_rows(spark):
    """(id, added hours ago, expires in hours or NULL, scope, mode, tag)"""
    rows = [
        (1, 1, 5, "cache_only", "freshness_cache", "web"),
        (2, 1, -5, "cache_only", "freshness_cache", "web"),
        (3, 1, 0, "cache_only", "freshness_cache", "web"),
        (4, 1, None, "cache_only", "freshness_cache", "web"),
        (5, 30, None, "cache_only", "freshness_cache", "web"),
        (6, 30, -5, "cache_plus_memory", "freshness_cache", "web"),
        (7, 30, -5, None, "cache_then_memory", "web"),
        (8, 30, -5, None, "hybrid_search", "web"),
        (9, 30, -5, None, "freshness_cache", "manual"),
        (10, 30, -5, None, "freshness_cache", None),
        (11, 24, None, "cache_only", "freshness_cache", "web"),
    ]
    made = [
        (i, NOW - a * HOUR, None if e is None else NOW + e * HOUR, s, m, t, t) for i, a, e, s, m, t in rows
    ]
    return spark.createDataFrame(
        made,
        "doc_id long, added_at timestamp_ntz, expires_at timestamp_ntz, memory_scope string, "
        "retrieval_mode string, provider_name string, inserted_from string",
    )


def test_freshness_by_columns(spark):
    df = lifecycle_rows(spark)
    fresh = lambda d: ids(d.filter(filters.is_fresh(d.columns, 86400, NOW)))
    assert fresh(df) == [1, 4, 11]
    assert fresh(df.drop("added_at")) == [1]
    assert fresh(df.drop("expires_at")) == [1, 2, 3, 4, 11]
    with pytest.raises(ValueError):
        fresh(df.drop("expires_at", "added_at"))
    assert df.filter(filters.is_fresh(df.columns, None, NOW)).count() == 11


def test_cleanup_by_columns(spark):
    df = lifecycle_rows(spark)
    kept = lambda d, **o: ids(lifecycle.cleanup_expired(d, 86400, NOW, "web", **o))
    assert kept(df) == [1, 3, 4, 6, 8, 9, 10, 11]
    assert kept(df.drop("added_at")) == [1, 3, 4, 5, 6, 8, 9, 10, 11]
    assert kept(df.drop("expires_at")) == [1, 2, 3, 4, 6, 7, 8, 9, 10, 11]
    assert kept(df.drop("memory_scope")) == [1, 2, 3, 4, 8, 9, 10, 11]
    assert kept(df.drop("memory_scope", "retrieval_mode")) == list(range(1, 12))
    assert kept(df.drop("retrieval_mode")) == [1, 3, 4, 6, 7, 8, 9, 10, 11]
    assert lifecycle.count_expired(df, 86400, NOW, "web").first()[0] == 3
    with pytest.raises(ValueError):
        lifecycle.cleanup_expired(df, 0, NOW, "web")


def test_scope_filter_needs_its_column(spark):
    df = lifecycle_rows(spark)
    assert ids(df.filter(filters.in_scopes(df.columns, ("cache_plus_memory",)))) == [6]
    assert df.filter(filters.in_scopes(df.columns, ())).count() == 11
    with pytest.raises(ValueError):
        filters.in_scopes(["content"], ("cache_only",))


def test_metadata_filter_shapes(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "b", 1), (3, None, 2)], "doc_id long, x string, y int")
    keep = lambda f: ids(df.filter(filters.matches_metadata(f)))
    assert keep({}) == [1, 2, 3] and keep(None) == [1, 2, 3]
    assert keep({"x": None}) == [3]
    assert keep({"x": ["a", "b"], "y": 1}) == [2]
    assert keep({"x": ("a",)}) == [1] and keep({"x": {"b"}}) == [2]
    assert keep({"x": []}) == []


def test_threshold_must_be_finite(spark):
    with pytest.raises(ValueError):
        filters.scores_at_least(float("nan"))
    df = spark.createDataFrame([(1, 0.5), (2, None), (3, 0.4)], "doc_id long, score double")
    assert ids(df.filter(filters.scores_at_least(0.5))) == [1]


def test_domain_rules(spark):
    df = spark.createDataFrame(
        [(1, "https://a.example/x"), (2, "https://sub.a.example/"), (3, "https://nota.example/"), (4, "http://B.example:80/")],
        "doc_id long, url string",
    )
    assert ids(df.filter(filters.in_domains("url", ["a.example"]))) == [1, 2]
    assert ids(df.filter(filters.in_domains("url", None, ["a.example"]))) == [3, 4]
    listed = spark.createDataFrame([("b.example",)], "domain string")
    assert ids(filters.domain_list_filter(df, listed, True)) == [4]
    assert ids(filters.domain_list_filter(df, listed, False)) == [1, 2, 3]


def test_phrases(spark):
    df = spark.createDataFrame(
        [(1, 'find "Blue Sky" now', "a blue sky"), (2, 'find "blue sky" "no"', "blue sky"), (3, "blue", "red")],
        "doc_id long, q string, t string",
    )
    assert ids(df.filter(filters.contains_phrases(F.col("q"), F.col("t")))) == [1, 3]


# --- merging and saving ---------------------------------------------------------------------------


def test_upsert_absent_differs_from_null(spark):
    store = spark.createDataFrame(
        [(1, "old", "k1", "t1", 4), (2, "old", "k2", "t2", None), (3, "twin", "k2", "t3", 1), (4, "loose", None, "t4", 1)],
        "doc_id long, content string, source_url string, source_title string, query_count long",
    ).withColumn("embeddings", F.array(F.lit(1.0)).cast("array<float>"))
    rows = [
        (10, "new", "k1", None, 1, ["content", "source_title", "query_count"], 1),
        (11, "newer", "k1", "ignored", 1, ["content"], 2),
        (12, "new", "k2", None, 1, ["content", "query_count"], 3),
        (13, "first", "k9", "t", 1, ["content", "query_count"], 4),
        (14, "second", "k9", "t", 1, ["query_count"], 5),
        (15, "third", "k9", "last", 1, ["source_title", "query_count"], 6),
        (16, "plain", None, "p", 1, ["content", "source_title", "query_count"], 7),
        (17, "blank", "", "p", 1, ["content", "query_count"], 8),
    ]
    docs = spark.createDataFrame(
        rows,
        "doc_id long, content string, source_url string, source_title string, query_count long, provided array<string>, seq long",
    ).withColumn("embeddings", F.array(F.lit(2.0)).cast("array<float>"))
    got = {
        r["doc_id"]: (r["content"], r["source_url"], r["source_title"], r["query_count"])
        for r in lifecycle.upsert(store, docs, "source_url").collect()
    }
    assert got == {
        1: ("newer", "k1", None, 5),
        2: ("new", "k2", "t2", 1),
        3: ("new", "k2", "t3", 2),
        4: ("loose", None, "t4", 1),
        13: ("first", "k9", "last", 3),
        16: ("plain", None, "p", 1),
        17: ("blank", None, None, 1),
    }


def test_upsert_needs_store_columns(spark):
    store = spark.createDataFrame([], "doc_id long, content string, embeddings array<float>, source_url string")
    docs = spark.createDataFrame([], "doc_id long, content string, source_url string, extra string, provided array<string>, seq long")
    with pytest.raises(ValueError, match="extra"):
        lifecycle.upsert(store, docs, "source_url")


FOREIGN = [
    (1, "q", 1, "https://a.example/", "A", "first text", 0.95),
    (1, "q", 2, "https://b.example/", "B", "second text", 0.7),
    (1, "q", 3, "https://c.example/", "C", "third text", 0.9),
    (2, "r", 1, "", "D", "", None),
]
FOREIGN_SCHEMA = "qid long, query string, rank long, url string, title string, content string, score double"


def prepared(spark, columns, **settings):
    foreign = spark.createDataFrame(FOREIGN, FOREIGN_SCHEMA)
    return lifecycle.persist_prepare(
        foreign, RetrievalConfig(**settings), NOW, columns, lifecycle.hashing_embedder(8)
    )


def test_threshold_before_cap_in_arrival_order(spark):
    foreign = spark.createDataFrame(FOREIGN, FOREIGN_SCHEMA)
    assert ids(topk.persist_select(foreign, 0.8, 1), "url") == ["https://a.example/"]
    assert ids(topk.persist_select(foreign, 0.8, 2), "url") == ["https://a.example/", "https://c.example/"]
    assert topk.persist_select(foreign, None, None).count() == 4


def test_columns_written_follow_the_flags(spark):
    base = ["doc_id", "content", "embeddings"]
    lifecycle_columns = list(st.LIFECYCLE_COLUMNS)
    assert prepared(spark, []).columns == [*base, "provided", "seq"]
    assert "added_at" in prepared(spark, [], retrieval_mode="freshness_cache").columns
    assert "memory_scope" not in prepared(spark, ["memory_scope"], retrieval_mode="freshness_cache").columns
    assert "memory_scope" in prepared(spark, lifecycle_columns, retrieval_mode="freshness_cache").columns
    assert "memory_scope" not in prepared(spark, lifecycle_columns).columns
    assert {"source_url", "cache_hit"} <= set(prepared(spark, [], provenance=True).columns)
    assert "raw_payload" in prepared(spark, [], json_payload=True).columns


def test_key_is_provided_only_when_there_is_one(spark):
    rows = prepared(spark, [], upsert_key="source_url").collect()
    given = {r["source_url"]: "source_url" in r["provided"] for r in rows}
    assert given == {"https://a.example/": True, "https://b.example/": True, "https://c.example/": True, None: False}
    hashed = prepared(spark, [], upsert_key="content_hash").filter("content = ''").first()
    assert hashed["content_hash"] is None and "content_hash" not in hashed["provided"]


def test_dedup_is_against_the_store_only(spark):
    store = spark.createDataFrame([(1, [1.0, 0.0], "web", "web")], "doc_id long, embeddings array<float>, provider_name string, inserted_from string")
    docs = spark.createDataFrame(
        [(10, [1.0, 0.01], None), (11, [0.0, 1.0], None), (12, [0.0, 1.0], None), (13, [1.0, 0.0], "key"), (14, None, None), (15, [1.0, 0.0], "")],
        "doc_id long, embeddings array<float>, source_url string",
    )
    kept = lambda s: ids(lifecycle.semantic_dedup(docs, s, 0.9, NOW, "web", "source_url"))
    assert kept(store) == [11, 12, 13, 14]
    assert kept(store.limit(0)) == [10, 11, 12, 13, 14, 15]
    assert kept(store.withColumn("provider_name", F.lit(None).cast("string"))) == [10, 11, 12, 13, 14, 15]


def test_maintenance_at_most_once_per_interval(spark):
    df = lifecycle_rows(spark)
    cfg = RetrievalConfig("freshness_cache", auto_cleanup=True)
    cleaned, last = lifecycle.maintenance(df, cfg, NOW, None)
    assert cleaned.count() == 8 and last == NOW
    again, last = lifecycle.maintenance(df, cfg, NOW + HOUR / 2, last)
    assert again is df and last == NOW
    _, last = lifecycle.maintenance(df, cfg, NOW + HOUR, last)
    assert last == NOW + HOUR


# --- ranking and outputs --------------------------------------------------------------------------


def results_of(spark, rows):
    return spark.createDataFrame(rows, "qid long, rank long, doc_id long, content string, score double, origin string")


def test_ranker_is_stable_and_counts_missing_as_zero(spark):
    df = results_of(
        spark,
        [(1, 1, 5, "l1", 0.5, "local"), (1, 2, 6, "l2", None, "local"), (1, 1, None, "f1", 0.5, "foreign"), (1, 2, None, "f2", 0.0, "foreign"), (1, 3, None, "f3", -0.1, "foreign")],
    )
    assert [r["content"] for r in topk.rank_by_score(df, 9).orderBy("rank").collect()] == ["l1", "f1", "l2", "f2", "f3"]


@pytest.mark.parametrize("n", [3, 2500])
def test_top_n_with_one_hot_key(spark, n):
    df = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(0).alias("k"), F.col("id").alias("v")
    )
    kept = topk.top_n(df, ["k"], [F.desc("v")], n).filter("k = 0")
    want = [v for v in range(5999, -1, -1) if v % 3 != 0 or v == 0][:n]
    assert [(r["rank"], r["v"]) for r in kept.orderBy("rank").collect()] == list(enumerate(want, 1))


def test_prefix_stops_at_the_first_overflow(spark):
    rows = [(1, 1, "u", "a b c"), (1, 2, "u", "x " * 60), (1, 3, "u", "d"), (2, 1, "u", "y " * 90)]
    df = spark.createDataFrame(rows, "qid long, rank long, url string, content string")
    assert [(r["qid"], r["rank"]) for r in topk.token_prefix(df, 50).collect()] == [(1, 1)]
    context = {r["qid"]: r["context"] for r in results.search_context(df, 50).collect()}
    assert context == {1: '[{"url":"u","content":"a b c"}]', 2: "[]"}


def test_unknown_origin_is_counted(spark):
    df = results_of(spark, [(1, 1, 5, "a", 0.5, "local"), (1, 2, None, "b", 0.1, None)])
    row = origin_counts(df).first()
    assert (row["n_local"], row["n_foreign"], row["n_unknown"]) == (1, 0, 1)


def test_preview_of_odd_rows(spark):
    df = results_of(spark, [(1, 1, None, None, None, None), (1, 2, None, "w" * 130, 0.123456, "local")])
    rows = [tuple(r)[1:] for r in topk.result_preview(df).orderBy("rank").collect()]
    assert rows == [(1, "", "", ""), (2, "local", "0.1235", "...")]


def test_cache_modes_do_not_rank_or_top_up(spark):
    vector = lambda x: [x, (1 - x * x) ** 0.5]
    store = spark.createDataFrame(
        [(1, "a", vector(0.9), NOW), (2, "b", vector(0.2), NOW)],
        "doc_id long, content string, embeddings array<float>, added_at timestamp_ntz",
    )
    queries = spark.createDataFrame([(1, "q", [1.0, 0.0]), (2, "r", [-1.0, 0.0])], "qid long, query string, qvec array<float>")
    foreign = spark.createDataFrame(
        [(q, "q", r, f"u{r}", "t", f"f{r}", s) for q in (1, 2) for r, s in ((1, 0.1), (2, 0.9), (3, 0.5))], FOREIGN_SCHEMA
    )
    cfg = RetrievalConfig("freshness_cache", max_results=2, cache_score_threshold=0.5)
    rows = modes.freshness_cache(queries, store, cfg, NOW, foreign).orderBy("qid", "rank").collect()
    assert [(r["qid"], r["rank"], r["content"], r["origin"]) for r in rows] == [
        (1, 1, "a", "local"), (2, 1, "f1", "foreign"), (2, 2, "f2", "foreign"),
    ]
    missed = RetrievalConfig("freshness_cache", max_results=2, max_local=0, max_foreign=1)
    rows = modes.freshness_cache(queries, store, missed, NOW, foreign).collect()
    assert sorted((r["qid"], r["content"]) for r in rows) == [(1, "f1"), (2, "f1")]


# --- text -----------------------------------------------------------------------------------------


def test_text_search_small(spark):
    docs = spark.createDataFrame([(1, "red fox red"), (2, "blue fox"), (3, ""), (4, None)], "doc_id long, content string")
    queries = spark.createDataFrame([(1, "Red!"), (2, "fox"), (3, "?!"), (4, "none")], "qid long, query string")
    rows = text_index.text_search(docs, queries, 5).collect()
    got = sorted((r["qid"], r["rank"], r["doc_id"]) for r in rows)
    assert got == [(1, 1, 1), (2, 1, 2), (2, 2, 1)]
    assert all(0 < r["score"] <= 1 for r in rows)
    in_parts = text_index.text_search(docs, queries, 5, budget=60).collect()
    assert sorted(map(tuple, in_parts)) == sorted(map(tuple, rows))


def test_native_hybrid_without_words_is_vector_only(spark):
    store = spark.createDataFrame([(1, "x", [1.0, 0.0]), (2, "y", [0.0, 1.0])], "doc_id long, content string, embeddings array<float>")
    queries = spark.createDataFrame([(1, "?", [1.0, 0.1]), (2, "y", [1.0, 0.0])], "qid long, query string, qvec array<float>")
    rows = {(r["qid"], r["rank"]): (r["doc_id"], r["score"]) for r in modes.native_hybrid_hits(store, queries, 1).collect()}
    assert rows[(1, 1)][0] == 1 and rows[(2, 1)] == (1, 1.0)
    fused = modes.native_hybrid_hits(store, queries, 2).filter("qid = 2 AND doc_id = 2").first()
    # A word of its only kind: frequency 1 in a text of mean length reaches 1 / 2.2 of what a word can add.
    assert fused["score"] == round(1 / 2.2, 6)


def test_small_text_expressions(spark):
    df = spark.createDataFrame([(" a\nb  c ", 'say "x y" and "z"')], "t string, q string")
    row = df.select(
        text.chunk_text(F.col("t"), 2).alias("chunks"),
        text.quoted_phrases(F.col("q")).alias("phrases"),
        text.preview_text(F.lit("one two three four"), 12).alias("short"),
        text.sanitize_text_query(F.lit("a-b, c!")).alias("clean"),
        text.token_count(F.lit('{"a": 1}')).alias("tokens"),
    ).first()
    assert row["chunks"] == ["a b", "c"] and row["phrases"] == ["x y", "z"]
    assert (row["short"], row["clean"], row["tokens"]) == ("one two...", "a b c", 7)
    with pytest.raises(ValueError):
        text.chunk_text(F.col("t"), 0)


# --- pages ----------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    "href, want",
    [
        ("/x", "https://h.example/x"),
        ("x?y#z", "https://h.example/a/x?y"),
        ("//o.example/x", "https://o.example/x"),
        ("http://o.example", "http://o.example"),
        ("#top", "https://h.example/a/b?q=1"),
        ("?n=2", "https://h.example/a/b?n=2"),
        ("mailto:x@y", "mailto:x@y"),
    ],
)
def test_resolve(spark, href, want):
    got = spark.range(1).select(urls.resolve(F.lit("https://h.example/a/b?q=1#f"), F.lit(href))).first()[0]
    assert got == want


def test_html(spark):
    page = "<title>A &amp; B</title><script>x</script><h1>Head</h1><p>Some <b>bold</b> &lt;text&gt;<a href=\"/l\">link</a><img src=\"i.png\">"
    row = spark.range(1).select(
        html.html_extract(F.lit(page)).alias("t"), html.html_extract(F.lit(page), "markdown").alias("m")
    ).first()
    assert row["t"]["title"] == "A & B" and row["t"]["content"] == "A & B Head Some bold <text> link"
    assert row["t"]["images"] == ["i.png"] and row["t"]["links"] == ["/l"]
    assert row["m"]["content"] == "# Head\nSome **bold** <text>[link](/l)"
    with pytest.raises(ValueError):
        html.html_extract(F.lit(page), "pdf")


def test_crawl_visits_once_within_limits(spark):
    """A ring with a hub that every page links to."""
    n = 12
    url = lambda i: f"https://h.example/p{i:02d}"
    edges = [(url(i), url((i + 1) % n), 0) for i in range(n)] + [(url(i), url(0), 1) for i in range(n)]
    edges += [(url(0), url(i), i) for i in range(2, n)] + [(url(0), "https://o.example/", 99)]
    df = spark.createDataFrame(edges, "src string, dst string, link_pos int")
    seeds = spark.createDataFrame([(url(0),), (url(5),)], "seed string")
    rules = site.CrawlRules(max_depth=3, max_breadth=3, limit=6, allow_external=False)
    rows = site.site_map(seeds, df, rules).collect()
    by_seed = {}
    for r in rows:
        by_seed.setdefault(r["seed"], []).append((r["depth"], r["url"]))
    assert sorted(by_seed[url(0)]) == [(0, url(0)), (1, url(1)), (1, url(2)), (1, url(3)), (2, url(4)), (3, url(5))]
    assert sorted(by_seed[url(5)]) == [(0, url(5)), (1, url(0)), (1, url(6)), (2, url(1)), (2, url(2)), (2, url(3))]
    with pytest.raises(ValueError):
        site.CrawlRules(limit=0)


def test_crawl_instructions(spark):
    pages = spark.createDataFrame([(1, "https://h.example/a", "<p>about prices"), (2, "https://h.example/b", "<p>other")], "page_id long, url string, html string")
    edges = spark.createDataFrame([("https://h.example/a", "https://h.example/b", 0)], "src string, dst string, link_pos int")
    seeds = spark.createDataFrame([("https://h.example/a",)], "seed string")
    rules = site.CrawlRules()
    assert site.crawl(seeds, pages, edges, rules).count() == 2
    assert ids(site.crawl(seeds, pages, edges, rules, instructions="find Prices"), "url") == ["https://h.example/a"]


# --- responses ------------------------------------------------------------------------------------


def test_responses_without_results(spark):
    df = spark.createDataFrame([(1, '{"query":"q"}'), (2, '{"query":"q","results":[]}'), (3, "not json")], "id int, response string")
    assert rs.flatten_search(df).count() == 0
    assert rs.flatten_extract(df).count() == 0
    assert rs.flatten_map(df).count() == 0


def test_error_classes(spark):
    envelope = '{"error":{"code":"limit","message":"m"}}'
    rows = [
        (1, 429, '{"detail":{"error":"slow down"}}', False), (2, 429, envelope, True), (3, 429, envelope, False),
        (4, 432, None, False), (5, 401, '"bad key"', False), (6, 400, "<html>", False), (7, 502, None, True), (8, 200, None, False),
        (9, 429, '{"error":{"code":7}}', True), (10, 429, '{"error":"limit"}', True),
    ]
    df = spark.createDataFrame(rows, "id int, status int, body string, keyless boolean")
    got = {r["id"]: (r["error_class"], r["detail"]) for r in rs.classify_response(df).collect()}
    assert got == {
        1: ("usage_limit", "slow down"), 2: ("keyless_limit", ""), 3: ("usage_limit", ""), 4: ("forbidden", ""),
        5: ("invalid_key", "bad key"), 6: ("bad_request", ""), 7: ("http_error", ""), 8: ("ok", ""),
        9: ("usage_limit", ""), 10: ("usage_limit", ""),
    }

def test_two_saves_at_one_time_have_ids_of_their_own(spark):
    """Query ids and ranks start anew in every batch."""
    from siftwell.operators import lifecycle

    cfg = RetrievalConfig("hybrid_search", persist_score_threshold=0.0)
    schema = "qid long, query string, rank int, url string, title string, content string, score double"
    ids = []
    for word in ("alpha", "beta"):
        found = spark.createDataFrame([(1, word, 1, "http://u", "t", f"about {word}", 0.9)], schema)
        saved = lifecycle.persist_prepare(found, cfg, NOW, [], lifecycle.hashing_embedder(8))
        ids += [r["doc_id"] for r in saved.collect()]
    assert len(set(ids)) == 2


def test_long_chunks(spark):
    from siftwell.functions.text import chunk_text

    words = [f"w{k}" for k in range(2500)]
    row = spark.createDataFrame([(" \n".join(words) + " ", "", "one")], "a string, b string, c string").select(
        *(chunk_text(F.col(c), 1200) for c in "abc")
    ).first()
    assert [c.split() for c in row[0]] == [words[:1200], words[1200:2400], words[2400:]]
    assert row[1] == [] and row[2] == ["one"]


def test_local_content_is_joined_without_moving_the_store(spark):
    from siftwell.plans.modes import RESULT_COLUMNS, with_store_content

    results = spark.createDataFrame(
        [(1, 1, 7, None, 0.9, "local"), (1, 2, None, "far", 0.5, "foreign")],
        "qid long, rank int, doc_id long, content string, score double, origin string",
    )
    store = spark.range(1000).select(F.col("id").alias("doc_id"), F.concat(F.lit("c"), "id").alias("content"))
    filled = with_store_content(results, store)
    plan = filled._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan
    assert {tuple(r) for r in filled.select(RESULT_COLUMNS).collect()} == {
        (1, 1, 7, "c7", 0.9, "local"), (1, 2, None, "far", 0.5, "foreign")
    }


def test_postings_of_many_bytes_take_more_tasks(spark, monkeypatch):
    """The more bytes the texts measure, the more partitions their terms are counted in, with the same rows; ids may repeat."""
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = spark.createDataFrame([(i // 2, f"a b c{i} a") for i in range(400)] + [(None, "a"), (1, None)], "doc_id long, content string")
    want = sorted(map(str, text_index.text_postings(docs).collect()))
    monkeypatch.setattr(text_index, "TASK_BYTES", 100)
    found = text_index.text_postings(docs)
    assert sorted(map(str, found.collect())) == want
    assert found.select(F.spark_partition_id()).distinct().count() > usual


def test_texts_are_cut_into_words_by_their_bytes(monkeypatch):
    lowered = pa.array(["a b", None, "x" * 40, "c", "d e f", ""])
    batch = pa.record_batch([pa.array(range(6)), lowered], ["doc_id", "lowered"])
    monkeypatch.setattr(text_scan, "SLICE_BYTES", 8)
    cut = [part.column("doc_id").to_pylist() for part in text_scan.text_slices(batch, 100)]
    assert cut == [[0, 1], [2], [3, 4, 5]]
    assert [len(part) for part in text_scan.text_slices(batch, 1)] == [1] * 6
    assert list(text_scan.text_slices(batch.slice(0, 0), 5)) == []


def test_a_scan_reads_the_texts_once(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "red fox red"), (2, "blue fox"), (3, "fox red"), (4, None)], "doc_id long, content string")
    queries = spark.createDataFrame([(1, 'red "red fox"'), (2, "fox"), (3, '"no such" fox')], "qid long, query string")
    read, real = [], text_index.lowered_texts
    monkeypatch.setattr(text_index, "lowered_texts", lambda *given: read.append(1) or real(*given))
    rows = text_index.text_search(docs, queries, 5, F.col("doc_id") < 3, phrases=True).collect()
    assert sorted((r.qid, r.rank, r.doc_id) for r in rows) == [(1, 1, 1), (2, 1, 2), (2, 2, 1)]
    assert len(read) == 1


def test_few_keys_reach_the_scans_below_a_join(spark, tmp_path):
    for name, column in (("texts", "doc_id"), ("vectors", "vec_id")):
        spark.range(100).withColumnRenamed("id", column).withColumn(name, F.lit("x")).write.parquet(str(tmp_path / name))
    texts, vectors = (spark.read.parquet(str(tmp_path / name)) for name in ("texts", "vectors"))
    store = texts.join(vectors, texts.doc_id == vectors.vec_id, "left")
    keys = spark.createDataFrame([(3,), (3,), (None,), (200,)], "doc_id long")
    found = sizing.rows_for(keys, store, "doc_id")
    assert [r.doc_id for r in found.collect()] == [3, 3]
    pushed = [line for line in found._jdf.queryExecution().executedPlan().toString().split("\n") if "PushedFilters" in line]
    assert any("In(doc_id" in line for line in pushed) and any("In(vec_id" in line for line in pushed)
    assert sizing.rows_for(keys.limit(0), store, "doc_id").count() == 0
