"""Whole searches with saving, in the order a user would run them."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from siftwell.config import RetrievalConfig
from siftwell.operators.lifecycle import column_embedder, hashing_embedder
from siftwell.plans import modes
from siftwell.plans.engine import RetrievalEngine
from siftwell.sources.store import OPTIONAL_COLUMNS, PartitionedStore, ensure_columns

NOW = datetime(2024, 1, 31)
STATIC = [
    (1, "https://a.example/", "A", "spark joins and shuffles explained", 0.99),
    (2, "https://b.example/", "B", "a guide to partition pruning", 0.88),
    (3, "https://c.example/", "C", "an unrelated note", 0.30),
]


@pytest.fixture
def table(spark, tmp_path):
    empty = spark.createDataFrame([], "doc_id long, content string, embeddings array<float>")
    store = PartitionedStore(spark, str(tmp_path / "store"), "source_url", 4)
    store.create(ensure_columns(empty, OPTIONAL_COLUMNS)[0])
    return store


class Source:
    """Answers every query with the static results, and remembers which were asked."""

    def __init__(self, spark):
        self.static = spark.createDataFrame(STATIC, "rank long, url string, title string, content string, score double")
        self.asked = []

    def __call__(self, queries, n):
        self.asked.append(sorted(r["qid"] for r in queries.select("qid").collect()))
        fan = queries.select("qid", "query").withColumn("rank", F.explode(F.lit([1, 2, 3]).cast("array<bigint>")))
        return fan.join(self.static, "rank").filter(F.col("rank") <= n)


def queries(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts, 1)), "qid long, query string")


def engine(table, source, mode="freshness_cache", **settings):
    cfg = RetrievalConfig(mode, cache_score_threshold=0.2, memory_score_threshold=0.2, provenance=True, **settings)
    return RetrievalEngine(table, cfg, source, hashing_embedder(32))


def test_miss_saves_then_hits(spark, table):
    source = Source(spark)
    e = engine(table, source, persist_score_threshold=0.5)
    asked = queries(spark, "spark joins and shuffles explained")
    first = e.search(asked, NOW, save_foreign=True)
    assert {r["origin"] for r in first.collect()} == {"foreign"} and first.count() == 3
    assert table.read().count() == 2 and source.asked == [[1]]
    again = e.search(asked, NOW + timedelta(hours=1), save_foreign=True)
    rows = again.orderBy("rank").collect()
    assert rows[0]["origin"] == "local" and rows[0]["content"] == STATIC[0][3]
    assert source.asked == [[1], []] and table.read().count() == 2
    late = e.search(asked, NOW + timedelta(days=2)).collect()
    assert {r["origin"] for r in late} == {"foreign"}


def test_only_unanswered_queries_reach_the_source(spark, table):
    source = Source(spark)
    e = engine(table, source)
    e.search(queries(spark, "spark joins and shuffles explained"), NOW, save_foreign=True)
    e.search(queries(spark, "spark joins and shuffles explained", "zebra"), NOW + timedelta(minutes=1))
    assert source.asked[-1] == [2]


def test_upsert_twice_adds_nothing_and_counts(spark, table):
    e = engine(table, Source(spark), "hybrid_search", upsert_key="source_url", memory_metadata=True)
    for hours in (0, 1):
        e.search(queries(spark, "x"), NOW + timedelta(hours=hours), save_foreign=True)
    rows = table.read().collect()
    assert len(rows) == 3 and {r["query_count"] for r in rows} == {2}
    assert {r["last_seen_at"] for r in rows} == {NOW + timedelta(hours=1)}


def test_dedup_adds_nothing(spark, table):
    e = engine(table, Source(spark), "hybrid_search", dedup_similarity_threshold=0.99)
    e.search(queries(spark, "x"), NOW, save_foreign=True)
    e.search(queries(spark, "x"), NOW, save_foreign=True)
    assert table.read().count() == 3


def test_memory_outlives_cache(spark, table):
    source = Source(spark)
    e = engine(table, source, "cache_then_memory")
    asked = queries(spark, "a guide to partition pruning")
    e.search(asked, NOW, save_foreign=True)
    assert {r["memory_scope"] for r in table.read().collect()} == {"cache_plus_memory"}
    later = e.search(asked, NOW + timedelta(days=9)).orderBy("rank").collect()
    assert later[0]["origin"] == "local" and source.asked[-1] == []
    assert e.cleanup(NOW + timedelta(days=9)) == 0


def test_cleanup_and_delete(spark, table):
    e = engine(table, Source(spark), auto_cleanup=True, persistence_depth="cache_only")
    e.search(queries(spark, "x"), NOW, save_foreign=True)
    e.search(queries(spark, "x"), NOW + timedelta(minutes=5))
    assert table.read().count() == 3
    e.search(queries(spark, "x"), NOW + timedelta(days=3))
    assert table.read().count() == 0
    e.search(queries(spark, "y"), NOW + timedelta(days=3), save_foreign=True)
    assert e.delete_query("y") == 3 and e.delete_query("y") == 0


def test_transform_shapes_what_is_saved(spark, table):
    e = engine(table, Source(spark), "hybrid_search")
    keep = lambda df: df.filter("score > 0.5").select("doc_id", "content", "embeddings", F.col("title").alias("source_title"))
    e.search(queries(spark, "x"), NOW, save_foreign=keep)
    assert sorted(r["source_title"] for r in table.read().collect()) == ["A", "B"]
    with pytest.raises(ValueError, match="odd"):
        e.search(queries(spark, "x"), NOW, save_foreign=lambda df: df.select("doc_id", "content", "embeddings", F.lit(1).alias("odd")))


def test_no_foreign_when_the_limit_is_zero(spark, table):
    source = Source(spark)
    e = RetrievalEngine(table, RetrievalConfig(max_foreign=0), source, hashing_embedder(32))
    assert e.search(queries(spark, "x"), NOW, save_foreign=True).count() == 0
    assert table.read().count() == 0


def test_ranker_hook_sees_candidates_and_orders(spark, table):
    def shortest_first(candidates, n):
        best = candidates.assign(score=-candidates["content"].str.len().astype(float))
        return best.sort_values("score", ascending=False)

    e = RetrievalEngine(
        table, RetrievalConfig(max_results=2), Source(spark), hashing_embedder(32), modes.pandas_ranker(shortest_first)
    )
    rows = e.search(queries(spark, "x"), NOW).orderBy("rank").collect()
    assert [r["content"] for r in rows] == [STATIC[1][3], STATIC[0][3]]


def test_column_embedder_hook(spark, table):
    embed = column_embedder(lambda text: F.array(F.length(text).cast("float"), F.lit(1.0).cast("float")))
    e = RetrievalEngine(table, RetrievalConfig(), Source(spark), embed)
    e.search(queries(spark, "x"), NOW, save_foreign=True)
    assert all(len(r["embeddings"]) == 2 for r in table.read().collect())
    with pytest.raises(TypeError):
        RetrievalEngine(table, RetrievalConfig(), "not callable", embed)


def test_native_hybrid_serves_every_mode(spark, table):
    e = engine(table, Source(spark), native_hybrid=True)
    asked = queries(spark, "partition pruning")
    e.search(asked, NOW, save_foreign=True)
    rows = e.search(asked, NOW + timedelta(minutes=1)).orderBy("rank").collect()
    assert rows[0]["content"] == STATIC[1][3] and rows[0]["score"] > 1
