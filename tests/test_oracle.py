"""Every registered query gives the rows of its SQL, over the whole of the given tables."""

import pytest

import __spark_entry__ as entry
from compare import compare, connect

SF = "/root/testdata/sf0.001"
QUERIES, SQL = entry.QUERIES, entry.SQL


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_rows(spark, con, name):
    assert name in SQL
    got, want = compare(spark, con, QUERIES[name], SQL[name], SF)
    assert got == want


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["qid", "rank", "doc_id", "content", "score", "origin"]
    assert df.count() > 0


def test_every_tier_answers_some_query(spark):
    from pyspark.sql import functions as F

    from siftwell.config import RetrievalConfig
    from siftwell.plans import modes
    from siftwell.workload import fixtures as fx

    cfg = RetrievalConfig(
        "cache_then_memory", max_results=5, cache_score_threshold=0.4, memory_score_threshold=0.4
    )
    store, queries = fx.store(spark, SF), fx.queries(spark, SF)
    hits = modes.tier_hits(queries, store, cfg, fx.NOW)
    first = {r["qid"]: r["t"] for r in hits.groupBy("qid").agg(F.min("tier").alias("t")).collect()}
    assert set(first.values()) == {0, 1}
    assert len(first) < queries.count()
