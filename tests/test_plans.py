"""What the physical plans must and must not hold."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from siftwell.operators import topk
from siftwell.workload import fixtures as fx

SF = "/root/testdata/sf0.001"
QUERIES = entry.queries()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


NO_PYTHON = [n for n in QUERIES if n.startswith(("filter_", "cleanup_", "dist_", "store_", "text_", "html_"))]


@pytest.mark.parametrize(
    "name",
    ["knn_exact", "text_search", "native_hybrid", "hybrid_search", "freshness_cache", "cache_then_memory",
     "ivf_search", "store_upsert", "table_search", "link_edges", "extract", "semantic_dedup"],
)
def test_no_nested_loops(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name", [n for n in NO_PYTHON if n not in ("filter_score_threshold", "text_search")])
def test_builtin_functions_only(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert "Python" not in text and "InArrow" not in text and "InPandas" not in text


@pytest.mark.parametrize("name", ["knn_exact", "topk_per_query", "text_search", "persist_cap", "topic_fanout_topn", "crawl_breadth"])
def test_groups_are_cut_before_the_shuffle(spark, name):
    assert "WindowGroupLimit" in plan(QUERIES[name](spark, SF))


def test_large_limits_are_cut_per_salt(spark):
    text = plan(topk.top_n(spark.range(10).withColumn("k", F.lit(0)), ["k"], [F.desc("id")], 5000))
    assert text.count("Window ") >= 2 and "_salt" in text


def test_filters_and_columns_reach_the_scan(spark):
    documents = fx.table(spark, SF, "embeddings").filter("vec_id > 3 AND embedding IS NOT NULL").select("vec_id")
    text = plan(documents)
    assert "GreaterThan(vec_id,3)" in text and "IsNotNull(embedding)" in text
    assert "html" not in plan(QUERIES["url_parts"](spark, SF)).split("ReadSchema")[1]


def test_texts_are_tokenised_once_below_the_shuffle(spark):
    text = plan(QUERIES["text_index_build"](spark, SF))
    assert text.count("regexp_extract_all") == 1
