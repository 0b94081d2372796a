"""Exact and cell search against brute force, on every way the work can be split."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from siftwell.config import METRICS
from siftwell.functions import vectors
from siftwell.operators import ivf, knn as nn

RNG = np.random.default_rng(7)
ROWS = RNG.integers(-2, 3, size=(300, 8)).astype(float)
ASKED = RNG.integers(-2, 3, size=(40, 8)).astype(float)


@pytest.fixture(scope="module")
def tables(spark):
    store = spark.createDataFrame(
        [(i, f"text {i}", [float(x) for x in v]) for i, v in enumerate(ROWS)],
        "doc_id long, content string, embeddings array<float>",
    ).repartition(5)
    queries = spark.createDataFrame(
        [(i, [float(x) for x in v]) for i, v in enumerate(ASKED)], "qid long, qvec array<float>"
    )
    return store.cache(), queries.cache()


def brute(store, queries, metric, k):
    """Best k by the column expressions, without any splitting."""
    score = F.round(1 - vectors.distance(metric, F.col("qvec"), F.col("embeddings")), 6)
    rows = store.crossJoin(queries).select("qid", "doc_id", score.alias("score")).collect()
    best = {}
    for r in rows:
        best.setdefault(r["qid"], []).append((r["score"] is None, -(r["score"] or 0), r["doc_id"], r["score"]))
    return {(q, i + 1, d, s) for q, hits in best.items() for i, (_, _, d, s) in enumerate(sorted(hits)[:k])}


def found(df):
    return {tuple(r) for r in df.select("qid", "rank", "doc_id", "score").collect()}


@pytest.mark.parametrize("metric", METRICS)
def test_all_metrics_match_brute_force(tables, metric):
    store, queries = tables
    got = {(q, r, d, None if s is None else round(s, 5)) for q, r, d, s in found(nn.knn(store, queries, 6, metric))}
    want = {(q, r, d, None if s is None else round(s, 5)) for q, r, d, s in brute(store, queries, metric, 6)}
    assert got == want


def test_blocks_give_the_same_as_one_scan(tables):
    store, queries = tables
    scanned = found(nn.knn(store, queries, 5))
    blocked = nn.knn(store, queries, 5, budget=500, block_rows=37)
    assert found(blocked) == scanned
    assert "FlatMapCoGroupsInArrow" in plan(blocked) or "CoGroup" in plan(blocked)


def test_tiers_are_scored_together(tables):
    store, queries = tables
    even, odd = F.col("doc_id") % 2 == 0, F.col("doc_id") % 2 == 1
    both = nn.knn_tiers(store, queries, [(even, 3), (odd, 5)])
    for tier, rule, k in ((0, even, 3), (1, odd, 5)):
        assert found(both.filter(F.col("tier") == tier)) == found(nn.knn(store, queries, k, eligible=rule))


def test_no_limit_no_rows(tables):
    store, queries = tables
    assert nn.knn(store, queries, 0).count() == 0
    assert nn.knn_tiers(store, queries, [(F.lit(True), 0), (F.lit(True), 2)]).select("tier").distinct().collect()[0][0] == 1


def test_rows_and_queries_without_vector_take_no_part(spark):
    store = spark.createDataFrame([(1, [1.0, 0.0]), (2, None)], "doc_id long, embeddings array<float>")
    queries = spark.createDataFrame([(1, [1.0, 0.0]), (2, None)], "qid long, qvec array<float>")
    assert found(nn.knn(store, queries, 5)) == {(1, 1, 1, 1.0)}


def test_zero_vector_has_no_score_and_comes_last(spark):
    store = spark.createDataFrame([(1, [0.0, 0.0]), (2, [-1.0, 0.0])], "doc_id long, embeddings array<float>")
    queries = spark.createDataFrame([(1, [1.0, 0.0])], "qid long, qvec array<float>")
    assert found(nn.knn(store, queries, 5)) == {(1, 1, 2, -1.0), (1, 2, 1, None)}


def test_mixed_dimensions_are_an_error(spark):
    store = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0])], "doc_id long, embeddings array<float>").coalesce(1)
    queries = spark.createDataFrame([(1, [1.0, 0.0])], "qid long, qvec array<float>")
    with pytest.raises(Exception):
        nn.knn(store, queries, 5).collect()


def test_empty_store_and_no_queries(spark, tables):
    store, queries = tables
    assert nn.knn(store.limit(0), queries, 3).count() == 0
    assert nn.knn(store, queries.limit(0), 3).count() == 0


def test_all_cells_probed_is_exact(spark, tables):
    store, queries = tables
    cells, centroids = ivf.ivf_build(store, 4)
    assert cells.count() == len(ROWS)
    got = ivf.ivf_search(cells, centroids, queries, 5, 4, block_rows=30, query_rows=9)
    assert found(got) == found(nn.knn(store, queries, 5))


def test_saved_index_reads_back(spark, tables, tmp_path):
    store, queries = tables
    cells, centroids = ivf.ivf_build(store, 4)
    ivf.save_index(cells, centroids, str(tmp_path / "index"))
    again = ivf.load_index(spark, str(tmp_path / "index"))
    assert found(ivf.ivf_search(*again, queries, 3, 2)) == found(ivf.ivf_search(cells, centroids, queries, 3, 2))


@pytest.mark.parametrize("metric", ["cosine", "euclidean"])
def test_cells_separate_clusters_of_any_length(spark, metric):
    """Training and assignment look at vectors in the same space."""
    import numpy as np

    chance, rows = np.random.default_rng(3), []
    centers = [(9, 0), (0, 14), (-5, 0), (0, -11)]
    for c, center in enumerate(centers):
        rows += [(c * 100 + k, (np.array(center) + chance.normal(0, 0.2, 2)).tolist()) for k in range(100)]
    store = spark.createDataFrame(rows, "doc_id long, embeddings array<float>")
    cells, centroids = ivf.ivf_build(store, 4, metric=metric)
    together = {}
    for r in cells.select("doc_id", "cell").collect():
        together.setdefault(r["cell"], set()).add(r["doc_id"] // 100)
    assert len(together) == 4 and all(len(c) == 1 for c in together.values())


def test_hot_cell_is_split(spark):
    """One cell holds nearly every row and is probed by every query."""
    rows = [(i, [1.0, i / 1000]) for i in range(200)] + [(999, [-1.0, 0.0])]
    store = spark.createDataFrame(rows, "doc_id long, embeddings array<float>")
    queries = spark.createDataFrame([(i, [1.0, i / 100]) for i in range(30)], "qid long, qvec array<float>")
    centroids = spark.createDataFrame([(0, [1.0, 0.0]), (1, [-1.0, 0.0])], "cell int, centroid array<double>")
    cells = ivf.assign_cells(store, centroids)
    got = ivf.ivf_search(cells, centroids, queries, 4, 2, block_rows=16, query_rows=7)
    assert found(got) == found(nn.knn(store, queries, 4))


def test_oversized_centroids_are_refused(spark):
    centroids = spark.createDataFrame([(0, [1.0, 0.0])], "cell int, centroid array<double>")
    with pytest.raises(ValueError):
        ivf.nearest_cells(centroids, F.col("v"), 1, budget=4)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scorer_meets_many_queries_in_slices():
    """Equal to brute force over slices, tiers, ties, zero vectors and tiers with few rows; and a pair costs little."""
    import numpy as np

    rng = np.random.default_rng(3)
    n, m = 1300, 20000
    asked, rows = (rng.normal(size=(k, 16)).astype(np.float32).astype(np.float64) for k in (n, m))
    rows[100:140], rows[5], asked[7], asked[9] = rows[100], 0.0, 0.0, rows[100]
    ids = rng.permutation(m).astype(np.int64)
    tiers = [np.ones(m, bool), rng.random(m) < 0.3, np.arange(m) < 3]
    ks = [5, 3, 4]
    scorer = nn._Scorer(np.arange(n), asked, ks, "cosine")
    for at in range(0, m, 9000):
        scorer.add(ids[at : at + 9000], rows[at : at + 9000], [t[at : at + 9000] for t in tiers])
    got = {}
    for tier, q, d, s in zip(*(c.to_pylist() for c in scorer.table().columns)):
        got.setdefault((tier, q), []).append((d, s))
    unit = [nn._unit(side) for side in (asked, rows)]
    for q in [*range(20), 600, n - 1]:
        score = np.round((unit[1] * unit[0][q]).sum(axis=1), 6)
        order = np.lexsort((ids, -np.where(np.isnan(score), -np.inf, score)))
        for tier, k in enumerate(ks):
            want = [i for i in order if tiers[tier][i]][:k]
            assert got[tier, q] == [(ids[i], None if np.isnan(score[i]) else score[i]) for i in want]


def test_many_queries_are_dealt_out(spark, monkeypatch):
    """Beyond so many queries no task gets all of them, however small their vectors are."""
    monkeypatch.setattr(nn, "SCAN_QUERIES", 10)
    monkeypatch.setattr(nn, "QUERY_ROWS", 8)
    seen = []
    real = nn.score_blocks
    monkeypatch.setattr(nn, "score_blocks", lambda rows, queries, *rest: seen.append(queries) or real(rows, queries, *rest))
    rows = spark.createDataFrame([(i, [float(i % 7), 1.0 + i % 5]) for i in range(60)], "doc_id long, embeddings array<float>")
    asked = rows.select(F.col("doc_id").alias("qid"), F.col("embeddings").alias("qvec")).where("qid < 30")
    got = nn.knn(rows, asked, 3).collect()
    assert len(got) == 90 and seen and seen[0].select("q_block").distinct().count() == 4


def test_every_block_has_a_task(spark, monkeypatch):
    """Blocks of few bytes are not put together in one partition: the work of a block is the product of its sides."""
    monkeypatch.setattr(nn, "SCAN_QUERIES", 10)
    monkeypatch.setattr(nn, "QUERY_ROWS", 8)
    real, scored = nn.score_blocks, []
    monkeypatch.setattr(nn, "score_blocks", lambda *given: scored.append(real(*given)) or scored[-1])
    rows = spark.createDataFrame([(i, [float(i % 7), 1.0 + i % 5]) for i in range(60)], "doc_id long, embeddings array<float>")
    asked = rows.select(F.col("doc_id").alias("qid"), F.col("embeddings").alias("qvec")).where("qid < 30")
    assert found(nn.knn(rows, asked, 3, block_rows=20)) == brute(rows, asked, "cosine", 3)
    assert scored[0].rdd.getNumPartitions() == 12
