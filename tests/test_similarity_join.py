"""The threshold join of vectors: all pairs' result, for a part of their work."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from siftwell.operators import knn as nn, similarity_join as sj


def table(spark, rows, names):
    return spark.createDataFrame([(i, None if v is None else [float(x) for x in v]) for i, v in rows], f"{names[0]} long, {names[1]} array<float>")


@pytest.fixture(scope="module")
def data(spark):
    """Clusters, one with a third of the rows, and candidates near, far, zero and null."""
    rng = np.random.default_rng(6)
    centres = rng.normal(0, 1, (40, 24))
    sizes = [500, *[25] * 39]
    rows = [c + rng.normal(0, 0.15, 24) for c, n in zip(centres, sizes, strict=True) for _ in range(n)]
    asked = [rows[k] + rng.normal(0, 0.1, 24) for k in range(0, 1400, 9)] + [rng.normal(0, 1, 24) for _ in range(60)]
    store = [*enumerate(rows), (5000, np.zeros(24)), (5001, None), (5002, rows[3])]
    return table(spark, store, ("doc_id", "embeddings")), table(spark, [*enumerate(asked), (900, np.zeros(24)), (901, None)], ("qid", "qvec"))


def all_pairs(candidates, store, threshold, rule=None):
    best = nn.nearest_similarity(candidates, store, rule).where(F.col("similarity") >= threshold)
    return sorted((r.qid, r.similarity) for r in best.collect())


@pytest.mark.parametrize("threshold", [-1.0, 0.0, 0.6, 0.9, 0.97, 1.0, 1.1])
def test_equals_all_pairs(data, threshold):
    store, candidates = data
    got = sorted((r.qid, r.similarity) for r in sj.similarity_at_least(candidates, store, threshold, pivots=12).collect())
    assert got == all_pairs(candidates, store, threshold)


def test_blocks_and_rules(data, monkeypatch):
    store, candidates = data
    monkeypatch.setattr(sj, "BLOCK_ROWS", 100)
    monkeypatch.setattr(sj, "BLOCK_QUERIES", 30)
    monkeypatch.setattr(sj, "BAND", 7)
    rule = F.col("doc_id") % 2 == 0
    got = sorted((r.qid, r.similarity) for r in sj.similarity_at_least(candidates, store, 0.9, rule).collect())
    assert got == all_pairs(candidates, store, 0.9, rule) and got


def test_fewer_pairs_the_higher_the_threshold(data):
    """About a tenth of all pairs are of one cluster; the others are hardly ever multiplied out."""
    store, candidates = data
    rows = store.where("embeddings IS NOT NULL").select("doc_id", F.col("embeddings").alias("vec"))
    asked = candidates.where("qvec IS NOT NULL").select("qid", F.col("qvec").alias("vec"))
    every = rows.count() * asked.count()
    work = [
        tuple(sj.similar_pairs(asked, rows, t).agg(F.sum("met"), F.sum("multiplied")).first()) for t in (0.5, 0.8, 0.98)
    ]
    assert all(0 < multiplied <= met < every for met, multiplied in work)
    assert work[0][0] > work[1][0] > work[2][0] and work[0][1] > work[1][1] > work[2][1]
    assert work[2][1] < 0.12 * every


def test_nothing_to_compare(spark, data):
    store, candidates = data
    for a, b in ((candidates.limit(0), store), (candidates, store.limit(0)), (candidates, store.where("doc_id = 5000"))):
        assert sj.similarity_at_least(a, b, 0.5).collect() == []


def test_a_candidate_that_has_its_best_meets_few_more_pairs():
    """A low threshold leaves nearly all pairs; equal rows lie in the first tiles, so hardly any of the later ones matter."""
    rng = np.random.default_rng(9)
    rows, _ = sj.unit_rows(rng.normal(0, 1, (16000, 16)))
    asked = rows[:200]
    away = np.r_[np.full(200, 0.9), np.full(15800, 1.0)]
    best, met, multiplied = sj.block_maxima(asked, np.full(200, 0.95), rows, away, 0.1, 1.3)
    assert met == 200 * 16000 and multiplied < met / 2
    assert np.allclose(best, 1.0, rtol=0, atol=1e-9)
    far = rng.normal(0, 1, (300, 16))
    far, _ = sj.unit_rows(far)
    best, _, _ = sj.block_maxima(far, np.full(300, 0.95), rows, away, 0.1, 1.3)
    assert np.array_equal(np.round(best, 6), np.round((far @ rows.T).max(axis=1), 6))
