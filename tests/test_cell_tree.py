"""The two-level cell index: bounds, certainty, and what a search reads."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from siftwell.operators import cell_tree as ct, knn as nn, metrics


def table(spark, rows, id_name="doc_id", vector="embeddings"):
    return spark.createDataFrame([(i, v.tolist()) for i, v in rows], f"{id_name} long, {vector} array<float>")


def found(df):
    return sorted((r.qid, r.rank, r.doc_id, r.score) for r in df.collect())


@pytest.fixture(scope="module")
def data(spark):
    """Clusters of different lengths and sizes, one of which holds a third of the rows; queries of their own."""
    rng = np.random.default_rng(8)
    centres = rng.normal(0, 4, (30, 6))
    sizes = [400, *rng.integers(5, 60, 29)]
    rows = np.concatenate([c + rng.normal(0, 0.3, (n, 6)) for c, n in zip(centres, sizes, strict=True)])
    asked = np.concatenate([rows[::23] + rng.normal(0, 0.2, rows[::23].shape), rng.normal(0, 4, (15, 6))])
    return table(spark, list(enumerate(rows))), table(spark, list(enumerate(asked)), "qid", "qvec")


@pytest.fixture(scope="module", params=["cosine", "euclidean", "l2_squared"])
def tree(request, data, tmp_path_factory):
    return ct.build_cell_tree(data[0], str(tmp_path_factory.mktemp("tree")), 6, 5, request.param, sample=100)


def test_every_row_lies_in_its_nearest_leaf(data, tree):
    given = {r.doc_id: r.embeddings for r in data[0].collect()}
    rows = tree.cells.collect()
    assert {r.doc_id: r.embeddings for r in rows} == given and len(rows) == len(given)
    leaves, groups = {}, {r.grp: r for r in tree.groups.collect()}
    for leaf in tree.leaves.collect():
        leaves.setdefault(leaf.grp, {})[leaf.leaf] = leaf
    assert sum(leaf.n_rows for own in leaves.values() for leaf in own.values()) == len(rows)
    for r in rows:
        v = ct.in_space(np.array([r.embeddings]), tree.metric)
        gaps = {k: float(ct.gaps(v, np.array([leaf.centroid]))[0, 0]) for k, leaf in leaves[r.grp].items()}
        assert gaps[r.leaf] <= min(gaps.values()) + 1e-9
        assert gaps[r.leaf] <= leaves[r.grp][r.leaf].radius + 1e-9
        own = {g: float(ct.gaps(v, np.array([x.centroid]))[0, 0]) for g, x in groups.items()}
        assert own[r.grp] <= min(own.values()) + 1e-9 and own[r.grp] <= groups[r.grp].radius + 1e-9


def test_a_target_of_all_is_exact(data, tree):
    store, queries = data
    assert found(ct.cell_search(tree, queries, 5, 1, 1, target=100)) == found(nn.knn(store, queries, 5, tree.metric))


@pytest.mark.parametrize("target", [40, 90])
def test_the_target_is_met_by_every_query(data, tree, target):
    store, queries = data
    exact = nn.knn(store, queries, 10, tree.metric)
    got = ct.cell_search(tree, queries, 10, 1, 1, target=target)
    assert metrics.recall_at_k(got, exact, 10).agg(F.min("recall")).first()[0] >= target / 100


def test_only_visited_groups_are_read(spark, data, tree):
    """Of one query's groups; far ones stay closed, also when the search has to be sure."""
    store, queries = data
    one = queries.where("qid = 0")
    probes = spark.createDataFrame([(0, 0, 0)], "qid long, grp int, leaf int")
    plan = ct.visited_hits(tree, one, probes, 3)._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "grp" in filters and "= 0)" in filters
    reach = one.withColumn("reach", F.lit(0.2))
    near = reach.select(ct.groups_within(tree, F.col("qvec"), F.col("reach")).alias("g")).first().g
    assert 0 < len(near) < 6


def test_odd_vectors_and_tables(spark, tmp_path):
    rows = [(1, np.zeros(3)), (2, np.zeros(3)), (3, np.ones(3)), (4, np.array([1.0, 0, 0]))]
    store = table(spark, rows).unionByName(spark.createDataFrame([(5, None)], "doc_id long, embeddings array<float>"))
    tree = ct.build_cell_tree(store, str(tmp_path / "t"), 2, 3)
    queries = table(spark, [(1, np.ones(3)), (2, np.zeros(3))], "qid", "qvec")
    queries = queries.unionByName(spark.createDataFrame([(3, None)], "qid long, qvec array<float>"))
    for k in (1, 3, 9):
        assert found(ct.cell_search(tree, queries, k, target=100)) == found(nn.knn(store, queries, k))
    assert ct.cell_search(tree, queries, 0).collect() == []
    assert ct.cell_search(tree, queries.limit(0), 3, target=100).collect() == []
    with pytest.raises(ValueError):
        ct.cell_search(tree, queries, 3, target=101)
    with pytest.raises(ValueError):
        ct.cell_search(ct.CellTree(tree.cells, tree.leaves, tree.groups, "dot"), queries, 3, target=90)


def test_a_query_counts_as_often_as_it_visits_a_leaf():
    visited = pa.chunked_array([pa.array([[4, 1, 4], [7], [], [1]], pa.list_(pa.int32()))])
    place, times = ct.probe_counts(visited, np.array([1, 4, 6]))
    assert place.tolist() == [0, 3, 0] and times.tolist() == [[True, True, False], [True, False, False], [False, True, False]]


def test_hits_below_the_floor_stay_in_their_block(spark, data, tree):
    """What cannot be among the best is not returned, and a query meets a block once, whatever leaves it visits."""
    queries = data[1]
    probes = queries.select("qid").crossJoin(tree.leaves.select("grp", "leaf"))
    every = ct.visited_hits(tree, queries, probes, 4)
    best = every.groupBy("qid").agg(F.max("score").alias("floor"))
    got = ct.visited_hits(tree, queries, probes, 4, best)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, every.join(best, "qid").where("score >= floor").drop("floor").collect()))
    assert got.count() < every.count()


def test_leaves_are_assigned_in_slices(spark, data, tmp_path, monkeypatch):
    widest = []
    real = ct.gaps
    rows = data[0].limit(300)
    whole = ct.build_cell_tree(rows, str(tmp_path / "a"), 2, 3, sample=100)
    monkeypatch.setattr(ct, "SLICE_ROWS", 64)
    monkeypatch.setattr(ct, "gaps", lambda left, right: real(left, right) if len(left) <= 100 else widest.append(1) or 1 / 0)
    sliced = ct.build_cell_tree(rows, str(tmp_path / "b"), 2, 3, sample=1)
    assert sliced.cells.count() == whole.cells.count() == 300
