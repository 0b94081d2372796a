"""A stored vector index: groups of cells, searched by the cells that matter, with a recall that can be asked for.

Layout. Vectors are dealt to the nearest of a bounded number of group centroids, and within a group to the nearest of its leaves. Only
the group centroids are sent to all tasks; leaves meet vectors and queries by group, so their number has no limit. The
stored rows are partitioned by group and sorted by leaf; every leaf and group knows its radius, the largest distance of
a member to its centroid. Distances are Euclidean: of unit vectors for cosine, of the vectors as they are otherwise.

Search. A query first visits the nearest leaves of its nearest groups. By the triangle inequality no member of a cell is nearer than the
distance to its centroid less its radius. With an accuracy target of p %, the score of result number ceil(k * p / 100) gives a
distance, and a second visit goes to all cells whose bound does not exceed it: after that so many results are certainly the
true ones, all ``k`` for 100 %. Only the partitions of visited groups are read.

Leaf centroids are fitted on a bounded sample of each group, ``SAMPLE`` rows in expectation chosen by a hash of their ids; every row is
indexed, and the bounds hold for all of them whatever the fit.
"""

from __future__ import annotations

import math
import os
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwell.operators.ivf import CELLS, QUERY_ROWS, nearest_cells, train_centroids
from siftwell.operators.knn import BLOCK_PARTITIONS, BLOCK_ROWS, LEAST_BLOCKS, LEAST_ROWS, SLICE_ROWS, _ids, _matrix, _Scorer
from siftwell.operators.topk import top_n
from siftwell.session import cut_lineage, scratch_path

LEAVES = 16
SAMPLE = 16384
ROUNDS = 8
#: Scores are rounded to six decimals; a bound may miss a rounded score by that much.
ROUNDING = 1e-6
#: Metrics for which the triangle inequality bounds scores.
BOUNDED = ("cosine", "euclidean", "euclidean_squared", "l2_squared")


@dataclass(frozen=True)
class CellTree:
    """``cells(grp, leaf, doc_id, embeddings, away)``, ``leaves(grp, leaf, centroid, radius, n_rows)``, ``groups(grp, centroid, radius)``."""

    cells: DataFrame
    leaves: DataFrame
    groups: DataFrame
    metric: str


def in_space(matrix: np.ndarray, metric: str) -> np.ndarray:
    if metric != "cosine":
        return matrix
    norms = np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))
    return matrix / np.where(norms == 0, 1.0, norms)


def gaps(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Euclidean distances of all rows of both."""
    squared = (left * left).sum(axis=1)[:, None] - 2 * (left @ right.T) + (right * right).sum(axis=1)
    return np.sqrt(np.maximum(squared, 0.0))


def fit_leaves(rows: np.ndarray, n: int, seed: int) -> np.ndarray:
    """Centroids of at most ``n`` parts of a sample."""
    distinct = np.unique(rows, axis=0)
    centres = distinct[np.random.default_rng(seed).permutation(len(distinct))[:n]]
    for _ in range(ROUNDS):
        nearest = gaps(rows, centres).argmin(axis=1)
        members = np.bincount(nearest, minlength=len(centres))
        sums = np.stack([np.bincount(nearest, rows[:, d], len(centres)) for d in range(rows.shape[1])], axis=1)
        centres = np.where(members[:, None] > 0, sums / np.maximum(members, 1)[:, None], centres)
    return centres


def train_leaves(placed: DataFrame, sizes: DataFrame, n: int, seed: int, metric: str, sample: int) -> DataFrame:
    """``grp, leaf, centroid`` for every group, each fitted in a task of its own."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("doc_id")
        grp = table.column("grp")[0].as_py()
        centres = fit_leaves(in_space(_matrix(table.column("embeddings")), metric), n, seed + grp)
        return pa.table(
            {
                "grp": pa.array([grp] * len(centres), pa.int32()),
                "leaf": pa.array(range(len(centres)), pa.int32()),
                "centroid": pa.array(list(centres), pa.list_(pa.float64())),
            }
        )

    # One row per group.
    share = F.lit(float(sample)) / F.col("n_rows")
    chosen = placed.join(F.broadcast(sizes), "grp").where(
        (F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < F.greatest(share, F.lit(1.0) / F.col("n_rows")) * (1 << 20))
        | (F.col("doc_id") == F.col("least"))
    )
    return chosen.select("grp", "doc_id", "embeddings").groupBy("grp").applyInArrow(run, "grp int, leaf int, centroid array<double>")


def assign_leaves(placed: DataFrame, sizes: DataFrame, leaves: DataFrame, groups: DataFrame, metric: str) -> DataFrame:
    """Every row with its leaf, its distance to the leaf's centroid, and that to the group's."""
    shared = placed.sparkSession.sparkContext.broadcast({r.grp: np.array(r.centroid) for r in groups.collect()})

    def run(rows: pa.Table, own: pa.Table) -> pa.Table:
        if rows.num_rows == 0 or own.num_rows == 0:
            return pa.table({c: pa.array([], t) for c, t in (
                ("grp", pa.int32()), ("leaf", pa.int32()), ("doc_id", pa.int64()), ("embeddings", pa.list_(pa.float32())),
                ("away", pa.float64()), ("far", pa.float64()))})
        own = own.sort_by("leaf")
        centres, centre = _matrix(own.column("centroid")), shared.value[rows.column("grp")[0].as_py()]
        leaf, away, far = [], [], []
        for at in range(0, rows.num_rows, SLICE_ROWS):
            vectors = in_space(_matrix(rows.column("embeddings").slice(at, SLICE_ROWS)), metric)
            gap = gaps(vectors, centres)
            leaf.append(gap.argmin(axis=1))
            away.append(gap[np.arange(len(gap)), leaf[-1]])
            far.append(gaps(vectors, centre[None, :])[:, 0])
        return pa.table(
            {
                "grp": rows.column("grp"),
                "leaf": own.column("leaf").combine_chunks().take(pa.array(np.concatenate(leaf))),
                "doc_id": rows.column("doc_id"),
                "embeddings": rows.column("embeddings"),
                "away": np.concatenate(away),
                "far": np.concatenate(far),
            }
        )

    stripes = sizes.select("grp", F.ceil(F.col("n_rows") / BLOCK_ROWS).cast("int").alias("stripes"))
    dealt = placed.join(F.broadcast(stripes), "grp").withColumn(
        "stripe", F.pmod(F.xxhash64("doc_id"), F.col("stripes")).cast("int")
    )
    copied = leaves.join(F.broadcast(stripes), "grp").withColumn("stripe", F.explode(F.sequence(F.lit(0), F.col("stripes") - 1)))
    copied = copied.drop("stripes").toDF("grp", "leaf", "centroid", "stripe")
    return dealt.select("grp", "stripe", "doc_id", "embeddings").groupBy("grp", "stripe").cogroup(
        copied.groupBy("grp", "stripe")
    ).applyInArrow(run, "grp int, leaf int, doc_id long, embeddings array<float>, away double, far double")


def build_cell_tree(
    store: DataFrame,
    path: str,
    n_groups: int = CELLS,
    leaves: int = LEAVES,
    metric: str = "cosine",
    seed: int = 42,
    id_col: str = "doc_id",
    vec_col: str = "embeddings",
    sample: int = SAMPLE,
) -> CellTree:
    """Write the index of all vectors under ``path``. The number of groups is a setting and bounds what is sent to all tasks."""
    spark = store.sparkSession
    rows = store.where(F.col(vec_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(vec_col).cast("array<float>").alias("embeddings")
    )
    centroids = train_centroids(rows, n_groups, seed, "embeddings", metric)
    grp = F.element_at(nearest_cells(centroids, F.col("embeddings"), 1, metric=metric), 1)
    kept = scratch_path(spark, "grouped-vectors")
    rows.withColumn("grp", grp).write.parquet(kept)
    placed = spark.read.parquet(kept)
    sizes = cut_lineage(placed.groupBy("grp").agg(F.count(F.lit(1)).alias("n_rows"), F.min("doc_id").alias("least")))
    fitted = cut_lineage(train_leaves(placed, sizes, leaves, seed, metric, sample))
    groups = centroids.withColumnRenamed("cell", "grp")
    assigned = assign_leaves(placed, sizes, fitted, groups, metric)
    assigned.sortWithinPartitions("grp", "leaf").write.mode("overwrite").partitionBy("grp").parquet(os.path.join(path, "cells"))
    cells = spark.read.parquet(os.path.join(path, "cells"))
    own = cells.groupBy("grp", "leaf").agg(F.max("away").alias("radius"), F.count(F.lit(1)).alias("n_rows"), F.max("far").alias("far"))
    own = cut_lineage(own)
    fitted.join(own.drop("far"), ["grp", "leaf"]).write.mode("overwrite").parquet(os.path.join(path, "leaves"))
    groups.join(own.groupBy("grp").agg(F.max("far").alias("radius")), "grp").write.mode("overwrite").parquet(os.path.join(path, "groups"))
    return open_cell_tree(spark, path, metric)


def open_cell_tree(spark: SparkSession, path: str, metric: str = "cosine") -> CellTree:
    return CellTree(*(spark.read.parquet(os.path.join(path, name)) for name in ("cells", "leaves", "groups")), metric)


def groups_within(tree: CellTree, vector: Column, reach: Column) -> Column:
    """The groups that may hold a vector within ``reach``."""
    rows = tree.groups.orderBy("grp").collect()
    spark = tree.groups.sparkSession
    # As many rows as groups, a setting of the index.
    packed = (np.array([r.grp for r in rows]), np.array([r.centroid for r in rows], np.float64), np.array([r.radius for r in rows]))
    shared, metric = spark.sparkContext.broadcast(packed), tree.metric

    @F.pandas_udf("array<int>")
    def within(vectors: pd.Series, reaches: pd.Series) -> pd.Series:
        ids, centres, radii = shared.value
        if vectors.empty:
            return pd.Series([], dtype=object)
        near = gaps(in_space(np.stack(vectors.to_numpy()).astype(np.float64), metric), centres) - radii
        return pd.Series([ids[row <= r] for row, r in zip(near, reaches.to_numpy(), strict=True)])

    return within(vector, reach)


def leaf_distances(tree: CellTree, asked: DataFrame, n_queries: int) -> DataFrame:
    """``qid, grp, leaf, gap, lower``: distance of queries to the leaves of ``asked(qid, qvec, grp)``, and to their nearest possible member."""
    metric = tree.metric

    def run(queries: pa.Table, own: pa.Table) -> pa.Table:
        if queries.num_rows and own.num_rows:
            gap = gaps(in_space(_matrix(queries.column("qvec")), metric), _matrix(own.column("centroid")))
            lower = gap - own.column("radius").to_numpy()
        else:
            gap = lower = np.zeros((0, 0))
        n, m = gap.shape
        of = pa.array(np.tile(np.arange(m), n))
        grp = queries.column("grp")[0].as_py() if n else 0
        return pa.table(
            {
                "qid": np.repeat(_ids(queries.column("qid"))[:n], m),
                "grp": pa.array(np.full(n * m, grp, np.int32)),
                "leaf": own.column("leaf").combine_chunks().take(of) if m else pa.array([], pa.int32()),
                "gap": gap.ravel(),
                "lower": lower.ravel(),
            }
        )

    bands = max(1, math.ceil(n_queries / QUERY_ROWS))
    left = asked.withColumn("band", F.pmod(F.xxhash64("qid"), F.lit(bands)).cast("int"))
    right = tree.leaves.select("grp", "leaf", "centroid", "radius").withColumn(
        "band", F.explode(F.sequence(F.lit(0), F.lit(bands - 1)))
    )
    return left.groupBy("grp", "band").cogroup(right.groupBy("grp", "band")).applyInArrow(
        run, "qid long, grp int, leaf int, gap double, lower double"
    )


def visited_hits(tree: CellTree, queries: DataFrame, probes: DataFrame, k: int, floors: DataFrame | None = None) -> DataFrame:
    """Best ``k`` of each block of rows in the cells of ``probes(qid, grp, leaf)``; groups deal out by their stored sizes.

    A query meets a block of a group's rows once, with the list of the leaves it visits there. ``floors(qid, floor)`` are scores below
    which hits are of no use. A query that is probed several times for a leaf, or that is in several rows, counts as often.
    """
    # One row per group, a setting of the index; so are leaves of a group.
    asked_of = {r.grp: r.n for r in probes.groupBy("grp").agg(F.count_distinct("qid").alias("n")).collect()}
    groups = sorted(asked_of)
    n_rows = dict(tree.leaves.where(F.col("grp").isin(groups)).groupBy("grp").agg(F.sum("n_rows")).collect())
    sizes, blocks = [], 0
    for grp in sorted(n_rows):
        bands = max(math.ceil(asked_of[grp] / QUERY_ROWS), 1)
        # Blocks of small inputs are cut down, so that every core has some.
        least = math.ceil(LEAST_BLOCKS / (len(n_rows) * bands))
        stripes = max(math.ceil(n_rows[grp] / BLOCK_ROWS), min(least, n_rows[grp] // LEAST_ROWS), 1)
        sizes.append((grp, blocks, stripes, bands))
        blocks += stripes * bands
    spark = tree.cells.sparkSession
    sized = F.broadcast(spark.createDataFrame(sizes, "grp int, first int, stripes int, bands int"))

    def dealt(column: str, n: str) -> Column:
        return F.pmod(F.xxhash64(column), F.col(n)).cast("int")

    def copied(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    block = (F.col("first") + F.col("row_block") * F.col("bands") + F.col("q_block")).alias("block")
    rows = tree.cells.where(F.col("grp").isin(groups)).join(sized, "grp").withColumn("row_block", dealt("doc_id", "stripes"))
    rows = rows.withColumn("q_block", copied("bands")).select(block, "leaf", "doc_id", F.col("embeddings").alias("vec"))
    visits = probes.groupBy("qid", "grp").agg(F.collect_list("leaf").alias("visited"))
    asked = visits.join(queries.select("qid", "qvec"), "qid").withColumn("floor", F.lit(float("-inf")))
    if floors is not None:
        asked = asked.drop("floor").join(floors.select("qid", "floor"), "qid", "left")
    asked = asked.join(sized, "grp").withColumn("q_block", dealt("qid", "bands")).withColumn("row_block", copied("stripes"))
    asked = asked.select(block, "qid", "qvec", "visited", "floor")
    metric = tree.metric

    def one_block(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({"qid": pa.array([], pa.int64()), "doc_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        leaf = left["leaf"].to_numpy()
        order = np.argsort(leaf, kind="stable")
        leaves, starts = np.unique(leaf[order], return_index=True)
        place, times = probe_counts(right["visited"], leaves)
        floor = right["floor"].to_numpy(zero_copy_only=False).astype(np.float64)
        floor = np.where(np.isnan(floor), -np.inf, floor)
        scorer = _Scorer(_ids(right["qid"])[place], _matrix(right["qvec"])[place], [k], metric, floor[place])
        for n, (start, end) in enumerate(zip(starts, np.r_[starts[1:], len(order)])):
            for at in range(start, end if times[:, n].any() else start, SLICE_ROWS):
                some = pa.array(order[at : min(at + SLICE_ROWS, end)])
                ids = _ids(left["doc_id"].take(some))
                scorer.add(ids, _matrix(left["vec"].take(some)), [np.ones(len(ids), bool)], times[:, n])
        return scorer.table().select(["qid", "doc_id", "score"])

    def own_task(side: DataFrame) -> DataFrame:
        if blocks <= BLOCK_PARTITIONS:
            return side.repartitionById(max(blocks, 1), F.col("block"))
        return side.repartition(BLOCK_PARTITIONS, "block")

    rows, asked = own_task(rows), own_task(asked)
    return rows.groupBy("block").cogroup(asked.groupBy("block")).applyInArrow(one_block, "qid long, doc_id long, score double")


def probe_counts(visited: pa.ChunkedArray, leaves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of queries that visit some of these leaves, as often as they visit one, and which leaves each of the places visits."""
    lists = visited.combine_chunks()
    of, leaf = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy())), lists.flatten().to_numpy()
    column = np.minimum(np.searchsorted(leaves, leaf), len(leaves) - 1)
    own = leaves[column] == leaf
    times = np.bincount(of[own] * len(leaves) + column[own], minlength=len(lists) * len(leaves)).reshape(len(lists), -1)
    places = [np.flatnonzero((times > n).any(axis=1)) for n in range(times.max(initial=0))]
    marks = [times[some] > n for n, some in enumerate(places)]
    if not places:
        return np.zeros(0, np.int64), np.zeros((0, len(leaves)), bool)
    return np.concatenate(places), np.concatenate(marks)


def distance_of(score: Column, metric: str) -> Column:
    """The largest distance that a score, before rounding, may stand for."""
    loss = F.lit(1.0 + ROUNDING) - score
    if metric == "cosine":
        return F.sqrt(F.greatest(loss, F.lit(0.0)) * 2)
    if metric == "euclidean":
        return loss
    return F.sqrt(F.greatest(loss, F.lit(0.0)))


def cell_search(
    tree: CellTree, queries: DataFrame, k: int, nprobe: int = 3, probe_groups: int = 2, target: float | None = None
) -> DataFrame:
    """``qid, rank, doc_id, score``: the best ``k`` of the ``nprobe`` nearest cells within the nearest groups; with ``target``,
    of so many cells more that at least that percentage of the exact best ``k`` is certainly found."""
    if target is not None and tree.metric not in BOUNDED:
        raise ValueError(f"An accuracy target needs one of {', '.join(BOUNDED)}.")
    if target is not None and not 0 < target <= 100:
        raise ValueError("target must be a percentage.")
    asked = queries.where(F.col("qvec").isNotNull()).select(F.col("qid").cast("long"), F.col("qvec").cast("array<float>").alias("qvec"))
    if k < 1:
        return queries.sparkSession.createDataFrame([], "qid long, rank int, doc_id long, score double")
    n_queries = asked.count()
    order = [F.desc_nulls_last("score"), F.asc("doc_id")]
    centroids = tree.groups.select(F.col("grp").alias("cell"), "centroid")
    near = nearest_cells(centroids, F.col("qvec"), probe_groups, metric=tree.metric)
    first = leaf_distances(tree, asked.select("qid", "qvec", F.explode(near).alias("grp")), n_queries)
    probes = cut_lineage(top_n(first, ["qid"], [F.asc("gap"), F.asc("grp"), F.asc("leaf")], nprobe).select("qid", "grp", "leaf"))
    found = top_n(visited_hits(tree, asked, probes, k), ["qid"], order, k).select("qid", "rank", "doc_id", "score")
    if target is None:
        return found
    found = cut_lineage(found)
    certain = math.ceil(k * target / 100)
    told = found.where((F.col("rank") == certain) & F.col("score").isNotNull())
    reach = asked.join(told.select("qid", distance_of(F.col("score"), tree.metric).alias("reach")), "qid", "left").withColumn(
        "reach", F.coalesce("reach", F.lit(float("inf")))
    )
    wider = reach.select("qid", "qvec", F.explode(groups_within(tree, F.col("qvec"), F.col("reach"))).alias("grp"))
    bounds = leaf_distances(tree, wider, n_queries).join(reach.select("qid", "reach"), "qid")
    more = bounds.where(F.col("lower") <= F.col("reach") + ROUNDING).select("qid", "grp", "leaf")
    more = cut_lineage(more.join(probes, ["qid", "grp", "leaf"], "left_anti"))
    # Nothing below the k-th score so far can be among the best.
    floors = found.where(F.col("rank") == k).select("qid", F.col("score").alias("floor"))
    both = found.drop("rank").unionByName(visited_hits(tree, asked, more, k, floors))
    return top_n(both, ["qid"], order, k).select("qid", "rank", "doc_id", "score")
