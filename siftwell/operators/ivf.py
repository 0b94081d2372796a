"""Partitioned vector index: vectors grouped in cells around centroids, a few cells probed per query."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwell.operators.knn import BLOCK_ROWS, score_blocks
from siftwell.operators.sizing import BROADCAST_BYTES, measured_bytes
from siftwell.operators.topk import top_n
from siftwell.session import cut_lineage

# Fixed value: default number of cells.
CELLS = 10
QUERY_ROWS = 8192


def in_space(vector: Column, metric: str) -> Column:
    """A vector as cells see it: of length 1 for cosine, as it is for other metrics."""
    values = vector.cast("array<double>")
    if metric != "cosine":
        return values
    length = F.sqrt(F.aggregate(values, F.lit(0.0), lambda total, x: total + x * x))
    return F.when(length == 0, values).otherwise(F.transform(values, lambda x: x / length))


def train_centroids(
    store: DataFrame, n_cells: int = CELLS, seed: int = 42, vec_col: str = "embeddings", metric: str = "cosine"
) -> DataFrame:
    """``(cell, centroid)`` by distributed k-means over every vector, in the space in which cells are assigned."""
    spark = store.sparkSession
    features = store.filter(F.col(vec_col).isNotNull()).select(
        array_to_vector(in_space(F.col(vec_col), metric)).alias("features")
    )
    centers = KMeans(k=n_cells, seed=seed).fit(features).clusterCenters()
    rows = [(i, [float(x) for x in center]) for i, center in enumerate(centers)]
    return spark.createDataFrame(rows, "cell int, centroid array<double>")


def group_centroids(store: DataFrame, group: str, vec_col: str = "embeddings") -> DataFrame:
    """``(cell, centroid)``: the mean vector of each value of an integer column."""
    parts = store.filter(F.col(vec_col).isNotNull()).select(
        F.col(group).cast("int").alias("cell"), F.posexplode(vec_col).alias("pos", "x")
    )
    means = parts.groupBy("cell", "pos").agg(F.avg(F.col("x").cast("double")).alias("mean"))
    entries = F.array_sort(F.collect_list(F.struct("pos", "mean")))
    return means.groupBy("cell").agg(F.transform(entries, lambda e: e["mean"]).alias("centroid"))


def nearest_cells(
    centroids: DataFrame, vector: Column, n: int, budget: int = BROADCAST_BYTES, metric: str = "cosine"
) -> Column:
    """The ``n`` nearest cells of a vector, nearest first.

    The number of cells is a setting, not something that grows with the store; it is measured all the
    same before the centroids are sent to the tasks.
    """
    size = measured_bytes(centroids, F.size("centroid") * 8 + 8)
    if size > budget:
        raise ValueError(f"Centroids take {size} bytes; use fewer cells or raise the budget of {budget}.")
    packed = centroids.orderBy("cell").toPandas()
    spark = centroids.sparkSession
    matrix = np.stack(packed["centroid"].to_numpy()).astype(np.float64)
    shared = spark.sparkContext.broadcast((packed["cell"].to_numpy(), matrix))
    unit = metric == "cosine"

    @F.pandas_udf("array<int>")
    def cells(vectors: pd.Series) -> pd.Series:
        ids, centers = shared.value
        if vectors.empty:
            return pd.Series([], dtype=object)
        rows = np.stack(vectors.to_numpy()).astype(np.float64)
        if unit:
            norms = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
            rows = rows / np.where(norms == 0, 1.0, norms)
        # Nearest by Euclidean distance, without the part all cells share.
        closeness = rows @ centers.T - (centers * centers).sum(axis=1) / 2
        order = np.argsort(-closeness, axis=1, kind="stable")[:, :n]
        return pd.Series(list(ids[order]))

    return cells(vector)


def assign_cells(
    store: DataFrame, centroids: DataFrame, id_col: str = "doc_id", vec_col: str = "embeddings", metric: str = "cosine"
) -> DataFrame:
    """``(cell, doc_id, embeddings)``: every vector in its nearest cell."""
    rows = store.filter(F.col(vec_col).isNotNull())
    cell = F.element_at(nearest_cells(centroids, F.col(vec_col), 1, metric=metric), 1)
    return rows.select(
        cell.alias("cell"), F.col(id_col).cast("long").alias("doc_id"), F.col(vec_col).alias("embeddings")
    )


def ivf_build(
    store: DataFrame,
    n_cells: int = CELLS,
    seed: int = 42,
    id_col: str = "doc_id",
    vec_col: str = "embeddings",
    metric: str = "cosine",
) -> tuple[DataFrame, DataFrame]:
    """``(cells, centroids)`` tables of an index over the store."""
    centroids = train_centroids(store, n_cells, seed, vec_col, metric)
    return assign_cells(store, centroids, id_col, vec_col, metric), centroids


def save_index(cells: DataFrame, centroids: DataFrame, path: str) -> None:
    """Cells as one folder each, so that a search reads only the folders it probes."""
    cells.write.mode("overwrite").partitionBy("cell").parquet(f"{path}/cells")
    centroids.write.mode("overwrite").parquet(f"{path}/centroids")


def load_index(spark, path: str) -> tuple[DataFrame, DataFrame]:
    return spark.read.parquet(f"{path}/cells"), spark.read.parquet(f"{path}/centroids")


def ivf_search(
    cells: DataFrame,
    centroids: DataFrame,
    queries: DataFrame,
    k: int,
    nprobe: int,
    metric: str = "cosine",
    block_rows: int = BLOCK_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """``(qid, rank, doc_id, score)``: exact best ``k`` within the ``nprobe`` nearest cells of a query.

    Rows and queries meet by cell. A cell holding many rows, or probed by many queries, is dealt into
    blocks by its own counts, so no task gets a whole hot cell.
    """
    nearest = nearest_cells(centroids, F.col("qvec"), nprobe, metric=metric)
    probes = queries.filter(F.col("qvec").isNotNull()).select("qid", "qvec", F.explode(nearest).alias("cell"))
    # One row per cell.
    sizes = cut_lineage(
        cells.groupBy("cell").agg(F.count("*").alias("n_rows"))
        .join(probes.groupBy("cell").agg(F.count("*").alias("n_probes")), "cell")
        .select(
            "cell",
            F.ceil(F.col("n_rows") / block_rows).cast("int").alias("stripes"),
            F.ceil(F.col("n_probes") / query_rows).cast("int").alias("bands"),
        )
    )

    def dealt(column: str, n: str) -> Column:
        return F.pmod(F.xxhash64(column), F.col(n)).cast("int")

    def copied(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    rows = (
        cells.join(sizes, "cell")
        .withColumn("row_block", dealt("doc_id", "stripes"))
        .withColumn("q_block", copied("bands"))
        .select(
            "cell", "row_block", "q_block", "doc_id",
            F.col("embeddings").cast("array<float>").alias("vec"), F.lit(True).alias("t0"),
        )
    )
    asked = (
        probes.join(sizes, "cell")
        .withColumn("q_block", dealt("qid", "bands"))
        .withColumn("row_block", copied("stripes"))
        .select(
            "cell", "row_block", "q_block", F.col("qid").cast("long").alias("qid"),
            F.col("qvec").cast("array<float>").alias("qvec"),
        )
    )
    blocks = sizes.agg(F.coalesce(F.sum(F.col("stripes") * F.col("bands")), F.lit(1))).first()[0]
    hits = score_blocks(rows, asked, ["cell", "row_block", "q_block"], [k], metric, blocks)
    return top_n(hits, ["qid"], [F.desc_nulls_last("score"), F.asc("doc_id")], k).select(
        "qid", "rank", "doc_id", "score"
    )
