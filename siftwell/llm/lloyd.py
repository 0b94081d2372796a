"""Lloyd's clustering in exact integers, sharded by dimension.

Vectors become integers, floor(scale * component), and are laid out once: packed by ``PACK``, and each pack is cut
into blocks of ``BLOCK`` columns, and the blocks dealt out by (shard, pack). In a round

1. a task takes column blocks, and computes exact partial squared distances to its shard's slices of the centroids;
2. the partial distances of a pack are added up over its shards, and the nearest centroid is taken (ties: the smaller number);
3. the clusters of a pack, two bytes a vector, go back to its blocks, which stay where they lie. Every shard adds up its
   columns by cluster, in the tasks first, and replaces its slice by the floors of sum / count; empty clusters stay.

Only centroids (``k`` times the dimension, both parameters) pass through the driver. The layout is a checkpoint, so each round
starts from stored data and a lost executor costs the running round's tasks.

Vectors of another dimension, null ones, and those with a null, non-finite or too large component take no part and have no row
in the result; too large is one whose integer reaches 2**27, beyond which distances would leave the range of longs. Rows
without an identifier take part, but are first centroids only where there are no others. Rows that repeat an identifier are
rows of their own, first the one with the smaller vector. Fewer vectors than ``k`` make as many clusters. Sums over a cluster
that leave the range of longs are null. Only the two named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwell.session import cut_lineage, scratch_path

#: Vectors packed together, and columns of a block.
PACK = 2048
BLOCK = 16
LIMIT = 1 << 27
#: Below this, products and sums over a block are exact in doubles.
SMALL = 1 << 20


def whole_numbers(vector: Column, scale: int) -> Column:
    return F.transform(vector.cast("array<double>"), lambda x: F.floor(x * scale))


def usable(vector: Column, dims: int, scale: int) -> Column:
    """Vectors of the dimension whose components are finite and in range."""
    values = vector.cast("array<double>")
    return F.coalesce(
        (F.size(values) == dims)
        & F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * scale) < F.lit(float(LIMIT - 1)))),
        F.lit(False),
    )


def lay_out(rows: DataFrame, dims: int) -> DataFrame:
    """``shard, pack, ids, block`` from ``id, v``: column blocks of packed vectors; the first shard's have the ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            values = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.int32).reshape(-1, dims)
            for at in range(0, len(values), PACK):
                ids = batch.column(0).slice(at, PACK).to_pylist()
                blocks = [np.ascontiguousarray(values[at : at + PACK, c : c + BLOCK]).tobytes() for c in range(0, dims, BLOCK)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(range(len(blocks)), pa.int32()),
                        pa.array([number] * len(blocks), pa.int64()),
                        pa.array([ids, *[None] * (len(blocks) - 1)], pa.list_(pa.int64())),
                        pa.array(blocks, pa.binary()),
                    ],
                    ["shard", "pack", "ids", "block"],
                )
                number += 1

    return rows.mapInArrow(run, "shard int, pack long, ids array<long>, block binary")


def partial_distances(block: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Exact squared distances over a block's columns: a row for each vector, a column for each centroid."""
    if max(np.abs(block).max(initial=0), np.abs(centres).max(initial=0)) < SMALL:
        x, c = block.astype(np.float64), centres.astype(np.float64)
        found = (x * x).sum(axis=1)[:, None] - 2 * (x @ c.T) + (c * c).sum(axis=1)
        return found.astype(np.int64)
    x, c = block.astype(np.int64), centres.astype(np.int64)
    return (x * x).sum(axis=1)[:, None] - 2 * (x @ c.T) + (c * c).sum(axis=1)


def distances(blocks: DataFrame, centroids) -> DataFrame:
    """``pack, ids, part``: each column block's partial distances; ``centroids`` is a broadcast matrix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = centroids.value
        for batch in batches:
            for k in range(batch.num_rows):
                shard, pack, ids, block = (batch.column(c)[k] for c in range(4))
                centres = whole[:, shard.as_py() * BLOCK : (shard.as_py() + 1) * BLOCK]
                values = np.frombuffer(block.as_buffer(), np.int32).reshape(-1, centres.shape[1])
                part = partial_distances(values, centres)
                if part.max(initial=0) < 1 << 31:
                    part = part.astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([pack.as_py()], pa.int64()),
                        pa.array([ids.as_py()], pa.list_(pa.int64())),
                        pa.array([part.tobytes()], pa.binary()),
                    ],
                    ["pack", "ids", "part"],
                )

    return blocks.select("shard", "pack", "ids", "block").mapInArrow(run, "pack long, ids array<long>, part binary")


def nearest(parts: DataFrame, k: int) -> DataFrame:
    """``pack, clusters, ids, distances`` of each pack, from its blocks' partial distances."""

    def run(table: pa.Table) -> pa.Table:
        ids = next(x for x in table.column("ids") if x.is_valid)
        total = np.zeros((len(ids), k), np.int64)
        for part in table.column("part"):
            raw = part.as_buffer()
            total += np.frombuffer(raw, np.int32 if raw.size == total.size * 4 else np.int64).reshape(total.shape)
        best = total.argmin(axis=1)
        return pa.table(
            {
                "pack": table.column("pack").slice(0, 1),
                "clusters": pa.array([best.astype(np.int32)], pa.list_(pa.int32())),
                "ids": pa.array([ids.as_py()], pa.list_(pa.int64())),
                "distances": pa.array([total[np.arange(len(best)), best]], pa.list_(pa.int64())),
            }
        )

    return parts.groupBy("pack").applyInArrow(
        run, "pack long, clusters array<int>, ids array<long>, distances array<long>"
    )


def column_sums(blocks: DataFrame, clusters: DataFrame, shards: int, k: int) -> DataFrame:
    """``cluster, dim, total, members``: sums of all vectors of a cluster, by each shard for its own columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        members: dict[int, np.ndarray] = {}
        for batch in batches:
            for row in range(batch.num_rows):
                shard = batch.column(0)[row].as_py()
                which = batch.column(1)[row].values.to_numpy(zero_copy_only=False)
                values = np.frombuffer(batch.column(2)[row].as_buffer(), np.int32).reshape(len(which), -1)
                order = np.argsort(which, kind="stable")
                found, first = np.unique(which[order], return_index=True)
                total = sums.setdefault(shard, np.zeros((k, values.shape[1]), np.int64))
                total[found] += np.add.reduceat(values[order], first, axis=0, dtype=np.int64)
                count = members.setdefault(shard, np.zeros(k, np.int64))
                count += np.bincount(which, minlength=k)
        for shard, total in sums.items():
            cluster, column = np.nonzero(np.broadcast_to(members[shard][:, None] > 0, total.shape))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(cluster.astype(np.int32)),
                    pa.array((column + shard * BLOCK).astype(np.int32)),
                    pa.array(total[cluster, column]),
                    pa.array(members[shard][cluster]),
                ],
                ["cluster", "dim", "total", "members"],
            )

    sent = clusters.select("pack", "clusters", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
    met = blocks.select("shard", "pack", "block").join(sent.hint("shuffle_hash"), ["shard", "pack"])
    by_task = met.select("shard", "clusters", "block").mapInArrow(run, "cluster int, dim int, total long, members long")
    return by_task.groupBy("cluster", "dim").agg(F.sum("total").alias("total"), F.sum("members").alias("members"))


def first_centroids(rows: DataFrame, k: int, prefix: str) -> np.ndarray:
    """The ``k`` vectors whose ids, after ``prefix``, have the smallest SHA-256."""
    key = F.sha2(F.concat(F.lit(prefix), F.col("id").cast("string")), 256)
    taken = rows.select(key.alias("key"), "v").orderBy(F.col("key").asc_nulls_last(), "v").limit(k).collect()
    return np.array([r.v for r in taken], np.int64)


def in_range(total: int) -> int | None:
    """A sum as a long, or null beyond."""
    return int(total) if total < 1 << 63 else None


def cluster(
    vectors: DataFrame,
    k: int = 40,
    rounds: int = 5,
    dims: int = 64,
    scale: int = 256,
    prefix: str = "2:",
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """One row per vector that takes part: id, ``cluster``, ``distance`` to its centroid (squared), ``cluster_inertia`` and ``inertia``
    (distances added up over the cluster and over all), and ``centroid_sha256`` of the centroid's components, joined by commas."""
    spark = vectors.sparkSession
    rows = vectors.where(usable(F.col(vector_column), dims, scale)).select(
        F.col(id_column).cast("long").alias("id"), whole_numbers(F.col(vector_column), scale).alias("v")
    )
    centroids = first_centroids(rows, k, prefix)
    k = len(centroids)
    if k == 0:
        return spark.createDataFrame(
            [],
            f"{id_column} long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string",
        )
    # Written before it is dealt out: a task that runs again must not pack other vectors together.
    path = scratch_path(spark, "column-blocks")
    lay_out(rows, dims).write.parquet(path)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = cut_lineage(spark.read.parquet(path).repartition(partitions, "shard", "pack"))
    shards = -(-dims // BLOCK)
    for _ in range(rounds):
        found = nearest(distances(blocks, spark.sparkContext.broadcast(centroids)), k)
        sums = column_sums(blocks, found, shards, k)
        moved = sums.select("cluster", "dim", F.expr("(total - pmod(total, members)) div members").alias("value")).toPandas()
        centroids = centroids.copy()
        centroids[moved["cluster"], moved["dim"]] = moved["value"]
    found = cut_lineage(nearest(distances(blocks, spark.sparkContext.broadcast(centroids)), k))
    each = found.select(F.explode(F.arrays_zip("ids", "clusters", "distances")).alias("x")).select(
        F.col("x.ids").alias(id_column), F.col("x.clusters").alias("cluster"), F.col("x.distances").alias("distance")
    )
    # One row per cluster.
    own = dict(each.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(19,0)"))).collect())
    every = sum(map(int, own.values()))
    totals = spark.createDataFrame(
        [
            (n, in_range(own[n]), in_range(every), hashlib.sha256(",".join(map(str, centroids[n].tolist())).encode()).hexdigest())
            for n in sorted(own)
        ],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    return each.join(F.broadcast(totals), "cluster").select(
        id_column, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
