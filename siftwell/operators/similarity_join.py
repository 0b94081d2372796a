"""Threshold join of vectors by cosine, exact and without comparing all pairs.

Unit vectors whose cosine reaches ``t`` lie within ``sqrt(2 - 2 t)`` of each other. Some vectors of the store, ``PIVOTS`` at most, are
pivots; every row belongs to its nearest one. By the triangle inequality

* a candidate visits a pivot's rows only if its distance to the pivot less the pivot's radius is within reach;
* there, it meets only the rows whose distance to the pivot differs from its own by no more than the reach.

For the pairs left, the products of the few dimensions with the most weight are taken first; by Cauchy and Schwarz the others
add at most the product of the norms of what is left. Only pairs that can still reach ``t``, and more than the best the candidate
has, are multiplied out: one by one, or as one matrix product where many of a tile are left.

Rows of a pivot with many rows, or visited by many candidates, are dealt into blocks by counts, so a hot pivot lies in no single task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwell.operators.knn import _ids, _matrix
from siftwell.session import cut_lineage

PIVOTS = 64
BLOCK_ROWS = 32768
BLOCK_QUERIES = 16384
#: Tiles of which more than one pair in so many is left are multiplied whole.
DENSE = 32
#: Pairs multiplied in double precision at once.
PAIRS = 1 << 14
#: Candidates whose products with a run of rows are taken at once.
BAND = 256
#: The share of the dimensions multiplied first.
FIRST_SHARE = 4
#: Similarities are rounded to six decimals.
ROUNDING = 1e-6

PLACED = "cell int, away double, vec array<float>"
VISITS = "qid long, cell int, away double, vec array<float>"
FOUND = "qid long, similarity double, met long, multiplied long"


def unit_rows(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of length 1, and which rows are not zero."""
    norms = np.sqrt((matrix * matrix).sum(axis=1))
    sound = norms > 0
    return matrix / np.where(sound, norms, 1.0)[:, None], sound


def gaps(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2.0 - 2.0 * (left @ right.T), 0.0))


def placed_rows(rows: DataFrame, pivots) -> DataFrame:
    """Every vector with its nearest pivot and the distance to it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                vectors, sound = unit_rows(_matrix(batch.column("vec")))
                away = gaps(vectors, pivots.value)
                cell = away.argmin(axis=1)
                found = pa.RecordBatch.from_arrays(
                    [pa.array(cell.astype(np.int32)), pa.array(away[np.arange(len(cell)), cell]), batch.column("vec")],
                    ["cell", "away", "vec"],
                )
                yield found.filter(pa.array(sound))

    return rows.select("vec").mapInArrow(run, PLACED)


def visits(candidates: DataFrame, pivots, radii: np.ndarray, reach: float) -> DataFrame:
    """Every candidate with each pivot whose rows it may reach."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                vectors, sound = unit_rows(_matrix(batch.column("vec")))
                away = gaps(vectors, pivots.value)
                who, cell = np.nonzero((away - radii <= reach) & sound[:, None])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("qid").take(pa.array(who)),
                        pa.array(cell.astype(np.int32)),
                        pa.array(away[who, cell]),
                        batch.column("vec").take(pa.array(who)),
                    ],
                    ["qid", "cell", "away", "vec"],
                )

    return candidates.select("qid", "vec").mapInArrow(run, VISITS)


def block_maxima(
    asked: np.ndarray, asked_away: np.ndarray, rows: np.ndarray, away: np.ndarray, least: float, reach: float
) -> tuple[np.ndarray, int, int]:
    """Best similarity of each candidate that reaches ``least`` (else -inf), and how many pairs met and were multiplied out.

    Bounds and products that tell which pairs matter are of single precision; what is returned is multiplied in double precision.
    """
    best = np.full(len(asked), -np.inf)
    met = multiplied = 0
    order = np.argsort(away, kind="stable")
    rows, away = rows[order], away[order]
    heavy = np.argsort(-(rows * rows).sum(axis=0), kind="stable")
    rows, asked = rows[:, heavy], asked[:, heavy]
    first = max(1, rows.shape[1] // FIRST_SHARE)
    left_rows = np.sqrt((rows[:, first:] ** 2).sum(axis=1)).astype(np.float32)
    left_asked = np.sqrt((asked[:, first:] ** 2).sum(axis=1)).astype(np.float32)
    single, single_asked = rows.astype(np.float32), asked.astype(np.float32)
    slack = ROUNDING * (1 + rows.shape[1] / 4)
    by_away = np.argsort(asked_away, kind="stable")
    for k in range(0, len(by_away), BAND):
        some = by_away[k : k + BAND]
        lows = np.searchsorted(away, asked_away[some] - reach, side="left")
        highs = np.searchsorted(away, asked_away[some] + reach, side="right")
        met += int((highs - lows).sum())
        low, high = int(lows.min()), int(highs.max())
        step = max(1, (1 << 20) // len(some))
        for at in range(low, high, step):
            part = slice(at, min(at + step, high))
            # A candidate looks for what is better than the best it has.
            floor = np.maximum(least, best[some])
            bound = single_asked[some, :first] @ single[part, :first].T
            bound += left_asked[some][:, None] * left_rows[part]
            may = bound >= (floor - slack).astype(np.float32)[:, None]
            if lows.max() > part.start or highs.min() < part.stop:
                place = np.arange(part.start, part.stop)
                may &= (place >= lows[:, None]) & (place < highs[:, None])
            n = int(np.count_nonzero(may))
            multiplied += n
            if n * DENSE > may.size:
                # Most of a tile is multiplied at once.
                product = single_asked[some] @ single[part].T
                floor = np.maximum(floor, product.max(axis=1, where=may, initial=-np.inf) - slack)
                may &= product >= (floor - slack).astype(np.float32)[:, None]
            who, which = np.nonzero(may)
            for at_pair in range(0, len(who), PAIRS):
                w, x = some[who[at_pair : at_pair + PAIRS]], which[at_pair : at_pair + PAIRS] + part.start
                np.maximum.at(best, w, (asked[w] * rows[x]).sum(axis=1))
    return best, met, multiplied


def similar_pairs(candidates: DataFrame, rows: DataFrame, threshold: float, pivots: int = PIVOTS) -> DataFrame:
    """``qid, similarity, met, multiplied`` of every block: candidates whose best row in it reaches the threshold, and a row without
    ``qid`` that says how many pairs met in the block and how many of them were multiplied out.

    ``candidates(qid, vec)`` and ``rows(doc_id, vec)`` have no null vectors. Zero vectors are similar to nothing.
    """
    spark = rows.sparkSession
    least = threshold - ROUNDING
    nothing = spark.createDataFrame([], FOUND)
    if least > 1 + ROUNDING:
        return nothing
    reach = math.sqrt(max(0.0, 2.0 - 2.0 * least)) + ROUNDING
    # A bounded number of rows, and as many numbers as pivots.
    taken = rows.select("vec").orderBy(F.xxhash64("doc_id")).limit(pivots).toArrow()
    if taken.num_rows == 0:
        return nothing
    vectors, sound = unit_rows(_matrix(taken.column("vec")))
    vectors = np.unique(vectors[sound], axis=0)
    if len(vectors) == 0:
        vectors = np.eye(1, _matrix(taken.column("vec")).shape[1])
    shared = spark.sparkContext.broadcast(vectors)
    placed = placed_rows(rows, shared)
    sizes = {r.cell: r for r in placed.groupBy("cell").agg(F.max("away").alias("radius"), F.count(F.lit(1)).alias("n")).collect()}
    radii = np.array([sizes[c].radius if c in sizes else -np.inf for c in range(len(vectors))])
    seen = cut_lineage(visits(candidates, shared, radii, reach))
    asked_of = dict(seen.groupBy("cell").count().collect())
    if not asked_of:
        return nothing
    parts = spark.createDataFrame(
        [(c, math.ceil(sizes[c].n / BLOCK_ROWS), math.ceil(n / BLOCK_QUERIES)) for c, n in sorted(asked_of.items())],
        "cell int, stripes int, bands int",
    )

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        n = min(left.num_rows, 1) * right.num_rows
        best, met, multiplied = np.zeros(0), 0, 0
        if n:
            asked, own = (unit_rows(_matrix(t.column("vec")))[0] for t in (right, left))
            best, met, multiplied = block_maxima(
                asked, right.column("away").to_numpy(), own, left.column("away").to_numpy(), least, reach
            )
        best = np.round(best, 6)
        hit = np.flatnonzero(best >= threshold)
        empty = [None] * len(hit)
        return pa.table(
            {
                "qid": pa.array([*_ids(right.column("qid"))[hit].tolist(), None], pa.int64()),
                "similarity": pa.array([*best[hit].tolist(), None], pa.float64()),
                "met": pa.array([*empty, met], pa.int64()),
                "multiplied": pa.array([*empty, multiplied], pa.int64()),
            }
        )

    def dealt(of: Column, n: str) -> Column:
        return F.pmod(of, F.col(n)).cast("int")

    def copied(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    # One row per pivot.
    left = placed.join(F.broadcast(parts), "cell").withColumn("stripe", dealt(F.xxhash64("vec"), "stripes"))
    left = left.withColumn("band", copied("bands")).select("cell", "stripe", "band", "away", "vec")
    right = seen.join(F.broadcast(parts), "cell").withColumn("band", dealt(F.xxhash64("qid"), "bands"))
    right = right.withColumn("stripe", copied("stripes")).select("cell", "stripe", "band", "qid", "away", "vec")
    keys = ["cell", "stripe", "band"]
    return left.groupBy(*keys).cogroup(right.toDF(*right.columns).groupBy(*keys)).applyInArrow(run, FOUND)


def similarity_at_least(
    candidates: DataFrame, store: DataFrame, threshold: float, eligible: Column | None = None, pivots: int = PIVOTS
) -> DataFrame:
    """``qid, similarity``: the best cosine of each candidate with an eligible row, if it reaches ``threshold``."""
    rule = F.col("embeddings").isNotNull() if eligible is None else eligible & F.col("embeddings").isNotNull()
    rows = store.where(rule).select("doc_id", F.col("embeddings").cast("array<float>").alias("vec"))
    asked = candidates.where(F.col("qvec").isNotNull()).select(
        F.col("qid").cast("long").alias("qid"), F.col("qvec").cast("array<float>").alias("vec")
    )
    found = similar_pairs(asked, rows, threshold, pivots)
    return found.where(F.col("qid").isNotNull()).groupBy("qid").agg(F.max("similarity").alias("similarity"))
