"""Hard-negative mining: exact inner products by a residue number system, then selection within windows of scores.

Vectors become integers, floor(scale * component). Queries of a search are the anchors, every row whose id is divisible by
``every``; they are scored against all rows in a grid of cells: rows are dealt into parts by a hash of their id, anchors likewise,
and each pair of parts meets in one task. A cell's size does not follow the data; only the number of cells does.

In a cell the matrices are reduced modulo small primes and multiplied in float32, where sums of so many products of
centred residues are exact; mixed-radix Chinese remaindering gives back the signed scores. Primes are taken until
their product exceeds twice the largest possible score, by the norms in the cell, so the scores are exact.

The first pass keeps, for each anchor, the best ``positives`` other rows of its label, by cell and then overall. The second scores
again and keeps, for each anchor and positive, the best ``negatives`` rows of other labels whose scores lie in the window from
``low`` % of the positive's score up to the score itself. Higher scores come first, ties by smaller id.

Rows with a null id, label or vector, with a null or non-finite component, or with a squared norm of 2**61 or more (scores would leave
the range of longs) take no part. Shorter vectors count as filled up with zeros. Where the id is divisible by ``noise`` the label
first becomes (label + 1) % 10. Rows that repeat an id are rows of their own: none is a positive of an anchor of
its id, and anchors of one id share their lists. A window of a negative score is empty. Only the three named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siftwell.llm.lloyd import whole_numbers

#: Moduli, largest first: fixed values. Their product exceeds 2**62.
PRIMES = (251, 241, 239, 233, 229, 227, 223, 211)
#: Components multiplied before a reduction: 1024 * 125**2 is below 2**24, so float32 sums are exact.
DEPTH = 1024
#: Rows and anchors of a cell, and scores held at once in it.
ROWS = 8192
ANCHORS = 4096
SCORES = 1 << 21
LARGEST_NORM = float(1 << 61)


def moduli(largest: int) -> list[int]:
    """So many primes that scores of up to ``largest`` in size are told apart."""
    product, taken = 1, []
    for prime in PRIMES:
        if product > 2 * largest:
            break
        taken.append(prime)
        product *= prime
    return taken


def centred(values: np.ndarray, prime: int) -> np.ndarray:
    """Residues between -prime / 2 and prime / 2."""
    residues = values % prime
    return np.where(residues > prime // 2, residues - prime, residues).astype(np.float32)


def largest_norm(values: np.ndarray) -> int:
    """The largest squared norm, rounded up."""
    return ceil((values.astype(np.float64) ** 2).sum(axis=1).max(initial=0) * (1 + 1e-9))


class ResidueMatrix:
    """Rows to be multiplied by many anchors: their residues for each modulus."""

    def __init__(self, rows: np.ndarray, primes: list[int]):
        self.primes = primes
        self.residues = [centred(rows, p).T for p in primes]

    def scores(self, anchors: np.ndarray) -> np.ndarray:
        """Exact inner products of all anchors and rows."""
        found: np.ndarray | None = None
        product = 1
        for prime, right in zip(self.primes, self.residues, strict=True):
            left = centred(anchors, prime)
            residue = np.zeros((left.shape[0], right.shape[1]), np.int64)
            for k in range(0, left.shape[1], DEPTH):
                residue += (left[:, k : k + DEPTH] @ right[k : k + DEPTH]).astype(np.int64)
            residue %= prime
            if found is None:
                found = residue
            else:
                found += product * ((residue - found % prime) * pow(product, -1, prime) % prime)
            product *= prime
        if found is None:
            return np.zeros((len(anchors), self.residues[0].shape[1] if self.residues else 0), np.int64)
        found[found > product // 2] -= product
        return found


def matrix(column: pa.ListArray, width: int) -> np.ndarray:
    """Lists as rows of a matrix, filled up with zeros."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lengths), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def first_of(ids: np.ndarray, scores: np.ndarray, n: int) -> np.ndarray:
    """The places of the first ``n`` by score, then id; ids ascend."""
    if len(ids) > 4 * n:
        least = np.partition(scores, -n)[-n]
        some = np.flatnonzero(scores >= least)
        return some[np.argsort(-scores[some], kind="stable")[:n]]
    return np.argsort(-scores, kind="stable")[:n]


class Cell:
    """Rows of a part, by id, and the anchors they meet."""

    def __init__(self, rows: pa.Table, anchors: pa.Table):
        lists = [t.column("v").combine_chunks() for t in (rows, anchors)]
        width = max((int(np.max(x.value_lengths().to_numpy(zero_copy_only=False), initial=0)) for x in lists), default=0)
        order = np.argsort(rows.column("id").to_numpy(), kind="stable")
        self.ids, self.labels = (rows.column(c).to_numpy()[order] for c in ("id", "label"))
        values, self.wanted = matrix(lists[0], width)[order], matrix(lists[1], width)
        # By Cauchy and Schwarz no score exceeds the larger of the two squared norms.
        primes = moduli(max(largest_norm(values), largest_norm(self.wanted), 1))
        self.rows = ResidueMatrix(values, primes)
        self.anchor_ids, self.anchor_labels = (anchors.column(c).to_numpy() for c in ("id", "label"))
        self.same = {label: np.flatnonzero(self.labels == label) for label in np.unique(self.anchor_labels)}
        self.other = {label: np.flatnonzero(self.labels != label) for label in self.same}

    def scored(self) -> Iterator[tuple[int, np.ndarray]]:
        """Each anchor's number and its scores."""
        step = max(1, SCORES // max(1, len(self.ids)))
        for k in range(0, len(self.wanted), step):
            for n, scores in enumerate(self.rows.scores(self.wanted[k : k + step]), k):
                yield n, scores


def grid_parts(n: int, size: int, least: int) -> int:
    return max(least, -(-n // size), 1)


def pairs(rows: DataFrame, anchors: DataFrame, row_parts: int, anchor_parts: int):
    """Rows and anchors grouped by the cells of the grid, to be met there."""
    spread_rows = rows.withColumns(
        {"p": F.pmod(F.xxhash64("id"), F.lit(row_parts)), "q": F.explode(F.sequence(F.lit(0), F.lit(anchor_parts - 1)))}
    )
    spread_anchors = anchors.withColumns(
        {
            "q": F.pmod(F.xxhash64("id"), F.lit(anchor_parts)).cast("int"),
            "p": F.explode(F.sequence(F.lit(0).cast("long"), F.lit(row_parts - 1).cast("long"))),
        }
    )
    spread_anchors = spread_anchors.toDF(*spread_anchors.columns)
    return spread_rows.groupBy("p", "q").cogroup(spread_anchors.groupBy("p", "q"))


def best_positives(rows: DataFrame, anchors: DataFrame, n: int, parts: tuple[int, int]) -> DataFrame:
    """``anchor_id, positive_id, positive_score``: the first ``n`` other rows of an anchor's label."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[tuple[int, int, int]] = []
        if left.num_rows and right.num_rows:
            cell = Cell(left, right)
            for k, scores in cell.scored():
                mine = cell.same[cell.anchor_labels[k]]
                mine = mine[cell.ids[mine] != cell.anchor_ids[k]]
                top = mine[first_of(cell.ids[mine], scores[mine], n)]
                found += zip([cell.anchor_ids[k]] * len(top), cell.ids[top], scores[top], strict=True)
        return pa.table({c: pa.array([x[i] for x in found], pa.int64()) for i, c in enumerate(("anchor_id", "positive_id", "positive_score"))})

    met = pairs(rows, anchors, *parts).applyInArrow(run, "anchor_id long, positive_id long, positive_score long")
    order = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    return met.withColumn("place", F.row_number().over(order)).where(F.col("place") <= n).drop("place")


def best_negatives(rows: DataFrame, anchors: DataFrame, n: int, low: int, parts: tuple[int, int]) -> DataFrame:
    """The first ``n`` rows of other labels in the window of each of ``positives(positive_id, positive_score)`` of an anchor."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[tuple[int, int, int, int, int]] = []
        if left.num_rows and right.num_rows:
            cell, wanted = Cell(left, right), right.column("positives").to_pylist()
            for k, scores in cell.scored():
                windows = [(p["positive_id"], p["positive_score"]) for p in wanted[k] if p["positive_score"] >= 0]
                if not windows:
                    continue
                anchor, others = cell.anchor_ids[k], cell.other[cell.anchor_labels[k]]
                # 100 * score >= low * positive_score, in whole numbers.
                floor = [-(-low * score // 100) for _, score in windows]
                others = others[(scores[others] <= max(score for _, score in windows)) & (scores[others] >= min(floor))]
                others = others[np.argsort(-scores[others], kind="stable")]
                falling = -scores[others]
                for (positive, score), least in zip(windows, floor, strict=True):
                    at = int(np.searchsorted(falling, -score))
                    for row in others[at : at + n]:
                        if scores[row] >= least:
                            found.append((anchor, positive, score, cell.ids[row], scores[row]))
        names = ("anchor_id", "positive_id", "positive_score", "negative_id", "negative_score")
        return pa.table({c: pa.array([x[i] for x in found], pa.int64()) for i, c in enumerate(names)})

    met = pairs(rows, anchors, *parts).applyInArrow(
        run, "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"
    )
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    return met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def mine(
    vectors: DataFrame,
    every: int = 100,
    positives: int = 5,
    negatives: int = 5,
    low: int = 80,
    noise: int = 7,
    scale: int = 256,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``: up to ``negatives`` rows for each anchor and positive."""
    spark = vectors.sparkSession
    values = F.col(vector_column).cast("array<double>")
    sound = F.coalesce(F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float(1 << 40)))), F.lit(False))
    taken = vectors.where(F.col(id_column).isNotNull() & F.col(label_column).isNotNull() & sound).select(
        F.col(id_column).cast("long").alias("id"),
        F.when(F.col(id_column) % noise == 0, (F.col(label_column) + 1) % 10).otherwise(F.col(label_column)).cast("long").alias("label"),
        whole_numbers(F.col(vector_column), scale).alias("v"),
    )
    norm = F.aggregate("v", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    rows = taken.where(norm < LARGEST_NORM)
    anchors = rows.where(F.col("id") % every == 0)
    n_rows, n_anchors = rows.agg(F.count(F.lit(1)), F.count_if(F.col("id") % every == 0)).first()
    # More cells than cores where there are few rows; parts of at most so many rows and anchors otherwise.
    parts = (
        grid_parts(n_rows, ROWS, min(2 * spark.sparkContext.defaultParallelism, n_rows // 64 + 1)),
        grid_parts(n_anchors, ANCHORS, 1),
    )
    best = best_positives(rows, anchors, positives, parts)
    lists = best.groupBy("anchor_id").agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("positives"))
    wanted = anchors.join(lists.withColumnRenamed("anchor_id", "id"), "id")
    wanted = wanted.toDF(*wanted.columns)
    return best_negatives(rows, wanted, negatives, low, parts).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"
    )
