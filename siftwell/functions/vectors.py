"""Vector distances as column expressions, computed in double."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from siftwell.config import METRICS, one_of


def _fold(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, x: total + x)


def _pairwise(a: Column, b: Column, term) -> Column:
    return _fold(F.zip_with(a, b, lambda x, y: term(x.cast("double"), y.cast("double"))))


def dot_product(a: Column, b: Column) -> Column:
    return _pairwise(a, b, lambda x, y: x * y)


def dist_cosine(a: Column, b: Column) -> Column:
    """``1 - cos(a, b)``; NULL when either vector has no length."""
    norms = F.sqrt(dot_product(a, a)) * F.sqrt(dot_product(b, b))
    return F.when(norms != 0, F.lit(1.0) - dot_product(a, b) / norms)


def dist_l2_squared(a: Column, b: Column) -> Column:
    return _pairwise(a, b, lambda x, y: (x - y) * (x - y))


def dist_euclidean(a: Column, b: Column) -> Column:
    return F.sqrt(dist_l2_squared(a, b))


def dist_dot(a: Column, b: Column) -> Column:
    """Negated, so that a smaller value is a nearer vector as with every other metric."""
    return -dot_product(a, b)


def dist_manhattan(a: Column, b: Column) -> Column:
    return _pairwise(a, b, lambda x, y: F.abs(x - y))


def dist_hamming(a: Column, b: Column) -> Column:
    return _pairwise(a, b, lambda x, y: F.when(x != y, 1.0).otherwise(0.0))


def dist_jaccard(a: Column, b: Column) -> Column:
    """Over the sets of non-zero positions; two all-zero vectors are identical."""
    both = _pairwise(a, b, lambda x, y: F.when((x != 0) & (y != 0), 1.0).otherwise(0.0))
    either = _pairwise(a, b, lambda x, y: F.when((x != 0) | (y != 0), 1.0).otherwise(0.0))
    return F.when(either == 0, 0.0).otherwise(1.0 - both / either)


_BY_NAME = dict(
    zip(
        METRICS,
        (
            dist_euclidean,
            dist_l2_squared,
            dist_l2_squared,
            dist_cosine,
            dist_dot,
            dist_manhattan,
            dist_hamming,
            dist_jaccard,
        ),
    )
)


def distance(metric: str, a: Column, b: Column) -> Column:
    one_of(metric, METRICS, "metric")
    return _BY_NAME[metric](a, b)


def score_from_distance(value: Column) -> Column:
    return F.lit(1.0) - value
