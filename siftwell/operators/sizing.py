"""Measured sizes, so that nothing is broadcast on a guess."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwell.session import INPUT_PARTITIONS, cut_lineage

BROADCAST_BYTES = 64 << 20
BROADCAST_ROWS = 1 << 20
#: So many keys at most are given to the scans of a table as a filter.
FILTER_KEYS = 4096


def measured_bytes(df: DataFrame, row_bytes: Column) -> int:
    """Total of ``row_bytes`` over ``df``: one small aggregate job."""
    return df.agg(F.sum(row_bytes.cast("long"))).first()[0] or 0


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt over as many partitions as the session asks for; as it is where it asks for none.

    The small files of local sessions have too few splits to fill the cores. Tables on a cluster have splits
    enough; there the setting stays unset and nothing is shuffled.
    """
    partitions = df.sparkSession.conf.get(INPUT_PARTITIONS, None)
    return df.repartition(int(partitions)) if partitions else df


def rows_for(keys: DataFrame, table: DataFrame, on: str, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``keys`` inner-joined to the rows of ``table``, without moving the table while the keys are few.

    Keys are the outcome of a search (ids of the rows returned), so they are computed once and written to the
    shared folder; they are sent to the tasks when they are at most ``limit`` rows, else both sides are joined by a shuffle. Few keys
    are a filter besides, which reaches below joins that the table itself is made of.
    """
    found = cut_lineage(keys)
    n = found.count()
    if 0 < n <= FILTER_KEYS:
        values = [r[0] for r in found.select(on).distinct().collect()]
        table = table.where(F.col(on).isin([v for v in values if v is not None]))
    return (F.broadcast(found) if n <= limit else found).join(table, on)
