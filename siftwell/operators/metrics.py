"""Counts and rates over results, stores and request logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Origins a result can have.
ORIGINS = ("local", "foreign", "unknown")


def origin_counts(results: DataFrame, keys: tuple[str, ...] = ("qid",)) -> DataFrame:
    """Results per origin; a missing origin counts as unknown."""
    origin = F.coalesce("origin", F.lit("unknown"))
    return results.groupBy(*keys).agg(
        *[F.count_if(origin == name).alias(f"n_{name}") for name in ORIGINS]
    )


def rows_delta(before: DataFrame, after: DataFrame, key: str = "retrieval_query") -> DataFrame:
    """Rows per retrieval query before and after a run, in one pass and one aggregation."""
    sides = before.select(key, F.lit(0).alias("_after")).unionByName(
        after.select(key, F.lit(1).alias("_after"))
    )
    counted = sides.groupBy(key).agg(
        F.count_if(F.col("_after") == 0).alias("rows_before"),
        F.count_if(F.col("_after") == 1).alias("rows_after"),
    )
    return counted.withColumn("delta", F.col("rows_after") - F.col("rows_before"))


def rate_columns() -> list[Column]:
    """Aggregates over a request log of (latency_ms, local, foreign)."""
    reused = F.when(F.col("local") > 0, 1).otherwise(0)
    return [
        F.count("*").alias("requests"),
        F.round(F.avg("latency_ms"), 6).alias("avg_latency_ms"),
        F.max("latency_ms").alias("max_latency_ms"),
        F.sum("local").alias("local"),
        F.sum("foreign").alias("foreign"),
        F.max(reused).cast("long").alias("reused"),
        F.round(F.avg(reused), 6).alias("hit_rate"),
    ]


def mode_metrics(log: DataFrame, keys: tuple[str, ...] = ("mode", "run")) -> DataFrame:
    """Latency, origins and reuse per mode and run. All aggregates are of fixed size."""
    return log.groupBy(*keys).agg(*rate_columns())


def recall_at_k(approximate: DataFrame, exact: DataFrame, k: int) -> DataFrame:
    """Share of each query's exact top k that the approximate top k holds."""
    found = approximate.filter(F.col("rank") <= k).select("qid", "doc_id", F.lit(1).alias("_hit"))
    wanted = exact.filter(F.col("rank") <= k)
    return (
        wanted.join(found, ["qid", "doc_id"], "left")
        .groupBy("qid")
        .agg(F.round(F.count("_hit") / F.count("*"), 6).alias("recall"))
    )


# --- percentiles ----------------------------------------------------------------------------------

#: Size of a latency sketch: ranks read from it are off by about 1.3 % at most, whatever the number of requests.
SKETCH_SIZE = 200
SHARES = {"p50_latency_ms": 0.5, "p95_latency_ms": 0.95}


def latency_percentiles(sketches: DataFrame) -> DataFrame:
    """``requests`` and the percentiles of each row's ``sketch``."""
    read = [F.kll_sketch_get_quantile_double("sketch", F.lit(share)).alias(name) for name, share in SHARES.items()]
    return sketches.select(*[c for c in sketches.columns if c != "sketch"], F.kll_sketch_get_n_double("sketch").alias("requests"), *read)


def latency_sketch(latency: str = "latency_ms") -> Column:
    """A mergeable KLL sketch (Karnin, Lang, Liberty 2016) of latencies; partial sketches are merged after the shuffle."""
    return F.kll_sketch_agg_double(F.col(latency).cast("double"), F.lit(SKETCH_SIZE)).alias("sketch")


def mode_percentiles(log: DataFrame, keys: tuple[str, ...] = ("mode", "run")) -> DataFrame:
    """Requests, median and 95th percentile of the latency per mode and run."""
    return latency_percentiles(log.groupBy(*keys).agg(latency_sketch()))


def pane_sketches(log: DataFrame, pane: str, keys: tuple[str, ...] = ("mode",), ts: str = "ts") -> DataFrame:
    """``pane_start``, the keys and a sketch for every pane; for tables, and for streams with a watermark."""
    return log.groupBy(F.window(ts, pane).alias("w"), *keys).agg(latency_sketch()).select(F.col("w.start").alias("pane_start"), *keys, "sketch")


def sliding_percentiles(panes: DataFrame, pane_seconds: int, per_window: int, keys: tuple[str, ...] = ("mode",)) -> DataFrame:
    """Percentiles of every window of ``per_window`` consecutive panes, by merging their sketches: requests are not read again."""
    starts = F.transform(
        F.sequence(F.lit(0), F.lit(per_window - 1)),
        lambda k: F.col("pane_start") - F.make_dt_interval(secs=(k * pane_seconds).cast("decimal(18,6)")),
    )
    spread = panes.select(*keys, "sketch", F.explode(starts).alias("window_start"))
    merged = spread.groupBy("window_start", *keys).agg(F.kll_merge_agg_double("sketch").alias("sketch"))
    return latency_percentiles(merged)
