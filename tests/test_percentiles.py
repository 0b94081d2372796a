"""Percentiles from mergeable sketches."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from siftwell.operators import metrics

LOG = "ts timestamp, mode string, run long, latency_ms double"


def log_of(spark, n, seed=1):
    rng = random.Random(seed)
    start = datetime(2024, 1, 1)
    rows = [(start + timedelta(minutes=7 * k), "ab"[k % 2], k % 3, rng.lognormvariate(3, 1)) for k in range(n)]
    return rows, spark.createDataFrame(rows, LOG).repartition(7)


def rank_error(values, quantile, share):
    below, upto = sum(v < quantile for v in values) / len(values), sum(v <= quantile for v in values) / len(values)
    return max(below - share, share - upto, 0.0)


def test_percentiles_are_near_the_exact_ones(spark):
    rows, log = log_of(spark, 20_000)
    for r in metrics.mode_percentiles(log).collect():
        own = [x[3] for x in rows if (x[1], x[2]) == (r.mode, r.run)]
        assert r.requests == len(own)
        assert rank_error(own, r.p50_latency_ms, 0.5) < 0.02 and rank_error(own, r.p95_latency_ms, 0.95) < 0.02


def test_few_requests_are_exact(spark):
    rows = [(datetime(2024, 1, 1), "a", 0, float(x)) for x in range(1, 101)]
    r = metrics.mode_percentiles(spark.createDataFrame(rows, LOG)).first()
    assert (r.requests, r.p50_latency_ms, r.p95_latency_ms) == (100, 50.0, 95.0)
    missing = spark.createDataFrame([(None, "a", 0, None), (None, "a", 0, 3.0)], LOG)
    r = metrics.mode_percentiles(missing).first()
    assert (r.requests, r.p50_latency_ms) == (1, 3.0)
    assert metrics.mode_percentiles(missing.limit(0)).collect() == []


def test_windows_are_merged_from_panes(spark):
    rows, log = log_of(spark, 3_000)
    panes = metrics.pane_sketches(log, "6 hours")
    found = metrics.sliding_percentiles(panes, 6 * 3600, 4).collect()
    whole = log.groupBy(F.window("ts", "1 day", "6 hours").getField("start").alias("window_start"), "mode").count()
    assert {(r.window_start, r.mode): r.requests for r in found} == {(r.window_start, r.mode): r["count"] for r in whole.collect()}
    for r in found:
        own = [x[3] for x in rows if x[1] == r.mode and r.window_start <= x[0] < r.window_start + timedelta(days=1)]
        assert rank_error(own, r.p50_latency_ms, 0.5) < 0.02 and rank_error(own, r.p95_latency_ms, 0.95) < 0.02
