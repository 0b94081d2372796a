import time
from datetime import datetime

from pyspark.sql import functions as F

from siftwell.config import RetrievalConfig
from siftwell.operators.lifecycle import hashing_embedder, save_to_table
from siftwell.sources.store import PartitionedStore
from siftwell.streaming import jobs
from siftwell.streaming.expiry import joined_lives

NOW = datetime(2024, 1, 31)


def source(spark, path, rows):
    spark.createDataFrame(rows, "user_id long, ts timestamp").write.mode("append").parquet(path)
    return spark.readStream.schema("user_id long, ts timestamp").parquet(path)


def at(hour):
    return datetime(2024, 1, 1 + hour // 24, hour % 24)


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    path, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    jobs.drain(jobs.windowed_counts(source(spark, path, [(1, at(30)), (1, at(100))]), "1 day", "1 hour"), out, check)
    late = jobs.LateRows()
    spark.streams.addListener(late)
    query = jobs.drain(jobs.windowed_counts(source(spark, path, [(1, at(2)), (1, at(200))]), "1 day", "1 hour"), out, check)
    for _ in range(100):
        if late.dropped.get(query.id):
            break
        time.sleep(0.1)
    spark.streams.removeListener(late)
    assert late.dropped[query.id] == 1
    assert sorted(r["n"] for r in spark.read.parquet(out).collect()) == [1, 1]


def test_expiry_waits_for_the_last_refresh(spark, tmp_path):
    rows = [(1, at(0)), (1, at(4)), (1, at(30)), (2, at(1)), (3, at(90)), (None, at(3))]
    expired = jobs.run_append(
        jobs.stream_ttl_expiry(source(spark, str(tmp_path / "in"), rows), "user_id", 6 * 3600, "1 hour"), "expiry"
    )
    got = sorted((r["user_id"], r["expires_at"], r["refreshes"]) for r in expired.collect())
    assert got == [(1, at(10), 2), (1, at(36), 1), (2, at(7), 1)]


def test_refreshes_across_batches_move_the_timer(spark, tmp_path):
    """Each batch refreshes, joins or begins lives of earlier ones; what expired leaves the state."""
    path, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    batches = [
        [(1, at(0)), (2, at(1))],
        [(1, at(5)), (3, at(8))],
        [(1, at(10)), (1, at(22)), (2, at(7)), (3, at(3))],
        [(1, at(17)), (4, at(40))],
        [(4, at(90))],
    ]
    states = []
    for rows in batches:
        stream = source(spark, path, rows)
        query = jobs.drain(jobs.stream_ttl_expiry(stream, "user_id", 6 * 3600, "20 hours"), out, check)
        states.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    got = sorted((r["user_id"], r["expires_at"], r["refreshes"]) for r in spark.read.parquet(out).collect())
    # Key 1: 0, 5, 10 are one life until 16; 17 and 22 came in two batches, the later one first. Key 2: 7 is refreshed at its expiry.
    assert got == [(1, at(16), 3), (1, at(28), 2), (2, at(7), 1), (2, at(13), 1), (3, at(14), 2), (4, at(46), 1)]
    assert states[-1] < states[2]


def test_lives_join_in_any_order():
    import itertools

    import numpy as np

    moments, ttl = [0, 3, 5, 14, 20, 21, 40, 50], 10
    want = joined_lives([], np.array(moments), ttl)
    assert want == [(0, 21, 6), (40, 40, 1), (50, 50, 1)]
    for order in itertools.islice(itertools.permutations(moments), 0, 40320, 501):
        lives = []
        for k in range(0, len(order), 3):
            lives = joined_lives(lives, np.array(order[k : k + 3]), ttl)
        assert lives == want


def test_first_row_per_key(spark, tmp_path):
    rows = [(1, at(0)), (1, at(1)), (2, at(2))]
    first = jobs.run_append(jobs.stream_dedup_key(source(spark, str(tmp_path / "in"), rows), "user_id", "2 days"), "first")
    assert sorted(r["user_id"] for r in first.collect()) == [1, 2]


def test_stream_equals_batch(spark, tmp_path):
    rows = [(i % 5, at(i)) for i in range(60)]
    stream = source(spark, str(tmp_path / "in"), rows)
    log = lambda df: df.select(
        "ts", F.lit("m").alias("mode"), F.lit(1.0).alias("latency_ms"), F.lit(1).alias("local"), F.lit(0).alias("foreign")
    )
    final = jobs.run_complete(jobs.stream_mode_metrics(log(stream), "1 day", "1 hour"), "metrics")
    batch = jobs.windowed_metrics(log(spark.read.parquet(str(tmp_path / "in"))), "1 day")
    assert sorted(map(str, final.collect())) == sorted(map(str, batch.collect()))


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    table = PartitionedStore(spark, str(tmp_path / "store"))
    table.create(spark.createDataFrame([], "doc_id long, content string, embeddings array<float>"))
    foreign = spark.createDataFrame(
        [(1, "q", 1, "u", "t", "text", 0.5)],
        "qid long, query string, rank long, url string, title string, content string, score double",
    )
    for _ in range(2):
        save_to_table(table, foreign, RetrievalConfig(), NOW, hashing_embedder(4), token=("batch", 0))
    assert table.read().count() == 1


def test_stream_write_through_reads_all_files(spark, tmp_path):
    schema = "qid long, query string, rank long, url string, title string, content string, score double"
    table = PartitionedStore(spark, str(tmp_path / "store"))
    table.create(spark.createDataFrame([], "doc_id long, content string, embeddings array<float>"))
    for part in range(2):
        rows = [(part, "q", r, f"u{r}", "t", f"text {part} {r}", 0.5) for r in range(3)]
        spark.createDataFrame(rows, schema).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        jobs.stream_write_through(
            stream, table, RetrievalConfig(), NOW, hashing_embedder(4), str(tmp_path / "check")
        ).awaitTermination()
    assert table.read().count() == 6


def test_one_timer_a_key():
    """However many lives a key has, it has one timer; when that fires, all lives that the watermark has passed are reported."""
    import pandas as pd

    from siftwell.streaming.expiry import KeyExpiry

    class Handle:
        def __init__(self):
            self.timers, self.rows = [], []

        def getListState(self, name, schema):
            return self

        def get(self):
            return iter(self.rows)

        def put(self, rows):
            self.rows = list(rows)

        def clear(self):
            self.rows = []

        def registerTimer(self, moment):
            self.timers.append(moment)

        def deleteTimer(self, moment):
            self.timers.remove(moment)

        def getExpiryTimeInMs(self):
            return self.fired

        def getCurrentWatermarkInMs(self):
            return self.watermark

    handle, expiry = Handle(), KeyExpiry("user_id", 10_000)
    expiry.init(handle)
    list(expiry.handleInputRows((7,), iter([pd.DataFrame({"micros": [0, 20_000, 25_000, 50_000, 90_000]})]), handle))
    assert handle.timers == [10] and len(handle.rows) == 4
    list(expiry.handleInputRows((7,), iter([pd.DataFrame({"micros": [5_000]})]), handle))
    assert handle.timers == [15]
    handle.fired, handle.watermark = handle.timers.pop(), 60
    (told,) = expiry.handleExpiredTimer((7,), handle, handle)
    assert sorted(zip(told["expires_micros"], told["refreshes"])) == [(15_000, 2), (35_000, 2)]
    assert handle.timers == [60] and len(handle.rows) == 2
    handle.fired, handle.watermark = handle.timers.pop(), 200
    (told,) = expiry.handleExpiredTimer((7,), handle, handle)
    assert sorted(told["expires_micros"]) == [60_000, 100_000] and handle.timers == [] and handle.rows == []
