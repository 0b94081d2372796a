"""Store upkeep and request metrics as streams. Each takes a streaming DataFrame with a TIMESTAMP
event time and returns a streaming DataFrame, except the write-through job, which is a sink."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from siftwell.config import RetrievalConfig
from siftwell.operators.lifecycle import Embedder, save_to_table
from siftwell.operators.metrics import rate_columns
from siftwell.session import scratch_path
from siftwell.sources.store import PartitionedStore
from siftwell.streaming.expiry import STATE_STORE, expired_keys


def event_time(df: DataFrame, column: str = "ts") -> DataFrame:
    """Watermarks need TIMESTAMP; stored tables carry TIMESTAMP_NTZ."""
    return df.withColumn(column, F.col(column).cast("timestamp"))


def stream_write_through(
    foreign: DataFrame,
    table: PartitionedStore,
    cfg: RetrievalConfig,
    now: datetime | Callable[[], datetime],
    embed: Embedder,
    checkpoint: str,
    prepare: Callable[[DataFrame], DataFrame] = lambda batch: batch,
    name: str = "write-through",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Saves arriving foreign results into a store table, once per micro-batch.

    ``now`` is a fixed time or a function that is asked for each batch; ``trigger`` holds the arguments of
    ``DataStreamWriter.trigger`` and by default takes what is available and stops.

    A batch that is run again after a failure finds its outcome staged and puts the same rows in place.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        save_to_table(table, prepare(batch), cfg, now() if callable(now) else now, embed, token=(name, batch_id))

    return (
        foreign.writeStream.foreachBatch(save)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def stream_dedup_key(stream: DataFrame, key: str, ttl: str, ts: str = "ts") -> DataFrame:
    """First row of each key within the ttl."""
    return stream.withWatermark(ts, ttl).dropDuplicatesWithinWatermark([key])


def sessions(events: DataFrame, key: str, gap: str, ts: str = "ts") -> DataFrame:
    """Requests per session of each key, a session ending ``gap`` after its last request.

    The same expression runs over a table and, with a watermark, over a stream.
    """
    return (
        events.groupBy(key, F.session_window(ts, gap).alias("session"))
        .agg(F.count("*").alias("requests"))
        .select(key, F.col("session.start").alias("started"), F.col("session.end").alias("ended"), "requests")
    )


def stream_sessions(stream: DataFrame, key: str, gap: str, delay: str, ts: str = "ts") -> DataFrame:
    return sessions(stream.withWatermark(ts, delay), key, gap, ts)


def stream_ttl_expiry(stream: DataFrame, key: str, ttl_seconds: int, delay: str, ts: str = "ts") -> DataFrame:
    """``(key, expires_at, refreshes)`` once a key was not refreshed for the ttl, by event-time timers."""
    return expired_keys(stream, key, ttl_seconds, delay, ts)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for as long as a query is started; a running query keeps what it was started with."""
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def windowed_metrics(
    log: DataFrame, length: str, slide: str | None = None, keys: tuple[str, ...] = ("mode",), ts: str = "ts"
) -> DataFrame:
    """Latency, origins and hit rate per tumbling or sliding window; for tables and streams."""
    window = F.window(ts, length, slide) if slide else F.window(ts, length)
    return (
        log.groupBy(window.alias("w"), *keys)
        .agg(*rate_columns())
        .withColumn("window_start", F.col("w.start"))
        .drop("w")
    )


def stream_mode_metrics(
    log: DataFrame, length: str, delay: str, slide: str | None = None, ts: str = "ts"
) -> DataFrame:
    return windowed_metrics(log.withWatermark(ts, delay), length, slide, ts=ts)


def windowed_counts(stream: DataFrame, length: str, delay: str, ts: str = "ts") -> DataFrame:
    """Rows per window; rows later than the watermark are dropped by Spark."""
    counted = stream.withWatermark(ts, delay).groupBy(F.window(ts, length).alias("w")).agg(F.count("*").alias("n"))
    return counted.select(F.col("w.start").alias("window_start"), "n")


class LateRows(StreamingQueryListener):
    """Counts the rows that stateful operators dropped as too late, by query id, over all progress of a session's queries.

    ``spark.streams.addListener(late)`` before the query starts; queries themselves remember only their last reports.
    """

    def __init__(self) -> None:
        self.dropped: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        self.dropped.setdefault(str(event.id), 0)

    def onQueryProgress(self, event) -> None:
        late = sum(int(operator.numRowsDroppedByWatermark) for operator in event.progress.stateOperators)
        key = str(event.progress.id)
        self.dropped[key] = self.dropped.get(key, 0) + late

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def drain(df: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Append what is available to a parquet folder and stop."""
    with settings(df.sparkSession, STATE_STORE):
        query = (
            df.writeStream.format("parquet").outputMode("append").option("path", out)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )
        query.awaitTermination()
    return query


def run_append(df: DataFrame, name: str) -> DataFrame:
    """Everything an append-mode stream emits from the data available now."""
    out = scratch_path(df.sparkSession, name)
    drain(df, f"{out}/rows", f"{out}/checkpoint")
    return df.sparkSession.read.schema(df.schema).parquet(f"{out}/rows")


def run_complete(df: DataFrame, name: str) -> DataFrame:
    """Final state of a complete-mode aggregation over the data available now."""
    spark = df.sparkSession
    out = scratch_path(spark, name)
    last = []

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/rows-{batch_id}")
        last.append(batch_id)

    query = (
        df.writeStream.foreachBatch(save).outputMode("complete")
        .option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.parquet(f"{out}/rows-{last[-1]}")


def read_stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One table of a folder of parquet tables, as a stream."""
    schema = spark.read.parquet(f"{folder}/{name}.parquet").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(folder)
