"""Registered queries: streaming jobs run over the given tables until they are drained."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from siftwell.operators import lifecycle, metrics
from siftwell.session import scratch_path
from siftwell.sources.store import PartitionedStore
from siftwell.streaming import jobs
from siftwell.workload import fixtures as fx
from siftwell.workload.fixtures import NOW, stamp
from siftwell.workload.registry import check
from siftwell.workload.upkeep import SAVE, saved_view, sql_write_through
from siftwell.workload.webpages import LOG, RATES, rank_errors, request_log

FULL = "'%Y-%m-%d %H:%M:%S'"
SESSIONS = """marked AS (SELECT user_id, ts, CASE WHEN ts < lag(ts) OVER w + INTERVAL 6 HOURS THEN 0 ELSE 1 END AS opens
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
numbered AS (SELECT user_id, ts, sum(opens) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS n FROM marked),
sessions AS (SELECT user_id, min(ts) AS started, max(ts) + INTERVAL 6 HOURS AS ended, count(*) AS requests FROM numbered GROUP BY user_id, n),
closed AS (SELECT * FROM sessions WHERE ended <= (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 1 DAY FROM events))"""


def _events(spark, sf):
    return jobs.event_time(jobs.read_stream(spark, sf, "events"))


def _session_view(df):
    return df.select("user_id", stamp("started").alias("started"), stamp("ended").alias("ended"), "requests")


@check(
    "sessions",
    f"WITH {SESSIONS} SELECT user_id, strftime(started, {FULL}) AS started, strftime(ended, {FULL}) AS ended, requests FROM sessions",
)
def sessions(spark, sf):
    events = jobs.event_time(fx.table(spark, sf, "events"))
    return _session_view(jobs.sessions(events, "user_id", "6 hours"))


@check(
    "stream_sessions",
    f"WITH {SESSIONS} SELECT user_id, strftime(started, {FULL}) AS started, strftime(ended, {FULL}) AS ended, requests FROM closed",
)
def stream_sessions(spark, sf):
    return _session_view(
        jobs.run_append(jobs.stream_sessions(_events(spark, sf), "user_id", "6 hours", "1 day"), "sessions")
    )


@check(
    "stream_ttl_expiry",
    f"WITH {SESSIONS} SELECT user_id, strftime(ended, {FULL}) AS expires_at, requests AS refreshes FROM closed",
)
def stream_ttl_expiry(spark, sf):
    """The events arrive in four micro-batches, so that keys are refreshed across them."""
    base = scratch_path(spark, "expiry")
    events = jobs.event_time(fx.table(spark, sf, "events"))
    quarter = F.ntile(4).over(Window.orderBy("day"))
    days = events.select(F.to_date("ts").alias("day")).distinct().withColumn("quarter", quarter)
    dealt = events.withColumn("day", F.to_date("ts")).join(F.broadcast(days), "day").drop("day")
    for n in range(1, 5):
        dealt.where(F.col("quarter") == n).drop("quarter").coalesce(1).write.mode("append").parquet(f"{base}/source")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/source")
    jobs.drain(jobs.stream_ttl_expiry(stream, "user_id", 6 * 3600, "1 day"), f"{base}/rows", f"{base}/checkpoint")
    expired = spark.read.parquet(f"{base}/rows")
    return expired.select("user_id", stamp("expires_at").alias("expires_at"), "refreshes")


@check("stream_dedup_key", "SELECT DISTINCT user_id, event_type FROM events")
def stream_dedup_key(spark, sf):
    keyed = _events(spark, sf).withColumn("key", F.concat_ws("|", "user_id", "event_type"))
    first = jobs.run_append(jobs.stream_dedup_key(keyed, "key", "40 days"), "dedup")
    return first.select("user_id", "event_type")


def _metrics_sql(source: str) -> str:
    return f"WITH {LOG}, w AS ({source}) SELECT strftime(window_start, {FULL}) AS window_start, mode, {RATES} FROM w GROUP BY 1, 2"


TUMBLING = "SELECT *, date_trunc('day', ts) AS window_start FROM log"
SLIDING = """SELECT *, time_bucket(INTERVAL 6 HOURS, ts) - to_hours(6 * i::INT) AS window_start
  FROM log, (SELECT unnest(range(4)) AS i)"""


@check("windowed_metrics", _metrics_sql(TUMBLING))
def windowed_metrics(spark, sf):
    log = request_log(jobs.event_time(fx.table(spark, sf, "events")))
    return jobs.windowed_metrics(log, "1 day").withColumn("window_start", stamp("window_start"))


def _stream_metrics(name: str, sql: str, slide: str | None) -> None:
    def run(spark, sf):
        log = request_log(_events(spark, sf))
        final = jobs.run_complete(jobs.stream_mode_metrics(log, "1 day", "1 day", slide), name)
        return final.withColumn("window_start", stamp("window_start"))

    check(name, sql)(run)


_stream_metrics("stream_mode_metrics", _metrics_sql(TUMBLING), None)
_stream_metrics("stream_mode_metrics_sliding", _metrics_sql(SLIDING), "6 hours")


CLOSED_PANES = f"""WITH {LOG},
panes AS (SELECT *, time_bucket(INTERVAL 6 HOURS, ts) AS pane FROM log),
closed AS (SELECT * FROM panes WHERE pane + INTERVAL 6 HOURS <= (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 1 DAY FROM events))
SELECT strftime(pane - to_hours(6 * i::INT), {FULL}) AS window_start, mode, count(*) AS requests,
  true AS p50_latency_ms_close, true AS p95_latency_ms_close
FROM closed, (SELECT unnest(range(4)) AS i) GROUP BY 1, 2"""


@check("stream_mode_percentiles", CLOSED_PANES)
def stream_mode_percentiles(spark, sf):
    """A stream leaves one sketch for each closed pane of six hours; windows of a day are merged from them."""
    panes = jobs.run_append(metrics.pane_sketches(request_log(_events(spark, sf)).withWatermark("ts", "1 day"), "6 hours"), "panes")
    found = metrics.sliding_percentiles(panes, 6 * 3600, 4)
    log = request_log(jobs.event_time(fx.table(spark, sf, "events")))
    closed = log.withColumn("pane_start", F.window("ts", "6 hours").getField("start")).join(panes.select("pane_start").distinct(), "pane_start")
    starts = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda k: F.col("pane_start") - F.make_dt_interval(hours=k * 6))
    told = rank_errors(found, closed.withColumn("window_start", F.explode(starts)), ["window_start", "mode"])
    return told.withColumn("window_start", stamp("window_start"))


@check(
    "stream_late",
    f"""SELECT strftime(date_trunc('day', ts), {FULL}) AS window_start, count(*) AS n FROM events
WHERE ts >= TIMESTAMP '2024-01-16' AND date_trunc('day', ts) + INTERVAL 1 DAY <=
  (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 1 DAY FROM events) GROUP BY 1""",
)
def stream_late(spark, sf):
    """The second half of the events arrives first; the first half is then too late and is dropped."""
    base = scratch_path(spark, "late")
    events = jobs.event_time(fx.table(spark, sf, "events"))
    early = F.col("ts") < F.lit("2024-01-16").cast("timestamp")
    for arriving in (~early, early):
        events.filter(arriving).write.mode("append").parquet(f"{base}/source")
        stream = spark.readStream.schema(events.schema).parquet(f"{base}/source")
        jobs.drain(jobs.windowed_counts(stream, "1 day", "1 day"), f"{base}/rows", f"{base}/checkpoint")
    counted = spark.read.parquet(f"{base}/rows")
    return counted.select(stamp("window_start").alias("window_start"), "n")


@check("stream_write_through", sql_write_through())
def stream_write_through(spark, sf):
    """Pages arriving in three micro-batches are saved into a store, merged by content hash; a batch has whole queries."""
    table = PartitionedStore(spark, scratch_path(spark, "store"), "content_hash", 8)
    table.create(fx.store(spark, sf))
    items, pages = fx.table(spark, sf, "benchmark"), fx.table(spark, sf, "pages")
    arriving = scratch_path(spark, "arriving-pages")
    total = items.count()
    third = F.floor((F.col("page_id") % total) * 3 / total)
    for n in range(3):
        pages.where(third == n).coalesce(1).write.mode("append").parquet(arriving)
    query = jobs.stream_write_through(
        spark.readStream.schema(pages.schema).option("maxFilesPerTrigger", 1).parquet(arriving),
        table,
        SAVE,
        NOW,
        lifecycle.hashing_embedder(fx.DIM),
        scratch_path(spark, "write-through"),
        prepare=lambda batch: fx.foreign_from(batch, items),
    )
    query.awaitTermination()
    return saved_view(table.read())
