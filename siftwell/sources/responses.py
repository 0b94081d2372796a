"""Tables of raw JSON responses as rows, and logs of requests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Response shapes and status classes.
SEARCH_SCHEMA = (
    "query string, follow_up_questions array<string>, answer string, images array<string>, "
    "results array<struct<title:string,url:string,content:string,score:double,raw_content:string>>, "
    "response_time double"
)
EXTRACT_SCHEMA = (
    "results array<struct<url:string,raw_content:string,images:array<string>>>, "
    "failed_results array<struct<url:string,error:string>>"
)
CRAWL_SCHEMA = (
    "base_url string, results array<struct<url:string,raw_content:string,images:array<string>>>, "
    "response_time double"
)
MAP_SCHEMA = "base_url string, results array<string>, response_time double"
STATUS_CLASSES = (
    ((429,), "usage_limit"),
    ((403, 432, 433), "forbidden"),
    ((401,), "invalid_key"),
    ((400,), "bad_request"),
)


def _parsed(df: DataFrame, json_col: str, schema: str) -> DataFrame:
    """Parsed once: the outer explodes that follow keep Catalyst from testing the array in the scan."""
    return df.withColumn("_r", F.from_json(json_col, schema)).drop(json_col)


def flatten_search(df: DataFrame, json_col: str = "response") -> DataFrame:
    """One row per result; a response without results gives none."""
    other = [c for c in df.columns if c != json_col]
    return (
        _parsed(df, json_col, SEARCH_SCHEMA)
        .select(*other, F.col("_r.query").alias("query"), F.posexplode_outer("_r.results").alias("_pos", "_item"))
        .filter(F.col("_item").isNotNull())
        .select(*other, "query", (F.col("_pos") + 1).alias("rank"), "_item.*")
    )


def flatten_extract(df: DataFrame, json_col: str = "response") -> DataFrame:
    """Rows of ``results`` (status ok) and of ``failed_results`` (status failed), in one pass."""
    other = [c for c in df.columns if c != json_col]

    def tagged(items: Column, status: str, content: bool) -> Column:
        return F.transform(
            F.coalesce(items, F.array()),
            lambda x: F.struct(
                F.lit(status).alias("status"),
                x["url"].alias("url"),
                (x["raw_content"] if content else F.lit(None).cast("string")).alias("raw_content"),
                (F.size(x["images"]) if content else F.lit(None).cast("int")).alias("n_images"),
                (F.lit(None).cast("string") if content else x["error"]).alias("error"),
            ),
        )

    both = F.concat(
        tagged(F.col("_r.results"), "ok", True), tagged(F.col("_r.failed_results"), "failed", False)
    )
    items = _parsed(df, json_col, EXTRACT_SCHEMA).select(*other, F.explode_outer(both).alias("_item"))
    return items.filter(F.col("_item").isNotNull()).select(*other, "_item.*")


def flatten_crawl(df: DataFrame, json_col: str = "response") -> DataFrame:
    """One row per crawled page."""
    other = [c for c in df.columns if c != json_col]
    return (
        _parsed(df, json_col, CRAWL_SCHEMA)
        .select(*other, F.col("_r.base_url").alias("base_url"), F.explode_outer("_r.results").alias("_item"))
        .filter(F.col("_item").isNotNull())
        .select(*other, "base_url", "_item.*")
    )


def flatten_map(df: DataFrame, json_col: str = "response") -> DataFrame:
    """One row per discovered URL."""
    other = [c for c in df.columns if c != json_col]
    found = _parsed(df, json_col, MAP_SCHEMA).select(
        *other, F.col("_r.base_url").alias("base_url"), F.explode_outer("_r.results").alias("url")
    )
    return found.filter(F.col("url").isNotNull())


def research_latest(log: DataFrame) -> DataFrame:
    """Newest polled state of each research request, its duration and number of sources."""
    state = F.struct("status", "model", "created_at", "completed_at", F.size("sources").alias("n_sources"))
    latest = log.groupBy("request_id").agg(F.max_by(state, "poll_ts").alias("_s"), F.count("*").alias("polls"))
    seconds = F.unix_seconds(F.col("_s.completed_at").cast("timestamp")) - F.unix_seconds(
        F.col("_s.created_at").cast("timestamp")
    )
    return latest.select(
        "request_id",
        "polls",
        F.col("_s.status").alias("status"),
        F.col("_s.model").alias("model"),
        seconds.alias("duration_s"),
        F.when(F.col("_s.n_sources") >= 0, F.col("_s.n_sources")).otherwise(0).alias("n_sources"),
    )


def classify_response(log: DataFrame) -> DataFrame:
    """Adds ``error_class`` and ``detail`` to a log of (status, body, keyless).

    An unauthenticated request answered with the recoverable-error envelope is told apart first; then
    the status decides. ``detail`` is the body's ``detail.error``, or a body that is a bare string.
    """
    body = F.coalesce("body", F.lit(""))
    # Only a code that is a string makes an envelope.
    code = F.try_variant_get(F.try_parse_json(body), "$.error.code", "variant")
    envelope = F.coalesce(F.schema_of_variant(code) == "STRING", F.lit(False))
    kind = F.when(F.col("status").between(200, 299), "ok")
    kind = kind.when(F.col("keyless") & envelope, "keyless_limit")
    for codes, name in STATUS_CLASSES:
        kind = kind.when(F.col("status").isin(*codes), name)
    text = F.when(body.startswith('"'), F.regexp_extract(body, '^"(.*)"$', 1))
    return log.withColumn("error_class", kind.otherwise("http_error")).withColumn(
        "detail", F.coalesce(text, F.get_json_object(body, "$.detail.error"), F.lit(""))
    )
