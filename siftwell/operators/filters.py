"""Row filters. Those whose meaning depends on which columns a store has take the column names."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import datetime, timedelta
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwell.config import finite
from siftwell.functions import urls
from siftwell.functions.payload import at
from siftwell.functions.text import quoted_phrases

# Scope and mode names written to stores, and the days in each named time range.
CACHE_ONLY = "cache_only"
CACHE_MODES = ("freshness_cache", "cache_then_memory")
TIME_RANGES = {"day": 1, "week": 7, "month": 30, "year": 365}


def _all_of(parts: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, parts, F.lit(True))


def is_fresh(
    columns: Iterable[str], ttl_seconds: int | None, now: datetime, timestamp_column: str = "added_at"
) -> Column:
    """A row's own expiry wins; rows without one are judged by age. No ttl means no filter."""
    if ttl_seconds is None:
        return F.lit(True)
    present = set(columns)
    young = F.col(timestamp_column) >= at(now - timedelta(seconds=ttl_seconds))
    unexpired = F.col("expires_at") > at(now)
    if "expires_at" in present and timestamp_column in present:
        return unexpired | (F.col("expires_at").isNull() & young)
    if "expires_at" in present:
        return unexpired
    if timestamp_column not in present:
        raise ValueError(f"The store has no {timestamp_column} column, so freshness is unknown.")
    return young


def matches_metadata(filters: Mapping[str, Any] | None) -> Column:
    """None asks for NULL, a collection for membership (an empty one matches nothing), else equality."""

    def one(name: str, value: Any) -> Column:
        if value is None:
            return F.col(name).isNull()
        if isinstance(value, (list, tuple, set)):
            return F.col(name).isin(list(value)) if value else F.lit(False)
        return F.col(name) == value

    return _all_of(one(name, value) for name, value in (filters or {}).items())


def in_scopes(columns: Iterable[str], scopes: Iterable[str] | None) -> Column:
    wanted = list(scopes or ())
    if not wanted:
        return F.lit(True)
    if "memory_scope" not in set(columns):
        raise ValueError("The store has no memory_scope column; add it before filtering by scope.")
    return F.col("memory_scope").isin(wanted)


def scores_at_least(threshold: float, column: str = "score") -> Column:
    return F.col(column) >= F.lit(finite(threshold, "threshold"))


def suppresses_duplicates(columns: Iterable[str], now: datetime, managed_tag: str) -> Column:
    """Store rows that may make a candidate a duplicate: managed ones that are not expired cache."""
    present = set(columns)
    parts = [F.col(c) == managed_tag for c in ("provider_name", "inserted_from") if c in present]
    if {"memory_scope", "expires_at"} <= present:
        scope, expiry = F.col("memory_scope"), F.col("expires_at")
        parts.append(scope.isNull() | (scope != CACHE_ONLY) | expiry.isNull() | (expiry > at(now)))
    return _all_of(parts)


def is_expired(
    columns: Iterable[str],
    ttl_seconds: int,
    now: datetime,
    managed_tag: str,
    timestamp_column: str = "added_at",
) -> Column:
    """Rows that cleanup deletes. Durable rows never match; an unknown comparison is no match."""
    if ttl_seconds <= 0:
        raise ValueError("cache_ttl_seconds must be greater than 0.")
    present = set(columns)
    cutoff = at(now - timedelta(seconds=ttl_seconds))
    aged = F.col(timestamp_column) < cutoff if timestamp_column in present else F.lit(False)
    unscoped = F.lit(False)
    if "retrieval_mode" in present:
        unscoped = F.col("retrieval_mode").isin(*CACHE_MODES) & _all_of(
            F.col(c) == managed_tag for c in ("provider_name", "inserted_from") if c in present
        )
    if {"memory_scope", "expires_at"} <= present:
        expiry = F.col("expires_at")
        past = (expiry < at(now)) | (expiry.isNull() & aged)
        scope = F.col("memory_scope")
        doomed = past & ((scope == CACHE_ONLY) | (scope.isNull() & unscoped))
    elif "memory_scope" in present:
        doomed = aged & (F.col("memory_scope") == CACHE_ONLY)
    else:
        doomed = aged & unscoped
    return F.coalesce(doomed, F.lit(False))


def in_domains(
    url_column: str, include: list[str] | None = None, exclude: list[str] | None = None
) -> Column:
    host = urls.host(F.col(url_column))
    parts = []
    if include:
        parts.append(urls.host_within(host, include))
    if exclude:
        parts.append(~urls.host_within(host, exclude))
    return _all_of(parts)


def published_within(
    now: datetime,
    time_range: str | None = None,
    start: datetime | None = None,
    end: datetime | None = None,
    days: int | None = None,
    column: str = "published_at",
) -> Column:
    """Start inclusive, end exclusive; ``time_range`` and ``days`` count back from ``now``."""
    parts = []
    if time_range is not None:
        if time_range not in TIME_RANGES:
            raise ValueError(f"time_range must be one of {', '.join(TIME_RANGES)}.")
        parts.append(F.col(column) >= at(now - timedelta(days=TIME_RANGES[time_range])))
    if days is not None:
        parts.append(F.col(column) >= at(now - timedelta(days=days)))
    if start is not None:
        parts.append(F.col(column) >= at(start))
    if end is not None:
        parts.append(F.col(column) < at(end))
    return _all_of(parts)


def has_facets(topic: str | list[str] | None = None, country: str | None = None) -> Column:
    parts = []
    if topic is not None:
        parts.append(F.col("topic").isin([topic] if isinstance(topic, str) else topic))
    if country is not None:
        parts.append(F.col("country") == country)
    return _all_of(parts)


def contains_phrases(query: Column, text: Column) -> Column:
    """Every double-quoted phrase of the query occurs in the text, ignoring case."""
    lowered = F.lower(text)
    return F.forall(quoted_phrases(query), lambda phrase: F.contains(lowered, F.lower(phrase)))


def follows_url_rules(
    url: Column,
    select_paths: list[str] | None = None,
    exclude_paths: list[str] | None = None,
    select_domains: list[str] | None = None,
    exclude_domains: list[str] | None = None,
    seed_host: Column | None = None,
    allow_external: bool = True,
) -> Column:
    """Path and domain rules are patterns; without ``allow_external`` only the seed's host stays."""

    def any_of(value: Column, patterns: list[str]) -> Column:
        return reduce(lambda a, b: a | b, [value.rlike(p) for p in patterns])

    parts = []
    for value, keep, drop in (
        (urls.path(url), select_paths, exclude_paths),
        (urls.host(url), select_domains, exclude_domains),
    ):
        if keep:
            parts.append(any_of(value, keep))
        if drop:
            parts.append(~any_of(value, drop))
    if not allow_external and seed_host is not None:
        parts.append(urls.host(url) == seed_host)
    return _all_of(parts)


def domain_list_filter(df: DataFrame, domains: DataFrame, keep: bool, url_column: str = "url") -> DataFrame:
    """Exact-host include/exclude against a table of ``domain`` too long for an IN list."""
    wanted = domains.select(F.lower("domain").alias("_host")).distinct()
    return (
        df.withColumn("_host", urls.host(F.col(url_column)))
        .join(wanted, "_host", "left_semi" if keep else "left_anti")
        .drop("_host")
    )
