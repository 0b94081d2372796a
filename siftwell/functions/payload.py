"""The JSON payload kept next to a stored row, and the lifecycle columns."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def payload_json(result: dict[str, Column], provenance: dict[str, Column]) -> Column:
    """``{"provenance": {...}, "result": {...}}`` with sorted keys; NULL fields are kept."""
    parts = [
        F.struct(*[column.alias(name) for name, column in sorted(fields.items())]).alias(part)
        for part, fields in sorted({"result": result, "provenance": provenance}.items())
    ]
    return F.to_json(F.struct(*parts), {"ignoreNullFields": "false"})


def payload_extract(payload: Column, path: str) -> Column:
    """Value at a dotted path, such as ``provenance.retrieval_mode``."""
    return F.get_json_object(payload, f"$.{path}")


def at(now: datetime) -> Column:
    return F.lit(now).cast("timestamp_ntz")


def seconds(n: int) -> Column:
    return F.make_dt_interval(secs=F.lit(n))


def expiry_columns(now: datetime, ttl_seconds: int, depth: str) -> dict[str, Column]:
    return {
        "memory_scope": F.lit(depth),
        "expires_at": at(now) + seconds(ttl_seconds),
        "last_seen_at": at(now),
        "query_count": F.lit(1).cast("long"),
    }
