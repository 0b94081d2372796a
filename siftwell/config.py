"""Retrieval settings and the checks made on them before any plan is built."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from math import isfinite
from typing import Any

# Enumerations and defaults that results depend on.
RETRIEVAL_MODES = ("hybrid_search", "freshness_cache", "cache_then_memory")
PERSISTENCE_DEPTHS = ("cache_only", "cache_plus_memory")
UPSERT_KEYS = ("source_url", "content_hash")
METRICS = (
    "euclidean",
    "euclidean_squared",
    "l2_squared",
    "cosine",
    "dot",
    "manhattan",
    "hamming",
    "jaccard",
)
CACHE_TTL_SECONDS = 86400
CLEANUP_INTERVAL_SECONDS = 3600
CONTEXT_TOKENS = 4000
CONTEXT_RESULTS = 5
COMPANY_TOPICS = ("news", "general", "finance")


def finite(value: Any, name: str) -> float:
    try:
        number = float(value)
    except (TypeError, ValueError) as error:
        raise ValueError(f"{name} must be a number.") from error
    if not isfinite(number):
        raise ValueError(f"{name} must be finite.")
    return number


def positive(value: float | None, name: str) -> None:
    if value is not None and value <= 0:
        raise ValueError(f"{name} must be greater than 0.")


def one_of(value: str | None, allowed: tuple[str, ...], name: str) -> None:
    if value not in allowed:
        raise ValueError(f"{name} must be one of {', '.join(allowed)}; got {value!r}.")


@dataclass(frozen=True)
class RetrievalConfig:
    """What one retrieval job does; every flow in :mod:`siftwell.plans` takes one of these."""

    retrieval_mode: str = "hybrid_search"
    metric: str = "cosine"
    max_results: int = 10
    max_local: int | None = None
    max_foreign: int | None = None
    cache_ttl_seconds: int = CACHE_TTL_SECONDS
    cache_score_threshold: float = 0.0
    memory_score_threshold: float = 0.0
    memory_max_results: int | None = None
    persistence_depth: str | None = None
    timestamp_column: str = "added_at"
    metadata_filters: Mapping[str, Any] = field(default_factory=dict)
    native_hybrid: bool = False
    json_payload: bool = False
    provenance: bool = False
    memory_metadata: bool = False
    upsert_key: str | None = None
    dedup_similarity_threshold: float | None = None
    persist_score_threshold: float | None = None
    max_persisted_foreign: int | None = None
    auto_cleanup: bool = False
    cleanup_interval_seconds: int = CLEANUP_INTERVAL_SECONDS
    managed_tag: str = "web"

    def __post_init__(self) -> None:
        one_of(self.retrieval_mode, RETRIEVAL_MODES, "retrieval_mode")
        one_of(self.metric, METRICS, "metric")
        if self.is_cache or self.memory_metadata:
            positive(self.cache_ttl_seconds, "cache_ttl_seconds")
        if self.retrieval_mode == "cache_then_memory":
            self._set("memory_metadata", True)
        if self.persistence_depth is None:
            depth = "cache_plus_memory" if self.retrieval_mode == "cache_then_memory" else "cache_only"
            self._set("persistence_depth", depth)
        one_of(self.persistence_depth, PERSISTENCE_DEPTHS, "persistence_depth")
        for name in ("cache_score_threshold", "memory_score_threshold"):
            self._set(name, finite(getattr(self, name), name))
        for name in ("dedup_similarity_threshold", "persist_score_threshold"):
            if getattr(self, name) is not None:
                self._set(name, finite(getattr(self, name), name))
        positive(self.memory_max_results, "memory_max_results")
        positive(self.max_persisted_foreign, "max_persisted_foreign")
        if self.upsert_key is not None:
            one_of(self.upsert_key, UPSERT_KEYS, "upsert_key")
        if self.auto_cleanup:
            positive(self.cleanup_interval_seconds, "cleanup_interval_seconds")
        if self.metric != "cosine" and (self.is_cache or self.dedup_similarity_threshold is not None):
            raise ValueError("Score thresholds and semantic deduplication require metric='cosine'.")

    def _set(self, name: str, value: Any) -> None:
        object.__setattr__(self, name, value)

    @property
    def is_cache(self) -> bool:
        return self.retrieval_mode in ("freshness_cache", "cache_then_memory")

    @property
    def local_limit(self) -> int:
        return self.max_results if self.max_local is None else self.max_local

    @property
    def foreign_limit(self) -> int:
        return self.max_results if self.max_foreign is None else self.max_foreign

    @property
    def memory_limit(self) -> int:
        return self.memory_max_results or self.local_limit
