import pytest

from siftwell.config import RetrievalConfig


@pytest.mark.parametrize(
    "settings",
    [
        {"retrieval_mode": "other"},
        {"metric": "other"},
        {"persistence_depth": "other"},
        {"upsert_key": "title"},
        {"retrieval_mode": "freshness_cache", "cache_ttl_seconds": 0},
        {"memory_metadata": True, "cache_ttl_seconds": -1},
        {"cache_score_threshold": float("nan")},
        {"memory_score_threshold": float("inf")},
        {"dedup_similarity_threshold": "high"},
        {"persist_score_threshold": float("-inf")},
        {"memory_max_results": 0},
        {"max_persisted_foreign": 0},
        {"auto_cleanup": True, "cleanup_interval_seconds": 0},
        {"retrieval_mode": "freshness_cache", "metric": "dot"},
        {"dedup_similarity_threshold": 0.9, "metric": "euclidean"},
    ],
)
def test_bad_settings_are_errors(settings):
    with pytest.raises(ValueError):
        RetrievalConfig(**settings)


def test_defaults_follow_the_mode():
    assert RetrievalConfig().persistence_depth == "cache_only"
    durable = RetrievalConfig("cache_then_memory")
    assert durable.persistence_depth == "cache_plus_memory" and durable.memory_metadata
    assert RetrievalConfig("cache_then_memory", persistence_depth="cache_only").persistence_depth == "cache_only"


def test_limits_default_to_max_results():
    cfg = RetrievalConfig(max_results=7)
    assert (cfg.local_limit, cfg.foreign_limit, cfg.memory_limit) == (7, 7, 7)
    assert RetrievalConfig(max_local=0).local_limit == 0
    assert RetrievalConfig(max_local=3, memory_max_results=9).memory_limit == 9
