"""Jobs that change a store: prepare foreign rows, drop near-duplicates, merge, clean up."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwell.config import RetrievalConfig
from siftwell.functions.embedding import hash_embedding
from siftwell.functions.payload import at, expiry_columns, payload_json
from siftwell.functions.text import content_hash
from siftwell.operators import filters
from siftwell.operators.sizing import BROADCAST_BYTES, BROADCAST_ROWS, measured_bytes
from siftwell.operators.similarity_join import similarity_at_least
from siftwell.operators.topk import persist_select
from siftwell.session import cut_lineage
from siftwell.sources.store import LIFECYCLE_COLUMNS, PartitionedStore, Token, append, count_where, delete_where

Embedder = Callable[[DataFrame, str, str], DataFrame]
RESULT_FIELDS = ("title", "url", "content", "score", "raw_content")


def hashing_embedder(dim: int) -> Embedder:
    """Default embedder: adds an ``embeddings`` column by feature hashing."""
    return column_embedder(lambda text: hash_embedding(text, dim))


def column_embedder(expression: Callable[[Column], Column]) -> Embedder:
    """Embedder from a column function, such as an iterator pandas UDF that loads a model once."""
    return lambda df, _id_col, text_col: df.withColumn("embeddings", expression(F.col(text_col)))


def surrogate_id(*parts: Column) -> Column:
    """A 60-bit id from the identifying parts of a row, the same on every run."""
    digest = F.sha2(F.concat_ws("|", *[p.cast("string") for p in parts]), 256)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def _truthy(column: Column) -> Column:
    return F.coalesce(column != "", F.lit(False))


def persistence_metadata(
    columns: list[str], store_columns: list[str], cfg: RetrievalConfig, now: datetime
) -> tuple[dict[str, Column], Column]:
    """Columns that the settings add to a saved row, and which of them each row provides."""
    lifecycle = cfg.memory_metadata or (cfg.is_cache and set(LIFECYCLE_COLUMNS) <= set(store_columns))
    added: dict[str, Column] = {}
    if cfg.is_cache or lifecycle:
        added[cfg.timestamp_column] = at(now)
    if cfg.json_payload:
        added["raw_payload"] = payload_json(
            {c: F.col(c) for c in RESULT_FIELDS if c in columns},
            {
                "source_url": F.col("url"),
                "retrieval_query": F.col("query"),
                "retrieval_timestamp": F.lit(now.isoformat() + "+00:00"),
                "retrieval_mode": F.lit(cfg.retrieval_mode),
                "cache_hit": F.lit(False),
                "inserted_from": F.lit(cfg.managed_tag),
                "provider_name": F.lit(cfg.managed_tag),
            },
        )
    if cfg.provenance:
        added |= {
            "source_url": F.col("url"),
            "source_title": F.col("title"),
            "retrieval_query": F.col("query"),
            "retrieval_timestamp": at(now),
            "retrieval_mode": F.lit(cfg.retrieval_mode),
            "cache_hit": F.lit(0),
            "inserted_from": F.lit(cfg.managed_tag),
            "provider_name": F.lit(cfg.managed_tag),
        }
    if lifecycle:
        added |= expiry_columns(now, cfg.cache_ttl_seconds, cfg.persistence_depth)
    provided = [F.lit(c) for c in ("content", "embeddings", *added)]
    if cfg.upsert_key == "source_url" and "source_url" not in added:
        added["source_url"] = F.when(_truthy(F.col("url")), F.col("url"))
        provided.append(F.when(_truthy(F.col("url")), F.lit("source_url")))
    if cfg.upsert_key == "content_hash":
        added["content_hash"] = F.when(_truthy(F.col("content")), content_hash(F.col("content")))
        provided.append(F.when(_truthy(F.col("content")), F.lit("content_hash")))
    return added, F.array_compact(F.array(*provided))


def persist_prepare(
    foreign: DataFrame,
    cfg: RetrievalConfig,
    now: datetime,
    store_columns: list[str],
    embed: Embedder,
    transform: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Foreign rows as documents to save: threshold, cap, embedding, then the default columns or
    whatever ``transform`` returns (it sees the embedding, and may drop rows).

    Rows carry ``provided``, the columns they set, and ``seq``, their order within the batch.
    """
    chosen = persist_select(foreign, cfg.persist_score_threshold, cfg.max_persisted_foreign)
    # Query ids and ranks start anew in every batch, so what was asked and found belongs to the identity too.
    identity = [F.col(c) for c in ("qid", "rank", "url", "query", "content") if c in foreign.columns]
    keyed = chosen.withColumn(
        "doc_id", surrogate_id(*identity, F.lit(now.isoformat()))
    ).withColumn("seq", F.struct("qid", "rank"))
    embedded = embed(keyed, "doc_id", "content")
    if transform is not None:
        return transform(embedded)
    added, provided = persistence_metadata(foreign.columns, store_columns, cfg, now)
    return embedded.select(
        "doc_id",
        "content",
        "embeddings",
        *[column.alias(name) for name, column in added.items()],
        provided.alias("provided"),
        "seq",
    )


def semantic_dedup(
    candidates: DataFrame,
    store: DataFrame,
    threshold: float,
    now: datetime,
    managed_tag: str,
    key: str | None = None,
    metadata: dict | None = None,
) -> DataFrame:
    """Candidates whose nearest suppressing store row scores below ``threshold``.

    Rows with a merge key or without a vector always stay. Candidates are compared with the store
    only, not with each other, and only with rows that may be near enough.
    """
    rule = filters.suppresses_duplicates(store.columns, now, managed_tag) & filters.matches_metadata(
        metadata
    )
    judged = candidates if key is None else candidates.filter(~_truthy(F.col(key)))
    asked = judged.select(F.col("doc_id").alias("qid"), F.col("embeddings").alias("qvec"))
    duplicates = similarity_at_least(asked, store, threshold, rule).select(F.col("qid").alias("doc_id"))
    return candidates.join(duplicates, "doc_id", "left_anti")


def last_write_per_key(docs: DataFrame, key: str) -> DataFrame:
    """One row per key: the last provided value of each column, whether any document provided it,
    and the counter values that an update or an insert would end at.

    All are partial aggregates, so a key that fills a third of the batch is reduced before the shuffle.
    """
    values = [c for c in docs.columns if c not in (key, "provided", "seq", "doc_id", "query_count")]
    aggregates = [F.min_by("doc_id", "seq").alias("doc_id"), F.count("*").alias("writes")]
    for c in values:
        gives = F.array_contains("provided", c)
        aggregates.append(F.max_by(c, F.when(gives, F.col("seq"))).alias(c))
        aggregates.append(F.max(gives).alias(f"has_{c}"))
    if "query_count" in docs.columns:
        gives = F.array_contains("provided", "query_count")
        first = F.struct(gives.alias("given"), F.col("query_count").alias("value"))
        aggregates += [F.count_if(gives).alias("bumps"), F.min_by(first, "seq").alias("_first")]
    merged = docs.groupBy(key).agg(*aggregates)
    if "query_count" not in docs.columns:
        return merged.withColumn("bumps", F.lit(0).cast("long")).withColumn(
            "query_count", F.lit(None).cast("long")
        )
    given, value = F.col("_first.given"), F.col("_first.value").cast("long")
    later = F.col("bumps") - F.when(given, 1).otherwise(0)
    inserted = F.when(later > 0, F.coalesce(F.when(given, value), F.lit(0)) + later).otherwise(
        F.when(given, value)
    )
    return merged.withColumn("query_count", inserted).drop("_first")


def upsert(store: DataFrame, docs: DataFrame, key: str, few: bool = False) -> DataFrame:
    """Merge documents into the store by ``key``; ``few`` documents are sent to where the store's rows lie.

    A matched row takes the provided columns and a higher query_count; an unmatched key is inserted
    once; a document without a key is inserted as it is. All store rows holding a key are updated.
    An outer join would leave a hot key in one task, so updates are a left join, which AQE can split,
    and inserts an anti join against distinct keys.
    """
    unknown = sorted(set(docs.columns) - {"provided", "seq"} - set(store.columns))
    if unknown:
        raise ValueError(f"The store is missing columns: {', '.join(unknown)}.")
    keyed = docs.filter(_truthy(F.col(key)))
    merged = last_write_per_key(keyed, key)
    has_count = "query_count" in store.columns
    values = [c for c in docs.columns if c not in (key, "provided", "seq", "doc_id", "query_count")]
    new = merged.select(key, "bumps", *[F.struct(f"has_{c}", c).alias(f"new_{c}") for c in values])
    joined = store.join(F.broadcast(new) if few else new, key, "left")

    def updated(c: str) -> Column:
        if c in values:
            given = F.coalesce(F.col(f"new_{c}.has_{c}"), F.lit(False))
            return F.when(given, F.col(f"new_{c}.{c}")).otherwise(F.col(c)).alias(c)
        if c == "query_count":
            counted = F.coalesce(c, F.lit(0)) + F.col("bumps")
            return F.when(F.col("bumps") > 0, counted).otherwise(F.col(c)).alias(c)
        return F.col(c)

    changed = joined.select([updated(c) for c in store.columns])
    known = store.select(key).filter(F.col(key).isNotNull()).distinct()
    extra = ["query_count"] if has_count and "query_count" in docs.columns else []
    fresh = merged.join(known, key, "left_anti").select("doc_id", key, *values, *extra)
    plain = docs.filter(~_truthy(F.col(key))).select(
        "doc_id", *[F.when(F.array_contains("provided", c), F.col(c)).alias(c) for c in (key, *values, *extra)]
    )
    return append(append(changed, fresh), plain).select(store.columns)


def documents_to_save(
    store: DataFrame,
    foreign: DataFrame,
    cfg: RetrievalConfig,
    now: datetime,
    embed: Embedder,
    transform: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Prepared documents without those too near to a stored row."""
    docs = persist_prepare(foreign, cfg, now, store.columns, embed, transform)
    if cfg.dedup_similarity_threshold is not None:
        # The documents are measured, compared and saved: embed them once.
        docs = cut_lineage(docs)
        docs = semantic_dedup(
            docs,
            store,
            cfg.dedup_similarity_threshold,
            now,
            cfg.managed_tag,
            cfg.upsert_key if cfg.upsert_key in docs.columns else None,
            dict(cfg.metadata_filters),
        )
    return docs


def merges(docs: DataFrame, cfg: RetrievalConfig) -> bool:
    return cfg.upsert_key is not None and cfg.upsert_key in docs.columns


def as_store_rows(docs: DataFrame, store: DataFrame) -> DataFrame:
    """Documents with exactly the store's columns; a column the store lacks is an error."""
    new = docs.drop("provided", "seq")
    unknown = sorted(set(new.columns) - set(store.columns))
    if unknown:
        raise ValueError(f"The store is missing columns: {', '.join(unknown)}.")
    return append(store.limit(0), new).select(store.columns)


def write_through(
    store: DataFrame,
    foreign: DataFrame,
    cfg: RetrievalConfig,
    now: datetime,
    embed: Embedder,
    transform: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """The store after saving foreign results: prepare, drop near-duplicates, then append or merge."""
    docs = documents_to_save(store, foreign, cfg, now, embed, transform)
    if merges(docs, cfg):
        return upsert(store, docs, cfg.upsert_key)
    return append(store, as_store_rows(docs, store))


def save_to_table(
    table: PartitionedStore,
    foreign: DataFrame,
    cfg: RetrievalConfig,
    now: datetime,
    embed: Embedder,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    token: Token | None = None,
) -> None:
    """Write-through into a store. Nothing to save writes nothing; a batch whose outcome is staged is put in place again.

    Without a merge key only the new rows are written; a merge rewrites the partitions that hold the documents' keys.
    """
    if token is not None and table.staged(token):
        table.replay(token)
        return
    store = table.read()
    docs = cut_lineage(documents_to_save(store, foreign, cfg, now, embed, transform))
    if docs.isEmpty():
        return
    if merges(docs, cfg):
        few = docs.count() <= BROADCAST_ROWS and measured_bytes(docs, F.octet_length(F.to_json(F.struct("*")))) <= BROADCAST_BYTES
        table.merge(docs, cfg.upsert_key, partial(upsert, few=few), token, scattered=not few)
    else:
        table.append(as_store_rows(docs, store), token)


def cleanup_expired(
    store: DataFrame, ttl_seconds: int, now: datetime, managed_tag: str, timestamp_column: str = "added_at"
) -> DataFrame:
    """Survivors of cache cleanup; durable rows always survive."""
    return delete_where(
        store, filters.is_expired(store.columns, ttl_seconds, now, managed_tag, timestamp_column)
    )


def count_expired(
    store: DataFrame, ttl_seconds: int, now: datetime, managed_tag: str, timestamp_column: str = "added_at"
) -> DataFrame:
    return count_where(
        store, filters.is_expired(store.columns, ttl_seconds, now, managed_tag, timestamp_column)
    )


def cleanup_due(cfg: RetrievalConfig, now: datetime, last_cleanup: datetime | None) -> bool:
    interval = timedelta(seconds=cfg.cleanup_interval_seconds)
    return cfg.auto_cleanup and (last_cleanup is None or now - last_cleanup >= interval)


def maintenance(
    store: DataFrame, cfg: RetrievalConfig, now: datetime, last_cleanup: datetime | None
) -> tuple[DataFrame, datetime | None]:
    """Cleanup before a search, at most once per interval; returns the store and the last run."""
    if not cleanup_due(cfg, now, last_cleanup):
        return store, last_cleanup
    return (
        cleanup_expired(store, cfg.cache_ttl_seconds, now, cfg.managed_tag, cfg.timestamp_column),
        now,
    )
