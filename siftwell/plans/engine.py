"""One object for a store, its settings and its hooks: search a table of queries, save, clean up."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwell.config import RetrievalConfig
from siftwell.operators import filters, lifecycle
from siftwell.operators.lifecycle import Embedder, hashing_embedder
from siftwell.operators.text_blocks import TextIndex
from siftwell.plans import modes
from siftwell.session import cut_lineage
from siftwell.sources.store import PartitionedStore, check_store

ForeignSource = Callable[[DataFrame, int], DataFrame]
Transform = Callable[[DataFrame], DataFrame]
EMBEDDING_DIM = 1024


class RetrievalEngine:
    """Answers tables of queries from a store table, falling back to a foreign source.

    ``foreign_source(queries, n)`` returns ranked results of the queries it is given, at most ``n``
    each; the cache modes ask it only about queries the store left unanswered. ``embed`` makes vectors
    of queries and documents, ``ranker`` orders merged results in hybrid_search. With ``text_index``, searches by
    vector and text read the texts' stored index; rows saved after it was built are found by vector only.
    """

    def __init__(
        self,
        table: PartitionedStore,
        cfg: RetrievalConfig,
        foreign_source: ForeignSource,
        embed: Embedder | None = None,
        ranker: modes.Ranker | None = None,
        embed_query: Embedder | None = None,
        text_index: TextIndex | None = None,
    ):
        self.text_index = text_index
        self.table, self.cfg, self.foreign_source = table, cfg, foreign_source
        self.embed = embed or hashing_embedder(EMBEDDING_DIM)
        self.embed_query = embed_query or self.embed
        self.ranker = ranker
        for name, hook in (("foreign_source", foreign_source), ("embed", self.embed), ("embed_query", self.embed_query)):
            if not callable(hook):
                raise TypeError(f"{name} must be callable.")
        if ranker is not None and not callable(ranker):
            raise TypeError("ranker must be callable.")
        self.last_cleanup: datetime | None = None

    def search(
        self, queries: DataFrame, now: datetime, save_foreign: bool | Transform = False
    ) -> DataFrame:
        """``(qid, rank, doc_id, content, score, origin)`` for every query.

        Queries without a ``qvec`` column are embedded. With ``save_foreign`` the foreign results that
        were fetched are saved before this returns; a function given there shapes and picks the rows.
        """
        self._maybe_cleanup(now)
        store = check_store(self.table.read(), ("doc_id",))
        if "qvec" not in queries.columns:
            queries = cut_lineage(
                self.embed_query(queries, "qid", "query").withColumnRenamed("embeddings", "qvec")
            )
        if not self.cfg.is_cache:
            foreign = self._fetch(queries)
            found = modes.hybrid_search(queries, store, self.cfg, now, foreign, self.ranker, self.text_index)
        else:
            hits = cut_lineage(modes.tier_hits(queries, store, self.cfg, now, self.text_index))
            foreign = self._fetch(modes.tier_fallback(queries, hits))
            found = modes.tiered_results(queries, store, self.cfg, hits, foreign)
        if save_foreign is not False and self.cfg.foreign_limit > 0:
            found = cut_lineage(found)
            self.save(foreign, now, None if save_foreign is True else save_foreign)
        return found

    def _fetch(self, queries: DataFrame) -> DataFrame:
        """Foreign results, kept so that what is returned and what is saved are the same rows."""
        if self.cfg.foreign_limit < 1:
            return self.foreign_source(queries.limit(0), 0)
        fetched = self.foreign_source(queries, self.cfg.foreign_limit)
        return cut_lineage(modes.capped_foreign(fetched, self.cfg.foreign_limit).drop("source_rank"))

    def save(self, foreign: DataFrame, now: datetime, transform: Transform | None = None) -> None:
        lifecycle.save_to_table(self.table, foreign, self.cfg, now, self.embed, transform)

    def cleanup(self, now: datetime, ttl_seconds: int | None = None) -> int:
        """Delete expired cache rows now; returns how many there were."""
        ttl = self.cfg.cache_ttl_seconds if ttl_seconds is None else ttl_seconds
        columns = self.table.read().columns
        return self.table.delete_where(
            filters.is_expired(columns, ttl, now, self.cfg.managed_tag, self.cfg.timestamp_column)
        )

    def _maybe_cleanup(self, now: datetime) -> None:
        if lifecycle.cleanup_due(self.cfg, now, self.last_cleanup):
            self.cleanup(now)
            self.last_cleanup = now

    def delete_query(self, retrieval_query: str) -> int:
        """Delete the rows saved for one query; returns how many there were."""
        return self.table.delete_where(F.col("retrieval_query") == retrieval_query)
