"""Term statistics of a corpus, and one-off BM25 searches (Robertson and Zaragoza 2009) of tables that have no index.

A search without an index scans the texts where they lie (:mod:`siftwell.operators.text_scan`): a document's score is
summed in its own task and only the best k per query and partition are shuffled, so a term that occurs in most documents is never
gathered in one task. The terms of the queries are sent to the tasks; queries whose terms measure more than a budget are
dealt into parts that do not, and each part scans anew. What is counted in a text is written, so a scan reads it once. A stored index (:mod:`siftwell.operators.text_blocks`) gives the same rows
without opening texts, for any number of queries.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwell.functions.text import quoted_phrases, words
from siftwell.operators.sizing import BROADCAST_BYTES, measured_bytes
from siftwell.operators.text_blocks import K1, B, query_terms, rank_text
from siftwell.operators.text_scan import count_texts, lowered_texts, pack_weights, scan_frequencies, scan_scores
from siftwell.session import cut_lineage

# What a row of (qid, term, idf) takes besides its term.
TERM_BYTES = 40
#: Text that one task cuts into terms and counts, in expectation.
TASK_BYTES = 16 << 20


def text_postings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "content") -> DataFrame:
    """``(doc_id, term, tf, doc_length)``, partitioned by ``doc_id``, into more partitions the more bytes the texts measure, since a
    task holds the terms of all its texts.

    The outer explode keeps Catalyst from adding a filter on the token array below the shuffle, which
    would cut every text into tokens twice.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"))
    parts = math.ceil(measured_bytes(texts, F.octet_length("_text")) / TASK_BYTES)
    usual = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        (texts.repartition(parts, "doc_id") if parts > usual else texts.repartition("doc_id"))
        .select("doc_id", words(F.col("_text")).alias("_words"))
        .select("doc_id", F.size("_words").alias("doc_length"), F.explode_outer("_words").alias("term"))
        .filter(F.col("term").isNotNull())
        .groupBy("doc_id", "doc_length", "term")
        .agg(F.count("*").alias("tf"))
    )


def term_frequencies(postings: DataFrame) -> DataFrame:
    """``(term, df, tokens)``: in how many documents each term occurs, and how often."""
    return postings.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("tokens"))


def document_count(docs: DataFrame, text_col: str = "content") -> Column:
    """Number of documents with a text, as a scalar subquery."""
    return docs.agg(F.count(text_col)).scalar()


def corpus_stats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "content") -> DataFrame:
    """``(term, df, n_docs, mean_length)``: what a text index keeps about its corpus."""
    terms = cut_lineage(term_frequencies(text_postings(docs, id_col, text_col)))
    n_docs = document_count(docs, text_col)
    tokens = terms.agg(F.sum("tokens")).scalar()
    return terms.select("term", "df", n_docs.alias("n_docs"), (tokens / n_docs).alias("mean_length"))


def scanned_scores(
    docs: DataFrame,
    queries: DataFrame,
    terms: DataFrame,
    k: int,
    eligible: Column | None,
    id_col: str,
    text_col: str,
    phrases: bool,
) -> DataFrame:
    """Best ``k`` scores per query and partition, by scanning the texts once where they lie.

    ``terms`` measured small, and everything gathered here is one row per term of it.
    """
    asked = terms.toPandas()
    names = asked["term"].unique().tolist()
    quoted: list[tuple[int, str]] = []
    if phrases:
        rows = queries.select("qid", F.explode_outer(quoted_phrases(F.col("query"))).alias("p"))
        quoted = [(r["qid"], r["p"]) for r in rows.select("qid", F.lower("p").alias("p")).collect() if r["p"] is not None]
    place = {p: i for i, p in enumerate(dict.fromkeys(p for _, p in quoted))}
    counted = count_texts(lowered_texts(docs, id_col, text_col, eligible), names, list(place))
    stats = scan_frequencies(counted, names).toPandas()
    total = stats[stats["term"].isna()]
    n, tokens = int(total["df"].sum()), int(total["tokens"].sum())
    found = stats[stats["term"].notna()].set_index("term")["df"]
    df = found.reindex(asked["term"]).fillna(0).to_numpy()
    weights = pa.table(
        {"qid": asked["qid"].to_numpy(), "term": asked["term"].to_numpy(), "idf": np.log(1.0 + (n - df + 0.5) / (df + 0.5))},
        schema=pa.schema([("qid", pa.int64()), ("term", pa.string()), ("idf", pa.float64())]),
    )
    packed = pack_weights(weights, tokens / max(n, 1) or 1.0, [(q, place[p]) for q, p in quoted], K1 + 1)
    return scan_scores(counted, packed, k, K1, B)


def text_search(
    docs: DataFrame,
    queries: DataFrame,
    k: int,
    eligible: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "content",
    phrases: bool = False,
    budget: int = BROADCAST_BYTES,
) -> DataFrame:
    """``(qid, rank, doc_id, score)``: best documents matching any query term.

    Statistics cover all of ``docs``; ``eligible`` only limits which documents are returned. With
    ``phrases``, a document must hold every quoted phrase of the query. A document is a row; an id in several rows gets its
    best score. Query terms that measure more than ``budget`` bytes are searched in several scans.
    """
    if k < 1:
        return docs.sparkSession.createDataFrame([], "qid long, rank int, doc_id long, score double")
    size = measured_bytes(query_terms(queries), F.octet_length("term") + F.lit(TERM_BYTES))
    if phrases:
        size += measured_bytes(queries, F.octet_length("query"))
    parts = max(1, -(-size // budget))
    found: DataFrame | None = None
    for part in range(parts):
        some = queries if parts == 1 else queries.where(F.pmod(F.xxhash64("qid"), F.lit(parts)) == part)
        scores = scanned_scores(docs, some, query_terms(some), k, eligible, id_col, text_col, phrases)
        found = scores if found is None else found.unionByName(scores)
    return rank_text(found, k)
