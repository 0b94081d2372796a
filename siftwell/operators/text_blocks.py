"""A stored text index with positions, and BM25 top-k and phrases answered from it without opening a text.

Layout. Documents are dealt into shards of about ``SHARD_DOCS`` by a hash of their row, and a shard into ``BLOCKS`` blocks by the
hash's upper bits, so a block holds the same documents for every term. One stored row per (shard, term) has the postings in order
of the hash (row, frequency, document length), the positions as gaps, and for each block that occurs the end of its run and the
largest score a posting of it can add. Texts are cut into tokens where they lie; only postings are shuffled. No group exceeds the
documents of a shard.

Search. The stored rows of the asked terms meet the query terms by shard and part of the queries. For each query the blocks
are visited by the sum of their bounds, the largest first, until no block left can reach the k-th score found so far: its
documents are never scored. A phrase is an ordered merge of its terms' positions. Documents that may not be returned are
left out before the cut, by joining their ids to the shards' lists of documents.

A document is a row: rows that share an id are scored one by one, and the id gets the best of their scores.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siftwell.functions.text import quoted_phrases, sanitize_text_query, words
from siftwell.operators.sizing import rows_for, spread
from siftwell.operators.text_scan import BETWEEN_WORDS
from siftwell.session import INPUT_PARTITIONS, scratch_path

# BM25 parameters.
K1 = 1.2
B = 0.75

SHARD_DOCS = 16384
BLOCKS = 512
#: Queries that meet a shard in one task.
QUERY_PART = 2048
#: Bytes of text cut into tokens at once, if a single text is not longer.
SLICE_BYTES = 4 << 20
#: Scores are rounded to six decimals, so a bound may fall short of a rounded score by that much.
ROUNDING = 1e-6
FIRST_BLOCKS = 16

RAW = "row long, doc_id long, term string, tf int, length int, gaps array<int>"
PACKED = (
    "shard int, term string, rows array<long>, tfs array<int>, lengths array<int>, gaps array<int>, "
    "blocks array<int>, ends array<int>, tops array<double>"
)


def saturation(tf, length, mean_length: float):
    """What a term of weight 1 adds to a document's score."""
    return tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / mean_length))


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers from each start on, ``lengths`` of them, one run after the other."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)


def lists(values: np.ndarray | pa.Array, edges: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(values))


def cut_texts(lowered: pa.Array, rows: pa.Array, ids: pa.Array) -> pa.RecordBatch:
    """Postings of some texts: one row per text and term, and one without a term per text."""
    tokens = pc.split_pattern_regex(lowered, BETWEEN_WORDS)
    flat, doc = tokens.flatten(), pc.list_parent_indices(tokens).to_numpy()
    real = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    doc, coded = doc[real], flat.filter(pa.array(real)).dictionary_encode()
    code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    length = np.bincount(doc, minlength=len(lowered))
    place = np.arange(len(doc)) - np.repeat(np.cumsum(length) - length, length)
    order = np.lexsort((place, code, doc))
    doc, code, place = doc[order], code[order], place[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (code[1:] != code[:-1])
    gaps = place.copy()
    gaps[1:] -= np.where(new[1:], 0, place[:-1])
    edges = np.r_[np.flatnonzero(new), len(doc)]
    owner, which = doc[edges[:-1]], code[edges[:-1]]
    every = np.arange(len(lowered))
    whose = pa.array(np.r_[owner, every])
    return pa.RecordBatch.from_arrays(
        [
            rows.take(whose),
            ids.take(whose),
            pa.concat_arrays([coded.dictionary.take(pa.array(which)).cast(pa.string()), pa.nulls(len(every), pa.string())]),
            pa.array(np.r_[np.diff(edges), np.zeros(len(every), np.int64)].astype(np.int32)),
            pa.array(length[np.r_[owner, every]].astype(np.int32)),
            lists(gaps.astype(np.int32), np.r_[edges, np.full(len(every), len(doc))]),
        ],
        ["row", "doc_id", "term", "tf", "length", "gaps"],
    )


def raw_postings(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``RAW`` rows of every document that has a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lowered = batch.column("lowered")
            size = np.cumsum(np.r_[0, pc.binary_length(lowered).to_numpy(zero_copy_only=False)])
            at = 0
            while at < batch.num_rows:
                to = max(at + 1, int(np.searchsorted(size, size[at] + SLICE_BYTES, side="right")) - 1)
                part = slice(at, to - at)
                yield cut_texts(*(batch.column(c).slice(part.start, part.stop) for c in ("lowered", "row", "doc_id")))
                at = to

    texts = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("_text"))
    keyed = spread(texts).select(
        F.lower("_text").alias("lowered"), F.xxhash64("doc_id", F.monotonically_increasing_id()).alias("row"), "doc_id"
    )
    return keyed.mapInArrow(run, RAW)


def pack_groups(rows: pa.Table, mean_length: float) -> pa.RecordBatch:
    """One ``PACKED`` row per (shard, term) of sorted postings."""
    columns = {c: rows.column(c).combine_chunks() for c in rows.column_names}
    shard, row, tf, length = (columns[c].to_numpy(zero_copy_only=False) for c in ("shard", "row", "tf", "length"))
    edges = group_edges(columns["term"], shard)
    block = (row >> 55) + BLOCKS // 2
    top = saturation(tf, length, mean_length)
    new = np.zeros(len(row), bool)
    new[edges[:-1]] = True
    new[1:] |= block[1:] != block[:-1]
    runs = np.flatnonzero(new)
    owner = np.searchsorted(edges, runs, side="right") - 1
    run_edges = np.searchsorted(runs, edges)
    gap_edges = columns["gaps"].offsets.to_numpy()
    return pa.RecordBatch.from_arrays(
        [
            pa.array(shard[edges[:-1]]),
            columns["term"].take(pa.array(edges[:-1])),
            lists(row, edges),
            lists(tf, edges),
            lists(length, edges),
            lists(columns["gaps"].flatten(), gap_edges[edges] - gap_edges[0]),
            lists(block[runs].astype(np.int32), run_edges),
            lists((np.r_[runs[1:], len(row)] - edges[owner]).astype(np.int32), run_edges),
            lists(np.maximum.reduceat(top, runs) if len(runs) else top, run_edges),
        ],
        ["shard", "term", "rows", "tfs", "lengths", "gaps", "blocks", "ends", "tops"],
    )


def group_edges(term: pa.Array, shard: np.ndarray) -> np.ndarray:
    """Where each run of one (term, shard) begins, and the end."""
    if len(shard) == 0:
        return np.zeros(1, np.int64)
    other = pc.not_equal(term.slice(1), term.slice(0, len(term) - 1)).to_numpy(zero_copy_only=False)
    return np.r_[0, np.flatnonzero(other | (shard[1:] != shard[:-1])) + 1, len(shard)]


def packed(raw: DataFrame, shards: int, mean_length: float) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table]).combine_chunks()
            if held.num_rows == 0:
                continue
            # The last group may go on in the next batch.
            edges = group_edges(held.column("term").combine_chunks(), held.column("shard").to_numpy())
            if edges[-2]:
                yield pack_groups(held.slice(0, int(edges[-2])).combine_chunks(), mean_length)
                held = held.slice(int(edges[-2])).combine_chunks()
        if held is not None and held.num_rows:
            yield pack_groups(held.combine_chunks(), mean_length)

    rows = raw.where(F.col("term").isNotNull()).select(
        F.pmod("row", F.lit(shards)).cast("int").alias("shard"), "term", "row", "tf", "length", "gaps"
    )
    return rows.repartition("shard", "term").sortWithinPartitions("term", "shard", "row").mapInArrow(run, PACKED)


@dataclass(frozen=True)
class TextIndex:
    """``postings`` as ``PACKED``, ``documents(shard, rows, ids)``, ``terms(term, df)``, and the corpus's numbers."""

    postings: DataFrame
    documents: DataFrame
    terms: DataFrame
    shards: int
    n_docs: int
    mean_length: float


def build_text_index(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "content", shard_docs: int = SHARD_DOCS
) -> TextIndex:
    """Write the index of all texts under ``path``. Rows without a text are not in it."""
    spark = docs.sparkSession
    # Every row of a text's postings carries the text's row key, so they are written by one attempt of a task.
    kept = scratch_path(spark, "raw-postings")
    raw_postings(docs, id_col, text_col).write.parquet(kept)
    raw = spark.read.parquet(kept)
    texts = raw.where(F.col("term").isNull())
    n_docs, tokens = texts.agg(F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0))).first()
    mean_length = tokens / n_docs if n_docs and tokens else 1.0
    shards = max(-(-n_docs // shard_docs), int(spark.conf.get(INPUT_PARTITIONS, None) or 1))
    packed(raw, shards, mean_length).write.mode("overwrite").parquet(os.path.join(path, "postings"))
    postings = spark.read.parquet(os.path.join(path, "postings"))
    postings.groupBy("term").agg(F.sum(F.size("rows")).alias("df")).write.mode("overwrite").parquet(os.path.join(path, "terms"))
    by_shard(texts.select(F.pmod("row", F.lit(shards)).cast("int").alias("shard"), "row", "doc_id")).write.mode("overwrite").parquet(
        os.path.join(path, "documents")
    )
    numbers = spark.createDataFrame([(shards, n_docs, mean_length)], "shards int, n_docs long, mean_length double")
    numbers.coalesce(1).write.mode("overwrite").parquet(os.path.join(path, "corpus"))
    return open_text_index(spark, path)


def open_text_index(spark: SparkSession, path: str) -> TextIndex:
    postings, documents, terms, corpus = (
        spark.read.parquet(os.path.join(path, name)) for name in ("postings", "documents", "terms", "corpus")
    )
    return TextIndex(postings, documents, terms, *corpus.select("shards", "n_docs", "mean_length").first())


def by_shard(rows: DataFrame) -> DataFrame:
    """``shard, rows, ids`` from ``shard, row, doc_id``: at most a shard's documents in one list."""
    entries = F.sort_array(F.collect_list(F.struct("row", "doc_id")))
    return rows.groupBy("shard").agg(entries.alias("e")).select("shard", F.col("e.row").alias("rows"), F.col("e.doc_id").alias("ids"))


class Shard:
    """The asked terms of one shard, and its documents that may be returned."""

    def __init__(self, table: pa.Table, mean_length: float):
        self.mean_length = mean_length
        self.rows, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.terms: dict[str, dict[str, np.ndarray]] = {}
        names = [c for c in ("rows", "tfs", "lengths", "gaps", "blocks", "ends", "tops") if c in table.column_names]
        columns = {c: table.column(c).combine_chunks() for c in ("term", "ids", *names)}
        for k, term in enumerate(columns["term"].to_pylist()):
            if term is None:
                self.rows, self.ids = (columns[c][k].values.to_numpy(zero_copy_only=False) for c in ("rows", "ids"))
            else:
                self.terms[term] = {c: columns[c][k].values.to_numpy(zero_copy_only=False) for c in names}

    def places(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in the list of documents, and whether the row is there."""
        place = np.minimum(np.searchsorted(self.rows, rows), max(len(self.rows) - 1, 0))
        return place, (self.rows[place] == rows if len(self.rows) else np.zeros(len(rows), bool))

    def scored(self, weights: list[tuple[str, float]], blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of some blocks and their scores."""
        found, adds = [np.zeros(0, np.int64)], [np.zeros(0)]
        for term, idf in weights:
            of = self.terms.get(term)
            if of is None:
                continue
            at = np.minimum(np.searchsorted(of["blocks"], blocks), len(of["blocks"]) - 1)
            at = at[of["blocks"][at] == blocks]
            begin = np.where(at > 0, of["ends"][at - 1], 0)
            which = ragged(begin, of["ends"][at] - begin)
            found.append(of["rows"][which])
            adds.append(idf * saturation(of["tfs"][which], of["lengths"][which], self.mean_length))
        rows, inverse = np.unique(np.concatenate(found), return_inverse=True)
        return rows, np.round(np.bincount(inverse.ravel(), np.concatenate(adds), len(rows)), 6)

    def best(
        self, weights: list[tuple[str, float]], k: int, allowed: np.ndarray | None = None
    ) -> tuple[np.ndarray, np.ndarray, int, int]:
        """Ids and scores of the best ``k``, and how many blocks were scored of how many that have a term."""
        bound = np.zeros(BLOCKS)
        for term, idf in weights:
            if term in self.terms:
                bound[self.terms[term]["blocks"]] += idf * self.terms[term]["tops"]
        order = np.argsort(-bound, kind="stable")[: np.count_nonzero(bound)]
        ids, scores = np.zeros(0, np.int64), np.zeros(0)
        least, at, step = -np.inf, 0, FIRST_BLOCKS
        while at < len(order) and bound[order[at]] >= least - ROUNDING:
            some = order[at : at + step]
            some = some[bound[some] >= least - ROUNDING]
            at, step = at + len(some), 2 * step
            rows, new = self.scored(weights, np.sort(some))
            place, known = self.places(rows)
            if allowed is not None:
                known &= np.isin(rows, allowed)
            ids, scores = best_per_id(np.r_[ids, self.ids[place[known]]], np.r_[scores, new[known]], k)
            if len(ids) >= k:
                least = scores[-1]
        return ids, scores, at, len(order)

    def positions(self, term: str) -> tuple[np.ndarray, np.ndarray]:
        """The place of the document in the term's postings and the position, of every occurrence in order."""
        of = self.terms[term]
        first = np.cumsum(of["tfs"]) - of["tfs"]
        total = np.cumsum(of["gaps"].astype(np.int64))
        before = np.where(first > 0, total[first - 1], 0)
        return np.repeat(np.arange(len(of["tfs"])), of["tfs"]), total - np.repeat(before, of["tfs"])

    def holding(self, phrase: list[str]) -> np.ndarray:
        """Rows in which the terms of the phrase follow each other."""
        if any(term not in self.terms for term in phrase):
            return np.zeros(0, np.int64)
        common = self.terms[phrase[0]]["rows"]
        for term in set(phrase[1:]):
            common = np.intersect1d(common, self.terms[term]["rows"], assume_unique=True)
        ahead: np.ndarray | None = None
        for n, term in enumerate(phrase):
            doc, position = self.positions(term)
            place = np.searchsorted(common, self.terms[term]["rows"])
            place = np.where(np.isin(self.terms[term]["rows"], common), place, -1)[doc]
            keys = (place[place >= 0] << 32) + position[place >= 0] - n
            ahead = keys if ahead is None else np.intersect1d(ahead, keys, assume_unique=True)
        return common[np.unique(ahead >> 32)]

    def holding_all(self, phrases: list[list[str]]) -> np.ndarray:
        kept = self.holding(phrases[0])
        for phrase in phrases[1:]:
            kept = np.intersect1d(kept, self.holding(phrase), assume_unique=True)
        return kept


def best_per_id(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``k`` ids by their best score, then id."""
    order = np.lexsort((-scores, ids))
    ids, scores = ids[order], scores[order]
    first = np.ones(len(ids), bool)
    first[1:] = ids[1:] != ids[:-1]
    ids, scores = ids[first], scores[first]
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


def query_terms(queries: DataFrame) -> DataFrame:
    """``(qid, term)``: distinct terms of each sanitised query."""
    terms = F.array_distinct(words(sanitize_text_query(F.col("query"))))
    return queries.select("qid", F.explode(terms).alias("term"))


def phrase_tokens(queries: DataFrame) -> DataFrame:
    """``qid, phrases``: the terms of every quoted phrase that has any, for queries that have such."""
    tokens = F.filter(F.transform(quoted_phrases(F.col("query")), words), lambda p: F.size(p) > 0)
    return queries.select("qid", tokens.alias("phrases")).where(F.size("phrases") > 0)


def met(
    index: TextIndex, asked: DataFrame, parts: int, eligible: DataFrame | None, positions: bool
):
    """Stored rows and ``asked(qid, term, ...)``, grouped by shard and part of the queries."""
    part = F.pmod(F.xxhash64("qid"), F.lit(parts)).cast("int")
    asked = asked.withColumn("part", part)
    wanted = asked.where(F.col("term").isNotNull()).select("part", "term").distinct()
    names = ["rows", "tfs", "lengths", "blocks", "ends", "tops", *(["gaps"] if positions else [])]
    # What is stored of the terms stays where it lies, but for the rows of those that are asked.
    postings = rows_for(wanted, index.postings.select("shard", "term", *names), "term").select("shard", "term", *names, "part")
    documents = index.documents
    if eligible is not None:
        each = documents.select("shard", F.explode(F.arrays_zip("rows", "ids")).alias("d"))
        each = each.select("shard", F.col("d.rows").alias("row"), F.col("d.ids").alias("doc_id"))
        documents = by_shard(each.join(eligible.select(F.col("doc_id").cast("long").alias("doc_id")).distinct(), "doc_id", "left_semi"))
    documents = documents.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    left = postings.unionByName(documents, allowMissingColumns=True)
    right = asked.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(index.shards - 1))))
    # Both sides come from the queries; new names for the columns tell them apart.
    right = right.toDF(*right.columns)
    return left.toDF(*left.columns).groupBy("shard", "part").cogroup(right.groupBy("shard", "part"))


def weighted_terms(index: TextIndex, queries: DataFrame) -> DataFrame:
    """``qid, term, idf`` of all terms, those that no document has included."""
    df = F.coalesce(F.col("df"), F.lit(0))
    idf = F.log(F.lit(1.0) + (F.lit(index.n_docs) - df + 0.5) / (df + 0.5))
    return query_terms(queries).join(index.terms, "term", "left").select("qid", "term", idf.alias("idf"))


def by_query(asked: pa.Table) -> Iterator[tuple[int, list[tuple[str, float]], list[list[str]]]]:
    """Each query's weighted terms and phrases."""
    weights: dict[int, list] = {}
    phrases: dict[int, list] = {}
    has_phrases = "phrases" in asked.column_names
    for row in asked.select(["qid", "term", "idf", *(["phrases"] if has_phrases else [])]).to_pylist():
        if row["term"] is None:
            phrases[row["qid"]] = row["phrases"]
        else:
            weights.setdefault(row["qid"], []).append((row["term"], row["idf"]))
    for qid, terms in weights.items():
        yield qid, sorted(terms), phrases.get(qid, [])


def search_scores(
    index: TextIndex, queries: DataFrame, k: int, eligible: DataFrame | None = None, phrases: bool = False
) -> DataFrame:
    """``qid, doc_id, score, ceiling``: each shard's best ``k`` per query, and the score no document can exceed.

    ``eligible(doc_id)`` limits what is returned, not the statistics. With ``phrases``, a document must hold the terms of
    every quoted phrase one after the other.
    """
    mean_length = index.mean_length

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[tuple[int, np.ndarray, np.ndarray, float]] = []
        if right.num_rows and left.num_rows:
            shard = Shard(left, mean_length)
            for qid, weights, wanted in by_query(right):
                ids, scores, _, _ = shard.best(weights, k, shard.holding_all(wanted) if wanted else None)
                found.append((qid, ids, scores, (K1 + 1) * sum(idf for _, idf in weights)))
        sizes = [len(ids) for _, ids, _, _ in found]
        return pa.table(
            {
                "qid": pa.array(np.repeat(np.array([f[0] for f in found], np.int64), sizes)),
                "doc_id": pa.array(np.concatenate([np.zeros(0, np.int64), *(f[1] for f in found)])),
                "score": pa.array(np.concatenate([np.zeros(0), *(f[2] for f in found)])),
                "ceiling": pa.array(np.repeat(np.array([f[3] for f in found], np.float64), sizes)),
            }
        )

    asked = weighted_terms(index, queries).withColumn("qid", F.col("qid").cast("long"))
    if phrases:
        asked = asked.unionByName(phrase_tokens(queries).withColumn("qid", F.col("qid").cast("long")), allowMissingColumns=True)
    parts = max(1, -(-queries.count() // QUERY_PART))
    return met(index, asked, parts, eligible, phrases).applyInArrow(run, "qid long, doc_id long, score double, ceiling double")


def phrase_matches(index: TextIndex, queries: DataFrame) -> DataFrame:
    """``qid, doc_id``: documents that hold every quoted phrase of the query, term by term; queries without phrases have none here."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        qids, ids = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        if right.num_rows and left.num_rows:
            shard = Shard(left, 1.0)
            for row in right.select(["qid", "phrases"]).to_pylist():
                if row["phrases"] is not None:
                    place, known = shard.places(shard.holding_all(row["phrases"]))
                    own = np.unique(shard.ids[place[known]])
                    qids.append(np.full(len(own), row["qid"]))
                    ids.append(own)
        return pa.table({"qid": np.concatenate(qids), "doc_id": np.concatenate(ids)})

    told = phrase_tokens(queries).withColumn("qid", F.col("qid").cast("long"))
    terms = told.select("qid", F.explode(F.array_distinct(F.flatten("phrases"))).alias("term"))
    asked = terms.unionByName(told, allowMissingColumns=True)
    parts = max(1, -(-queries.count() // QUERY_PART))
    found = met(index, asked, parts, None, True).applyInArrow(run, "qid long, doc_id long")
    # An id in several rows may lie in several shards.
    return found.distinct()


def rank_text(scores: DataFrame, k: int) -> DataFrame:
    """Best ``k`` per query. The score is the share of what a document could reach that holds all terms of the query, in [0, 1), so
    that it says how well a text matches and not only how it compares with the other texts."""
    best = scores.groupBy("qid", "doc_id").agg(F.max("score").alias("score"), F.max("ceiling").alias("ceiling"))
    order = Window.partitionBy("qid").orderBy(F.desc("score"), F.asc("doc_id"))
    cut = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return cut.select("qid", "rank", "doc_id", F.round(F.col("score") / F.col("ceiling"), 6).alias("score"))


def index_search(
    index: TextIndex, queries: DataFrame, k: int, eligible: DataFrame | None = None, phrases: bool = False
) -> DataFrame:
    """``qid, rank, doc_id, score``: best documents matching any query term, from the stored index alone."""
    if k < 1:
        return queries.sparkSession.createDataFrame([], "qid long, rank int, doc_id long, score double")
    return rank_text(search_scores(index, queries, k, eligible, phrases), k)
