"""The stored text index: equal to a scan of the texts and to plain Python, and it skips what cannot count."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from siftwell.operators import text_blocks as tb, text_index
from siftwell.workload import fixtures as fx

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, content string"
ASKED = "qid long, query string"


def tokens(text):
    return re.findall("[a-z0-9]+", text.lower())


def plain_search(rows, queries, k, eligible=None, phrases=False):
    """BM25 of every row, the best row of an id, in Python."""
    texts = [(i, tokens(t)) for i, t in rows if t is not None]
    n = len(texts)
    mean = sum(len(t) for _, t in texts) / n
    df = Counter(w for _, t in texts for w in set(t))
    idf = lambda w: math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5))
    out = []
    for qid, query in queries:
        asked = sorted(set(tokens(query)))
        told = [tokens(p) for p in re.findall('"([^"]+)"', query)] if phrases else []
        best = {}
        for i, t in texts:
            tf = Counter(t)
            if not any(tf[w] for w in asked) or (eligible is not None and i not in eligible):
                continue
            if not all(f" {' '.join(p)} " in f" {' '.join(t)} " for p in told if p):
                continue
            score = sum(idf(w) * tf[w] * 2.2 / (tf[w] + 1.2 * (0.25 + 0.75 * len(t) / mean)) for w in asked if tf[w])
            best[i] = max(best.get(i, 0), round(score, 6))
        ceiling = 2.2 * sum(map(idf, asked))
        for rank, (i, s) in enumerate(sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k], 1):
            out.append((qid, rank, i, round(s / ceiling, 6)))
    return sorted(out)


def searched(df):
    return sorted((r.qid, r.rank, r.doc_id, r.score) for r in df.collect())


def close(got, want):
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert all(abs(g[3] - w[3]) < 2e-6 for g, w in zip(got, want, strict=True))


@pytest.fixture(scope="module")
def words_table():
    """Zipf-like words, repeated ids with equal and with other texts, empty, blank and null texts."""
    rng = random.Random(4)
    names = [f"w{int(1.25 ** (k / 4))}" for k in range(120)]
    rows = [(i, " ".join(rng.choices(names, k=rng.randint(1, 60)))) for i in range(700)]
    rows += [(i, rows[i + 1][1]) for i in range(0, 60, 7)] + rows[30:40]
    rows += [(700, ""), (701, "?!"), (702, None), (703, "a b a b a c b a"), (704, "A-b. A,b c"), (705, "ab abc")]
    return rows


@pytest.fixture(scope="module")
def index(spark, words_table, tmp_path_factory):
    docs = spark.createDataFrame(words_table, DOCS).repartition(5)
    return tb.build_text_index(docs, str(tmp_path_factory.mktemp("index")), shard_docs=60)


QUERIES = [(1, "w1 w9"), (2, "W1, w40 w300 nowhere"), (3, "nowhere"), (4, "?!"), (5, "w2"), (6, 'w3 "w1 w2"'),
           (7, '"a b a c" a'), (8, '"a b" "b c"'), (9, '"nowhere a" a'), (10, '"?" a'), (11, "ab")]


@pytest.mark.parametrize("k", [1, 3, 2000])
@pytest.mark.parametrize("phrases", [False, True])
def test_equals_plain_python(spark, index, words_table, k, phrases):
    assert index.shards > 8
    queries = spark.createDataFrame(QUERIES, ASKED)
    got = searched(tb.index_search(index, queries, k, phrases=phrases))
    close(got, plain_search(words_table, QUERIES, k, phrases=phrases))


def test_only_eligible_documents_are_returned(spark, index, words_table):
    queries = spark.createDataFrame(QUERIES, ASKED)
    eligible = spark.range(0, 2000, 3).withColumnRenamed("id", "doc_id")
    got = searched(tb.index_search(index, queries, 5, eligible))
    close(got, plain_search(words_table, QUERIES, 5, eligible=set(range(0, 2000, 3))))
    assert tb.index_search(index, queries, 5, eligible.where("false")).collect() == []


def test_a_scan_gives_the_same_rows(spark, index, words_table):
    """An id in several rows gets its best score, however the rows are found and however small the budget is."""
    docs, queries = spark.createDataFrame(words_table, DOCS).repartition(3), spark.createDataFrame(QUERIES, ASKED)
    want = searched(tb.index_search(index, queries, 4))
    for budget in (1 << 26, 200):
        assert searched(text_index.text_search(docs, queries, 4, budget=budget)) == want


def test_phrases_from_positions(spark, index, words_table):
    queries = spark.createDataFrame(QUERIES, ASKED)
    got = sorted((r.qid, r.doc_id) for r in tb.phrase_matches(index, queries).collect())
    want = set()
    for qid, query in QUERIES:
        told = [p for p in map(tokens, re.findall('"([^"]+)"', query)) if p]
        for i, t in words_table:
            if told and t is not None and all(f" {' '.join(p)} " in f" {' '.join(tokens(t))} " for p in told):
                want.add((qid, i))
    assert got == sorted(want) and {q for q, _ in want} >= {6, 7, 8}


def test_no_text_is_read_at_search_time(spark, index):
    plan = tb.index_search(index, spark.createDataFrame(QUERIES, ASKED), 3)._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan and "gaps" not in plan and "CartesianProduct" not in plan


def test_nothing_to_search(spark, tmp_path):
    queries = spark.createDataFrame(QUERIES, ASKED)
    for n, rows in enumerate(([], [(1, None)], [(1, "")])):
        empty = tb.build_text_index(spark.createDataFrame(rows, DOCS), str(tmp_path / str(n)))
        assert tb.index_search(empty, queries, 3).collect() == []
        assert tb.phrase_matches(empty, queries).collect() == []
    full = tb.build_text_index(spark.createDataFrame([(1, "w1")], DOCS), str(tmp_path / "full"))
    assert tb.index_search(full, queries.where("false"), 3).collect() == []
    assert tb.index_search(full, queries, 0).collect() == []
    assert searched(tb.index_search(tb.open_text_index(spark, str(tmp_path / "full")), queries, 3))


def one_shard(rows):
    """A shard with all its terms, as a search task sees it."""
    rng = np.random.default_rng(2)
    keys = pa.array(np.sort(rng.integers(-(1 << 63), (1 << 63) - 1, len(rows))))
    cut = pa.Table.from_batches([tb.cut_texts(pa.array([t for _, t in rows]), keys, pa.array([i for i, _ in rows]))])
    postings = cut.filter(pa.compute.is_valid(cut.column("term"))).sort_by([("term", "ascending"), ("row", "ascending")])
    postings = postings.append_column("shard", pa.array([0] * postings.num_rows, pa.int32()))
    mean = len(" ".join(t for _, t in rows).split()) / len(rows)
    table = pa.Table.from_batches([tb.pack_groups(postings.combine_chunks(), mean)])
    documents = pa.table({"term": pa.nulls(1, pa.string()), "rows": [keys.to_pylist()], "ids": [[i for i, _ in rows]]})
    both = pa.concat_tables([table, documents], promote_options="default")
    return tb.Shard(both.combine_chunks(), mean)


def test_blocks_that_cannot_count_are_skipped():
    """With a common and a rare word, the blocks without the rare one are not scored; the result is that of all blocks."""
    rng = random.Random(9)
    rows = [(i, " ".join(rng.choices(["of", "the", "in", "on"], k=30)) + (" rare" if i % 400 == 0 else "")) for i in range(8000)]
    shard = one_shard(rows)
    weights = [("of", 0.1), ("rare", 4.0), ("the", 0.1)]
    ids, scores, scored, every = shard.best(weights, 10)
    assert every == tb.BLOCKS and scored < every / 4
    all_rows, all_scores = shard.scored(weights, np.arange(tb.BLOCKS))
    place, known = shard.places(all_rows)
    assert known.all()
    want = tb.best_per_id(shard.ids[place], all_scores, 10)
    assert ids.tolist() == want[0].tolist() and scores.tolist() == want[1].tolist()
    # A k that reaches into the common words leaves no block out.
    assert shard.best(weights, 5000)[2] == every


def test_bounds_hold_for_every_posting():
    rows = [(i, " ".join(["a"] * (i % 7 + 1) + ["b"] * (i % 11))) for i in range(3000)]
    shard = one_shard(rows)
    for of in shard.terms.values():
        adds = tb.saturation(of["tfs"], of["lengths"], shard.mean_length)
        block = (of["rows"] >> 55) + tb.BLOCKS // 2
        tops = dict(zip(of["blocks"].tolist(), of["tops"].tolist(), strict=True))
        assert all(a <= tops[b] for a, b in zip(adds, block.tolist(), strict=True))
        assert of["ends"][-1] == len(of["rows"])


def test_index_of_documents(spark, tmp_path):
    docs = fx.table(spark, SF, "documents")
    index = tb.build_text_index(docs, str(tmp_path), text_col="text", shard_docs=50)
    asked = fx.table(spark, SF, "benchmark").select(F.col("item_id").alias("qid"), F.col("text").alias("query"))
    assert searched(tb.index_search(index, asked, 7)) == searched(text_index.text_search(docs, asked, 7, text_col="text"))


def test_stored_terms_are_not_shuffled_for_a_search(spark, tmp_path):
    """The few terms that are asked go to the stored postings, whatever Spark would send of itself."""
    docs = spark.createDataFrame([(i, f"word{i % 7} common text {i}") for i in range(50)], "doc_id long, content string")
    asked = spark.createDataFrame([(1, "word3 common"), (2, '"common text"')], "qid long, query string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        index = tb.build_text_index(docs, str(tmp_path / "index"))
        scores = tb.search_scores(index, asked, 3, phrases=True)
        joins = [line for line in scores._jdf.queryExecution().executedPlan().toString().splitlines() if "Join [term" in line]
        assert len(scores.collect()) >= 6
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert [line for line in joins if "BroadcastHashJoin" in line] and not [line for line in joins if "SortMergeJoin" in line and "Inner" in line]
