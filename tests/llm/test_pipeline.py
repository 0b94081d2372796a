"""The pipeline's stages against brute-force versions, each on the stage's own input."""

from collections import Counter, defaultdict

import public_tokenizers as P

import corpus_pipeline
from cases import SF
from siftwell.llm import byte_bpe, mixing, quality
from test_corpus_operators import brute_components, sets_of

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark, documents, words_of):
    docs, seen = documents, {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        docs = stage(spark, docs, SF)
        seen[name] = (before, docs.collect())
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == COLUMNS
            docs = spark.createDataFrame(seen[name][1], documents.schema)
    before, after = seen["quality_rules"]
    kept = {r.doc_id for r in quality.judge(documents).collect() if r.kept}
    assert {r.doc_id for r in after} == kept and len(after) == len(kept)

    before, after = seen["exact_dedup"]
    last = defaultdict(int)
    for r in before:
        last[r.text] = max(last[r.text], r.doc_id)
    assert {r.doc_id for r in after} == set(last.values())

    before, after = seen["ngram_join"]
    group = brute_components(sets_of([(r.doc_id, r.text) for r in before], words_of))
    assert sorted(r.doc_id for r in after) == sorted(set(group.values()))

    before, after = seen["mixing"]
    planned = mixing.report(spark.createDataFrame(before, documents.schema)).collect()
    assert Counter(r.doc_id for r in after) == Counter({r.doc_id: r.copies for r in planned if r.copies})

    before, after = seen["byte_bpe"]
    bpe, texts = byte_bpe.load(P.path(corpus_pipeline.RANKS)), {r.doc_id: r.text for r in before}
    assert Counter(r.doc_id for r in after) == Counter(r.doc_id for r in before)
    assert all(r.ids == bpe.encode(texts[r.doc_id]) and r.n_tokens == len(r.ids) for r in after)


def test_stages_on_odd_rows(spark, odd, empty):
    for table in (odd, empty):
        docs = table
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF)
        docs.collect()


def test_run_is_the_chain(spark):
    rows = corpus_pipeline.run(spark, SF)
    assert rows.count() > 0 and {"doc_id", "source", "ids", "n_tokens"} <= set(rows.columns)
