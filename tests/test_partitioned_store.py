"""A store that rewrites only the partitions it has to, and takes a repeated batch once."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from siftwell.operators.lifecycle import upsert
from siftwell.sources import store as st

ROWS = "doc_id long, content string, embeddings array<float>, source_url string, query_count long"
DOCS = ROWS + ", provided array<string>, seq long"


def row(i, key, text="t", count=1):
    return (i, text, [1.0], key, count)


def doc(i, key, text, seq=0):
    return (i, text, [1.0], key, 1, ["content", "embeddings", "source_url", "query_count"], seq)


def files(path):
    return {str(p.relative_to(path)): p.stat().st_mtime_ns for p in Path(path).glob("store_partition=*/*.parquet")}


def partitions_of(names):
    return {n.split("/")[0] for n in names}


def content(table):
    return sorted(((r.doc_id, r.content, r.source_url, r.query_count) for r in table.read().collect()), key=str)


@pytest.fixture
def table(spark, tmp_path):
    store = st.PartitionedStore(spark, str(tmp_path / "store"), "source_url", 8)
    assert not store.exists()
    with pytest.raises(ValueError):
        store.read()
    rows = [row(i, f"k{i}") for i in range(40)] + [row(40, None), row(41, ""), row(42, "k1")]
    store.create(spark.createDataFrame(rows, ROWS))
    assert store.exists() and store.read().columns == ["doc_id", "content", "embeddings", "source_url", "query_count"]
    return store


def test_a_merge_leaves_other_partitions_alone(spark, table, tmp_path):
    before, plain = files(tmp_path / "store"), table.read()
    docs = spark.createDataFrame([doc(100, "k1", "new"), doc(101, "k1", "newer", 1), doc(102, "fresh", "f"), doc(103, None, "p")], DOCS)
    want = sorted(((r.doc_id, r.content, r.source_url, r.query_count) for r in upsert(plain, docs, "source_url").collect()), key=str)
    table.merge(docs, "source_url", upsert)
    assert content(table) == want
    after = files(tmp_path / "store")
    changed = partitions_of(before.keys() - after.keys())
    # Two keys, so two partitions at most; rows without a key only add files.
    assert 0 < len(changed) <= 2
    assert all(after[name] == time for name, time in before.items() if name.split("/")[0] not in changed)


def test_a_repeated_batch_changes_nothing(spark, table):
    docs = spark.createDataFrame([doc(100, "k1", "new"), doc(102, "fresh", "f"), doc(103, None, "p")], DOCS)
    assert not table.staged(("stream", 4))
    table.merge(docs, "source_url", upsert, ("stream", 4))
    once = content(table)
    assert table.staged(("stream", 4)) and not table.staged(("stream", 5)) and not table.staged(("other", 4))
    table.replay(("stream", 4))
    assert content(table) == once
    table.append(spark.createDataFrame([row(200, "z")], ROWS), ("stream", 5))
    table.replay(("stream", 5))
    assert len(content(table)) == len(once) + 1


def test_a_batch_that_died_after_staging_is_finished(spark, table, monkeypatch):
    docs = spark.createDataFrame([doc(100, "k1", "new"), doc(103, None, "p")], DOCS)
    before = content(table)

    def dies(self, folder, again):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(st.PartitionedStore, "_put", dies)
        with pytest.raises(RuntimeError):
            table.merge(docs, "source_url", upsert, ("stream", 0))
    assert content(table) == before and table.staged(("stream", 0))
    table.replay(("stream", 0))
    assert {r[0] for r in content(table)} == {r[0] for r in before} | {103}
    assert sum(r[1] == "new" for r in content(table)) == 2


def test_deletes_count_and_empty_partitions(spark, table, tmp_path):
    before = files(tmp_path / "store")
    assert table.delete_where(F.col("source_url") == "nowhere") == 0 and files(tmp_path / "store") == before
    assert table.delete_where(F.col("source_url") == "k1") == 2
    after = files(tmp_path / "store")
    assert len(partitions_of(before.keys() - after.keys())) == 1
    # A condition that is null keeps the row.
    assert table.delete_where(F.col("source_url") != "k2") == 39
    assert {r[2] for r in content(table)} == {None, "k2"}
    assert table.delete_where(F.lit(True)) == 2
    assert table.read().count() == 0 and table.read().columns[0] == "doc_id"
    table.append(spark.createDataFrame([row(7, "k7")], ROWS))
    assert content(table) == [(7, "t", "k7", 1)]


def test_settings_are_kept(spark, table, tmp_path):
    again = st.PartitionedStore(spark, str(tmp_path / "store"))
    assert (again.key, again.partitions) == ("source_url", 8)
    again.merge(spark.createDataFrame([doc(100, "k3", "new")], DOCS), "source_url", upsert)
    assert content(again) == content(table) and len(content(table)) == 43


def test_another_key_merges_everywhere(spark, table):
    """The store is dealt by one key; merging by another one has to look at all partitions."""
    docs = spark.createDataFrame([(500, "t", [2.0], "other", 1, ["content", "source_url"], 0)], DOCS)
    want = sorted(((r.doc_id, r.content, r.source_url, r.query_count) for r in upsert(table.read(), docs, "content").collect()), key=str)
    table.merge(docs, "content", upsert)
    assert content(table) == want


def test_few_documents_are_sent_to_the_store(spark, table, tmp_path):
    """Few documents are merged without a shuffle of the stored rows, with the same outcome."""
    docs = spark.createDataFrame([doc(100, "k1", "new"), doc(102, "fresh", "f"), doc(103, None, "p")], DOCS)
    want = sorted(((r.doc_id, r.content, r.source_url, r.query_count) for r in upsert(table.read(), docs, "source_url").collect()), key=str)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = upsert(table.read(), docs, "source_url", few=True)._jdf.queryExecution().executedPlan().toString()
        table.merge(docs, "source_url", lambda *given: upsert(*given, few=True), scattered=False)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert [line for line in plan.splitlines() if "BroadcastHashJoin" in line and "LeftOuter" in line]
    assert content(table) == want
