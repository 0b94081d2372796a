"""One query per operator, over whole tables, and the SQL for those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from siftwell.llm import (
    byte_bpe,
    exact,
    hard_negatives,
    line_dedup,
    lloyd,
    lm_scoring,
    mixing,
    ngram_join,
    passages,
    quality,
    simhash,
    token_counts,
    warc,
)

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(run):
    QUERIES[run.__name__] = run
    return run


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet")


def embeddings(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/embeddings.parquet")


@query
def op1_ngram_join(spark: SparkSession, sf: str) -> DataFrame:
    return ngram_join.near_duplicates(documents(spark, sf))


@query
def op2_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    return byte_bpe.round_trip(documents(spark, sf), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


@query
def op3_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return exact.dedup_report(documents(spark, sf), keep="largest")


SQL["op3_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))"""


@query
def op4_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return token_counts.budget(documents(spark, sf), public_tokenizers.path("piece_bpe_32k.model"), 4096)


@query
def op5_lm_scoring(spark: SparkSession, sf: str) -> DataFrame:
    return lm_scoring.score(documents(spark, sf), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


@query
def op6_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return line_dedup.report(documents(spark, sf))


SQL["op6_line_dedup"] = r"""
WITH split AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
line AS (SELECT doc_id, unnest(generate_series(1, len(lines) - 2)) AS pos, lines FROM split WHERE len(lines) >= 3),
win AS (
  SELECT doc_id, pos, array_to_string(lines[pos : pos + 2], chr(10)) AS key FROM line
  WHERE regexp_matches(lines[pos] || lines[pos + 1] || lines[pos + 2], '[^\x20\x09-\x0D]')),
ranked AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY doc_id, pos) AS k FROM win),
gone AS (SELECT DISTINCT doc_id, unnest([pos, pos + 1, pos + 2]) AS pos FROM ranked WHERE k > 1),
removed AS (SELECT doc_id, list(pos) AS ats FROM gone GROUP BY doc_id)
SELECT doc_id, CASE WHEN text IS NULL THEN 0 ELSE len(lines) END AS n_lines, coalesce(len(ats), 0) AS n_removed,
  sha256(CASE WHEN ats IS NULL THEN text ELSE array_to_string(
    [lines[i] for i in generate_series(1, len(lines)) if NOT list_contains(ats, i)], chr(10)) END) AS text_sha256
FROM split LEFT JOIN removed USING (doc_id)"""


@query
def op7_warc(spark: SparkSession, sf: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    return warc.round_trip(pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL["op7_warc"] = """
WITH told AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest,
    min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first_id
  FROM pages)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM told"""


@query
def op8_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return passages.near_passages(documents(spark, sf))


@query
def op9_quality(spark: SparkSession, sf: str) -> DataFrame:
    return quality.judge(documents(spark, sf))


@query
def op10_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.report(documents(spark, sf))


SQL["op10_mixing"] = r"""
WITH sized AS (
  SELECT doc_id, coalesce('s' || source, '') AS src,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    ('0x' || substr(md5(doc_id::VARCHAR), 1, 8))::BIGINT AS h
  FROM documents),
sources AS (
  SELECT src, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY src = '', src) - 1) % 3 + 1.0::DOUBLE AS weight
  FROM sized GROUP BY src),
tried AS (
  SELECT *, 3.0::DOUBLE * source_size AS cap, 3.0::DOUBLE * source_size / weight AS ratio,
    (sum(source_size) OVER () - coalesce(sum(3.0::DOUBLE * source_size) OVER (ORDER BY 3.0::DOUBLE * source_size / weight, src
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / sum(weight) OVER (ORDER BY 3.0::DOUBLE * source_size / weight, src ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM sources),
targets AS (
  SELECT src, source_size, least(cap, weight * (SELECT arg_min(level, ratio) FROM tried WHERE level <= ratio)) AS target, cap,
    ('0x' || substr(md5(src), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS start
  FROM tried),
ranked AS (
  SELECT *, CASE WHEN source_size = 0 THEN 0.0 WHEN target >= cap THEN 3.0 ELSE target / source_size END::DOUBLE AS rate,
    row_number() OVER (PARTITION BY src ORDER BY floor(log2(size + 1) * 2), h, doc_id, size) - 1 AS place
  FROM sized JOIN targets USING (src)),
counted AS (
  SELECT *, least(ceil(rate), floor(start + rate * (place + 1)) - floor(start + rate * place))::BIGINT AS copies FROM ranked)
SELECT doc_id, size, source_size, target, size * copies AS taken, copies FROM counted"""


@query
def op11_centroid_clustering(spark: SparkSession, sf: str) -> DataFrame:
    return lloyd.cluster(embeddings(spark, sf))


def lloyd_sql(k: int, rounds: int, dims: int) -> str:
    """The same rounds as common table expressions over one row per component."""
    nearest = """met{r} AS (
  SELECT row, cluster, sum((v - c) * (v - c)) AS distance FROM component JOIN centroid{r} USING (dim) GROUP BY row, cluster),
near{r} AS (SELECT row, arg_min(cluster, (distance, cluster)) AS cluster, min(distance) AS distance FROM met{r} GROUP BY row)"""
    moved = """sums{r} AS (
  SELECT cluster, dim, sum(v) AS total, count(*) AS members FROM near{r} JOIN component USING (row) GROUP BY cluster, dim),
centroid{n} AS (
  SELECT cluster, dim, coalesce((total - ((total % members) + members) % members) // members, c)::BIGINT AS c
  FROM centroid{r} LEFT JOIN sums{r} USING (cluster, dim))"""
    steps = [nearest.format(r=0)]
    for r in range(rounds):
        steps += [moved.format(r=r, n=r + 1), nearest.format(r=r + 1)]
    return f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id::VARCHAR), embedding) AS row, vec_id, embedding FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: isfinite(x))) = {dims}),
component AS (
  SELECT row, unnest(generate_series(1, {dims})) AS dim, floor(256 * unnest(embedding)::DOUBLE)::BIGINT AS v FROM kept),
centroid0 AS (SELECT (row - 1)::INT AS cluster, dim, v AS c FROM component WHERE row <= {k}),
{""",
""".join(steps)},
digest AS (
  SELECT cluster, sha256(string_agg(c::VARCHAR, ',' ORDER BY dim)) AS centroid_sha256 FROM centroid{rounds} GROUP BY cluster)
SELECT vec_id, cluster, distance::BIGINT AS distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
  (sum(distance) OVER ())::BIGINT AS inertia, centroid_sha256
FROM near{rounds} JOIN kept USING (row) JOIN digest USING (cluster)"""


SQL["op11_centroid_clustering"] = lloyd_sql(40, 5, 64)


@query
def op12_simhash(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf))


@query
def op13_hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    return hard_negatives.mine(embeddings(spark, sf))


SQL["op13_hard_negatives"] = """
WITH taken AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)),
scored AS (
  SELECT a.id AS anchor_id, a.label AS anchor_label, r.id, r.label,
    list_sum(list_transform(list_zip(a.v, r.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM taken a JOIN taken r ON a.id % 100 = 0 AND r.id <> a.id),
positive AS (
  SELECT anchor_id, anchor_label, id AS positive_id, score AS positive_score FROM scored WHERE label = anchor_label
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, positive_id, (row_number() OVER best)::INT AS rank, id AS negative_id, positive_score, score AS negative_score
FROM positive p JOIN scored s ON s.anchor_id = p.anchor_id AND s.label <> p.anchor_label
  AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
WINDOW best AS (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id)
QUALIFY row_number() OVER best <= 5"""
