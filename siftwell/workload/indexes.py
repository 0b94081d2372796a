"""Registered queries: vector cells, recall, and index upkeep."""

from __future__ import annotations

from pyspark.sql import functions as F

from siftwell.functions.vectors import distance
from siftwell.operators import cell_tree, ivf, knn as nn, metrics
from siftwell.operators.text_blocks import build_text_index, open_text_index
from siftwell.session import scratch_path
from siftwell.sources.store import ensure_index
from siftwell.workload import fixtures as fx
from siftwell.workload import retrieval as rt
from siftwell.workload.fixtures import SIM
from siftwell.workload.registry import check

# Fixed value: default accuracy target, in percent.
ACCURACY = 90

CELLS = """
means AS (SELECT label, i, avg(embedding[i]::DOUBLE) AS m FROM embeddings, (SELECT unnest(range(1, 65)) AS i) GROUP BY 1, 2),
centroids AS (SELECT label AS cell, list(m ORDER BY i) AS c FROM means GROUP BY 1),
closeness AS (SELECT vec_id, cell, list_dot_product(embedding::DOUBLE[], c) / sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]))
  - list_dot_product(c, c) / 2 AS near FROM embeddings, centroids),
places AS (SELECT vec_id, cell, row_number() OVER (PARTITION BY vec_id ORDER BY near DESC, cell) AS place FROM closeness),
probed AS (
  SELECT qid, doc_id, score, rank FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id) AS rank FROM (
    SELECT a.vec_id AS qid, b.vec_id AS doc_id, {sim} AS score
    FROM places p JOIN places h ON p.cell = h.cell AND p.place <= 3 AND h.place = 1
    JOIN embeddings a ON a.vec_id = p.vec_id JOIN embeddings b ON b.vec_id = h.vec_id)) WHERE rank <= 5),
exact AS (SELECT qid, doc_id, rank FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id) AS rank FROM (
    SELECT a.vec_id AS qid, b.vec_id AS doc_id, {sim} AS score FROM embeddings a, embeddings b)) WHERE rank <= 5)
""".format(sim=SIM.format(a="a.embedding", b="b.embedding"))


def _vectors(spark, sf):
    return fx.table(spark, sf, "embeddings").withColumnsRenamed({"vec_id": "doc_id", "embedding": "embeddings"})


def _asked(spark, sf):
    return _vectors(spark, sf).select(F.col("doc_id").alias("qid"), F.col("embeddings").alias("qvec"))


def _searched(spark, sf):
    vectors = _vectors(spark, sf)
    centroids = ivf.group_centroids(vectors, "label")
    cells = ivf.assign_cells(vectors, centroids)
    return ivf.ivf_search(cells, centroids, _asked(spark, sf), rt.K, 3)


@check("ivf_build", "SELECT count(*) AS n_rows, count(DISTINCT vec_id) AS n_docs, 10 AS n_cells FROM embeddings")
def ivf_build(spark, sf):
    """Cells by k-means over all vectors: each vector lies in exactly one of them."""
    cells, _ = ivf.ivf_build(_vectors(spark, sf), 10)
    return cells.groupBy("cell").agg(F.count("*").alias("n"), F.count_distinct("doc_id").alias("d")).agg(
        F.sum("n").alias("n_rows"), F.sum("d").alias("n_docs"), F.count("*").alias("n_cells")
    )


@check("ivf_assign", f"WITH {CELLS} SELECT vec_id AS doc_id, cell FROM places WHERE place = 1")
def ivf_assign(spark, sf):
    vectors = _vectors(spark, sf)
    return ivf.assign_cells(vectors, ivf.group_centroids(vectors, "label")).select("doc_id", "cell")


@check("ivf_search", f"WITH {CELLS} SELECT qid, rank, doc_id, score FROM probed")
def ivf_search(spark, sf):
    return _searched(spark, sf)


@check(
    "recall_at_k",
    f"WITH {CELLS} SELECT e.qid, round(count(p.doc_id) / count(*)::DOUBLE, 6) AS recall FROM exact e LEFT JOIN probed p USING (qid, doc_id) GROUP BY 1",
)
def recall_at_k(spark, sf):
    exact = nn.knn(_vectors(spark, sf), _asked(spark, sf), rt.K)
    return metrics.recall_at_k(_searched(spark, sf), exact, rt.K)


# --- two-level cells ------------------------------------------------------------------------------

_trees: dict[tuple[str, str], cell_tree.CellTree] = {}


def _tree(spark, sf):
    """The cell index of all vectors, built when it is first asked for in a session."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _trees:
        _trees[key] = cell_tree.build_cell_tree(_vectors(spark, sf), scratch_path(spark, "cell-tree"), 10, 8)
    return _trees[key]


EXACT = f"WITH {CELLS} SELECT qid, rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id) AS rank FROM (" + """
    SELECT a.vec_id AS qid, b.vec_id AS doc_id, {sim} AS score FROM embeddings a, embeddings b)) WHERE rank <= 5""".format(
    sim=SIM.format(a="a.embedding", b="b.embedding")
)


@check("cell_search_exact", EXACT)
def cell_search_exact(spark, sf):
    """An accuracy target of 100: further cells are visited until no other can hold a better row."""
    return cell_tree.cell_search(_tree(spark, sf), _asked(spark, sf), rt.K, target=100)


@check("cell_search_target", "SELECT vec_id AS qid, true AS enough FROM embeddings")
def cell_search_target(spark, sf):
    """Recall against the exact search, with the default accuracy target."""
    found = cell_tree.cell_search(_tree(spark, sf), _asked(spark, sf), rt.K, target=ACCURACY)
    recall = metrics.recall_at_k(found, nn.knn(_vectors(spark, sf), _asked(spark, sf), rt.K), rt.K)
    return recall.select("qid", (F.col("recall") >= ACCURACY / 100).alias("enough"))


@check(
    "cell_rows",
    "SELECT vec_id AS doc_id, true AS stored_whole, true AS in_nearest_leaf, true AS within_radii FROM embeddings",
)
def cell_rows(spark, sf):
    """Every row of the index, checked with column functions against all leaves of its group and its group's radius."""
    tree = _tree(spark, sf)
    unit = ivf.in_space(F.col("embeddings"), tree.metric)
    leaves = tree.leaves.select("grp", F.col("leaf").alias("other"), "centroid", "radius")
    met = tree.cells.withColumn("unit", unit).join(leaves, "grp")
    met = met.withColumn("gap", distance("euclidean", F.col("unit"), F.col("centroid")))
    own = F.max(F.when(F.col("leaf") == F.col("other"), F.col("gap")))
    row = met.groupBy("doc_id", "grp").agg(
        own.alias("own"),
        F.min("gap").alias("least"),
        F.max(F.when(F.col("leaf") == F.col("other"), F.col("radius"))).alias("radius"),
        F.first("unit").alias("unit"),
        F.first("embeddings").alias("embeddings"),
    )
    groups = tree.groups.select("grp", F.col("centroid").alias("centre"), F.col("radius").alias("reach"))
    given = _vectors(spark, sf).select("doc_id", F.col("embeddings").alias("given"))
    far = distance("euclidean", F.col("unit"), F.col("centre"))
    return row.join(groups, "grp").join(given, "doc_id", "right").select(
        "doc_id",
        (F.col("embeddings") == F.col("given").cast("array<float>")).alias("stored_whole"),
        (F.col("own") <= F.col("least") + 1e-9).alias("in_nearest_leaf"),
        ((F.col("own") <= F.col("radius") + 1e-9) & (far <= F.col("reach") + 1e-9)).alias("within_radii"),
    )


@check(
    "ensure_index",
    "WITH " + rt.DOC_POSTINGS + """ SELECT attempt, attempt = 1 AS built, (SELECT count(*) FROM postings) AS n_postings
FROM (SELECT unnest([1, 2]) AS attempt)""",
)
def ensure_text_index(spark, sf):
    path = scratch_path(spark, "text-index")
    docs = fx.table(spark, sf, "documents")
    build = lambda path: build_text_index(docs, path, text_col="text")
    built = [ensure_index(spark, path, build) for _ in range(2)]
    flags = F.explode(F.array(*[F.struct(F.lit(i + 1).alias("attempt"), F.lit(b).alias("built")) for i, b in enumerate(built)]))
    sizes = open_text_index(spark, path).postings.agg(F.sum(F.size("rows")).alias("n_postings"))
    return sizes.select(flags.alias("f"), "n_postings").select("f.*", "n_postings")
