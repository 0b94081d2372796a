"""N-gram Jaccard join: word shingles, a global order with common shingles last, and prefix trees.

1. Every text becomes a set of 64-bit shingle hashes. Texts of equal sets (compared by size and two 64-bit
   sums) form a class, and one of each class goes on.
2. Two sets that are similar enough share ``k`` shingles among the first ``n - ceil(0.75 n) + k`` of each, whatever the
   global order is; ``k`` is a sixth of the smaller set. With the order of hashes these prefixes are dealt out by
   shingle; documents that share fewer prefix shingles with all others together are done. What this pass counts
   also tells the common shingles, which then go last in the global order (at most ``COMMON`` of them, the
   most frequent first; this changes the work, not the result), and the remaining documents are dealt out and
   counted anew by their new prefixes.
3. Documents that met are gathered in blocks around the one they met whose prefix shingles are met most often. In a block the sets lie in a compressed
   prefix tree, frequent shingles first. The tree is walked once for all sets of the block together: overlaps
   are carried from a node to its children, and a set leaves a subtree when what is left of it and of the subtree's longest
   set cannot reach the similarity. Blocks have about ``BLOCK`` members or ``BLOCK_SHINGLES`` shingles besides their centre; larger ones are split.
4. Links give components. Prefix shingles whose documents lie in one component are done. The others give
   pairs of documents of different components that pass the bounds on sizes and positions, and whose sketches (512 bits, one
   parity for each part of the hashes) differ by no more bits than similar sets can; these go through blocks as well, so no link between components is lost. Components over all links are the result.

Words are separated by ASCII white space and A-Z are lowered. A text of fewer words than a shingle has one,
all of its words; null, empty and blank texts have none and link with nothing. Rows without an identifier get the
component of their class, or null. Rows that repeat an identifier are one node with several sets. Only the two named
columns are read. Hashes stand for shingles throughout; two different ones are equal with a chance of 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftwell.llm import slices
from siftwell.llm.links import components
from siftwell.llm.names import plain
from siftwell.session import cut_lineage, scratch_path

SIZE = 5
BLOCK = 64
#: Long sets fill a block sooner: the memory of a task does not follow the lengths of its texts, beyond two of them.
BLOCK_SHINGLES = 1 << 17
#: A sketch of a set has so many 64-bit words.
WORDS = 8
#: Shingles in so many prefixes are common; at most COMMON of them are sent to the tasks (8 bytes each).
COMMON_FROM = 48
COMMON = 1 << 20
#: Identifiers are sent to the tasks that read texts when they are at most so many, else texts and identifiers are joined by a shuffle.
BROADCAST_IDS = 1 << 20


def similar(overlap, left, right):
    """100 * intersection >= 75 * union."""
    return 7 * overlap >= 3 * (left + right)


def least_shared(n):
    """How many shingles the prefixes of a set of ``n`` and of a similar one that is not smaller have in common at least."""
    return n // 6 + 1


def prefix_length(n):
    return n - (3 * n + 3) // 4 + least_shared(n)


def prefix_column(n: Column) -> Column:
    return n - F.ceil(n * 0.75) + F.floor(n / 6) + 1


def doc_sets(chunk: slices.Chunk, common: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle hashes in the global order, text by text, with their text numbers and each text's count."""
    data = slices.LOWER[chunk.data]
    starts, ends, doc = slices.words(data, chunk.offsets)
    found, owner = slices.shingles(slices.hash_spans(data, starts, ends), doc, chunk.docs, SIZE)
    order = np.lexsort((found, owner))
    found, owner = found[order], owner[order]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])
    found, owner = found[new], owner[new]
    if common is not None and len(common):
        at = np.minimum(np.searchsorted(common, found), len(common) - 1)
        order = np.lexsort((found, common[at] == found, owner))
        found = found[order]
    return found, owner, np.bincount(owner, minlength=chunk.docs)


def signatures(docs: DataFrame) -> DataFrame:
    """``id, n, s1, s2`` from ``id, text``: the size of a set and two sums over it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in slices.chunks(batch.column(1)):
                found, _, n = doc_sets(chunk)
                edges = np.r_[0, np.cumsum(n)]
                sums = []
                for salt in (0x2545F4914F6CDD1D, 0x9FB21C651E98DF25):
                    total = np.zeros(len(found) + 1, np.uint64)
                    np.cumsum(slices.mix(found ^ np.uint64(salt)), out=total[1:])
                    sums.append((total[edges[1:]] - total[edges[:-1]]).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(chunk.first, chunk.docs), pa.array(n), *map(pa.array, sums)],
                    ["id", "n", "s1", "s2"],
                )

    return docs.mapInArrow(run, "id long, n long, s1 long, s2 long")


def prefixes(docs: DataFrame, common=None) -> DataFrame:
    """``shingle, id, n, place`` for the prefix of every set; ``common`` is a broadcast of sorted hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = common.value if common is not None else None
        for batch in batches:
            for chunk in slices.chunks(batch.column(1)):
                found, owner, n = doc_sets(chunk, last)
                place = np.arange(len(found)) - (np.cumsum(n) - n)[owner]
                kept = place < prefix_length(n)[owner]
                ids = batch.column(0).slice(chunk.first, chunk.docs)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(found[kept].view(np.int64)),
                        ids.take(pa.array(owner[kept])),
                        pa.array(n[owner[kept]].astype(np.int32)),
                        pa.array(place[kept].astype(np.int32)),
                    ],
                    ["shingle", "id", "n", "place"],
                )

    return docs.mapInArrow(run, "shingle long, id long, n int, place int")


def sketches(found: np.ndarray, owner: np.ndarray, docs: int) -> np.ndarray:
    """Parities of the numbers of shingles by hash, ``64 * WORDS`` bits a set: two sets differ by as many shingles as bits, or more."""
    bits = 64 * WORDS
    place = (slices.mix(found ^ np.uint64(0xA24BAED4963EE407)) % np.uint64(bits)).astype(np.int64)
    odd = (np.bincount(owner * bits + place, minlength=docs * bits) & 1).astype(np.uint8)
    return np.packbits(odd.reshape(docs, bits), axis=1).view(np.int64)


def sets(docs: DataFrame, common) -> DataFrame:
    """``id, shingles`` and the words of a sketch: whole sets in the global order."""
    names = [f"k{w}" for w in range(WORDS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in slices.chunks(batch.column(1)):
                found, owner, n = doc_sets(chunk, common.value)
                words = sketches(found, owner, chunk.docs)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(chunk.first, chunk.docs),
                        slices.gather(found.view(np.int64), np.r_[0, np.cumsum(n)]),
                        *(pa.array(np.ascontiguousarray(words[:, w])) for w in range(WORDS)),
                    ],
                    ["id", "shingles", *names],
                )

    return docs.mapInArrow(run, "id long, shingles array<long>, " + ", ".join(f"{k} long" for k in names))


class PrefixTree:
    """Sets of small integers, ascending, in a compressed prefix tree; nodes know the sizes below them."""

    def __init__(self, members: list[np.ndarray], sizes: np.ndarray):
        self.members, self.sizes = members, sizes
        # Big-endian bytes are in the order of the numbers, at four bytes each.
        order = sorted(range(len(members)), key=lambda k: members[k].astype(">u4").tobytes())
        self.root = self._build(order, 0)

    def _build(self, order: list[int], depth: int) -> tuple:
        """(label, depth at its end, sets that end here, children, least size, most elements left)."""
        first, last = self.members[order[0]], self.members[order[-1]]
        reach = min(len(first), len(last))
        differ = np.flatnonzero(first[depth:reach] != last[depth:reach])
        end = depth + int(differ[0]) if len(differ) else reach
        here = [k for k in order if len(self.members[k]) == end]
        rest = [k for k in order if len(self.members[k]) > end]
        children, at = [], 0
        while at < len(rest):
            to = at + 1
            while to < len(rest) and self.members[rest[to]][end] == self.members[rest[at]][end]:
                to += 1
            children.append(self._build(rest[at:to], end))
            at = to
        least = int(self.sizes[order].min())
        left = max(len(self.members[k]) for k in order) - end
        return first[depth:end], end, here, children, least, left

    def join(self) -> Iterator[tuple[int, int]]:
        """All similar pairs of members, each once or twice."""
        members, sizes = self.members, self.sizes
        width = max((int(m[-1]) + 1 for m in members if len(m)), default=0)
        has = np.zeros((len(members), width), bool)
        for k, m in enumerate(members):
            has[k, m] = True
        lengths = np.array([len(m) for m in members])
        flat = np.concatenate([m + k * (width + 1) for k, m in enumerate(members)]) if members else np.zeros(0, np.int64)
        begin = np.cumsum(lengths) - lengths
        stack = [(self.root, np.arange(len(members)), np.zeros(len(members), np.int64))]
        while stack:
            (label, _, here, children, least, left), probes, overlap = stack.pop()
            if len(label):
                overlap = overlap + has[probes[:, None], label].sum(axis=1)
                used = np.searchsorted(flat, probes * (width + 1) + label[-1], side="right") - begin[probes]
                reach = overlap + np.minimum(lengths[probes] - used, left)
                alive = similar(reach, sizes[probes], least)
                probes, overlap = probes[alive], overlap[alive]
            if len(probes) == 0:
                continue
            for k in here:
                hit = probes[similar(overlap, sizes[probes], sizes[k]) & (probes != k)]
                yield from ((k, int(p)) for p in hit)
            stack += [(child, probes, overlap) for child in children]


def tree_links(ids: np.ndarray, shingles: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links of a block, as many as join its similar members: (member, smaller member of its group)."""
    n = np.array([len(s) for s in shingles])
    values, which, times = np.unique(np.concatenate(shingles), return_inverse=True, return_counts=True)
    # Shingles of one member only overlap with nothing; the others are numbered, the most frequent first.
    shared = np.flatnonzero(times > 1)
    rank = np.full(len(values), -1)
    rank[shared[np.argsort(-times[shared], kind="stable")]] = np.arange(len(shared))
    ranked = np.split(rank[which], np.cumsum(n)[:-1])
    tree = PrefixTree([np.sort(r[r >= 0]) for r in ranked], n)
    above = list(range(len(ids)))

    def top(k: int) -> int:
        while above[k] != k:
            above[k] = above[above[k]]
            k = above[k]
        return k

    for a, b in tree.join():
        a, b = top(a), top(b)
        if a != b:
            a, b = (a, b) if ids[a] <= ids[b] else (b, a)
            above[b] = a
    return [(int(ids[k]), int(ids[top(k)])) for k in range(len(ids)) if ids[top(k)] != ids[k]]


def block_links(blocks: DataFrame, all_sets: DataFrame) -> DataFrame:
    """``a, b``: links found in the blocks of ``block, part, id``."""

    def run(group: pa.Table) -> pa.Table:
        column = group.column("shingles").combine_chunks()
        found = tree_links(
            group.column("id").to_numpy(), [np.asarray(s.values.to_numpy(zero_copy_only=False)) for s in column]
        )
        a, b = zip(*found) if found else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    filled = blocks.join(all_sets.select("id", "shingles"), "id").select("block", "part", "id", "shingles")
    return filled.groupBy("block", "part").applyInArrow(run, "a long, b long")


def split_blocks(members: DataFrame) -> DataFrame:
    """``block, part, id`` from ``block, id, n``: parts of about ``BLOCK`` members or ``BLOCK_SHINGLES`` shingles, each with the block's centre."""
    members = members.groupBy("block", "id").agg(F.max("n").alias("n"))
    full = F.greatest(F.count(F.lit(1)) / BLOCK, F.sum(F.when(F.col("id") != F.col("block"), F.col("n"))) / BLOCK_SHINGLES)
    counts = members.groupBy("block").agg(F.ceil(full).cast("int").alias("parts"))
    dealt = members.where("id <> block").join(counts, "block").select(
        "block", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int").alias("part"), "id"
    )
    centres = counts.select("block", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("block").alias("id"))
    return dealt.union(centres)


def met(rows: DataFrame) -> DataFrame:
    """Prefix rows of shingles that two or more documents have, with how many."""
    together = Window.partitionBy("shingle")
    return rows.withColumn("times", F.count(F.lit(1)).over(together)).where("times > 1")


def enough(rows: DataFrame) -> DataFrame:
    """Ids that have as many of these rows as a similar set needs; a similar set has three quarters of the size at least."""
    least = F.floor(F.ceil(F.col("n") * 0.75) / 6) + 1
    return rows.groupBy("id", "n").agg(F.count(F.lit(1)).alias("shared")).where(F.col("shared") >= least).select("id").distinct()


def stored(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back: as reliable as a checkpoint, and compressed by column."""
    path = scratch_path(df.sparkSession, "ngram-rows")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: id, ``n_shingles``, ``component_id`` (the smallest id that links reach) and ``class_id``
    (the smallest id of an equal set)."""
    spark = docs.sparkSession
    texts = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    signed = stored(signatures(texts))
    classes = signed.where("n > 0").groupBy("n", "s1", "s2").agg(F.min("id").alias("class_id"))
    members = signed.join(classes, ["n", "s1", "s2"], "left").select(
        "id", "n", F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("class_id")).alias("class_id")
    )

    def texts_of(ids: DataFrame) -> DataFrame:
        ids = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
        return texts.join(ids, "id", "left_semi")

    first = stored(met(prefixes(texts_of(cut_lineage(classes.where("class_id IS NOT NULL").select(F.col("class_id").alias("id"))))).select("shingle", "id", "n")))
    common = (
        first.where(F.col("times") >= COMMON_FROM).groupBy("shingle").agg(F.max("times").alias("times"))
        .orderBy(F.desc("times"), "shingle").limit(COMMON).select("shingle").toPandas()["shingle"].to_numpy(np.int64)
    )
    shared = spark.sparkContext.broadcast(np.sort(common.view(np.uint64)))
    candidates = cut_lineage(enough(first))
    met_again = stored(met(prefixes(texts_of(candidates), shared)))
    candidates = cut_lineage(enough(met_again))
    lists = stored(met(met_again.drop("times").join(candidates, "id", "left_semi")))

    path = scratch_path(spark, "shingle-sets")
    sets(texts_of(candidates), shared).write.parquet(path)
    all_sets = spark.read.parquet(path)

    centre = Window.partitionBy("shingle")
    # The original of many near copies has none of their own shingles, so its prefix is met most often.
    weight = lists.groupBy("id", "n").agg((F.sum("times") / prefix_column(F.col("n"))).alias("weight"))
    weight = weight.groupBy("id").agg(F.max("weight").alias("weight"))
    around = (
        lists.join(weight, "id")
        .select("id", "n", F.max(F.struct("weight", (-F.col("id")).alias("other"))).over(centre).alias("centre"))
        .groupBy("id").agg((-F.max("centre")["other"]).alias("block"), F.max("n").alias("n"))
    )
    links = cut_lineage(block_links(split_blocks(around.select("block", "id", "n")), all_sets))

    labels = components(links)
    placed = lists.join(labels.withColumnRenamed("node", "id"), "id", "left").select(
        "shingle", "id", "n", "place", F.coalesce("component", "id").alias("component")
    )
    mixed = stored(
        placed.select(
            "*", F.min("component").over(centre).alias("low"), F.max("component").over(centre).alias("high")
        ).where("low <> high").drop("low", "high")
    )
    words = [f"k{w}" for w in range(WORDS)]
    mixed = mixed.join(all_sets.select("id", *words), "id")
    other = mixed.select(*(F.col(c).alias(f"{c}2") for c in mixed.columns))
    reach = 1 + F.least(F.col("n") - 1 - F.col("place"), F.col("n2") - 1 - F.col("place2"))
    differ = sum((F.bit_count(F.col(k).bitwiseXOR(F.col(f"{k}2"))) for k in words[1:]), F.bit_count(F.col("k0").bitwiseXOR(F.col("k02"))))
    pairs = mixed.join(
        other,
        (F.col("shingle") == F.col("shingle2"))
        & (F.col("id") < F.col("id2"))
        & (F.col("component") != F.col("component2"))
        & similar(reach, F.col("n"), F.col("n2"))
        # Similar sets differ by a seventh of their sizes at most, so their sketches differ by as many bits at most.
        & (7 * differ <= F.col("n") + F.col("n2")),
    ).select(F.col("id").alias("block"), F.col("id2").alias("id"), F.col("n2").alias("n")).distinct()
    more = cut_lineage(block_links(split_blocks(cut_lineage(pairs)), all_sets))

    final = components(links.union(more))
    return members.join(final.withColumnRenamed("node", "class_id"), "class_id", "left").select(
        F.col("id").alias(id_column),
        F.col("n").alias("n_shingles"),
        F.coalesce("component", "class_id").alias("component_id"),
        "class_id",
    )


def keep_one(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of their component, with all columns, whatever their names.

    Rows that repeat a kept id all stay, and so do rows without an id whose class has none.
    """
    named, (id_column, text_column) = plain(docs, id_column, text_column)
    found = near_duplicates(named, id_column, text_column)
    dropped = found.where(F.col(id_column) != F.col("component_id")).select(F.col(id_column).alias("__dropped")).distinct()
    return named.join(dropped, named[id_column] == F.col("__dropped"), "left_anti").toDF(*docs.columns)
