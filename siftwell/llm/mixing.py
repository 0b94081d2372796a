"""Mixing sources to target weights by systematic sampling, with DataFrame functions only.

All sources together keep their total size. Targets follow the weights, but stop at ``cap`` times a
source's size; what is cut off goes to the others by weight until none is above: each target is the
smaller of its cap and a common level times its weight, and the level is found from running sums over sources sorted
by cap / weight.

Every document of a source expects target / size copies. Documents are put in an order by size, then
by a hash of the identifier; the expected copies are summed along it; one offset for
the source, from a hash of its name, is added; and a document is emitted once for each integer boundary that its
interval crosses. Ordering by size spreads the copies over all sizes alike, so the words taken lie near
the target. The running sum is taken in three levels (size classes of a source, hash ranges of a class, rows of a
range), so no source, however large, is sorted in one task.

Null sources form a source of their own, ordered last. Null and empty texts have size 0: they are mixed
like others and take no words. A source without any word has target 0 and rate 0. Rows that repeat an identifier
are documents of their own; equal ones share an order by chance, which does not change what
is taken. Extra columns pass through ``mix``; names that begin with two underscores are used inside.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftwell.llm.names import plain
from siftwell.session import cut_lineage

WORD = r"[^\x20\x09-\x0D]+"


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def unit_hash(text: Column) -> Column:
    """A fixed number in [0, 2**32) from a string."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long")


def source_key(source: Column) -> Column:
    """A string that is never null: "s" and the name, or nothing for a null source."""
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit(""))


def targets(sizes: DataFrame, cap: float = 3.0) -> DataFrame:
    """``__source, __size, __target, __rate`` from ``__source, __size``: one row per source.

    Single-partition windows here see one row per source.
    """
    by_name = Window.orderBy(F.col("__source") == "", "__source")
    weight = (F.pmod(F.row_number().over(by_name) - 1, F.lit(3)) + 1).cast("double")
    weighed = sizes.withColumn("__weight", weight).withColumn("__cap", F.lit(cap) * F.col("__size"))
    ratio = F.col("__cap") / F.col("__weight")
    by_ratio = Window.orderBy(ratio, "__source")
    below = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    everything = by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("__size").over(everything) - F.coalesce(F.sum("__cap").over(below), F.lit(0.0))
    tried = weighed.select("*", ratio.alias("__ratio"), (left / F.sum("__weight").over(rest)).alias("__level"))
    # The first source in this order that the level does not bring to its cap gives the level of all.
    fits = F.when(F.col("__level") <= F.col("__ratio"), F.struct("__ratio", "__level"))
    common = F.min(fits).over(Window.partitionBy(F.lit(0)))["__level"]
    target = F.least(F.col("__cap"), common * F.col("__weight"))
    rate = F.when(F.col("__size") == 0, 0.0).when(target >= F.col("__cap"), F.lit(cap)).otherwise(target / F.col("__size"))
    return tried.select("__source", "__size", target.alias("__target"), rate.alias("__rate"))


def plan(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source", cap: float = 3.0
) -> DataFrame:
    """``docs`` with ``__words``, ``__size`` and ``__target`` of the source, and ``__copies`` of the document."""
    ranges = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = ["__source", "__class", "__range"]
    sized = docs.select(
        "*",
        source_key(F.col(source_column)).alias("__source"),
        words_in(F.col(text_column)).alias("__words"),
        unit_hash(F.coalesce(F.col(id_column).cast("string"), F.lit(""))).alias("__hash"),
    ).select(
        "*",
        F.floor(F.log2(F.col("__words") + 1) * 2).cast("int").alias("__class"),
        F.floor(F.col("__hash") * ranges / 2**32).cast("int").alias("__range"),
    )
    counted = cut_lineage(
        sized.groupBy(*place).agg(F.count(F.lit(1)).alias("__n"), F.sum("__words").alias("__w"))
    )
    classes = counted.groupBy("__source", "__class").agg(F.sum("__n").alias("__cn"), F.sum("__w").alias("__cw"))
    sources = targets(classes.groupBy("__source").agg(F.sum("__cw").alias("__size")), cap)
    before_class = Window.partitionBy("__source").orderBy("__class").rowsBetween(Window.unboundedPreceding, -1)
    before_range = Window.partitionBy("__source", "__class").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        counted.select(*place, F.coalesce(F.sum("__n").over(before_range), F.lit(0)).alias("__before_range"))
        .join(
            classes.select(
                "__source", "__class", F.coalesce(F.sum("__cn").over(before_class), F.lit(0)).alias("__before_class")
            ),
            ["__source", "__class"],
        )
        .join(sources, "__source")
    )
    within = Window.partitionBy(*place).orderBy("__hash", F.col(id_column).asc_nulls_last(), "__words")
    ranked = sized.withColumn("__rank", F.row_number().over(within) - 1).join(starts, place)
    offset = unit_hash(F.col("__source")) / float(2**32)
    at = F.col("__before_class") + F.col("__before_range") + F.col("__rank")
    crossed = F.floor(offset + F.col("__rate") * (at + 1)) - F.floor(offset + F.col("__rate") * at)
    return ranked.withColumn("__copies", F.least(F.ceil("__rate"), crossed).cast("int"))


def report(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source") -> DataFrame:
    """One row per document: id, size, its source's size and target, and the words taken."""
    narrow = docs.select(id_column, text_column, source_column)
    return plan(narrow, id_column, text_column, source_column).select(
        id_column,
        F.col("__words").alias("size"),
        F.col("__size").alias("source_size"),
        F.col("__target").alias("target"),
        (F.col("__words") * F.col("__copies")).alias("taken"),
        F.col("__copies").cast("long").alias("copies"),
    )


def mix(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source") -> DataFrame:
    """The mix itself: the rows of ``docs``, whatever its columns' names, each as often as it is taken."""
    named, (id_column, text_column, source_column) = plain(docs, id_column, text_column, source_column)
    planned = plan(named, id_column, text_column, source_column).where(F.col("__copies") > 0)
    return planned.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select(*named.columns).toDF(*docs.columns)
