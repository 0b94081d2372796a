"""Line deduplication by overlapping windows of three lines, with DataFrame functions only.

Lines are what lies between line feeds, compared as they are. Every three consecutive lines of a text form a
window. A window found more than once in all texts is kept where it comes first (by identifier, then by position) and
its later occurrences are removed: each of their lines is covered, covered positions are merged, and the text is put together
again from the other lines. A line goes only when the same line, with its neighbours, stands earlier, so every
line that is removed somewhere is left somewhere. Windows of three blank lines do not count.

Texts of fewer than three lines have no window and stay as they are; null stays null, empty stays empty. Rows that repeat an identifier
and a text are one document: if they stay, they all stay. Rows without an identifier come first. Other columns pass through; names
that begin with two underscores are used inside.

A window's first place and its count are aggregated before they are shuffled; all other steps on windows are plain joins,
in which Spark can split a window that very many texts have. Windows are compared by the MD5 of their lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwell.llm.names import plain

LINES = 3


def window_keys(docs: DataFrame) -> DataFrame:
    """``__id, __row, __at, __key``: all windows of ``docs(__id, __row, __text)``."""
    line = F.split("__text", "\n", -1)
    keys = F.transform(
        F.sequence(F.lit(1), F.size("__lines") - (LINES - 1)),
        lambda k: F.when(
            F.trim(F.translate(F.concat(*(F.get("__lines", k - 1 + j) for j in range(LINES))), "\t\x0b\x0c\r", "    ")) != "",
            F.md5(F.concat_ws("\n", *(F.get("__lines", k - 1 + j) for j in range(LINES))).cast("binary")),
        ),
    )
    split = docs.select("__id", "__row", line.alias("__lines")).where(F.size("__lines") >= LINES)
    return split.select("__id", "__row", F.posexplode_outer(keys).alias("__at", "__key")).where("__key IS NOT NULL")


def mark(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with ``__removed``, the positions of the lines to remove, or null for none."""
    own = docs.select(
        "*",
        F.col(id_column).alias("__id"),
        F.col(text_column).alias("__text"),
        F.xxhash64(F.col(id_column), F.col(text_column)).alias("__row"),
    )
    found = window_keys(own.select("__id", "__row", "__text"))
    place = F.struct("__id", "__row", "__at")
    first = (
        found.groupBy("__key").agg(F.min(place).alias("__first"), F.count(F.lit(1)).alias("__times"))
        .where("__times > 1").select("__key", "__first")
    )
    later = found.join(first, "__key").where(~place.eqNullSafe(F.col("__first")))
    covered = later.groupBy("__row", F.col("__id").alias("__of")).agg(F.collect_set("__at").alias("__starts"))
    positions = F.array_distinct(F.flatten(F.transform("__starts", lambda p: F.array(*(p + j for j in range(LINES))))))
    removed = covered.select("__row", "__of", F.array_sort(positions).alias("__removed"))
    return own.join(
        removed, (own["__row"] == removed["__row"]) & own["__id"].eqNullSafe(removed["__of"]), "left"
    ).select(own["*"], F.split("__text", "\n", -1).alias("__lines"), "__removed")


def rest() -> Column:
    """The text without the lines at the removed positions, from the columns ``__lines`` and ``__removed``.

    The lines are a column of an earlier projection, so that they are split once a row and not once a line.
    """
    left = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), F.col("__removed"))
    return F.when(F.col("__removed").isNull(), F.col("__text")).otherwise(
        F.concat_ws("\n", F.transform(left, lambda p: F.get("__lines", p)))
    )


def dedup(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs``, whatever its columns' names, with the later occurrences of repeated windows removed from the texts."""
    named, (id_column, text_column) = plain(docs, id_column, text_column)
    marked = mark(named, id_column, text_column).withColumn("__new", rest())
    return marked.select(*(F.col("__new" if c == text_column else c) for c in named.columns)).toDF(*docs.columns)


def report(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per document: id, ``n_lines``, ``n_removed`` and the digest of the text that is left (null for a null text)."""
    marked = mark(docs.select(id_column, text_column), id_column, text_column)
    return marked.select(
        id_column,
        F.when(F.col("__text").isNull(), 0).otherwise(F.size("__lines")).cast("long").alias("n_lines"),
        F.when(F.col("__removed").isNull(), 0).otherwise(F.size("__removed")).cast("long").alias("n_removed"),
        F.sha2(rest(), 256).alias("text_sha256"),
    )
