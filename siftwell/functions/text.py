"""Text expressions: tokens, phrases, previews, chunks and hashes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Token patterns.
WORD = "[A-Za-z0-9]+"
LOWER_WORD = "[a-z0-9]+"
COUNTED_TOKEN = "[A-Za-z0-9]+|[^A-Za-z0-9\\s]"
QUOTED = '"([^"]+)"'
# Chunks of more words are cut by word position: patterns repeat so many times at most.
REPEATED_WORDS = 1000


def _all(text: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """Lower-case ASCII alphanumeric runs, in order."""
    return _all(F.lower(text), LOWER_WORD)


def sanitize_text_query(text: Column) -> Column:
    """The alphanumeric runs of a query joined by one space; '' means there is no text to search."""
    return F.array_join(_all(text, WORD), " ")


def quoted_phrases(text: Column) -> Column:
    return _all(text, QUOTED, 1)


def token_count(text: Column) -> Column:
    """Default token counter: each alphanumeric run and each other visible character is one token."""
    return F.size(_all(text, COUNTED_TOKEN))


def content_hash(text: Column) -> Column:
    return F.sha2(text, 256)


def squeeze(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, "\\s+", " "))


def preview_text(text: Column, width: int = 120) -> Column:
    """One line of at most ``width`` characters, cut after a whole word and marked with '...'."""
    line = squeeze(text)
    head = F.regexp_extract(line, f"^(.{{0,{width - 3}}}) ", 1)
    return F.when(F.length(line) <= width, line).otherwise(F.concat(head, F.lit("...")))


def chunk_text(text: Column, words_per_chunk: int) -> Column:
    """Consecutive windows of ``words_per_chunk`` words; a text without words has no chunk.

    Up to a thousand words a chunk, one pattern reads the text once; possessive repeats keep it from being read again.
    """
    if words_per_chunk < 1:
        raise ValueError("words_per_chunk must be at least 1.")
    if words_per_chunk > REPEATED_WORDS:
        listed = F.filter(F.split(text, "\\s+"), lambda word: word != "")
        starts = F.filter(F.sequence(F.lit(0), F.size(listed), F.lit(words_per_chunk)), lambda at: at < F.size(listed))
        return F.transform(starts, lambda at: F.array_join(F.slice(listed, at + 1, words_per_chunk), " "))
    window = f"(?:\\S++\\s++){{0,{words_per_chunk - 1}}}\\S++"
    return F.transform(_all(text, window), lambda chunk: F.regexp_replace(chunk, "\\s+", " "))


def best_chunks(text: Column, query: Column, n: int, words_per_chunk: int) -> Column:
    """The ``n`` chunks that hold the largest share of the query's words, the best first, ties in order of the text."""

    def chosen(asked: Column) -> Column:
        scored = F.transform(
            chunk_text(text, words_per_chunk),
            lambda chunk, place: F.struct(
                (-F.size(F.array_intersect(words(chunk), asked))).alias("near"), place.alias("place"), chunk.alias("chunk")
            ),
        )
        return F.transform(F.slice(F.array_sort(scored), 1, n), lambda c: c["chunk"])

    return let(F.array_distinct(words(query)), chosen)
