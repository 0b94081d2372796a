"""Column names that no name of an operator's own can meet."""

from __future__ import annotations

from pyspark.sql import DataFrame


def plain(docs: DataFrame, *columns: str) -> tuple[DataFrame, list[str]]:
    """``docs`` with its columns named by place, and the new names of ``columns``.

    ``result.toDF(*docs.columns)`` gives the old names back. Both are projections, so they cost nothing.
    """
    new = [f"c{k}" for k in range(len(docs.columns))]
    lowered = [name.lower() for name in docs.columns]
    return docs.toDF(*new), [new[docs.columns.index(c) if c in docs.columns else lowered.index(c.lower())] for c in columns]
