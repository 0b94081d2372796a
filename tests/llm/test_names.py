"""Documents whose extra columns have the names that operators use themselves."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from siftwell.llm import exact, line_dedup, mixing, ngram_join

OWN = """owner digest bytes dropped size copies copy text id row removed lines new words source class cn hash rate target rank starts of
before_class before_range""".split()


@pytest.mark.parametrize("operator", [exact.keep_one, ngram_join.keep_one, mixing.mix, line_dedup.dedup])
def test_columns_with_the_names_of_operators(spark, operator):
    body = " ".join(f"w{k}" for k in range(60))
    rows = [(k, "s", t) for k, t in enumerate([body, body, body + " more", "a\nb\nc", "a\nb\nc\nd", "", None])]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    more = docs.withColumns({f"__{name}": F.lit("x") for name in OWN} | {"c0": F.lit("y"), "c2": F.lit("z"), "a.b": F.lit("w")})
    found = operator(more)
    assert found.columns == more.columns
    kept = [r.asDict() for r in found.collect()]
    assert Counter((r["doc_id"], r["text"]) for r in kept) == Counter(map(tuple, operator(docs).select("doc_id", "text").collect()))
    assert all(r[f"__{name}"] == "x" for r in kept for name in OWN)
    assert all((r["c0"], r["c2"], r["a.b"]) == ("y", "z", "w") for r in kept) and kept
