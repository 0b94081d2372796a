import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from cases import LOWER, ODD_ROWS, SCHEMA, SF  # noqa: E402


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty, blank and very long texts, ties, repeated rows, and columns whose names operators use themselves."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(ODD_ROWS, SCHEMA)
    return df.withColumns({c: F.lit("x") for c in ("id", "n", "shingle", "kept", "page_id", "size", "content", "row", "key")})


@pytest.fixture(scope="module")
def empty(odd):
    return odd.where("false")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {r.doc_id: r.text for r in documents.select("doc_id", "text").collect()}


@pytest.fixture(scope="session")
def words_of():
    import re

    return lambda text: re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
