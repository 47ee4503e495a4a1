import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from conftest_llm import ODD  # noqa: E402


@pytest.fixture
def docs(spark):
    """Documents from (id, text) pairs, with extra columns whose names clash with those used inside."""

    def make(pairs):
        frame = spark.createDataFrame(list(pairs), "doc_id long, text string")
        return frame.withColumns({c: F.lit("x") for c in ("part", "rank", "score", "shard", "kept", "n", "label", "word")})

    return make


@pytest.fixture
def odd(docs):
    """Nulls, empty and very long texts, ties, repeated rows."""
    return docs(ODD)


@pytest.fixture
def nothing(docs):
    return docs([])
