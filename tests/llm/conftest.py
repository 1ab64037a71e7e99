"""Fixtures of the training-data operators: documents with every awkward case."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from llm_rows import ROWS, SCHEMA  # noqa: E402


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and very long texts, ties, repeated rows, extra columns with clashing names."""
    return spark.createDataFrame([(i, t, lang, s, len(t) if t is not None else None, 0.5, 7) for i, t, lang, s in ROWS], SCHEMA)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def texts(spark, small):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
