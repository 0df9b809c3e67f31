import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from llm_cases import EDGE, SCHEMA, rows_of  # noqa: E402


@pytest.fixture(scope="session")
def edge(spark):
    """Documents with every odd case and extra columns that clash with the operators' own."""
    return spark.createDataFrame(rows_of(EDGE), SCHEMA).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def docs(spark, sf_small):
    return spark.read.parquet(f"{sf_small}/documents.parquet").cache()
