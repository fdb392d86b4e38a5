import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    from nimbusmart.llm.registry import ship_package

    ship_package(spark)


@pytest.fixture(scope="session")
def rows():
    from brute import odd_documents

    return odd_documents()


@pytest.fixture(scope="session")
def docs(spark, rows):
    """The odd rows with extra columns whose names clash with results and helpers."""
    data = [(i, t, "src", "x", 1, [1], None) for i, t in rows]
    return spark.createDataFrame(data, "doc_id long, text string, source string, kept string, n_words int, spans array<int>, key string").repartition(5)


@pytest.fixture(scope="session")
def none(docs):
    return docs.limit(0)
