import pytest

from llm.cases import DOCUMENTS, EDGE_ROWS


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, clashing extra columns."""
    return spark.createDataFrame(EDGE_ROWS, DOCUMENTS)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCUMENTS)


@pytest.fixture(scope="session")
def docs(spark, small):
    return spark.read.parquet(f"{small}/documents.parquet")
