import pytest

from tests.llm import rows as made


@pytest.fixture(scope="session")
def edge(spark, tmp_path_factory):
    """Documents with NULLs in any column, empty and very long texts, ties, repeated rows, odd extra columns."""
    path = str(tmp_path_factory.mktemp("edge") / "documents")
    made.edge_documents(spark).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def none(edge):
    return edge.limit(0)
