"""Fixtures of the tests here, imported by name."""

import pyarrow.parquet as pq
import pytest


@pytest.fixture
def docs_of(spark):
    """Rows (doc_id, text) as a table with columns whose names operators use themselves."""

    def make(rows, partitions=3):
        rows = [(d, t, "x", "s", 1, "k", 2.0) for d, t in rows]
        schema = (
            "doc_id long, text string, lang string, source string, n_chars long,"
            " anchor string, length double"
        )
        return spark.createDataFrame(rows, schema).repartition(partitions)

    return make


@pytest.fixture(scope="session")
def texts(sf_dir):
    table = pq.read_table(f"{sf_dir}/documents.parquet", columns=["doc_id", "text"])
    return list(zip(*table.to_pydict().values()))
