import pytest


@pytest.fixture(scope="session")
def make(spark):
    """Small tables: make("doc_id long, text string", rows)."""
    def table(schema, rows):
        return spark.createDataFrame(rows, schema)
    return table
