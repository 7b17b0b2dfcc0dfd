import pytest


@pytest.fixture
def docs(spark):
    """Rows (doc_id, text, ...) as a documents table."""

    def make(rows, schema="doc_id long, text string, lang string, source string, n_chars long"):
        width = len(schema.split(","))
        return spark.createDataFrame([(*r, *[None] * (width - len(r))) for r in rows], schema)

    return make
