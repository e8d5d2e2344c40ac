import pytest


@pytest.fixture(scope="session")
def docs(spark):
    """Builds documents: rows of (doc_id, text) or (doc_id, text, source)."""

    def make(*rows):
        full = [(i, t, "en", s[0] if s else "src0", len(t or "")) for i, t, *s in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long")

    return make
