import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def make_docs(spark):
    """documents from (doc_id, text) or (doc_id, text, source), with clashing extra columns."""
    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "src0", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        for c in ("fp", "component_id", "score", "key", "n", "root", "digest", "part", "u", "range"):
            df = df.selectExpr("*", f"'x' as {c}")
        return df
    return make


SF = "/root/testdata/sf0.001"
