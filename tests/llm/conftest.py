import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """documents-like frame from (doc_id, text) pairs, with extra columns whose
    names the operators use inside."""
    def build(rows, extra=True):
        df = spark.createDataFrame([(i, t, "en", "src0", len(t or "")) for i, t in rows],
                                   "doc_id long, text string, lang string, source string, n_chars long")
        if extra:
            for name in ("row", "h", "norm", "id", "fp", "r", "c", "score", "length", "component_id"):
                df = df.selectExpr("*", f"'x' AS {name}")
        return df
    return build
