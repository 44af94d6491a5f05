import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(n, seed=1, stem="w"):
    return " ".join(f"{stem}{(i * 7919 + seed * 104729) % 9973}" for i in range(n))


@pytest.fixture(scope="session")
def frame(spark):
    """Rows (id, text) as a documents table with clashing extra columns."""

    def make(rows, lang="en", extra=("fp", "hits", "blob", "_row", "_no", "ids", "held", "n_words")):
        full = [(i, t, lang, "src0", None if t is None else len(t)) for i, t in rows]
        df = spark.createDataFrame(full, DOCS)
        for c in extra:
            df = df.selectExpr("*", f"'x' as `{c}`")
        return df

    return make


@pytest.fixture(scope="session")
def labels(spark):
    def make(rows):
        return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")

    return make
