import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    def make(*rows, more=""):
        """Rows of (doc_id, text[, lang[, source]])."""
        full = [(r + ("en", "a")[len(r) - 2 :])[:4] + (len(r[1] or ""),) for r in rows]
        frame = spark.createDataFrame(full, DOCUMENTS)
        for name in more.split():
            frame = frame.selectExpr("*", f"'x' AS {name}")
        return frame

    return make
