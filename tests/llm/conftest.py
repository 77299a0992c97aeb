import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark):
    """A documents table from (doc_id, text) pairs, with columns whose names the operators use inside."""

    def make(pairs, more=""):
        df = spark.createDataFrame([(i, t, "en", "s", len(t) if t is not None else None) for i, t in pairs], SCHEMA)
        return df.selectExpr("*", "'x' as h", "1 as line", "2 as bucket", "3 as owner", "'y' as tie", "0 as n", "4 as at", "5 as shard", "'z' as gone")

    return make
