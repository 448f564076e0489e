import pytest


@pytest.fixture
def table(spark):
    """Rows (doc_id, text) as documents, in several partitions, with columns whose names operators use themselves."""
    from pyspark.sql import functions as F

    def make(rows, parts=4):
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        extra = {c: F.lit("x") for c in ("n_words", "kept", "spans", "row", "d", "n", "items", "hits", "score", "ids", "mark", "gone", "lang")}
        return df.withColumns(extra)

    return make
