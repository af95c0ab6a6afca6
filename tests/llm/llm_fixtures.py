"""Fixture of the training-data operator tests."""

import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """documents(rows) -> DataFrame; a row is (doc_id, text[, lang[, source]])."""
    def make(rows, **extra):
        full = [tuple(r) + (None,) * (4 - len(r)) + (len(r[1] or ""),) for r in rows]
        df = spark.createDataFrame(full, DOC)
        from pyspark.sql import functions as F
        for name, value in extra.items():
            df = df.withColumn(name, F.lit(value))
        return df
    return make


@pytest.fixture
def sf_small():
    """Folder of the smallest given tables."""
    return "/root/testdata/sf0.001"
