import pytest
from pyspark.sql import Row  # noqa: F401

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text) pairs, in several partitions, with an
    extra column whose name clashes with an operator's own."""
    def make(rows, extra=True, parts=3):
        full = [(i, t, "en", "src0", None if t is None else len(t)) for i, t in rows]
        df = spark.createDataFrame(full, SCHEMA)
        if extra:
            from pyspark.sql import functions as F

            df = df.withColumn("kept", F.lit("x")).withColumn("score", F.lit("y")).withColumn("node", F.lit(1))
        return df.repartition(parts) if rows else df
    return make


@pytest.fixture
def vocabulary():
    tokenizers = pytest.importorskip("public_tokenizers")
    return tokenizers.path
