"""The corpus pipeline: quality, exact copies, near copies, secrets, packing.

``STAGES`` lists the stages in order. A stage takes ``(spark, docs, sf_dir)``
and returns a table: all but the last return the columns of ``documents``,
the last one the pieces of the packed sequences. ``run`` applies them to
``documents`` and writes each stage's result to the shared folder before the
next one reads it. Each stage works on all rows its predecessor kept; the
operators state what null, empty, repeated and clashing input gives.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import exact_dedup, hyperminhash, mil_quality, packing, secret_scan
from tillroll.llm.common import stored
from tillroll.llm.queries import documents, vocabulary
from tillroll.sources.tables import read_table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts. It learns from the
    labels of documents outside its held-out share."""
    labels = read_table(spark, sf_dir, "labels")
    model = mil_quality.learn(docs, labels, usable=~mil_quality.held_out())
    return mil_quality.keep_quality(docs, model)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: five-word shingles, 0.8."""
    return hyperminhash.drop_near_copies(docs, k=5, percent=80)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced in their texts."""
    cleaned = secret_scan.redact(docs)
    if "n_chars" not in cleaned.columns:
        return cleaned
    return cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the training sequences that hold every remaining document."""
    return packing.with_checksums(packing.pack(docs, vocabulary("byte_bpe_50k.json"), end_id=0))


STAGES = [
    ("quality", quality),
    ("exact_dedup", exact_copies),
    ("near_dedup", near_copies),
    ("secrets", secrets),
    ("packing", sequences),
]

ORACLE_SQL = None  # SQL expresses neither the classifier nor the tokenizer


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
