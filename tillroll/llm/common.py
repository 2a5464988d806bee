"""Helpers shared by the operators: shared work folders and Arrow batches."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.session import checkpoint_dir


def work_path(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts lineage in a way that survives lost executors; later steps read
    files instead of computing ``df`` again. The schema is passed on, so a
    table without rows reads back as well.
    """
    path = work_path(df.sparkSession, name)
    df.write.options(**({"compression": "zstd"} | options)).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def one_row_per(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` and the smallest ``_row`` for each of their combinations (any
    one if a type in it has no order). Tasks fold repeats before the shuffle."""
    kind = rows.schema["_row"].dataType.simpleString()
    pick = F.first if "map<" in kind or "variant" in kind else F.min
    return rows.groupBy(*keys).agg(pick("_row").alias("_row"))


def told_by(column: str) -> list:
    """A column that may be null as two keys that are not."""
    return [F.coalesce(F.col(column).cast("long"), F.lit(0)).alias("_id"), F.col(column).isNull().alias("_no_id")]


def rows_told_apart(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """One row of ``docs``, all columns, for each ``doc_id, text_sha256`` (of
    the text, A-Z lower-cased) in ``kept`` that it has."""
    keys = ["_id", "_no_id", "_sha"]
    sha = F.sha2(fold_ascii(F.coalesce(F.col("text").cast("string"), F.lit(""))), 256)
    rows = one_row_per(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                                   *told_by("doc_id"), sha.alias("_sha")), keys)
    kept = kept.select(*told_by("doc_id"), F.col("text_sha256").alias("_sha"))
    # The join's keys are those of the rows: they are not shuffled again, nor ever broadcast.
    return rows.join(kept.hint("merge"), keys, "left_semi").select("_row.*")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def id_and_text(docs: DataFrame) -> DataFrame:
    """``doc_id`` as long and ``text`` with null as empty; other columns are
    left behind, so no name of theirs can clash with an operator's own."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )


def text_bytes(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """A text column as UTF-8 bytes."""
    values = batch.column(batch.schema.get_field_index(column))
    wide = pa.types.is_large_string(values.type)
    return values.cast(pa.large_binary() if wide else pa.binary()).to_pylist()


def slices(batch: pa.RecordBatch, rows: int = 256, most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """A batch in parts of at most ``rows`` rows and about ``most_bytes`` of
    text (a longer row is a part of its own)."""
    sizes = np.zeros(batch.num_rows, np.int64)
    for column in batch.columns:
        if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
            sizes += pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        fit = int(np.searchsorted(ends, before + most_bytes, "right"))
        end = min(batch.num_rows, at + rows, max(at + 1, fit))
        yield batch.slice(at, end - at)
        at = end


def crc32_of_id(column: str = "doc_id"):
    """Unsigned CRC-32 of a document id written as decimal text."""
    return F.crc32(F.col(column).cast("string").cast("binary"))


def fold_ascii(column):
    """Lower-case A-Z and leave every other character as it is."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
