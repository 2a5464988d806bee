"""Token-id store: Parquet files of whole tokenized documents.

File format
-----------
One folder of Parquet files, in ascending ``doc_id`` order within and across
files (file ``part`` numbers ascend). Columns: ``doc_id``, ``part``,
``part_start`` (ids before the document in its file), ``n_tokens`` and
``ids`` (list of int). ``ids`` are dictionary-encoded: a vocabulary of 2^16
ids packs two bytes an id or less. The metadata columns are sorted or small
and use delta encoding. Row groups and pages are bounded in bytes, pages in
rows too, and column and page indexes are written, so a reader of a doc_id
range touches the pages of that range, and a reader of metadata never reads
``ids``.

Defined results: null text counts as empty; every document ends with the
``end_id``, so an empty one has one id. A null ``doc_id`` sorts first. Rows
that repeat a ``doc_id`` are all stored, ordered by text. Extra columns are
not read. An empty table gives an empty store.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillroll.llm.common import id_and_text, shuffle_partitions, slices, work_path
from tillroll.llm.tokens import encoder

STORE_SCHEMA = "doc_id long, part int, part_start long, n_tokens long, ids array<int>"
ROW_GROUP_BYTES = 16 << 20
PAGE_BYTES = 64 << 10
PAGE_ROWS = 1000


def _encode_part(tokenizer_path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, start, encode = TaskContext.get().partitionId(), 0, encoder(tokenizer_path)
        end = np.asarray([end_id], "<u4").tobytes()
        for batch in batches:
            for rows in slices(batch, 1024):
                coded = [ids + end for ids in encode(rows.column(1).to_pylist())]
                counts = np.asarray([len(x) // 4 for x in coded], np.int64)
                ends = np.cumsum(counts)
                values = pa.array(np.frombuffer(b"".join(coded), "<i4"))
                offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(np.full(len(coded), part, np.int32)),
                     pa.array(start + ends - counts), pa.array(counts), pa.ListArray.from_arrays(offsets, values)],
                    ["doc_id", "part", "part_start", "n_tokens", "ids"])
                start += int(counts.sum())

    return run


def write_store(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, parts: int | None = None,
                row_group_bytes: int = ROW_GROUP_BYTES, page_bytes: int = PAGE_BYTES,
                page_rows: int = PAGE_ROWS) -> str:
    """Tokenize whole texts and write the store at ``path``; returns ``path``.

    One range shuffle of texts orders the documents; tokens are never
    shuffled. ``parts`` is the number of files (the session's shuffle
    partitions if not given).
    """
    n = parts or shuffle_partitions(docs.sparkSession)
    ordered = id_and_text(docs).repartitionByRange(n, F.col("doc_id").asc_nulls_first())
    ordered = ordered.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    coded = ordered.mapInArrow(_encode_part(tokenizer_path, end_id), STORE_SCHEMA)
    options = {
        "compression": "zstd",
        "parquet.writer.version": "v2",
        "parquet.block.size": str(row_group_bytes),
        "parquet.page.size": str(page_bytes),
        "parquet.page.row.count.limit": str(page_rows),
        "parquet.enable.dictionary": "true",
        # Without a dictionary the second writer version delta-encodes integers.
        **{f"parquet.enable.dictionary#{c}": "false" for c in ("doc_id", "part", "part_start", "n_tokens")},
    }
    coded.write.options(**options).parquet(path)
    return path


def read_store(spark: SparkSession, path: str, first_id: int | None = None, last_id: int | None = None) -> DataFrame:
    """The store's rows, of a range of ids if given (pushed to the pages)."""
    df = spark.read.schema(STORE_SCHEMA).parquet(path)
    if first_id is not None:
        df = df.filter(F.col("doc_id") >= first_id)
    if last_id is not None:
        df = df.filter(F.col("doc_id") <= last_id)
    return df


def with_starts(spark: SparkSession, path: str, rows: DataFrame) -> DataFrame:
    """Adds ``start``, the number of ids of all documents before a row's.

    Sums one row per file (metadata columns only) and adds the row's place
    in its file.
    """
    files = read_store(spark, path).groupBy("part").agg(F.sum("n_tokens").alias("part_tokens"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("part", F.coalesce(F.sum("part_tokens").over(before), F.lit(0)).alias("file_start"))
    return rows.join(files, "part").withColumn("start", F.col("file_start") + F.col("part_start"))


def _checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(batch.schema.get_field_index("ids"))
        offsets = ids.offsets.to_numpy()
        values = ids.values.to_numpy().astype("<u4", copy=False)
        crc = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:])]
        kept = [batch.column(i) for i, f in enumerate(batch.schema) if f.name != "ids"]
        names = [f.name for f in batch.schema if f.name != "ids"]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(crc, pa.int64())], [*names, "ids_crc32"])


def checksums(rows: DataFrame) -> DataFrame:
    """Replaces ``ids`` by ``ids_crc32``, the unsigned CRC-32 of the ids as
    little-endian unsigned 32-bit integers."""
    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name != "ids")
    return rows.mapInArrow(_checksums, f"{kept}, ids_crc32 long")


def store_digest(docs: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """Writes a store in the shared folder, reads it back and describes each
    document: ``doc_id, start, n_tokens, ids_crc32``."""
    spark = docs.sparkSession
    path = write_store(docs, work_path(spark, "tokens"), tokenizer_path, end_id)
    return with_starts(spark, path, checksums(read_store(spark, path))).select(
        "doc_id", "start", "n_tokens", "ids_crc32")
