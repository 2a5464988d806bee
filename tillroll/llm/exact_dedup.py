"""Exact deduplication by Grace hashing.

Method
------
1. *Runs.* Every task folds its own copies with an open-addressing table that
   compares whole contents, and writes one run row per distinct content it
   saw (``run_id``, the content, its size and largest id, its members). The
   runs are a table in the shared folder, so a lost executor loses nothing,
   and a content that makes up a third of the corpus becomes one row a task.
2. *Buckets.* Runs are hash-partitioned by a per-level hash of their digest.
   A task owns a bucket and streams it through a table of bounded bytes. What
   fits is resolved; rows whose content found no room are written to spill
   files in the shared folder with all other rows of that content.
3. *Recursion.* Spill files are folded, partitioned by the next level's hash
   and treated alike until no spill is left. Equal contents share every hash,
   and a table holds one entry for them, so a hot content never stops the
   recursion; different contents part at some level.
4. Each run carries its group's result to its members over ``run_id``, a key
   that never has more rows than one task folded.

Results
-------
One row per input row. Texts are compared after lower-casing A-Z; null
counts as empty. The row with the largest ``doc_id`` of a group stays. A
null id is smaller than any other. Of rows that tie on that id (repeated
rows) exactly one has ``kept``. Empty texts are a group like any other. An
empty table gives no rows. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import id_and_text, rows_told_apart, shuffle_partitions, slices, stored, text_bytes

TABLE_BYTES = 64 << 20  # contents and members a task's table holds before rows spill
RUN_MEMBERS = 1 << 16  # ids of one run row
MEMBER_BYTES = 40  # an id in a list
RUN_SCHEMA = ("run_id long, digest binary, content binary, best_id long, best_at int, "
              "copies long, members array<long>")
NO_ID = -(1 << 63)  # stands for a null id while ids are compared


class ContentTable:
    """Open addressing with linear probing over whole contents.

    A slot holds an entry number; an entry holds the content itself. The
    digest's first bytes choose the slot, equality is decided on content.
    """

    def __init__(self, room: int):
        self.room = room
        self.clear()

    def clear(self) -> None:
        self.slots = [-1] * 1024
        self.contents: list[bytes] = []
        self.hashes: list[int] = []
        self.used = 0

    def find(self, digest: bytes, content: bytes) -> tuple[int, bool]:
        """The content's entry and whether it is new; -1 if it has no room."""
        h = int.from_bytes(digest[:8], "little")
        mask = len(self.slots) - 1
        at = h & mask
        while (entry := self.slots[at]) >= 0:
            if self.hashes[entry] == h and self.contents[entry] == content:
                return entry, False
            at = (at + 1) & mask
        if self.used and self.used + len(content) > self.room:
            return -1, False
        entry = len(self.contents)
        self.slots[at] = entry
        self.contents.append(content)
        self.hashes.append(h)
        self.used += len(content) + 64
        if 2 * len(self.contents) > len(self.slots):
            self._grow()
        return entry, True

    def _grow(self) -> None:
        size = 4 * len(self.slots)
        self.slots = [-1] * size
        for entry, h in enumerate(self.hashes):
            at = h & (size - 1)
            while self.slots[at] >= 0:
                at = (at + 1) & (size - 1)
            self.slots[at] = entry


def _arrow(columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in columns.values()], list(columns))


def _fold_documents(room: int):
    """Map side: one run row per distinct content of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        first = TaskContext.get().partitionId() << 40
        table, digests, members, made = ContentTable(room), [], [], 0

        def rows(step: int = 2000):
            nonlocal made
            for at in range(0, len(members), step):
                own = members[at:at + step]
                best = [max(range(len(m)), key=lambda i: (NO_ID if m[i] is None else m[i], -i)) for m in own]
                yield _arrow({
                    "run_id": (range(first + made, first + made + len(own)), pa.int64()),
                    "digest": (digests[at:at + step], pa.binary()),
                    "content": (table.contents[at:at + step], pa.binary()),
                    "best_id": ([m[b] for m, b in zip(own, best)], pa.int64()),
                    "best_at": (best, pa.int32()),
                    "copies": ([len(m) for m in own], pa.int64()),
                    "members": (own, pa.list_(pa.int64())),
                })
                made += len(own)

        for batch in batches:
            for part in slices(batch):
                for doc_id, text in zip(part.column(0).to_pylist(), text_bytes(part)):
                    content = text.lower()  # bytes: A-Z only
                    digest = hashlib.sha256(content).digest()
                    entry, new = table.find(digest, content)
                    if entry < 0:
                        yield from rows()
                        table.clear()
                        digests, members = [], []
                        entry, new = table.find(digest, content)
                    if new:
                        digests.append(digest)
                        members.append([])
                    members[entry].append(doc_id)
                    table.used += MEMBER_BYTES
                    if len(members[entry]) >= RUN_MEMBERS or table.used > max(room, len(content) + (RUN_MEMBERS << 6)):
                        yield from rows()
                        table.clear()
                        digests, members = [], []
        yield from rows()

    return run


BUCKET_SCHEMA = ("run_id long, digest binary, content binary, best_id long, best_at int, copies long, "
                 "runs array<long>, best_run long, keep_id long, keep_at int, group_size long")

BUCKET = pa.schema([
    ("run_id", pa.int64()), ("digest", pa.binary()), ("content", pa.binary()), ("best_id", pa.int64()),
    ("best_at", pa.int32()), ("copies", pa.int64()), ("runs", pa.list_(pa.int64())), ("best_run", pa.int64()),
    ("keep_id", pa.int64()), ("keep_at", pa.int32()), ("group_size", pa.int64())])


def _solve_bucket(room: int):
    """Reduce side: resolve what fits, hand the rest on as spill rows.

    A content gets an entry when it is first seen or never, so all its rows
    are resolved here or none is.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ContentTable(room)
        best: list[tuple] = []
        copies: list[int] = []
        runs: list[list[int]] = []
        for batch in batches:
            for part in slices(batch, 1024):
                spill = []
                columns = [part.column(i).to_pylist() for i in range(part.num_columns)]
                for i, (digest, content) in enumerate(zip(columns[1], columns[2])):
                    entry, new = table.find(digest, content)
                    if entry < 0:
                        spill.append(i)
                        continue
                    if new:
                        best.append((NO_ID - 1, 0, 0, None))
                        copies.append(0)
                        runs.append([])
                    best_id = columns[3][i]
                    rank = (NO_ID if best_id is None else best_id, -columns[0][i], -columns[4][i], best_id)
                    best[entry] = max(best[entry], rank, key=lambda r: r[:3])
                    copies[entry] += columns[5][i]
                    runs[entry].extend(columns[6][i])
                if spill:
                    kept = part.take(pa.array(spill))
                    kept = [c.cast(f.type) for c, f in zip(kept.columns, BUCKET)]
                    rest = [pa.nulls(len(spill), f.type) for f in list(BUCKET)[len(kept):]]
                    yield pa.RecordBatch.from_arrays([*kept, *rest], schema=BUCKET)
        for at in range(0, len(best), 2000):
            b = best[at:at + 2000]
            own = {
                "copies": copies[at:at + 2000], "runs": runs[at:at + 2000], "best_run": [-r[1] for r in b],
                "keep_id": [r[3] for r in b], "keep_at": [-r[2] for r in b], "group_size": copies[at:at + 2000],
            }
            yield pa.RecordBatch.from_arrays(
                [pa.array(own.get(f.name, [None] * len(b)), f.type) for f in BUCKET], schema=BUCKET)

    return run


def _fold_spill(room: int):
    """Map side of a deeper level: fold equal contents of spill rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, rows = ContentTable(room), []

        def out():
            for at in range(0, len(rows), 2000):
                own = rows[at:at + 2000]
                yield _arrow({name: ([r[i] for r in own], kind) for i, (name, kind) in enumerate((
                    ("run_id", pa.int64()), ("digest", pa.binary()), ("content", pa.binary()),
                    ("best_id", pa.int64()), ("best_at", pa.int32()), ("copies", pa.int64()),
                    ("runs", pa.list_(pa.int64()))))})

        for batch in batches:
            for part in slices(batch, 1024):
                for row in zip(*(part.column(i).to_pylist() for i in range(part.num_columns))):
                    entry, new = table.find(row[1], row[2])
                    if entry < 0:
                        yield from out()
                        table.clear()
                        rows.clear()
                        entry, new = table.find(row[1], row[2])
                    if new:
                        rows.append(list(row))
                        continue
                    held = rows[entry]
                    rank = [(NO_ID if r[3] is None else r[3], -r[0], -r[4]) for r in (held, row)]
                    if rank[1] > rank[0]:
                        held[0], held[3], held[4] = row[0], row[3], row[4]
                    held[5] += row[5]
                    held[6] = held[6] + row[6]
        yield from out()

    return run


def exact_groups(docs: DataFrame, table_bytes: int = TABLE_BYTES, buckets: int | None = None) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for every row.

    ``table_bytes`` bounds a task's table; ``buckets`` is the number of hash
    partitions a level makes (the session's shuffle partitions if not given).
    Runs at once: it writes runs, spills and results to the shared folder.
    """
    spark = docs.sparkSession
    n = buckets or shuffle_partitions(spark)
    runs = stored(id_and_text(docs).mapInArrow(_fold_documents(table_bytes), RUN_SCHEMA), "exact-runs")
    todo = runs.select("run_id", "digest", "content", "best_id", "best_at", "copies",
                       F.array("run_id").alias("runs"))
    solved, level = [], 0
    while True:
        bucketed = todo.repartition(n, F.xxhash64(F.col("digest"), F.lit(level)))
        out = bucketed.mapInArrow(_solve_bucket(table_bytes), BUCKET_SCHEMA)
        out = stored(out.withColumn("spilled", F.col("group_size").isNull()), f"exact-level{level}")
        solved.append(out.filter(~F.col("spilled")).select("runs", "best_run", "keep_id", "keep_at", "group_size"))
        spilled = out.filter("spilled")
        if spilled.isEmpty():
            break
        todo = spilled.select("run_id", "digest", "content", "best_id", "best_at", "copies", "runs")
        todo = todo.mapInArrow(_fold_spill(table_bytes), ", ".join(BUCKET_SCHEMA.split(", ")[:7]))
        level += 1
    groups = reduce(DataFrame.unionByName, solved).select(
        F.explode("runs").alias("run_id"), "best_run", "keep_id", "keep_at", "group_size")
    rows = runs.select("run_id", "digest", F.posexplode("members").alias("at", "doc_id"))
    # Both sides grow with the corpus: never a broadcast.
    return rows.join(groups.hint("merge"), "run_id").select(
        "doc_id", "keep_id", "group_size",
        ((F.col("run_id") == F.col("best_run")) & (F.col("at") == F.col("keep_at"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def drop_copies(docs: DataFrame, **options) -> DataFrame:
    """One row of ``docs`` for each group of ``exact_groups``, all columns.

    A row is told by its id and text, A-Z lower-cased; of rows that repeat
    both, the smallest stays.
    """
    return rows_told_apart(docs, exact_groups(docs, **options).filter("kept"))
