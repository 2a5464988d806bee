"""Packing documents into training sequences by multiway differencing.

Documents are tokenized whole and cut into pieces of at most ``piece``
tokens. A task gathers pieces into blocks; each block is divided into
windows by Karmarkar-Karp multiway differencing: every piece starts as a
partial partition, and the two partitions with the largest imbalance are
merged again and again, the larger parts of one with the smaller parts of
the other, until one partition of near-equal windows is left. If a window
exceeds the capacity, the block is divided again into one window more.

A block is closed when its tokens nearly fill ``windows`` sequences; the
piece that crosses this line is cut there (documents may be cut freely), so
near-equal windows are near-full ones. Full sequences of a document longer
than a sequence are cut off first and need no packing.

Rows: one per piece, ``doc_id, start`` (its document's tokens before it),
``length, ids`` (little-endian unsigned 32-bit), ``doc_tokens, sequence_id,
offset`` (its place there, gapless from 0). Every token of every document is
in exactly one piece. Null text counts as empty; an empty document has the
end id alone. Null and repeated ids are kept: each row is a document of its
own. An empty table gives no rows. Nothing is shuffled.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import id_and_text, slices
from tillroll.llm.tokens import encoder

SEQUENCE = 1024
PIECE = 256
WINDOWS = 64  # sequences of a block
PIECE_SCHEMA = ("doc_id long, start long, length long, ids binary, doc_tokens long, "
                "sequence_id long, offset long")


def differencing(sizes: list[int], ways: int) -> list[list[int]]:
    """Divides item numbers into ``ways`` windows of near-equal size.

    A partial partition is its parts in falling order of size. Parts hold
    the numbers of the partitions merged into them; their items are read
    off at the end. Ties go by item number, so the result is fixed.
    """
    if not sizes:
        return [[] for _ in range(ways)]
    heap = []
    for i, size in enumerate(sizes):
        sums = np.zeros(ways, np.int64)
        sums[0] = size
        heap.append((-size, i, sums, [(i,)] + [()] * (ways - 1)))
    heapq.heapify(heap)
    while len(heap) > 1:
        _, tie, a, parts_a = heapq.heappop(heap)
        _, _, b, parts_b = heapq.heappop(heap)
        sums = a + b[::-1]  # the largest of one with the smallest of the other
        parts = [x + y if x and y else x or y for x, y in zip(parts_a, reversed(parts_b))]
        order = np.argsort(-sums, kind="stable")
        sums = sums[order]
        sums_low = int(sums[-1])
        heapq.heappush(heap, (sums_low - int(sums[0]), tie, sums, [parts[k] for k in order]))
    return [list(p) for p in heap[0][3]]


def windows_of(sizes: list[int], capacity: int, least: int = 1) -> list[list[int]]:
    """Windows of at most ``capacity``; their number rises until all fit, from
    the fewest that can hold all or from ``least``."""
    ways = max(1, least, -(-sum(sizes) // capacity))
    while True:
        windows = differencing(sizes, ways)
        if all(sum(sizes[i] for i in w) <= capacity for w in windows):
            return [w for w in windows if w]
        ways += 1


class _Block:
    def __init__(self, sequence: int, piece: int, windows: int):
        self.sequence, self.piece, self.full = sequence, piece, windows
        # A little room per window, as near-equal windows differ by a few tokens.
        self.goal = windows * (sequence - max(1, piece // 16))
        self.clear()

    def clear(self) -> None:
        self.rows: list[tuple] = []
        self.tokens = 0

    def windows(self) -> list[list[tuple]]:
        # A full block has room in that many windows, and no room in fewer.
        found = windows_of([r[2] for r in self.rows], self.sequence, self.full if self.tokens == self.goal else 1)
        return [[self.rows[i] for i in w] for w in found]


def _pack(tokenizer_path: str, end_id: int, sequence: int, piece: int, windows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, block = encoder(tokenizer_path), _Block(sequence, piece, windows)
        end = np.asarray([end_id], "<u4").tobytes()
        number, out = TaskContext.get().partitionId() << 40, []

        def close(window: list[tuple]) -> None:
            nonlocal number
            offset = 0
            for doc_id, start, length, ids, doc_tokens in sorted(window, key=lambda r: -r[2]):
                out.append((doc_id, start, length, ids, doc_tokens, number, offset))
                offset += length
            number += 1

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out))
            out.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.binary() if i == 3 else pa.int64()) for i, c in enumerate(columns)],
                ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

        for batch in batches:
            for rows in slices(batch, 1024):
                for doc_id, ids in zip(rows.column(0).to_pylist(), encode(rows.column(1).to_pylist())):
                    ids += end
                    n = len(ids) // 4
                    tail = n // sequence * sequence
                    for at in range(0, tail, sequence):
                        close([(doc_id, at, sequence, ids[4 * at:4 * (at + sequence)], n)])
                    while tail < n:
                        length = min(piece, n - tail, block.goal - block.tokens)
                        block.rows.append((doc_id, tail, length, ids[4 * tail:4 * (tail + length)], n))
                        block.tokens += length
                        tail += length
                        if block.tokens == block.goal:
                            for window in block.windows():
                                close(window)
                            block.clear()
                if out:
                    yield flush()
        for window in block.windows() if block.rows else []:
            close(window)
        if out:
            yield flush()

    return run


def pack(docs: DataFrame, tokenizer_path: str, end_id: int, sequence: int = SEQUENCE, piece: int = PIECE,
         windows: int = WINDOWS) -> DataFrame:
    """The pieces of all documents, packed into sequences of ``sequence``."""
    return id_and_text(docs).mapInArrow(_pack(tokenizer_path, end_id, sequence, piece, windows), PIECE_SCHEMA)


def sequences(pieces: DataFrame) -> DataFrame:
    """One row per sequence: ``sequence_id, length, ids`` in offset order.

    A sequence has at most ``sequence`` tokens, so groups are bounded.
    """
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(ordered, F.unhex(F.lit("")), lambda whole, p: F.concat(whole, p["ids"]))
    return pieces.groupBy("sequence_id").agg(F.sum("length").alias("length"), joined.alias("ids"))


def with_checksums(pieces: DataFrame) -> DataFrame:
    """Replaces ``ids`` by ``ids_crc32`` (unsigned CRC-32 of those bytes)."""
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
