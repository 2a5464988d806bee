"""Duplicate passages by relative Lempel-Ziv parsing.

Method
------
1. *Index.* Every slice of a task's texts is a reference block. Each window of
   ``WINDOW`` words has an anchor, the smallest hash among its runs of
   ``GRAM`` words (the last of equal ones); windows next to each other mostly
   share theirs. A block's index has one entry for each stretch of windows
   with one anchor: the anchor, a hash of all words of the stretch and the
   place. Of equal entries of a block only the first is sent on; the others
   are copies already.
2. *Lookup.* All blocks' entries meet by anchor, sorted, in a stream that
   holds no group. An anchor of one place has no copies. A stretch that also
   starts earlier is a copy, whole. The first of each kind of stretch is
   handed to the boundary check if its anchor has other kinds too.
3. *Boundaries.* A copied passage begins and ends inside a stretch, so
   stretches with a known anchor but other words are checked window by
   window, against all other such stretches, by the windows' own hashes.
4. *Factors.* A text is parsed from left to right: a factor starts at a word
   whose window has an earlier occurrence and goes on while the following
   windows' earlier occurrences follow in the same reference document; where
   it ends, the next one is looked up. Factors have ``WINDOW`` words or more.

Texts are shuffled to their factors once; only those with stretches to check
go through a second, small exchange.

Results
-------
A window is a copy if its words also start earlier: at a smaller ``doc_id``,
or earlier in the same document. A null id is smaller than any other. Rows
that repeat id and text are one document and get the same result; other rows
with one id are ordered by a hash of the text. Null and empty texts have no
words; texts of under ``WINDOW`` words have no windows. Texts of any length
are read in parts. An empty table gives no rows. Only ``doc_id`` and ``text``
are read. Equal sequences are told by two 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import id_and_text, shuffle_partitions, slices, stored, text_bytes
from tillroll.llm.words import WHITE, chained, mix, powers

WINDOW = 20  # fixed value: words of a window
GRAM = 6  # words of an anchor
CHUNK = 1 << 19  # words worked on at once
NO_ID = -(1 << 63)

_R = np.uint64(0x2545F4914F6CDD1D)
_R_BACK = np.uint64(pow(int(_R), -1, 1 << 64))
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def grams(words: np.ndarray, size: int = GRAM) -> np.ndarray:
    """Hashes of all runs of ``size`` words."""
    n = len(words) - size + 1
    found = mix(words[:n])
    for j in range(1, size):
        found = chained(found, words[j:j + n])
    return found


def anchors(hashes: np.ndarray, reach: int) -> np.ndarray:
    """For each start, the place of the smallest of ``reach`` hashes from
    there on, the last of equal ones."""
    places = np.arange(len(hashes))

    def smaller(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.where(hashes[b] <= hashes[a], b, a)

    width = 1
    while 2 * width <= reach:
        places = smaller(places[:len(places) - width], places[width:])
        width *= 2
    if width < reach:
        places = smaller(places[:len(places) - (reach - width)], places[reach - width:])
    return places


class Sequences:
    """Hashes of any run of a word array, from prefix sums."""

    def __init__(self, words: np.ndarray):
        self.back = powers(_R_BACK, len(words) + 1)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * powers(_R, len(words)), dtype=np.uint64)])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        length = (ends - starts).astype(np.uint64)
        return mix((self.sums[ends] - self.sums[starts]) * self.back[starts] + length * _GOLD)


def stretches(words: np.ndarray, ends: np.ndarray):
    """Index entries of several documents' words, ``ends`` being where each
    document ends: anchor hash, sequence hash, first window, windows."""
    n = len(words)
    if n < WINDOW:
        return tuple(np.empty(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64))
    own = grams(words)
    place = anchors(own, WINDOW - GRAM + 1)
    inside = np.ones(len(place), bool)
    for j in range(1, WINDOW):  # windows that run over a document's end
        late = ends - j
        inside[late[(late >= 0) & (late < len(place))]] = False
    new = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (inside[1:] != inside[:-1])]))
    last = np.append(new[1:], len(place))
    keep = inside[new]
    new, last = new[keep], last[keep]
    return own[place[new]], Sequences(words).of(new, last + WINDOW - 1), new, last - new


# -- 1: index ---------------------------------------------------------------------

ENTRIES = ("route long, known boolean, anchor long, whole long, doc_id long, tie long, start int, windows int, "
           "ref_id long, ref_start int")
ENTRY = pa.schema([("route", pa.int64()), ("known", pa.bool_()), ("anchor", pa.int64()), ("whole", pa.int64()),
                   ("doc_id", pa.int64()), ("tie", pa.int64()), ("start", pa.int32()), ("windows", pa.int32()),
                   ("ref_id", pa.int64()), ("ref_start", pa.int32())])


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Id, tie and word hashes (a part at a time, with the offset of its
    first word; a part repeats the last ``WINDOW - 1`` words before it)."""
    for batch in batches:
        for part in slices(batch):
            for doc_id, tie, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), text_bytes(part)):
                held, at, n = [], 0, 0
                for hashes, _, _ in WHITE.words(text):
                    held.append(hashes)
                    n += len(hashes)
                    if n >= CHUNK:
                        own = np.concatenate(held)
                        yield doc_id, tie, at, own
                        at += n - (WINDOW - 1)
                        held, n = [own[-(WINDOW - 1):]], WINDOW - 1
                if n:
                    yield doc_id, tie, at, np.concatenate(held)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    block, n = [], 0
    for own in _documents(batches):
        block.append(own)
        n += len(own[3])
        if n >= CHUNK:
            yield block
            block, n = [], 0
    if block:
        yield block


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A block's entries: the first of equal ones for the lookup, the others
    as copies already (routed by place, not by anchor)."""
    for block in _blocks(batches):
        sizes = np.array([len(words) for *_, words in block])
        ends = np.cumsum(sizes)
        anchor, whole, first, windows = stretches(np.concatenate([words for *_, words in block]), ends)
        if not len(anchor):
            continue
        member = np.searchsorted(ends, first, "right")
        ids = np.array([NO_ID if d is None else d for d, *_ in block], np.int64)[member]
        ties = np.array([t for _, t, *_ in block], np.int64)[member]
        start = first - (ends - sizes)[member] + np.array([at for _, _, at, _ in block])[member]
        order = np.lexsort((start, ties, ids, whole, anchor))
        anchor, whole, ids, ties = anchor[order], whole[order], ids[order], ties[order]
        start, windows = start[order], windows[order]
        known = np.concatenate([[False], (anchor[1:] == anchor[:-1]) & (whole[1:] == whole[:-1])])
        owner = np.maximum.accumulate(np.where(known, 0, np.arange(len(known))))
        # Equal places are one document given twice: no copy of itself.
        known &= (ids != ids[owner]) | (ties != ties[owner]) | (start != start[owner])
        # A copy tells the others of its anchor only through the first entry.
        route = np.where(known, mix(ids.view(np.uint64) + start.astype(np.uint64) * _GOLD).view(np.int64),
                         anchor.view(np.int64))
        for at in range(0, len(route), 65536):
            s = slice(at, at + 65536)
            yield pa.RecordBatch.from_arrays(
                [pa.array(route[s]), pa.array(known[s]), pa.array(anchor[s].view(np.int64)),
                 pa.array(whole[s].view(np.int64)), pa.array(ids[s]), pa.array(ties[s]),
                 pa.array(start[s].astype(np.int32)), pa.array(windows[s].astype(np.int32)),
                 pa.array(ids[owner[s]], mask=~known[s]),
                 pa.array(start[owner[s]].astype(np.int32), mask=~known[s])], schema=ENTRY)


# -- 2: lookup ---------------------------------------------------------------------

FOUND = ("doc_id long, tie long, start int, windows int, anchor long, copy boolean, "
         "ref_id long, ref_start int")


def _found(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.bool_(), pa.int64(), pa.int32()]
    columns = list(zip(*rows))
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                      [f.split()[0] for f in FOUND.split(", ")])


def _lookup(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries sorted by route, anchor, whole and place, as a stream. Of each
    kind of stretch the first place is held until the next kind or anchor
    tells whether it must be checked."""
    anchor = whole = first = None  # of the running kind
    kinds, out = 0, []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = {f.name: batch.column(i) for i, f in enumerate(ENTRY)}
        a = columns["anchor"].to_numpy()
        equal = a[1:] == a[:-1]
        # Most anchors have one place; those at a batch's ends may go on in the next one.
        todo = np.concatenate([[True], equal]) | np.concatenate([equal, [True]]) | columns["known"].to_numpy(
            zero_copy_only=False)
        rows = [columns[f.name].filter(pa.array(todo)).to_pylist() for f in ENTRY][1:]
        for known, own, kind, doc_id, tie, start, windows, ref_id, ref_start in zip(*rows):
            place = (doc_id, tie, start, windows, own)
            if known:
                out.append((*place, True, ref_id, ref_start))
            elif own != anchor:
                if kinds > 1:
                    out.append((*first, False, None, None))
                anchor, whole, first, kinds = own, kind, place, 1
            elif kind != whole:
                out.append((*first, False, None, None))
                whole, first, kinds = kind, place, kinds + 1
            elif place[:3] != first[:3]:
                out.append((*place, True, first[0], first[2]))
            if len(out) >= 20000:
                yield _found(out)
                out = []
    if kinds > 1:
        out.append((*first, False, None, None))
    if out:
        yield _found(out)


# -- 3 and 4: boundaries and factors -----------------------------------------------

class Parse:
    """A document's copied windows and what they refer to."""

    def __init__(self, n_words: int):
        self.n = n_words
        self.copy = np.zeros(max(0, n_words - WINDOW + 1), bool)
        self.ref_id = np.zeros(len(self.copy), np.int64)
        self.ref_start = np.zeros(len(self.copy), np.int64)

    def add(self, start: np.ndarray, windows: np.ndarray, ref_id: np.ndarray, ref_start: np.ndarray) -> None:
        """Stretches of copied windows."""
        total = int(windows.sum())
        step = np.arange(total) - np.repeat(np.cumsum(windows) - windows, windows)
        at = np.repeat(start, windows) + step
        self.copy[at] = True
        self.ref_id[at] = np.repeat(ref_id, windows)
        self.ref_start[at] = np.repeat(ref_start, windows) + step

    def covered(self) -> np.ndarray:
        """Which words a copied window covers."""
        change = np.zeros(self.n + 1, np.int64)
        at = np.flatnonzero(self.copy)
        change[at] += 1
        change[at + WINDOW] -= 1
        return np.cumsum(change[:-1]) > 0

    def factors(self) -> list[tuple[int, int, int, int]]:
        """``start, length, ref_id, ref_start``, left to right, not
        overlapping: a factor goes on while its reference does."""
        at = np.flatnonzero(self.copy)
        if not len(at):
            return []
        new = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1] + 1)
                                             | (self.ref_id[at[1:]] != self.ref_id[at[:-1]])
                                             | (self.ref_start[at[1:]] != self.ref_start[at[:-1]] + 1)]))
        last = np.append(new[1:], len(at)) - 1
        out, done = [], 0
        for a, b in zip(at[new].tolist(), (at[last] + WINDOW).tolist()):
            begin = max(a, done)
            if b > begin:
                out.append((begin, b - begin, int(self.ref_id[a]), int(self.ref_start[a]) + begin - a))
                done = b
        return out


def _kept(text: bytes, removed: np.ndarray | None) -> tuple[str, list[bytes]]:
    """Digest of the words that stay, joined by a space, and their text part by part."""
    sha, at, parts = hashlib.sha256(), 0, []
    for _, part in WHITE.parts(text):
        words = part.split()  # splits bytes at the six signs of WHITE
        if removed is not None:
            stay = ~removed[at:at + len(words)]
            at += len(words)
            words = [w for w, s in zip(words, stay.tolist()) if s]
        if words:
            piece = b" ".join(words)
            if parts:
                sha.update(b" ")
            sha.update(piece)
            parts.append(piece)
    return sha.hexdigest(), parts


def _count(text: bytes) -> int:
    return sum(len(part.split()) for _, part in WHITE.parts(text))


FACTORS = "array<struct<start:int,length:int,ref_id:long,ref_start:int>>"
DONE = f"n_words long, n_removed long, kept_sha256 string, kept string, factors {FACTORS}"
OPEN = "text string, copies array<long>, checks array<struct<anchor:long,whole:long,start:int>>"
_FACTORS = pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32()), ("ref_id", pa.int64()),
                               ("ref_start", pa.int32())]))
_CHECKS = pa.list_(pa.struct([("anchor", pa.int64()), ("whole", pa.int64()), ("start", pa.int32())]))
_HEAD = [("doc_id", pa.int64()), ("tie", pa.int64())]
_DONE = [("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.string()),
         ("factors", _FACTORS)]
_OPEN = [("text", pa.string()), ("copies", pa.list_(pa.int64())), ("checks", _CHECKS)]


def _result(text: bytes, parse: Parse | None, full: bool) -> tuple:
    """The columns of DONE; texts and factors only where asked for."""
    if parse is None or not parse.copy.any():
        sha, parts = _kept(text, None)
        n = sum(p.count(b" ") + 1 for p in parts)
        return n, 0, sha, (b" ".join(parts).decode() if full else None), ([] if full else None)
    removed = parse.covered()
    sha, parts = _kept(text, removed)
    return (parse.n, int(removed.sum()), sha, b" ".join(parts).decode() if full else None,
            parse.factors() if full else None)


def _as_rows(rows: list[tuple], schema: list) -> pa.RecordBatch:
    columns = list(zip(*rows))
    return pa.RecordBatch.from_arrays(
        [pa.array([[dict(zip(("start", "length", "ref_id", "ref_start"), f)) for f in v] if v is not None else None
                   for v in c] if k == _FACTORS else c, k) for c, (_, k) in zip(columns, schema)],
        schema=pa.schema(schema))


def _entries(column: pa.Array, i: int) -> dict[str, np.ndarray]:
    """A row's list of structs as arrays."""
    own = column[i].values
    return {own.type.field(j).name: own.field(j).to_numpy(zero_copy_only=False) for j in range(own.type.num_fields)}


def _check(full: bool):
    """Documents with their stretches: results where all is known, else the
    text, its copies so far and the windows to check."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = _HEAD + _DONE + _OPEN
        for batch in batches:
            for part in slices(batch):
                found = part.column(3)
                rows = []
                for i, text in enumerate(text_bytes(part)):
                    head = (part.column(0)[i].as_py(), part.column(1)[i].as_py())
                    if not found[i].is_valid:
                        rows.append((*head, *_result(text, None, full), None, None, None))
                        continue
                    own = _entries(found, i)
                    copy = own["copy"].astype(bool)
                    told = [own[c][copy].astype(np.int64) for c in ("start", "windows", "ref_id", "ref_start")]
                    if copy.all():
                        parse = Parse(_count(text))
                        parse.add(*told)
                        rows.append((*head, *_result(text, parse, full), None, None, None))
                        continue
                    checks = _windows(text, own["start"][~copy].astype(np.int64),
                                      own["windows"][~copy].astype(np.int64), own["anchor"][~copy])
                    rows.append((*head, *[None] * len(_DONE), text.decode(),
                                 np.concatenate(told).tolist(), checks))
                yield _as_rows(rows, schema)

    return run


def _windows(text: bytes, start: np.ndarray, windows: np.ndarray, anchor: np.ndarray) -> list[dict]:
    """Anchor, hash and start of the windows of some stretches."""
    order = np.argsort(start, kind="stable")
    start, windows, anchor = start[order], windows[order], anchor[order]
    held, at, n, out = [], 0, 0, []

    def take(own: np.ndarray, at: int) -> None:
        """The windows that start in the part at hand, not in its overlap."""
        first = np.repeat(start, windows) + np.arange(int(windows.sum())) - np.repeat(
            np.cumsum(windows) - windows, windows)
        inside = (first >= at) & (first + WINDOW <= at + len(own))
        first, anchors_of = first[inside], np.repeat(anchor, windows)[inside]
        if len(first):
            hashes = Sequences(own).of(first - at, first - at + WINDOW).view(np.int64)
            out.extend(dict(anchor=a, whole=h, start=f) for a, h, f in zip(
                anchors_of.tolist(), hashes.tolist(), first.tolist()))

    for hashes, _, _ in WHITE.words(text):
        held.append(hashes)
        n += len(hashes)
        if n >= CHUNK:
            own = np.concatenate(held)
            take(own, at)
            at += n - (WINDOW - 1)
            held, n = [own[-(WINDOW - 1):]], WINDOW - 1
    if n:
        take(np.concatenate(held), at)
    return out


def _close(full: bool):
    """Open documents with the windows that proved to be copies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                rows = []
                for i, text in enumerate(text_bytes(part)):
                    parse = Parse(_count(text))
                    told = part.column(3)[i].values.to_numpy(zero_copy_only=False).reshape(4, -1)
                    parse.add(*told)
                    if part.column(4)[i].is_valid:
                        own = _entries(part.column(4), i)
                        start = own["start"].astype(np.int64)
                        parse.add(start, np.ones(len(start), np.int64), own["ref_id"], own["ref_start"].astype(np.int64))
                    rows.append((part.column(0)[i].as_py(), part.column(1)[i].as_py(), *_result(text, parse, full)))
                yield _as_rows(rows, _HEAD + _DONE)

    return run


def parsed(docs: DataFrame, full: bool = True) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256, kept, factors`` for every
    row; ``kept`` (the words that stay) and ``factors`` (``start, length,
    ref_id, ref_start`` in words) are null unless ``full``."""
    rows = id_and_text(docs)
    key = F.coalesce(F.col("doc_id"), F.lit(NO_ID))
    repeated = rows.groupBy(key.alias("d")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    tie = F.lit(0).cast("long") if repeated.isEmpty() else F.xxhash64("text")
    rows = rows.select(key.alias("doc_id"), tie.alias("tie"), "text")
    parts = max(shuffle_partitions(docs.sparkSession), 1)
    entries = rows.mapInArrow(_index, ENTRIES).repartition(parts, "route").sortWithinPartitions(
        "route", "anchor", "whole", "doc_id", "tie", "start")
    place = F.struct("start", "windows", "anchor", "copy", "ref_id", "ref_start")
    found = entries.mapInArrow(_lookup, FOUND).groupBy("doc_id", "tie").agg(F.collect_list(place).alias("found"))
    head = "doc_id long, tie long"
    checked = rows.join(found.hint("merge"), ["doc_id", "tie"], "left").select("doc_id", "tie", "text", "found")
    checked = stored(checked.mapInArrow(_check(full), f"{head}, {DONE}, {OPEN}"), "parse-checked")
    opened = checked.where("text IS NOT NULL")
    windows = opened.select("doc_id", "tie", F.explode("checks").alias("w")).select("doc_id", "tie", "w.*")
    earliest = windows.groupBy("anchor", "whole").agg(
        F.min(F.struct("doc_id", "tie", "start")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    copies = windows.join(earliest.hint("merge"), ["anchor", "whole"]).where(
        F.struct("doc_id", "tie", "start") > F.col("first"))
    copies = copies.groupBy("doc_id", "tie").agg(F.collect_list(F.struct(
        "start", F.col("first.doc_id").alias("ref_id"), F.col("first.start").alias("ref_start"))).alias("more"))
    closed = opened.select("doc_id", "tie", "text", "copies").join(copies.hint("merge"), ["doc_id", "tie"], "left")
    closed = closed.mapInArrow(_close(full), f"{head}, {DONE}")
    every = checked.where("text IS NULL").select(closed.columns).unionByName(closed)
    told = F.when(F.col("doc_id") != NO_ID, F.col("doc_id"))
    return every.select(told.alias("doc_id"), "n_words", "n_removed", "kept_sha256", "kept", "factors")


def removal_digest(docs: DataFrame) -> DataFrame:
    """The columns of op12."""
    return parsed(docs, full=False).select("doc_id", "n_words", "n_removed", "kept_sha256")
