"""Near-duplicate groups with HyperMinHash sketches.

Method
------
1. A document's set is its distinct ``k``-word shingles as 64-bit hashes
   (fewer words: the whole sequence as one; none: the empty set, linked with
   nothing). Documents with equal sets become one *node*.
2. A node's sketch has 256 registers. A shingle's second hash picks the
   register; the smallest remaining hash there is stored as its count of
   leading zeros and the ten bits behind its first one. Empty registers stay
   empty in the sketch; for banding they borrow a filled one (densification).
3. Bands of compressed registers are the candidate keys. Rows per band are
   chosen so that a pair at the threshold is missed with a probability of at
   most ``MISS``.
4. A bucket is not expanded into all pairs. First, every member is compared
   with the bucket's smallest member. Links found make components. Buckets
   whose members are of several components then join into families. In a
   family, the documents outside its largest component are compared with all
   others, in blocks of at most about ``BLOCK`` documents a side: each other
   pair of the family is known to be connected. Blocks emit links that join
   components, never pairs.
5. A candidate pair's Jaccard coefficient is estimated from the registers,
   corrected for chance collisions of compressed values. Pairs below the
   threshold by more than five standard errors end there; all others are
   confirmed on their full sets.
6. Components of the links, by large-star and small-star contraction.

Results: one row per row, ``doc_id, n_shingles, component_id`` (smallest
``doc_id`` reachable), ``kept``. Null text counts as empty. Rows with a null
id take part through equal sets only; alone, they have a null component and
are kept. Rows that repeat an id count as one document of several sets. Very
long texts are hashed in pieces. An empty table gives no rows; other columns
are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import id_and_text, rows_told_apart, slices, stored, text_bytes

REGISTERS = 256
MANTISSA = 10
EMPTY = 0xFFFF
# Fixed value: the limit of HyperMinHash's expected collisions per register.
COLLISIONS = 0.16991948715973909 / 2 ** MANTISSA
MISS = 1e-5
BLOCK = 1000  # documents of a block of a family

_GOLD = np.uint64(0x9E3779B97F4A7C15)
_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * _GOLD)
_BYTES[_WHITE] = 0


def _powers(n: int) -> np.ndarray:
    steps = np.full(n, 0x2545F4914F6CDD1D, np.uint64)
    steps[0] = 1
    return np.cumprod(steps)


def word_hashes(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of each white-space separated word."""
    signs = np.frombuffer(text, np.uint8)
    white = _WHITE[signs]
    begins = np.flatnonzero(~white & np.concatenate([[True], white[:-1]]))
    if not len(begins):
        return np.empty(0, np.uint64), begins
    signs = signs[begins[0]:]
    spans = np.diff(np.append(begins, begins[0] + len(signs)))
    place = np.arange(len(signs)) - np.repeat(begins - begins[0], spans)
    values = _BYTES[signs] * _powers(int(spans.max()))[place]
    return mix(np.add.reduceat(values, begins - begins[0])), begins


def _pieces(text: bytes, most: int = 1 << 20) -> Iterator[bytes]:
    """The text in pieces that end at white space, of about ``most`` bytes."""
    at = 0
    while len(text) - at > 2 * most:
        end = text.find(b" ", at + most)
        if end < 0:
            break
        yield text[at:end]
        at = end
    yield text[at:]


def shingle_set(words: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct shingle hashes of a document's word hashes."""
    if not len(words):
        return words
    width = min(k, len(words))
    n = len(words) - width + 1
    found = np.full(n, width, np.uint64)
    for j in range(width):
        found = mix(found * _GOLD + words[j:j + n])
    return np.unique(found)


def sets_of(texts: list[bytes], k: int) -> list[np.ndarray]:
    """Shingle sets of texts, A-Z lower-cased."""
    whole = b" ".join(texts).lower()
    hashed, begins, at = [], [], 0
    for piece in _pieces(whole):
        words, first = word_hashes(piece)
        hashed.append(words)
        begins.append(first + at)
        at += len(piece)
    words, begins = np.concatenate(hashed), np.concatenate(begins)
    starts = np.cumsum([0] + [len(t) + 1 for t in texts])
    cuts = np.searchsorted(begins, starts)
    return [shingle_set(words[a:b], k) for a, b in zip(cuts[:-1], cuts[1:])]


_PROBES = (mix(np.arange(400 * REGISTERS, dtype=np.uint64) * _GOLD) % np.uint64(REGISTERS)).astype(
    np.int64).reshape(400, REGISTERS)


def sketch(shingles: np.ndarray) -> np.ndarray:
    """Registers: leading zeros and mantissa of the smallest hash, or EMPTY."""
    own = np.sort(mix(shingles ^ _GOLD))
    place = (own >> np.uint64(56)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    rest = own[first] << np.uint64(8)  # 56 bits, left-aligned
    top = np.floor(np.log2(np.maximum(rest, np.uint64(1)).astype(np.float64))).astype(np.int64)
    top = np.where((rest >> np.minimum(top, 63).astype(np.uint64)) == 0, top - 1, top)  # rounding of the float
    zeros = np.minimum(63 - top, 57)
    behind = (rest << np.minimum(zeros + 1, 63).astype(np.uint64)) >> np.uint64(64 - MANTISSA)
    registers = np.full(REGISTERS, EMPTY, np.uint16)
    registers[place[first]] = (zeros.astype(np.uint64) << np.uint64(MANTISSA) | behind).astype(np.uint16)
    return registers


def densified(registers: np.ndarray) -> np.ndarray:
    """Empty registers borrow from a filled one, by a fixed order of probes."""
    if not (registers == EMPTY).any():
        return registers
    out = registers.copy()
    for probe in _PROBES:
        empty = np.flatnonzero(out == EMPTY)
        if not len(empty):
            return out
        out[empty] = registers[probe[empty]]
    out[out == EMPTY] = registers[registers != EMPTY].min()
    return out


def band_rows(threshold: float, miss: float = MISS) -> int:
    """The most registers per band that miss a pair at the threshold with a
    probability of at most ``miss``."""
    return max([1, *(r for r in range(1, 33) if (1 - threshold ** r) ** (REGISTERS // r) <= miss)])


def band_keys(registers: np.ndarray, rows: int) -> np.ndarray:
    bands = REGISTERS // rows
    cut = densified(registers)[:bands * rows].reshape(bands, rows).astype(np.uint64)
    keys = mix(np.arange(1, bands + 1, dtype=np.uint64) * _GOLD)
    for j in range(rows):
        keys = mix(keys + cut[:, j] * _GOLD + np.uint64(j))
    return keys.view(np.int64)


def estimate(a: np.ndarray, b: np.ndarray, n_a: int, n_b: int) -> tuple[float, int]:
    """Jaccard estimate of two sketches, less the expected chance collisions
    of compressed registers, and the number of registers it rests on."""
    used = (a != EMPTY) | (b != EMPTY)
    filled = int(used.sum())
    if not filled:
        return 0.0, 0
    equal = int(((a == b) & used).sum())
    ratio = max(n_a, n_b) / max(1, min(n_a, n_b))
    chance = COLLISIONS * filled * 4 * ratio / (1 + ratio) ** 2
    return max(0.0, (equal - chance) / filled), filled


NODE = "doc_id long, n_shingles long, digest binary, registers binary, bands array<long>, text_sha256 string"


def _sketch_batches(k: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            for part in slices(batch):
                texts = text_bytes(part)
                sets = sets_of(texts, k)
                sketches = [sketch(s) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays([
                    part.column(0),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                    pa.array([None if s is None else s.tobytes() for s in sketches], pa.binary()),
                    pa.array([None if s is None else band_keys(s, rows) for s in sketches], pa.list_(pa.int64())),
                    pa.array([hashlib.sha256(t.lower()).hexdigest() for t in texts], pa.string()),
                ], ["doc_id", "n_shingles", "digest", "registers", "bands", "text_sha256"])

    return run


def least_estimate(threshold: float, filled):
    """Estimates below this rule the threshold out, by five standard errors."""
    return threshold - 5 * (threshold * (1 - threshold) / np.maximum(1, filled)) ** 0.5


def _likely(threshold: float):
    """Pairs whose estimate does not rule the threshold out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, n_a, n_b, left, right = (batch.column(i).to_pylist() for i in range(6))
            keep = []
            for i in range(len(a)):
                small, large = sorted((n_a[i], n_b[i]))
                if small < threshold * large * (1 - 1e-9):  # no such pair reaches the threshold
                    continue
                found, filled = estimate(np.frombuffer(left[i], np.uint16), np.frombuffer(right[i], np.uint16),
                                         n_a[i], n_b[i])
                if found >= least_estimate(threshold, filled):
                    keep.append(i)
            chosen = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(chosen), batch.column(1).take(chosen)], ["a", "b"])

    return run


def _family_links(k: int, percent: int):
    """Links of a block of a family that join components: its documents
    with ``outside`` against its others. Exact sizes of intersections come
    from an index of the others' shingles."""

    def run(table: pa.Table) -> pa.Table:
        threshold = percent / 100
        ids = table.column("node").to_pylist()
        components = table.column("component").to_pylist()
        outside = table.column("outside").to_pylist()
        sets: list[np.ndarray] = []
        for batch in table.select(["text"]).to_batches():
            for part in slices(batch):
                sets += sets_of(text_bytes(part), k)
        inner = [i for i, o in enumerate(outside) if not o]
        sizes = np.array([len(sets[i]) for i in inner], np.int64)
        registers = np.stack([sketch(sets[i]) for i in inner]) if inner else np.empty((0, REGISTERS), np.uint16)
        owner = np.repeat(np.arange(len(inner)), sizes)
        shingles = np.concatenate([sets[i] for i in inner]) if inner else np.empty(0, np.uint64)
        order = np.argsort(shingles, kind="stable")
        owner, shingles = owner[order], shingles[order]
        group = {c: c for c in components}

        def root(c):
            while group[c] != c:
                group[c] = group[group[c]]
                c = group[c]
            return c

        links = []
        for i in (i for i, o in enumerate(outside) if o):
            own = sketch(sets[i])
            filled = ((registers != EMPTY) | (own != EMPTY)).sum(1)
            equal = ((registers == own) & (own != EMPTY)).sum(1)
            ratio = np.maximum(sizes, len(sets[i])) / np.maximum(1, np.minimum(sizes, len(sets[i])))
            chance = COLLISIONS * filled * 4 * ratio / (1 + ratio) ** 2
            likely = (equal - chance) / np.maximum(1, filled) >= least_estimate(threshold, filled)
            if not likely.any():
                continue
            begin, end = np.searchsorted(shingles, sets[i], "left"), np.searchsorted(shingles, sets[i], "right")
            spans = end - begin
            at = np.repeat(begin - (np.cumsum(spans) - spans), spans) + np.arange(int(spans.sum()))
            common = np.bincount(owner[at], minlength=len(inner))
            linked = likely & (100 * common >= percent * (sizes + len(sets[i]) - common))
            for j in np.flatnonzero(linked).tolist():
                x, y = root(components[i]), root(components[inner[j]])
                if x != y:
                    group[x] = y
                    links.append((ids[i], ids[inner[j]]))
        return pa.table([pa.array([x[n] for x in links], pa.int64()) for n in (0, 1)], ["a", "b"])

    return run


def _confirm(k: int, percent: int):
    """Pairs whose full sets reach the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for part in slices(batch, 64):
                ids = [part.column(i).to_pylist() for i in range(2)]
                sets = [sets_of(text_bytes(part, name), k) for name in ("left", "right")]
                keep = []
                for i, (x, y) in enumerate(zip(*sets)):
                    common = len(np.intersect1d(x, y, assume_unique=True))
                    if len(x) and 100 * common >= percent * (len(x) + len(y) - common):
                        keep.append(i)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids[j][i] for i in keep], pa.int64()) for j in range(2)], ["a", "b"])
        held.clear()

    return run


def components(links: DataFrame) -> DataFrame:
    """``node, component`` (smallest node reachable) of the linked nodes."""
    def lowest(edges: DataFrame) -> DataFrame:
        return edges.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))

    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(lowest(both), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u != v").distinct()
        small = large.join(lowest(large), "u")
        small = small.select("u", F.col("m").alias("v")).unionByName(small.select(F.col("v").alias("u"), F.col("m").alias("v")))
        edges = stored(small.filter("u != v").distinct(), "links")
        now = edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v") % 1_000_003), F.lit(0))).first()
        if now == state:
            break
        state = now
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component")))


def _within_families(buckets: DataFrame, found: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Links between components that share a bucket, beyond those with the
    buckets' smallest members."""
    labelled = buckets.join(found, "node", "left").select(
        "key", "node", "center", F.coalesce("component", "node").alias("component"))
    open_keys = labelled.groupBy("key").agg(
        F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("n")).filter(
        "x != y and n > 2").select("key")  # of two members, both are compared already
    members = stored(labelled.join(open_keys, "key").select("node", "center", "component").distinct(), "open")
    families = components(members.filter("node != center").select(F.col("node").alias("a"), F.col("center").alias("b")))
    rows = members.select("node", "component").distinct().join(families.toDF("node", "family"), "node")
    parts = rows.groupBy("family", "component").agg(F.count("*").alias("n"))
    shape = parts.groupBy("family").agg(
        F.max_by("component", F.struct("n", "component")).alias("largest"), F.sum("n").alias("all"),
        F.max("n").alias("most")).filter("all > most").select(
        "family", "largest", F.ceil(F.col("all") / BLOCK).cast("int").alias("inner_blocks"),
        F.ceil((F.col("all") - F.col("most")) / BLOCK).cast("int").alias("outer_blocks"))
    rows = rows.join(shape, "family")

    def block(count: str, salt: int):
        return F.pmod(F.xxhash64("node", F.lit(salt)), F.col(count)).cast("int")

    def every(count: str):
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    inner = rows.select("family", block("inner_blocks", 1).alias("i"), every("outer_blocks").alias("o"), "node",
                        "component", F.lit(False).alias("outside"))
    outer = rows.filter("component != largest").select(
        "family", every("inner_blocks").alias("i"), block("outer_blocks", 2).alias("o"), "node", "component",
        F.lit(True).alias("outside"))
    placed = inner.unionByName(outer)
    wanted = rows.select("node").distinct()
    own = texts.join(wanted, texts["doc_id"] == wanted["node"], "left_semi").toDF("node", "text")
    filled = placed.join(own, "node")
    return stored(filled.groupBy("family", "i", "o").applyInArrow(_family_links(k, percent), "a long, b long"), "links")


def near_groups(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """Groups of documents linked by a Jaccard coefficient of ``percent`` or
    more of their ``k``-word shingle sets. Runs at once."""
    return _grouped(docs, k, percent).select("doc_id", "n_shingles", "component_id", "kept")


def _grouped(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``near_groups`` with the digests of each row's set and text."""
    threshold = percent / 100
    texts = id_and_text(docs)
    sketched = stored(texts.mapInArrow(_sketch_batches(k, band_rows(threshold)), NODE), "sketches")
    nodes = stored(
        sketched.filter("doc_id is not null and n_shingles > 0").groupBy("digest", "n_shingles", "registers", "bands")
        .agg(F.min("doc_id").alias("node")), "nodes")
    members = nodes.select(F.explode("bands").alias("key"), "node")
    shared = members.groupBy("key").agg(F.min("node").alias("center"), F.max("node").alias("far")).filter("center != far")
    buckets = stored(members.join(shared.select("key", "center"), "key"), "buckets")

    def confirmed(pairs: DataFrame) -> DataFrame:
        """The links among pairs ``a < b``."""
        side = nodes.select("node", "n_shingles", "registers")
        rich = pairs.join(side.toDF("a", "n_a", "left"), "a").join(side.toDF("b", "n_b", "right"), "b")
        likely = rich.select("a", "b", "n_a", "n_b", "left", "right").mapInArrow(_likely(threshold), "a long, b long")
        likely = stored(likely, "likely")
        wanted = likely.select(F.col("a").alias("node")).unionByName(likely.select(F.col("b").alias("node"))).distinct()
        own = texts.join(wanted, texts["doc_id"] == wanted["node"], "left_semi")
        full = likely.join(own.toDF("a", "left"), "a").join(own.toDF("b", "right"), "b")
        return full.select("a", "b", "left", "right").mapInArrow(_confirm(k, percent), "a long, b long").distinct()

    pairs = buckets.filter("node != center").select(F.col("center").alias("a"), F.col("node").alias("b")).distinct()
    links = stored(confirmed(pairs), "links")
    found = components(links)
    more = _within_families(buckets, found, texts, k, percent)
    if not more.isEmpty():
        found = components(links.unionByName(more))
    labelled = nodes.join(found, "node", "left").select(
        "digest", F.coalesce("component", "node").alias("component"))
    out = sketched.select("doc_id", "n_shingles", "digest", "text_sha256").join(
        labelled.select(F.col("digest").alias("of"), "component"), F.col("digest") == F.col("of"), "left")
    component = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component"))
    return out.select("doc_id", "n_shingles", "digest", "text_sha256", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()))


def drop_near_copies(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one document of each group, all columns. Of rows that
    repeat an id (or have none) and have equal sets, one stays; without words
    only equal texts are repeats."""
    kept = _grouped(docs, **options).filter("kept")
    one = kept.groupBy("doc_id", "digest", F.when(F.col("digest").isNull(), F.col("text_sha256"))).agg(
        F.min("text_sha256").alias("text_sha256"))
    return rows_told_apart(docs, one)
