"""Phrase collocations by vertically partitioned suffix subtrees (ERA style).

Method
------
1. *Prefixes.* One pass counts all words per language and the word prefixes
   that are frequent enough in some slice of a task's text to be heavy in the
   corpus. Their number is bounded by the number of groups.
2. *Groups.* The words are dealt into as many groups as the memory budget of
   a group asks for, by a hash of their prefix. A heavy prefix is extended by
   its next word, so no prefix holds more than a share of a group, up to the
   depth of the trees. Every place of a text is the start of one suffix, cut
   to ``DEPTH`` words and at the end of its piece.
3. *Packets.* A task sorts the suffixes of a slice by group and prefix, folds
   equal ones into a count and sends one packet for each group and language;
   a prefix's first word travels as text, once, and is the group's
   dictionary.
4. *Subtrees.* A group's task sorts its suffixes word by word. Runs that agree
   in the first ``d`` words are the nodes of depth ``d``; a node's count is
   the sum of its leaves. Nodes below the least count end the descent there.
   Nodes on the path of a heavy prefix have parts in several groups and are
   added up afterwards.
5. *Scores.* Joins on sequence hashes give each candidate the counts of its
   parts and the largest count of a longer candidate around it. All
   arithmetic is on whole decimals.

Groups are independent: a lost executor costs its groups' tasks only.

Results
-------
Per language the best phrases, as op13 asks. Null texts count as empty, null
languages as ``und``. Repeated rows and null ids count like any other row.
Texts of any length are read in parts. An empty table gives no rows. Only
``text`` and ``lang`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import slices, stored, shuffle_partitions, text_bytes
from tillroll.llm.words import Separators, chained, joined, mix

DEPTH = 4  # fixed value: words of the longest phrase
LEAST = 30  # fixed value: occurrences of a candidate
BEST = 2000  # fixed value: phrases reported per language
BUDGET = 1_000_000  # suffixes a group may hold
SLICE = 1_000_000  # words of a slice of a task
SHARE = 4  # a heavy prefix has more than a group's words divided by this

BREAKS = b".,;:!?\n\x0b\x0c\r"
TOKENS = Separators(b" \t" + BREAKS)
_BREAK = np.zeros(256, bool)
_BREAK[list(BREAKS)] = True


class Slice:
    """Words of some texts of one language, with the piece each stands in."""

    def __init__(self):
        self.texts: list[bytes] = []
        self.hashes: list[np.ndarray] = []
        self.pieces: list[np.ndarray] = []
        self.begins: list[np.ndarray] = []
        self.sizes: list[np.ndarray] = []
        self.words = self.bytes = 0

    def add(self, text: bytes, piece: int) -> int:
        """Adds a part of a text; returns the piece its end stands in."""
        hashes, begins, sizes = joined(TOKENS.words(text))
        ends = np.flatnonzero(_BREAK[np.frombuffer(text, np.uint8)])
        self.texts.append(text)
        self.hashes.append(hashes)
        self.pieces.append(piece + np.searchsorted(ends, begins))
        self.begins.append(begins + self.bytes)
        self.sizes.append(sizes)
        self.words += len(hashes)
        self.bytes += len(text)
        return piece + len(ends)

    def suffixes(self, keep: int) -> np.ndarray:
        """``DEPTH`` rows of word hashes, a column for each start but the last
        ``keep`` words; 0 stands behind the end of a piece."""
        hashes, pieces = np.concatenate(self.hashes), np.concatenate(self.pieces)
        n = len(hashes)
        out = np.zeros((DEPTH, n), np.uint64)
        out[0] = hashes
        for d in range(1, min(DEPTH, n)):
            out[d, :n - d] = np.where(pieces[d:] == pieces[:n - d], hashes[d:], np.uint64(0))
        return out[:, :n - keep] if keep else out

    def word(self, i: int) -> bytes:
        return self._whole[self._begins[i]:self._begins[i] + self._sizes[i]]

    def ready(self) -> "Slice":
        self._whole = b"".join(self.texts)
        self._begins, self._sizes = np.concatenate(self.begins), np.concatenate(self.sizes)
        return self

    def tail(self, keep: int) -> "Slice":
        """The last ``keep`` words, to go before what follows in the text."""
        rest, n = Slice(), 0
        pieces, hashes = np.concatenate(self.pieces)[-keep:], np.concatenate(self.hashes)[-keep:]
        for i in range(self.words - keep, self.words):
            rest.texts.append(self.word(i))
            rest.begins.append(np.array([rest.bytes]))
            rest.sizes.append(np.array([len(rest.texts[-1])]))
            rest.bytes += len(rest.texts[-1])
            n += 1
        rest.hashes, rest.pieces, rest.words = [hashes], [pieces], n
        return rest


def cut_slices(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[str, Slice, int]]:
    """Language, slice and the number of its last words that only end
    suffixes (they start the next slice of the same text)."""
    held: dict[str, Slice] = {}
    pieces: dict[str, int] = {}
    total = 0
    for batch in batches:
        for part in slices(batch):
            for lang, text in zip(part.column(0).to_pylist(), text_bytes(part)):
                for _, own in TOKENS.parts(text.lower()):
                    now = held.setdefault(lang, Slice())
                    before = now.words
                    pieces[lang] = now.add(own, pieces.get(lang, 0))
                    total += now.words - before
                    if now.words >= size:
                        keep = DEPTH - 1
                        yield lang, now.ready(), keep
                        held[lang] = now.tail(keep)
                        total += held[lang].words - now.words
                pieces[lang] = pieces.get(lang, 0) + 1  # the next text is another piece
                if total >= 2 * size:  # many languages in one task
                    for name, now in held.items():
                        if now.words:
                            yield name, now.ready(), 0
                    held, pieces, total = {}, {}, 0
    for name, now in held.items():
        if now.words:
            yield name, now.ready(), 0


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


# -- 1: heavy prefixes ---------------------------------------------------------

PREFIXES = "lang string, depth int, prefix long, count long"


def _count_prefixes(groups: int, size: int):
    """Words per slice (depth 0) and prefixes that hold more than a share of
    the slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, own, keep in cut_slices(batches, size):
            suffix = own.suffixes(keep)
            n = suffix.shape[1]
            rows = [(0, 0, n)]
            least = max(2, n // (2 * SHARE * groups))
            prefix, alive = mix(suffix[0]), np.arange(n)
            for d in range(1, DEPTH):
                values, inverse, counts = np.unique(prefix, return_inverse=True, return_counts=True)
                heavy = counts >= least
                rows += [(d, int(v), int(c)) for v, c in zip(values[heavy].view(np.int64), counts[heavy])]
                alive, prefix = alive[heavy[inverse]], prefix[heavy[inverse]]
                going = suffix[d, alive] != 0
                alive = alive[going]
                prefix = chained(prefix[going], suffix[d, alive])
                if not len(alive):
                    break
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(rows)), pa.array([r[0] for r in rows], pa.int32()),
                 pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64())],
                ["lang", "depth", "prefix", "count"])

    return run


def heavy_prefixes(texts: DataFrame, budget: int, size: int) -> tuple[DataFrame, int, dict[str, np.ndarray]]:
    """Words per language, the number of groups, and per language the sorted
    prefixes that are extended: at most ``2 * SHARE`` per group and depth."""
    least_groups = shuffle_partitions(texts.sparkSession)
    found = texts.mapInArrow(_count_prefixes(least_groups, size), PREFIXES).groupBy("lang", "depth", "prefix").agg(
        F.sum("count").alias("count"))
    found = stored(found, "phrase-prefixes")
    totals = found.where("depth = 0").select("lang", F.col("count").alias("n"))
    words = totals.agg(F.sum("n")).first()[0] or 0
    groups = max(least_groups, -(-words // budget))
    heavy: dict[str, list] = {}
    for r in found.where((F.col("depth") > 0) & (F.col("count") >= words / (2 * SHARE * groups))).collect():
        heavy.setdefault(r.lang, []).append(r.prefix)
    return totals, groups, {k: np.sort(np.array(v, np.int64).view(np.uint64)) for k, v in heavy.items()}


def among(sorted_values: np.ndarray | None, x: np.ndarray) -> np.ndarray:
    if sorted_values is None or not len(sorted_values):
        return np.zeros(len(x), bool)
    at = np.minimum(np.searchsorted(sorted_values, x), len(sorted_values) - 1)
    return sorted_values[at] == x


def routes(suffix: np.ndarray, heavy: np.ndarray | None) -> np.ndarray:
    """The hash of the shortest prefix of each suffix that is not heavy."""
    route = mix(suffix[0])
    todo = np.flatnonzero(among(heavy, route))
    for d in range(1, DEPTH):
        todo = todo[suffix[d, todo] != 0]
        if not len(todo):
            break
        route[todo] = chained(route[todo], suffix[d, todo])
        todo = todo[among(heavy, route[todo])]
    return route


# -- 2 and 3: packets ------------------------------------------------------------

PACKETS = "group int, lang string, firsts binary, runs binary, rest binary"


def _squeeze(*parts: bytes) -> list[bytes]:
    squeezer = zstandard.ZstdCompressor(level=1)
    return [squeezer.compress(p) for p in parts]


def _send(groups: int, size: int, heavy: dict[str, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, own, keep in cut_slices(batches, size):
            suffix = own.suffixes(keep)
            route = routes(suffix, heavy.get(lang))
            whole = suffix[0]
            for d in range(1, DEPTH):
                whole = chained(whole, suffix[d])
            order = np.lexsort((whole, route))
            route, whole = route[order], whole[order]
            new = np.flatnonzero(np.concatenate([[True], (route[1:] != route[:-1]) | (whole[1:] != whole[:-1])]))
            counts = np.diff(np.append(new, len(order))).astype(np.uint32)
            order, route = order[new], route[new]
            run_at = np.flatnonzero(np.concatenate([[True], route[1:] != route[:-1]]))
            group = ((route >> np.uint64(32)) * np.uint64(groups) >> np.uint64(32)).astype(np.int64)
            cuts = np.searchsorted(group, np.unique(group), "left")
            for a, b in zip(cuts, np.append(cuts[1:], len(group))):
                first, last = np.searchsorted(run_at, [a, b])
                starts = run_at[first:last]
                firsts = b"\n".join(own.word(i) for i in order[starts].tolist())
                lengths = np.diff(np.append(starts, b)).astype(np.uint32)
                picked = order[a:b]
                rest = b"".join(suffix[d, picked].tobytes() for d in range(1, DEPTH)) + counts[a:b].tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(group[a])], pa.int32()), pa.array([lang]),
                     *[pa.array([x], pa.binary()) for x in _squeeze(firsts, lengths.tobytes(), rest)]],
                    ["group", "lang", "firsts", "runs", "rest"])

    return run


# -- 4: subtrees -------------------------------------------------------------------

NODES = "lang string, depth int, " + ", ".join(f"h{d} long" for d in range(1, DEPTH + 1)) + ", count long, word string"


def nodes_of(suffix: np.ndarray, counts: np.ndarray, heavy: np.ndarray | None, least: int):
    """Depth, words (columns) and count of the subtree's nodes that reach
    ``least`` or lie on a heavy path."""
    path = None
    for d in range(1, DEPTH + 1):
        alive = suffix[d - 1] != 0
        suffix, counts = suffix[:, alive], counts[alive]
        if not len(counts):
            return
        path = mix(suffix[0]) if d == 1 else chained(path[alive], suffix[d - 1])
        order = np.argsort(path, kind="stable")  # a level of the tree: its nodes are the runs
        suffix, counts, path = suffix[:, order], counts[order], path[order]
        starts = np.flatnonzero(np.concatenate([[True], path[1:] != path[:-1]]))
        totals = np.add.reduceat(counts, starts)
        shared = among(heavy, path[starts])
        told = (totals >= least) | shared
        at = starts[told]
        words = np.zeros((DEPTH, len(at)), np.uint64)
        words[:d] = suffix[:d, at]
        yield d, words, totals[told]
        stay = np.repeat(told, np.diff(np.append(starts, len(counts))))
        suffix, counts, path = suffix[:, stay], counts[stay], path[stay]


def _grow(heavy: dict[str, np.ndarray], least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for i in range(batch.num_rows):
                _, lang, *parts = (batch.column(c)[i].as_py() for c in range(batch.num_columns))
                firsts, lengths, rest = (unpack.decompress(p) for p in parts)
                hashes, begins, sizes = joined(TOKENS.words(firsts))
                lengths = np.frombuffer(lengths, np.uint32)
                n = int(lengths.sum())
                suffix = np.empty((DEPTH, n), np.uint64)
                suffix[0] = np.repeat(hashes, lengths)
                suffix[1:] = np.frombuffer(rest, np.uint64, (DEPTH - 1) * n).reshape(DEPTH - 1, n)
                counts = np.frombuffer(rest, np.uint32, n, (DEPTH - 1) * n * 8).astype(np.int64)
                held.setdefault(lang, []).append((suffix, counts, (firsts, hashes, begins, sizes)))
        for lang in list(held):
            packets = held.pop(lang)
            suffix = np.concatenate([p[0] for p in packets], axis=1)
            counts = np.concatenate([p[1] for p in packets])
            words = [p[2] for p in packets]
            packets.clear()
            for d, found, totals in nodes_of(suffix, counts, heavy.get(lang), least):
                names = [None] * len(totals)
                if d == 1:
                    names = _names(found[0], words)
                    words.clear()
                for at in range(0, len(totals), 10000):
                    end = at + 10000
                    part = found[:, at:end].view(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * part.shape[1]), pa.array([d] * part.shape[1], pa.int32()),
                         *[pa.array(part[c]) for c in range(DEPTH)], pa.array(totals[at:end], pa.int64()),
                         pa.array(names[at:end], pa.string())],
                        ["lang", "depth", *[f"h{c + 1}" for c in range(DEPTH)], "count", "word"])

    return run


def _names(wanted: np.ndarray, packets: list[tuple]) -> list[str]:
    """The words with the hashes ``wanted`` (sorted or not), from the packets' first words."""
    order = np.argsort(wanted)
    sorted_hashes, names = wanted[order], [None] * len(wanted)
    for firsts, hashes, begins, sizes in packets:
        for i in np.flatnonzero(among(sorted_hashes, hashes)).tolist():
            at = order[np.searchsorted(sorted_hashes, hashes[i])]
            if names[at] is None:
                names[at] = firsts[begins[i]:begins[i] + sizes[i]].decode()
    return names


def frequent_phrases(docs: DataFrame, least: int = LEAST, budget: int = BUDGET,
                     size: int = SLICE) -> tuple[DataFrame, DataFrame]:
    """``lang, depth, h1..h4, count, word`` of all phrases of up to ``DEPTH``
    words with ``least`` occurrences (``word`` for single words), and
    ``lang, n``. Written to the shared folder."""
    texts = _texts(docs)
    totals, groups, heavy = heavy_prefixes(texts, budget, size)
    packets = texts.mapInArrow(_send(groups, size, heavy), PACKETS).repartitionById(groups, "group")
    keys = ["lang", "depth", *[f"h{d}" for d in range(1, DEPTH + 1)]]
    nodes = packets.mapInArrow(_grow(heavy, least), NODES).groupBy(*keys).agg(
        F.sum("count").alias("count"), F.max("word").alias("word")).where(F.col("count") >= least)
    return stored(nodes, "phrase-nodes"), totals


# -- 5: scores ----------------------------------------------------------------------

def _sequence(first: int, last: int):
    """Columns of the words ``first`` to ``last``, shifted to the front."""
    own = [F.col(f"h{d}") for d in range(first, last + 1)]
    return [*own, *[F.lit(0).cast("long")] * (DEPTH - len(own))]


KEYS = [f"k{d}" for d in range(1, DEPTH + 1)]


def _parts(candidates: DataFrame, ranges) -> DataFrame:
    """A row for each candidate and part: ``ranges`` maps a candidate's length
    to ``(label, first, last)``."""
    choice = None
    for m in range(2, DEPTH + 1):
        parts = F.array(*[F.struct(F.lit(label).alias("label"), F.lit(b - a + 1).alias("words"),
                                   *[c.alias(k) for c, k in zip(_sequence(a, b), KEYS)])
                          for label, a, b in ranges(m)])
        choice = F.when(F.col("depth") == m, parts) if choice is None else choice.when(F.col("depth") == m, parts)
    return candidates.select("*", F.explode(choice).alias("p")).select("*", "p.*").drop("p")


def scored(nodes: DataFrame) -> DataFrame:
    """Candidates with ``a, l, r, score``, those inside a longer candidate of
    about the same count left out."""
    candidates = nodes.where(F.col("depth") > 1).drop("word").withColumnRenamed("count", "a")
    known = nodes.select("lang", F.col("depth").alias("words"),
                         *[F.col(f"h{d}").alias(k) for d, k in enumerate(KEYS, 1)], F.col("count").alias("f"))
    own = ["lang", "depth", *[f"h{d}" for d in range(1, DEPTH + 1)], "a"]
    on = ["lang", "words", *KEYS]
    inside = _parts(candidates.where(F.col("depth") > 2), lambda m: [
        (0, a, b) for a in range(1, m + 1) for b in range(a + 1, m + 1) if b - a + 1 < m])
    inside = inside.groupBy("lang", F.col("words").alias("depth"),
                            *[F.col(k).alias(f"h{d}") for d, k in enumerate(KEYS, 1)]).agg(F.max("a").alias("around"))
    whole = [c for c in own if c != "a"]
    candidates = candidates.join(inside.hint("merge"), whole, "left").where(
        F.col("around").isNull() | (100 * F.col("around").cast("decimal(30,0)") < 80 * F.col("a").cast("decimal(30,0)")))
    cuts = _parts(candidates.drop("around"), lambda m: [
        part for k in range(1, m) for part in ((2 * k, 1, k), (2 * k + 1, k + 1, m))])
    cuts = cuts.join(known.hint("merge"), on).groupBy(*own, F.floor(F.col("label") / 2).cast("int").alias("k")).agg(
        F.max(F.when(F.col("label") % 2 == 0, F.col("f"))).alias("l"),
        F.max(F.when(F.col("label") % 2 == 1, F.col("f"))).alias("r"))
    score = F.expr("(cast(a AS decimal(20,0)) * 2000000) div (cast(l AS decimal(20,0)) + cast(r AS decimal(20,0)))")
    best = cuts.groupBy(*own).agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    return best.select(*own, "cut.l", "cut.r", "cut.score")


def _first(rows: DataFrame, n: int, order: list, *keys: str) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_at", F.row_number().over(w)).where(F.col("_at") <= n).drop("_at")


def collocations(docs: DataFrame, best: int = BEST, salts: int = 64, **options) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's first
    ``best`` candidates by score, count and text.

    A language may hold most of all candidates, so ``salts`` parts of each are
    cut to their first ``best`` before one task ranks a language. The cut by
    score and count keeps all ties; only what it keeps is spelled.
    """
    nodes, totals = frequent_phrases(docs, **options)
    found = stored(scored(nodes), "phrase-scores")
    salt = F.pmod(F.xxhash64(*[f"h{d}" for d in range(1, DEPTH + 1)]), F.lit(salts))
    falling = [F.desc("score"), F.desc("a")]
    found = found.withColumn("salt", salt)
    level = _first(_first(found.select("lang", "score", "a", "salt"), best, falling, "lang", "salt"), best, falling, "lang")
    level = level.groupBy("lang").agg(F.min(F.struct("score", "a")).alias("last"))
    # A row per language and salt: the join's keys part a language's candidates as well.
    level = level.select("lang", "last", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))).alias("salt"))
    kept = found.join(level, ["lang", "salt"]).where(F.struct("score", "a") >= F.col("last")).drop("last", "salt")
    words = nodes.where("depth = 1").groupBy(F.col("h1").alias("h")).agg(F.max("word").alias("word"))
    places = F.array(*[F.struct(F.lit(d).alias("at"), F.col(f"h{d}").alias("h")) for d in range(1, DEPTH + 1)])
    spelled = kept.select("*", F.explode(F.filter(places, lambda p: p["h"] != 0)).alias("p")).select("*", "p.*").drop("p")
    own = ["lang", *[f"h{d}" for d in range(1, DEPTH + 1)], "a", "l", "r", "score"]
    spelled = spelled.join(words.hint("merge"), "h").groupBy(*own).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda w: w["word"]), " ").alias("phrase"))
    order = [*falling, F.asc("phrase")]
    ranked = _first(spelled.withColumn("salt", salt), best, order, "lang", "salt")
    ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.where(F.col("rank") <= best).join(totals, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")
