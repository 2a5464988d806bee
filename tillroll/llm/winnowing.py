"""Document fingerprints by winnowing, in DataFrame functions alone.

A text is cut into tokens: words of up to ``TOKEN`` characters are whole; a
longer run is cut behind each character of ``CUTS`` and each character outside
ASCII, so its own content decides where, and an inserted character moves no
cut but those next to it (only ``TOKEN`` or more characters without one are cut
by length, up to the next one). Prose and unbroken text alike have positions. Every run of ``K`` tokens is hashed to 31 bits; of every window
of ``WINDOW`` neighbouring hashes the smallest is chosen, the rightmost of
equal ones, and kept with its position. Two texts that share
``K + WINDOW - 1`` tokens in a row share a chosen hash there: that is the
match guarantee. A text of fewer tokens than a window has one window; a text
of fewer than ``K`` tokens has one hash of all of them; an empty text has
none.

Hash and position travel as one long, hash first and the position counted
down, so the smallest long of a window is the rightmost smallest hash.

Likeness of two fingerprints is the Jaccard coefficient of their distinct
hashes; two empty ones are alike (1), an empty and another one are not (0).

Null text counts as empty. Documents are walked in falling id order: null
ids last, rows that repeat an id by text. An empty table gives no rows; a
single document is its own neighbour. Other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import id_and_text, shuffle_partitions

K = 4
WINDOW = 4  # a power of two
TOKEN = 16
CUTS = r"aeiouAEIOU02468\p{P}\p{S}"  # a run over ``TOKEN`` characters is cut behind these
TOKENS = (rf"(?<!\S)\S{{1,{TOKEN}}}(?!\S)|[[^\s{CUTS}]&&[\x00-\x7F]]{{0,{TOKEN - 1}}}(?:[{CUTS}]|[^\s\x00-\x7F])"
          rf"|[[^\s{CUTS}]&&[\x00-\x7F]]{{1,{TOKEN}}}")
FAR = (1 << 31) - 1


def winnow(df: DataFrame, text: str, out: str, k: int = K, window: int = WINDOW) -> DataFrame:
    """Adds ``out``: the chosen hashes of column ``text``, in order, each
    packed with its place. ``window`` is a power of two.

    Every step is a column of its own, so that higher-order functions read
    finished arrays instead of working them out again for each element.
    """
    tokens, grams, least = f"{out}_tokens", f"{out}_grams", f"{out}_least"

    def gram(i: Column) -> Column:
        hash31 = F.shiftrightunsigned(F.xxhash64(*[F.get(tokens, i + j) for j in range(k)]), 33)
        return F.shiftleft(hash31, 31) + (F.lit(FAR) - i).cast("long")

    df = df.withColumn(tokens, F.regexp_extract_all(text, F.lit(TOKENS), F.lit(0)))
    df = df.withColumn(grams, F.greatest(F.size(tokens) - (k - 1), F.least(F.size(tokens), F.lit(1))))
    places = F.when(F.col(grams) > 0, F.sequence(F.lit(0), F.col(grams) - 1)).otherwise(F.expr("cast(array() as array<int>)"))
    df = df.withColumn(least, F.transform(places, gram))
    step = 1
    while step < window:  # from windows of one length to windows of twice that
        rest = F.slice(least, step + 1, F.greatest(grams, F.lit(1)))
        df = df.withColumn(least, F.zip_with(least, rest, lambda x, y: F.least(x, y)))
        step *= 2
    whole = F.greatest(F.col(grams) - (window - 1), F.lit(1))
    return df.withColumn(out, F.array_distinct(F.slice(least, F.lit(1), whole))).drop(tokens, grams, least)


def hashes(packed: Column) -> Column:
    """The distinct hashes of a fingerprint."""
    return F.array_distinct(F.transform(packed, lambda p: F.shiftright(p, 31).cast("int")))


def picks(packed: Column) -> Column:
    """Hash and token position of each chosen gram, in text order."""
    return F.transform(packed, lambda p: F.struct(
        F.shiftright(p, 31).cast("int").alias("hash"), (FAR - p.bitwiseAND(F.lit(FAR))).cast("int").alias("position")))


def fingerprint_text(packed: Column) -> Column:
    """A checksum of all chosen hashes and positions."""
    return F.sha2(F.concat_ws(",", F.transform(packed, lambda p: F.hex(p))), 256)


def likeness(a: Column, b: Column) -> Column:
    """Jaccard coefficient of two arrays of distinct hashes."""
    common = F.size(F.array_intersect(a, b))
    whole = F.size(a) + F.size(b) - common
    return F.when(whole == 0, F.lit(1.0)).otherwise(common / whole)


def fingerprints(docs: DataFrame, k: int = K, window: int = WINDOW) -> DataFrame:
    """``doc_id`` and ``picks`` (hash, position) of every row."""
    return winnow(id_and_text(docs), "text", "packed", k, window).select("doc_id", picks(F.col("packed")).alias("picks"))


def _bucket(cuts: list[int]) -> Column:
    """How many of the sorted ``cuts`` are below the id; -1 for a null id.
    Looks at about twice the square root of their number."""
    block = max(1, math.isqrt(len(cuts)))
    ends = cuts[block - 1::block]

    def longs(values):
        return F.array(*[F.lit(v).cast("long") for v in values]) if values else F.expr("cast(array() as array<bigint>)")

    below = F.size(F.filter(longs(ends), lambda c: c < F.col("doc_id"))) * block
    rest = F.size(F.filter(F.slice(longs(cuts), below + 1, F.lit(block)), lambda c: c < F.col("doc_id")))
    return F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(below + rest)


def fingerprinted_with_next(docs: DataFrame, buckets: int | None = None, k: int = K, window: int = WINDOW) -> DataFrame:
    """``doc_id, text, packed`` (see ``winnow``), and ``next``: ``text`` and
    ``hashes`` of the next document in falling id order, and of the first
    one behind the last.

    Ids are cut into buckets at approximate quantiles, one number per bucket.
    Each bucket also gets a copy of the first document of the bucket behind
    it, so one shuffle of texts brings neighbours together, no task sees
    more than a bucket and a text is fingerprinted once.
    """
    n = buckets or shuffle_partitions(docs.sparkSession)
    rows = id_and_text(docs)
    shares = F.array(*[F.lit(i / n) for i in range(1, max(2, n))])
    cuts = rows.agg(F.percentile_approx("doc_id", shares, F.lit(20 * n))).first()[0] or []
    rows = rows.withColumn("bucket", _bucket(sorted(set(cuts))) + 1)  # 0 to n
    falling = Window.orderBy(F.col("bucket").desc())  # a row per bucket
    every = falling.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = rows.groupBy("bucket").agg(F.max("doc_id").alias("head_id")).select(
        F.col("bucket").alias("head_bucket"), "head_id",
        F.coalesce(F.lag("bucket").over(falling), F.last("bucket").over(every)).alias("goes_to"))
    copies = rows.join(  # at most n + 1 rows are broadcast
        F.broadcast(heads),
        (F.col("bucket") == F.col("head_bucket")) & F.col("doc_id").eqNullSafe(F.col("head_id")))
    copies = copies.groupBy("goes_to").agg(F.min("text").alias("text")).select(
        F.lit(None).cast("long").alias("doc_id"), "text", F.col("goes_to").alias("bucket"), F.lit(True).alias("copy"))
    placed = rows.withColumn("copy", F.lit(False)).unionByName(copies).repartitionById(n + 1, "bucket")
    placed = winnow(placed, "text", "packed", k, window).withColumn("hashes", hashes(F.col("packed")))
    within = Window.partitionBy("bucket").orderBy("copy", F.col("doc_id").desc_nulls_last(), "text")
    following = F.struct(F.lead("text").over(within).alias("text"), F.lead("hashes").over(within).alias("hashes"))
    return placed.withColumn("next", following).filter(~F.col("copy")).select("doc_id", "text", "packed", "hashes", "next")


def edit_likeness(docs: DataFrame, k: int = K, window: int = WINDOW) -> DataFrame:
    """Each document against an edited text, whose last third is the start
    of the next document, and against the next document itself."""
    df = fingerprinted_with_next(docs, k=k, window=window)
    cut = F.floor(F.length("text") / 3).cast("int")
    df = df.withColumn("cut", cut)
    edited = F.concat(F.substring(F.col("text"), F.lit(1), F.length("text") - F.col("cut")),
                      F.substring(F.col("next.text"), F.lit(1), F.col("cut")))
    df = df.select("doc_id", F.length("text").cast("long").alias("n_chars"), edited.alias("edited"), "packed", "hashes",
                   F.col("next.hashes").alias("next_hashes"))
    df = winnow(df, "edited", "edited_packed", k, window)
    return df.withColumn("edited_hashes", hashes(F.col("edited_packed"))).select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint_text(F.col("packed")).alias("fingerprint"),
        fingerprint_text(F.col("edited_packed")).alias("edited_fingerprint"),
        likeness(F.col("hashes"), F.col("edited_hashes")).alias("near_edited"),
        likeness(F.col("hashes"), F.col("next_hashes")).alias("near_next"))
