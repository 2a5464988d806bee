import random

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tillroll.llm import phrases
from tillroll.llm.oracle import PHRASES

SCHEMA = "doc_id long, text string, lang string, rank string, h1 int"


def frame(spark, rows, parts=3):
    full = [(i, t, lang, "x", 1) for i, (t, lang) in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA).repartition(parts) if rows else spark.createDataFrame([], SCHEMA)


def brute(rows):
    con = duckdb.connect()
    con.register("documents", pa.table({"text": pa.array([t for t, _ in rows], pa.string()),
                                        "lang": pa.array([g for _, g in rows], pa.string())}))
    return sorted(con.sql(PHRASES).fetchall())


def result(df):
    return sorted((r.lang, r.rank, r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect())


def corpus(n, seed=2):
    r = random.Random(seed)
    words = "the The of TO ä日本 b c d e. f, g! h\n i\t j x;y long-word".split(" ")
    texts = [" ".join(r.choices(words, weights=range(len(words), 0, -1), k=r.randint(0, 60))) for _ in range(n)]
    texts += ["same old line again and again"] * 45 + ["a a a a a a a"] * 20 + ["hot pair"] * 200
    rows = [(t, r.choice(["en", "de", None, "und"])) for t in texts]
    return rows + [(None, "en"), ("", None), ("  \t ", "en"), ("...;;", "fr"), ("only one word", "fr")]


@pytest.mark.parametrize("budget, size", [(1 << 20, 1 << 20), (1000, 37)])
def test_equals_sql(spark, budget, size):
    rows = corpus(250)
    got = result(phrases.collocations(frame(spark, rows), budget=budget, size=size))
    assert got == brute(rows) and len(got) > 50


def test_one_long_text(spark):
    """A text of several parts and slices, with a hot prefix, counts whole."""
    r = random.Random(3)
    text = " ".join(r.choices(["the", "a", "of", "x", "y"], weights=[9, 2, 2, 1, 1], k=9000))
    rows = [(text, "en"), (text[:12000].replace(" x", ". x"), "en")]
    assert result(phrases.collocations(frame(spark, rows, 2), budget=2000, size=1000)) == brute(rows)


def test_ties_are_cut_by_text(spark):
    rows = [(f"w{i:03d} v{i:03d}", "en") for i in range(40) for _ in range(30)]
    got = result(phrases.collocations(frame(spark, rows), best=7, salts=3))
    assert [g[2] for g in got] == [f"w{i:03d} v{i:03d}" for i in range(7)]
    assert all(g[3:] == (30, 30, 30, 2400, 1000000) for g in got)


@pytest.mark.parametrize("rows", [[], [(None, None)], [("x", "en")]])
def test_nothing_frequent(spark, rows):
    df = phrases.collocations(frame(spark, rows, 2))
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"] and df.count() == 0


def test_heavy_prefixes_are_extended(spark):
    rows = [("hot " + w, "en") for w in "abcdefghij" for _ in range(100)]
    texts = phrases._texts(frame(spark, rows))
    totals, groups, heavy = phrases.heavy_prefixes(texts, budget=100, size=500)
    assert groups == 20 and totals.collect()[0].n == 2000 and len(heavy["en"]) >= 1
    packets = texts.mapInArrow(phrases._send(groups, 500, heavy), phrases.PACKETS)
    assert packets.select("group").distinct().count() > 5


def test_huge_word(spark):
    rows = [("w" * 9000 + " b " + "w" * 9000 + " b", "en")] * 20
    assert result(phrases.collocations(frame(spark, rows))) == brute(rows)
