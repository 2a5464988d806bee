import hashlib
import random

from pyspark.sql import functions as F

from tillroll.llm import winnowing as w


def make(r, n):
    return " ".join(r.choices([f"w{i}" for i in range(30)], k=n))


def test_picks_equal_brute_force(docs):
    r = random.Random(4)
    rows = [(i, make(r, n)) for i, n in enumerate([0, 1, 2, 3, 4, 5, 6, 7, 8, 20, 100, 300])] + [(50, "q" * 200), (51, "a a a a a a a a a a a a")]
    every = {x.doc_id: [(p.position, p.hash) for p in x.picks] for x in w.fingerprints(docs(rows), window=1).collect()}
    for x in w.fingerprints(docs(rows)).collect():
        hashes = dict(sorted(every[x.doc_id]))
        h = [hashes[i] for i in sorted(hashes)]
        # Without windows equal hashes at different places all stay.
        want, n = [], len(h)
        for a in range(max(1, n - w.WINDOW + 1) if n else 0):
            window = h[a:a + w.WINDOW]
            at = a + max(i for i, v in enumerate(window) if v == min(window))
            if at not in want:
                want.append(at)
        assert [(p.position, p.hash) for p in x.picks] == [(i, h[i]) for i in want]


def test_match_guarantee(docs):
    r = random.Random(9)
    shared = make(r, w.K + w.WINDOW - 1)
    rows = [(1, f"{make(r, 40)} {shared} {make(r, 30)}"), (2, f"x y z {shared} u v {make(r, 90)}")]
    a, b = ({p.hash for p in x.picks} for x in w.fingerprints(docs(rows)).collect())
    assert a & b


def test_edit_and_next(docs):
    r = random.Random(5)
    rows = [(3 * i, make(r, r.randint(0, 60))) for i in range(40)] + [(200, None), (201, "é日本 " * 9), (None, "zz"), (None, "aa"), (6, "twice")]
    got = w.edit_likeness(docs(rows))
    ordered = sorted(((i, t or "") for i, t in rows), key=lambda x: (x[0] is None, -(x[0] or 0), x[1]))
    want = []
    for at, (i, t) in enumerate(ordered):
        following = ordered[(at + 1) % len(ordered)][1]
        cut = len(t) // 3
        want.append((i, len(t), hashlib.sha256((t[:len(t) - cut] + following[:cut]).encode()).hexdigest()))
    out = got.collect()
    assert sorted(((x.doc_id, x.n_chars, x.edited_sha256) for x in out), key=repr) == sorted(want, key=repr)
    assert all(0 <= x.near_edited <= 1 and 0 <= x.near_next <= 1 for x in out)
    for x in out:
        if x.n_chars < 3:
            assert x.near_edited == 1 and x.fingerprint == x.edited_fingerprint


def test_equal_texts_equal_fingerprints(docs):
    out = w.edit_likeness(docs([(1, "a b c d e f"), (2, "a b c d e f"), (3, "g h")])).collect()
    assert len({x.fingerprint for x in out if x.doc_id < 3}) == 1


def test_single_and_empty(docs):
    one = w.edit_likeness(docs([(1, "some words in here to see")])).collect()
    assert len(one) == 1 and one[0].near_next == 1
    assert w.edit_likeness(docs([])).count() == 0


def test_native(docs):
    df = w.edit_likeness(docs([(1, "a b"), (2, "c d")]))
    plan = df._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_bucket_counts_cuts(spark):
    cuts = sorted(random.Random(1).sample(range(1000), 37))
    df = spark.range(1000).withColumnRenamed("id", "doc_id").select("doc_id", w._bucket(cuts).alias("b"))
    assert all(r.b == sum(c < r.doc_id for c in cuts) for r in df.collect())
    assert spark.sql("select cast(null as long) doc_id").select(w._bucket([]).alias("b")).first().b == -1
    assert df.filter(F.col("b") < 0).count() == 0


def tokens(spark, text):
    return spark.createDataFrame([(text,)], "t string").select(F.regexp_extract_all("t", F.lit(w.TOKENS), F.lit(0))).first()[0]


def test_tokens_hold_every_character(spark):
    r = random.Random(2)
    for _ in range(60):
        text = "".join(r.choices("abcxz01357_-+ \n\u00e9\u65e5", [9, 9, 9, 9, 9, 1, 1, 1, 1, 1, 1, 1, 1, 2, 1, 1, 1], k=r.randint(0, 120)))
        got = tokens(spark, text)
        assert "".join(got) == "".join(text.split())
        assert all(0 < len(t) <= w.TOKEN for t in got)
        assert [t for t in text.split() if len(t) <= w.TOKEN] == [t for t in text.split() if t in got and len(t) <= w.TOKEN]


def test_a_shift_in_unbroken_text_keeps_the_guarantee(docs):
    r = random.Random(3)
    for alphabet in ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", "0123456789abcdef", "\u65e5\u672c\u8a9e\u6587\u5b57"):
        text = "".join(r.choices(alphabet, k=2000))
        a, b = ({p.hash for p in x.picks} for x in w.fingerprints(docs([(1, text), (2, "x" + text)])).collect())
        assert len(a & b) >= len(a) - 4


def test_a_bucket_is_a_partition(spark, docs):
    rows = docs([(i, "some words") for i in range(4000)])
    df = w.fingerprinted_with_next(rows, buckets=16)
    parts = df.groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) == 16 and max(p["count"] for p in parts) < 2 * 4000 / 16
    plan = df._jdf.queryExecution().executedPlan().toString()  # the window needs no shuffle of its own
    assert plan.count("shufflepartitionidpassthrough(") == 1 and plan.count("hashpartitioning(bucket") == 1
