import numpy as np
import pytest
from pyspark.sql import functions as F

from tillroll.llm import mil_quality as m
from tillroll.sources.tables import read_table

SF = "/root/testdata/sf0.01"


def test_gradient_is_the_slope():
    r = np.random.default_rng(3)
    model = m.Model.fresh(1)
    bags = [r.normal(size=(n, m.FEATURES)) for n in (1, 3, 5)]
    x, sizes = np.concatenate(bags), np.array([1, 3, 5])
    begins, label, weight = np.cumsum(sizes) - sizes, np.array([0.0, 1, 1]), np.array([1.0, 2, 1])

    def cost():
        y = model.forward(x, begins, sizes)[-1]
        return -(weight * (label * np.log(y) + (1 - label) * np.log(1 - y))).sum() / weight.sum()

    slope = model.gradient(x, begins, sizes, label, weight)
    for k, g in slope.items():
        at = tuple(r.integers(0, n) for n in model.p[k].shape)
        model.p[k][at] += 1e-5
        up = cost()
        model.p[k][at] -= 2e-5
        down = cost()
        model.p[k][at] += 1e-5
        assert abs((up - down) / 2e-5 - g[at]) < 1e-6


def test_held_out_accuracy(spark):
    pytest.importorskip("os").path.isdir(SF) or pytest.skip("test tables not present")
    docs, labels = read_table(spark, SF, "documents"), read_table(spark, SF, "labels")
    model = m.learn(docs, labels, usable=~m.held_out())
    got = m.quality_scores(docs, model).join(labels, "doc_id").filter(m.held_out()).select("score", "quality").toPandas()
    pos, neg = got[got.quality == 1].score.values, got[got.quality == 0].score.values
    assert len(neg) and (pos[:, None] > neg[None]).mean() > 0.97
    assert (pos >= m.ACCEPT).mean() > 0.95


def test_attention_finds_the_bad_passage():
    bad = m.bag("WORD!! WORD!! WORD!! " * 30)
    good = m.bag("some quiet words of prose in a row " * 40)
    bags = [good] * 20 + [np.concatenate([good, bad])] * 20
    model = m.fit(bags, np.array([1.0] * 20 + [0.0] * 20), np.ones(40))
    assert model.score([good])[0] > 0.9 and model.score([np.concatenate([good, bad, good])])[0] < 0.5


def test_edges(spark, docs):
    df = docs([(1, None), (2, ""), (None, "word"), (3, "x" * 100_000), (3, "twice")])
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 0)], "doc_id long, quality int")
    model = m.learn(df, labels)
    assert model == 1.0
    assert m.quality_scores(df, model).count() == 5
    none = labels.filter("doc_id > 100")
    assert m.learn(df, none) == 1.0
    both = spark.createDataFrame([(1, 1), (3, 0), (3, 0), (2, 1)], "doc_id long, quality int")
    scores = m.quality_scores(df, m.learn(df, both)).collect()
    assert len(scores) == 5 and all(0 <= r.score <= 1 for r in scores)
    kept = m.keep_quality(df, 1.0)
    assert kept.columns == df.columns and kept.count() == 5 and m.keep_quality(df, 0.0).count() == 0
    assert m.quality_scores(docs([]), 1.0).count() == 0
    assert df.select(F.max(m.held_out().cast("int"))).first()[0] in (0, 1)
