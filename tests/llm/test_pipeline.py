import os

import pytest

import corpus_pipeline
from tillroll.llm import exact_dedup, hyperminhash, mil_quality, secret_scan
from tillroll.sources.tables import read_table

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def test_stages_one_by_one(spark):
    docs = read_table(spark, SF, "documents")
    columns = docs.columns
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "exact_dedup", "near_dedup", "secrets", "packing"]
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = stage(spark, docs, SF).cache()
        assert docs.columns == columns
        kept[name] = (before.count(), docs.count())
    assert kept["quality"][0] > kept["quality"][1] > 0.6 * kept["quality"][0]
    assert kept["secrets"][0] == kept["secrets"][1]
    assert exact_dedup.exact_groups(docs).filter("not kept").count() == 0
    assert hyperminhash.near_groups(docs).filter("not kept").count() == 0
    assert secret_scan.secret_spans(docs).filter("size(spans) > 0").count() == 0
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    ids = {r.doc_id for r in pieces.select("doc_id").distinct().collect()}
    assert ids == {r.doc_id for r in docs.select("doc_id").collect()}


def test_stages_take_odd_rows(spark):
    schema = read_table(spark, SF, "documents").schema
    rows = [(1, None, None, None, None), (None, "", "en", "s", 0), (2, "x" * 50_000, "en", "s", 50_000),
            (3, "same words in this text", "en", "s", 5), (3, "same words in this text", "en", "s", 5)]
    for table in (rows, []):
        docs = spark.createDataFrame(table, schema)
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            assert out.count() >= 0
        assert mil_quality.keep_quality(docs, 1.0).count() == len(table)


def test_copy_stages_leave_one_row(spark):
    schema = read_table(spark, SF, "documents").schema
    long = "one two three four five six seven"
    rows = [(3, "same words in this text", "en", "s", 5), (3, "same words in this text", "en", "s", 5),
            (3, "Same Words in this text", "de", "t", 5), (None, "no id here", "en", "s", 1),
            (None, "no id here", "en", "s", 1), (None, "another without id", "en", "s", 1),
            (1, long, "en", "s", 1), (2, long, "en", "s", 1), (2, "a text of its own", "en", "s", 1),
            (9, None, None, None, None), (9, None, None, None, None)]
    docs = spark.createDataFrame(rows, schema).repartition(3)
    left = {"exact": exact_dedup.drop_copies(docs), "near": hyperminhash.drop_near_copies(docs)}
    found = {name: sorted(((r.doc_id, (r.text or "").lower()) for r in out.collect()), key=repr) for name, out in left.items()}
    base = [(3, "same words in this text"), (None, "no id here"), (None, "another without id"), (2, "a text of its own"), (9, "")]
    assert found == {"exact": sorted([*base, (2, long)], key=repr), "near": sorted([*base, (1, long)], key=repr)}
    assert all(out.columns == docs.columns for out in left.values())
    twice = hyperminhash.drop_near_copies(exact_dedup.drop_copies(docs))
    assert twice.count() == 6
