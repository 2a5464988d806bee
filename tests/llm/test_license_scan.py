import re

from pyspark.sql import functions as F

from tillroll.llm import license_scan

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TEXTS = [
    "", None, "no such words", "MIT License", "the MIT-License, and Apache  license; mit license",
    "Licensed under the Apache License, Version 2.0 (the \"License\")", "GNU General Public License version 3",
    "under the terms of the GNU Lesser General Public License, version 2.1", "mit licenses mitlicense amit license",
    "Permission is hereby granted, free of charge, to any person obtaining a copy", "all rights reserved.",
    "SPDX-License-Identifier: BSD-3-Clause", "mit license é MIT\x00LICENSE", "...", " word ",
    "this is the zlib license and released into the public domain " * 40,
]


def brute(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(FOLD))
    places, labels = [], set()
    for phrase, label in license_scan.BASE:
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i:i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_base_equals_brute_force(docs):
    rows = list(enumerate(TEXTS)) + [(None, "mit license"), (3, "MIT License")]
    got = license_scan.scan(docs(rows)).collect()
    key = lambda r: repr(r)
    assert sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got), key=key) == \
        sorted(((i, *brute(t)) for i, t in rows), key=key)
    assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) for r in got)
    assert all(0 <= r.score <= 1 and (r.score > 0) == (r.labels != "") for r in got)


def test_method_labels(docs):
    got = {r.doc_id: r.labels for r in license_scan.scan(docs(list(enumerate(TEXTS)))).collect()}
    assert got[5] == "apache,apache-2.0" and got[6] == "gpl,gpl-3.0" and got[7] == "gpl,lgpl-2.1"
    assert got[9] == "mit" and got[10] == "proprietary" and got[11] == "bsd-3-clause" and got[2] == ""
    assert got[15] == "public-domain,zlib"


def test_contained_detections_are_suppressed(docs):
    rows = [(1, "released under the terms of the GNU General Public License version 2"), (2, "x " * 9 + "Apache License 2.0")]
    made = license_scan.rules()
    for r in license_scan.scan(docs(rows)).collect():
        spans = [(d.start, d.end, d.priority, d.rule) for d in r.detections]
        assert spans
        for a in spans:
            for b in spans:
                inside = a != b and b[0] <= a[0] and a[1] <= b[1]
                assert not (inside and (b[2], -(b[1] - b[0]), b[3]) < (a[2], -(a[1] - a[0]), a[3]))
        words = license_scan.__name__ and (dict(rows)[r.doc_id].lower().replace(".", " ").split())
        for d in r.detections:
            assert re.fullmatch(made[d.rule]["pattern"], " ".join(words[d.start:d.end]))


def test_hundreds_of_rules_with_keywords():
    made = license_scan.rules()
    assert len(made) > 300
    for r in made:
        assert r["keyword"] in re.findall(r"[a-z0-9]+", r["pattern"])


def own_words(pattern):
    """A text of a rule's own words: optional parts left out, first choices taken."""
    text = pattern.replace("(?:\\S+ ){1,12}", "some ").replace("(?:\\S+ ){0,20}", "").replace("licen[sc]e", "license")
    while re.search(r"\(\?:[^()]*\)\?", text):
        text = re.sub(r"\(\?:[^()]*\)\?", "", text)
    return re.sub(r"\(\?:([^()|]*)[^()]*\)", r"\1", text)


def test_every_rule_finds_its_own_words(docs):
    made = license_scan.rules()
    texts = [own_words(r["pattern"]) for r in made]
    for rule, text in zip(made, texts):
        assert re.fullmatch(rule["pattern"], text)
    got = {r.doc_id: r for r in license_scan.scan(docs(list(enumerate(texts)))).collect()}
    for i, text in enumerate(texts):
        assert got[i].labels and got[i].score > 0, text
        assert any(d.start == 0 and d.end == len(text.split()) for d in got[i].detections), text


def test_forms_without_license_language(docs):
    rows = ["This package is released under the Apache-2.0.", "available under the MIT.", "under the terms of the MPL 2.0",
            "Unauthorized copying of this file", "The origin of this software must not be misrepresented"]
    got = {r.doc_id: r.labels for r in license_scan.scan(docs(list(enumerate(rows)))).collect()}
    assert [got[i] for i in range(5)] == ["apache-2.0", "mit", "mpl-2.0", "proprietary", "zlib"]


def test_native_and_empty(docs):
    df = license_scan.scan(docs([]))
    assert df.count() == 0
    plan = license_scan.scan(docs([(1, "mit license")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    assert df.filter(F.col("score") > 1).count() == 0
