"""License scan: ordered signature rules over words, in DataFrame functions.

A text is lower-cased (A-Z) and reduced to its words with one space before
each and one behind the last. Hundreds of rules - written by hand, or made
from a hand-written list of license names and phrases that introduce them -
are gated by keywords: a rule is tried only if its keyword, a word of every
text it matches, is among the text's words. Each rule has a priority. A detection whose words lie inside those of another one of a
better priority (or the same and more words, or the same words and an
earlier rule) is suppressed.

Base phrases are rules of their own that are never suppressed.

Everything is one projection: no shuffle, no Python on the rows. Null text
counts as empty: no words, no detection, score 0. Null or repeated ids and
repeated rows are rows like any other; other columns are not read. An empty
table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import fold_ascii, id_and_text

# Fixed values of the contract: phrases and their labels.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Names of licenses as they are written once punctuation is gone.
NAMES = (
    ("mit", "mit"), ("mit", "expat"), ("x11", "x11"), ("apache-1.1", "apache software license version 1 1"),
    ("apache-2.0", "apache license version 2 0"), ("apache-2.0", "apache license 2 0"), ("apache-2.0", "apache 2 0"),
    ("bsd-2-clause", "bsd 2 clause"), ("bsd-3-clause", "bsd 3 clause"), ("bsd-2-clause", "simplified bsd"),
    ("bsd-3-clause", "new bsd"), ("bsd-4-clause", "original bsd"), ("0bsd", "zero clause bsd"), ("isc", "isc"),
    ("gpl-2.0", "gnu general public license version 2"), ("gpl-2.0", "gplv2"), ("gpl-2.0", "gpl 2 0"),
    ("gpl-3.0", "gnu general public license version 3"), ("gpl-3.0", "gplv3"), ("gpl-3.0", "gpl 3 0"),
    ("gpl", "gnu general public license"), ("gpl", "gnu gpl"),
    ("lgpl-2.1", "gnu lesser general public license version 2 1"), ("lgpl-2.1", "lgpl 2 1"),
    ("lgpl-3.0", "gnu lesser general public license version 3"), ("lgpl-3.0", "lgpl 3 0"),
    ("lgpl", "gnu library general public license"), ("lgpl", "gnu lesser general public license"),
    ("agpl-3.0", "gnu affero general public license version 3"), ("agpl-3.0", "agpl 3 0"),
    ("agpl", "gnu affero general public license"), ("gfdl", "gnu free documentation license"),
    ("mpl-1.1", "mozilla public license version 1 1"), ("mpl-2.0", "mozilla public license version 2 0"),
    ("mpl-2.0", "mpl 2 0"), ("mpl", "mozilla public license"), ("epl-1.0", "eclipse public license version 1 0"),
    ("epl-2.0", "eclipse public license 2 0"), ("epl", "eclipse public license"),
    ("cddl-1.0", "common development and distribution license"), ("cpl-1.0", "common public license"),
    ("cc-by-4.0", "creative commons attribution 4 0"), ("cc-by-sa-4.0", "creative commons attribution sharealike 4 0"),
    ("cc-by-nc-4.0", "creative commons attribution noncommercial 4 0"), ("cc0-1.0", "cc0 1 0 universal"),
    ("artistic-2.0", "artistic license 2 0"), ("artistic", "artistic"), ("bsl-1.0", "boost software license version 1 0"),
    ("bsl-1.0", "boost software"), ("zlib", "zlib"), ("unlicense", "unlicense"), ("wtfpl", "wtfpl"),
    ("python-2.0", "python software foundation"), ("php-3.01", "php license version 3 01"),
    ("postgresql", "postgresql"), ("openssl", "openssl"), ("ofl-1.1", "sil open font license version 1 1"),
    ("ofl-1.1", "open font"), ("ms-pl", "microsoft public"), ("ms-rl", "microsoft reciprocal"),
    ("eupl-1.2", "european union public licence"), ("ncsa", "university of illinois ncsa open source"),
)
# Phrases that introduce a name, with their priority: smaller is better.
FORMS = (
    (2, "spdx license identifier {}"), (3, "licensed under (?:the )?(?:terms of (?:the )?)?{}"),
    (3, "(?:released|distributed|available|published) under (?:the )?(?:terms of (?:the )?)?{}"),
    (3, "under the terms of (?:the )?{}"), (4, "{} licen[sc]e"), (5, "license {}"),
)
# Signatures of license texts and notices.
TEXTS = (
    ("mit", "hereby", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit", "hereby", "permission is hereby granted free of charge"),
    ("isc", "fee", "permission to use copy modify and or distribute this software for any purpose with or without fee"),
    ("bsd", "redistribution", "redistribution and use in source and binary forms with or without modification"),
    ("bsd-3-clause", "endorse", "neither the name of (?:\\S+ ){1,12}may be used to endorse or promote products"),
    ("bsd-4-clause", "advertising", "all advertising materials mentioning features or use of this software"),
    ("zlib", "misrepresented", "the origin of this software must not be misrepresented"),
    ("gpl", "copyleft", "this is a copyleft license"),
    ("gpl", "redistribute", "this program is free software you can redistribute it and or modify it"),
    ("lgpl", "redistribute", "this library is free software you can redistribute it and or modify it"),
    ("apache-2.0", "apache", "you may not use this file except in compliance with the license (?:\\S+ ){0,20}apache org"),
    ("mpl-2.0", "mozilla", "this source code form is subject to the terms of the mozilla public license"),
    ("bsl-1.0", "boost", "distributed under the boost software license"),
    ("unlicense", "unencumbered", "this is free and unencumbered software released into the public domain"),
    ("public-domain", "domain", "(?:released|placed|dedicated) (?:in|into|to) the public domain"),
    ("wtfpl", "fuck", "do what the fuck you want to public license"),
    ("cc-by", "commons", "creative commons attribution"), ("cc-by-nc", "commons", "creative commons attribution noncommercial"),
    ("proprietary", "confidential", "confidential and proprietary"),
    ("proprietary", "reserved", "all rights reserved"), ("proprietary", "unauthorized", "unauthorized copying of this file"),
    ("unknown", "license", "see (?:the )?license(?: file)? for (?:details|more information)"),
    ("unknown", "license", "license agreement"), ("unknown", "licence", "licence agreement"),
)
WEIGHTS = (0.0, 0.95, 0.9, 0.85, 0.7, 0.5)  # by priority, from 1
COMMON = {"license", "licence", "public", "software", "the", "version", "general", "open", "source", "and", "of",
          "union", "new", "original", "simplified", "common", "free", "university"}


def _keyword(name: str) -> str:
    """The first telling word of a name."""
    return next((w for w in name.split() if w not in COMMON and not w.isdigit()), name.split()[0])


def rules() -> list[dict]:
    """All rules in order: texts, then each name in each form."""
    found = [{"label": label, "priority": 5 if label == "unknown" else 1, "keyword": keyword, "pattern": pattern}
             for label, keyword, pattern in TEXTS]
    for label, name in NAMES:
        if "licen" in name:
            found.append({"label": label, "priority": 4, "keyword": _keyword(name), "pattern": name})
        short = name.removesuffix(" license").removesuffix(" licence")
        for priority, form in FORMS:
            words = short if form.startswith("{}") else name
            found.append({"label": label, "priority": priority, "keyword": _keyword(name),
                          "pattern": form.format(words)})
    return [r | {"rule": i} for i, r in enumerate(found)]


def _spaces(column: Column) -> Column:
    return F.length(column) - F.length(F.replace(column, F.lit(" "), F.lit("")))


def words_of(text: Column) -> Column:
    """The words, each behind one space, with a space at the end."""
    plain = F.trim(F.regexp_replace(fold_ascii(text), NOT_WORD, " "))
    return F.concat(F.lit(" "), plain, F.lit(" "))


def _detections(words: Column, rule: Column) -> Column:
    """Places of one rule, in words: start, and end exclusive."""
    pattern = F.concat(F.lit(" (?:"), rule["pattern"], F.lit(")(?= )"))
    # A struct in an array binds both lists, so they are worked out once.
    lists = F.array(F.struct(F.regexp_extract_all(words, pattern, F.lit(0)).alias("found"),
                             F.split(words, pattern).alias("between")))

    def places(both: Column) -> Column:
        def place(match: Column, i: Column) -> Column:
            before = (F.aggregate(F.slice(both["between"], F.lit(1), i + 1), F.lit(0), lambda n, x: n + _spaces(x))
                      + F.aggregate(F.slice(both["found"], F.lit(1), i), F.lit(0), lambda n, x: n + _spaces(x)))
            return F.struct(rule["label"].alias("label"), rule["priority"].alias("priority"),
                            rule["rule"].alias("rule"), before.alias("start"), (before + _spaces(match)).alias("end"))

        return F.transform(both["found"], place)

    return F.flatten(F.transform(lists, places))


def _better(a: Column, b: Column) -> Column:
    """Whether ``a`` suppresses ``b``: it contains it and comes first."""
    inside = (a["start"] <= b["start"]) & (b["end"] <= a["end"])
    longer = (a["end"] - a["start"]) - (b["end"] - b["start"])
    first = ((a["priority"] < b["priority"])
             | ((a["priority"] == b["priority"]) & ((longer > 0) | ((longer == 0) & (a["rule"] < b["rule"])))))
    return inside & first


def scan(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_words, n_base, first_word,
    last_word, base_labels`` and the kept ``detections`` (label, priority,
    rule, start, end in words), ``labels`` and ``score``."""
    made = rules()
    table = F.array(*[F.struct(*[F.lit(r[k]).alias(k) for k in ("label", "priority", "keyword", "pattern", "rule")])
                      for r in made])
    keywords = sorted({r["keyword"] for r in made})
    gate = " (" + "|".join(keywords) + ")(?= )"
    base = "(?:" + "|".join(p for p, _ in BASE) + ")"
    detection = "array<struct<label:string,priority:int,rule:int,start:int,end:int>>"

    df = id_and_text(docs).select("doc_id", words_of(F.col("text")).alias("words"))
    words = F.col("words")
    present = F.array_distinct(F.regexp_extract_all(words, F.lit(gate), F.lit(1)))
    df = df.select("doc_id", "words", present.alias("present"))
    active = F.filter(table, lambda r: F.array_contains(F.col("present"), r["keyword"]))
    found = F.when(F.size("present") > 0, F.flatten(F.transform(active, lambda r: _detections(words, r))))
    df = df.withColumn("found", F.coalesce(found, F.expr(f"cast(array() as {detection})")))
    kept = F.filter("found", lambda d: ~F.exists("found", lambda e: _better(e, d)))
    has_base = F.contains(words, F.lit(" license "))
    n_base = F.when(has_base, F.regexp_count(words, F.lit(f" {base}(?= )"))).otherwise(F.lit(0)).cast("long")
    df = df.select("doc_id", "words", kept.alias("detections"), n_base.alias("n_base"))
    hit = F.col("n_base") > 0
    before_first = F.regexp_extract(words, f"(?s)^(.*?) {base} ", 1)
    before_last = F.regexp_extract(words, f"(?s)^(.*) {base} ", 1)
    base_labels = F.array_compact(F.array(*[
        F.when(hit & F.contains(words, F.lit(f" {phrase} ")), F.lit(label)) for phrase, label in BASE]))
    labels = F.array_union(base_labels, F.transform("detections", lambda d: d["label"]))
    weights = F.array(*[F.lit(w) for w in WEIGHTS])
    doubt = F.aggregate("detections", F.lit(1.0), lambda p, d: p * (1 - F.get(weights, d["priority"])))
    return df.select(
        "doc_id",
        F.when(words == "  ", F.lit(0)).otherwise(_spaces(words) - 1).cast("long").alias("n_words"),
        "n_base",
        F.when(hit, _spaces(before_first)).cast("long").alias("first_word"),
        F.when(hit, _spaces(before_last)).cast("long").alias("last_word"),
        F.concat_ws(",", F.array_sort(base_labels)).alias("base_labels"),
        F.concat_ws(",", F.array_sort(F.array_distinct(labels))).alias("labels"),
        (1 - doubt * F.pow(F.lit(0.2), F.least("n_base", F.lit(8)))).alias("score"),
        "detections",
    )
