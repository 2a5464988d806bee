import hashlib
import random

import pytest

from tillroll.llm import exact_dedup


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault((t or "").encode().lower(), []).append(i)
    out = []
    for body, ids in groups.items():
        known = [i for i in ids if i is not None]
        best = max(known) if known else None
        out += [(i, best, len(ids), hashlib.sha256(body).hexdigest()) for i in ids]
    return sorted(out, key=repr)


def rows_with_copies(n, seed=1):
    r = random.Random(seed)
    texts = ["", "Ä b", "a" * 5000] + [" ".join(r.choices("x y z Wort".split(), k=r.randint(1, 6))) for _ in range(n)]
    return [(i, r.choice(texts)) for i in range(n)] + [(n, None), (None, "x"), (None, "only null id"), (5, "twice"), (5, "twice")]


@pytest.mark.parametrize("table_bytes, buckets", [(1 << 20, 4), (300, 2)])
def test_equals_brute_force(docs, table_bytes, buckets):
    rows = rows_with_copies(150) + [(1000 + i, "HOT text" if i % 2 else "hot Text") for i in range(120)]
    got = exact_dedup.exact_groups(docs(rows, parts=5), table_bytes, buckets).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=repr) == brute(rows)
    kept = [r for r in got if r.kept]
    assert len(kept) == len({r.text_sha256 for r in got}) == len({r.text_sha256 for r in kept})
    assert all(r.doc_id == r.keep_id for r in kept)


def test_empty_table(docs):
    df = exact_dedup.exact_groups(docs([]))
    assert df.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"] and df.count() == 0


def test_equal_digests_of_different_contents_stay_apart():
    table = exact_dedup.ContentTable(1 << 20)
    assert table.find(b"same-digest", b"one") == (0, True)
    assert table.find(b"same-digest", b"two") == (1, True)
    assert table.find(b"same-digest", b"one") == (0, False)


def test_table_keeps_its_room():
    table = exact_dedup.ContentTable(1000)
    found = [table.find(hashlib.sha256(bytes([i])).digest(), bytes([i]) * 200)[0] for i in range(9)]
    assert -1 in found and table.used <= 1000 + 264
    assert table.find(hashlib.sha256(bytes([0])).digest(), bytes([0]) * 200) == (0, False)


def test_drop_copies_keeps_columns(docs):
    df = docs([(1, "a"), (2, "A"), (3, "b"), (4, None), (5, "")])
    out = exact_dedup.drop_copies(df)
    assert out.columns == df.columns and sorted(r.doc_id for r in out.collect()) == [2, 3, 5]


def test_a_run_has_bounded_members(docs, monkeypatch):
    monkeypatch.setattr(exact_dedup, "RUN_MEMBERS", 5)
    rows = [(i, "same" if i % 3 else f"t{i}") for i in range(200)]
    got = {x.doc_id: (x.keep_id, x.group_size, x.kept) for x in exact_dedup.exact_groups(docs(rows)).collect()}
    same = [i for i, t in rows if t == "same"]
    assert got == {i: (max(same), len(same), i == max(same)) if t == "same" else (i, 1, True) for i, t in rows}


def test_runs_are_cut_at_their_members(monkeypatch):
    import pyarrow as pa
    import pyspark

    monkeypatch.setattr(exact_dedup, "RUN_MEMBERS", 5)
    monkeypatch.setattr(pyspark.TaskContext, "get", classmethod(lambda cls: type("T", (), {"partitionId": lambda self: 0})()))
    batch = pa.RecordBatch.from_arrays([pa.array(range(23)), pa.array(["x"] * 23)], ["doc_id", "text"])
    runs = [r for b in exact_dedup._fold_documents(1 << 20)(iter([batch])) for r in b.to_pylist()]
    assert [r["copies"] for r in runs] == [5, 5, 5, 5, 3] and len({r["run_id"] for r in runs}) == 5
