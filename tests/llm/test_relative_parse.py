import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from tillroll.llm import relative_parse as rp


def brute(rows):
    """(doc_id, n_words, n_removed, kept words) by the definition; rows with
    one id and other texts need not occur."""
    order = sorted({(rp.NO_ID if i is None else i, (t or "").encode()) for i, t in rows})
    seen, out = set(), {}
    for doc_id, text in order:
        words, gone = text.split(), set()
        for s in range(len(words) - 19):
            window = tuple(words[s:s + 20])
            if window in seen:
                gone.update(range(s, s + 20))
            seen.add(window)
        kept = b" ".join(w for p, w in enumerate(words) if p not in gone)
        out[doc_id, text] = (len(words), len(gone), hashlib.sha256(kept).hexdigest(), kept.decode())
    return sorted(((i, *out[rp.NO_ID if i is None else i, (t or "").encode()]) for i, t in rows), key=repr)


def passages(seed, n=60):
    r = random.Random(seed)

    def words(k, vocabulary=400):
        return [f"w{r.randint(0, vocabulary)}" for _ in range(k)]

    shared = [words(k) for k in (19, 20, 21, 26, 60, 150)]
    rows = []
    for i in range(n):
        own = words(r.randint(0, 80))
        for _ in range(r.randint(0, 3)):
            passage = r.choice(shared)
            a = r.randint(0, len(passage) // 2)
            own += passage[a:] + words(r.randint(0, 15))
        rows.append((i * 3, r.choice([" ", "\n", " \t"]).join(own)))
    line = words(12)
    rows += [(1000 + i, " ".join(words(9) + line + words(9))) for i in range(40)]  # too short to be a copy
    rows += [(2000 + i, rows[5][1]) for i in range(30)]  # a hot group
    rows += [(3000, "a " * 90), (3001, "a b " * 45), (3002, "a b c " * 50), (3003, "b c a " * 20)]
    rows += [(3004, None), (3005, ""), (3006, " \n\t "), (None, " ".join(shared[4])), (3007, "é\u00a0ü " * 30), (3008, "ä ö " * 30)]
    return rows


@pytest.mark.parametrize("seed, parts", [(1, 1), (2, 7)])
def test_equals_brute_force(docs, seed, parts):
    rows = passages(seed)
    got = rp.parsed(docs(rows, parts=parts)).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256, r.kept) for r in got), key=repr) == brute(rows)
    texts = {i: (t or "").encode().split() for i, t in rows}
    for r in got:
        done = 0
        for f in r.factors:  # factors say where the words stand earlier
            assert f.start >= done and f.length > 0
            done = f.start + f.length
            ref = texts[None if f.ref_id == rp.NO_ID else f.ref_id]
            assert texts[r.doc_id][f.start:done] == ref[f.ref_start:f.ref_start + f.length]
        assert sum(f.length for f in r.factors) == r.n_removed


def test_repeated_rows_and_ids(docs):
    text = " ".join(f"x{i}" for i in range(50))
    rows = [(1, text), (1, text), (2, text), (7, "other " + text), (7, text)]
    got = sorted((r.doc_id, r.n_words, r.n_removed) for r in rp.parsed(docs(rows)).collect())
    assert got == [(1, 50, 0), (1, 50, 0), (2, 50, 50), (7, 50, 50), (7, 51, 50)]


def test_empty_table(docs):
    df = rp.removal_digest(docs([]))
    assert df.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"] and df.count() == 0


def test_long_text_in_parts(docs):
    """More words than are worked on at once; a passage over the cut returns."""
    r = random.Random(4)
    words = [str(r.randint(0, 9999)) for _ in range(rp.CHUNK + 3000)]
    passage = words[rp.CHUNK - 40:rp.CHUNK + 40]
    rows = [(1, " ".join(words)), (2, " ".join(["new"] + passage + ["end"])), (3, " ".join(words[10:]))]
    got = {x.doc_id: (x.n_words, x.n_removed) for x in rp.removal_digest(docs(rows)).collect()}
    assert got == {1: (len(words), 0), 2: (82, 80), 3: (len(words) - 10, len(words) - 10)}


def test_stretches_hold_every_window_once(monkeypatch):
    monkeypatch.setattr(rp, "CHUNK", 64)
    r = random.Random(7)
    texts = [" ".join(r.choices("abcdefgh", k=k)) for k in (0, 19, 20, 63, 64, 65, 300)]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(len(texts)), pa.int64()), pa.array([0] * len(texts), pa.int64()), pa.array(texts)],
        ["doc_id", "tie", "text"])
    seen = sorted((e["doc_id"], s) for b in rp._index(iter([batch])) for e in b.to_pylist()
                  for s in range(e["start"], e["start"] + e["windows"]))
    assert seen == [(i, s) for i, t in enumerate(texts) for s in range(len(t.split()) - 19)]


def test_anchor_is_the_last_smallest():
    h = np.array([5, 3, 3, 9, 1, 1, 7, 2], np.uint64)
    assert rp.anchors(h, 3).tolist() == [2, 2, 4, 5, 5, 5]
    assert rp.anchors(h, 1).tolist() == list(range(8))
