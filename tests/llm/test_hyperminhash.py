import random

import numpy as np
import pytest

from tillroll.llm import hyperminhash as h


def brute(rows, k, percent):
    sets, parent = [], list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set()))
    for a in range(len(rows)):
        for b in range(a):
            n = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * n >= percent * len(sets[a] | sets[b]):
                parent[root(a)] = root(b)
    low = {}
    for i, (doc, _) in enumerate(rows):
        low[root(i)] = min(doc, low.get(root(i), doc))
    return sorted((doc, len(sets[i]), low[root(i)], doc == low[root(i)]) for i, (doc, _) in enumerate(rows))


def family(r, base, n, edits):
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(r.randint(0, edits)):
            words[r.randrange(len(words))] = r.choice("Alpha beta gamma delta eps".split())
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("k, percent", [(3, 85), (5, 80)])
def test_equals_brute_force(docs, monkeypatch, k, percent):
    monkeypatch.setattr(h, "BLOCK", 5)  # several blocks a family
    r = random.Random(3)
    texts = ["", None, " \t\n", "one", "One", "two words", "same words here", "same words  here\n"]
    for size in (12, 60, 200):
        for _ in range(3):
            texts += family(r, [f"w{r.randrange(400)}" for _ in range(size)], 12, max(1, size // 12))
    rows = list(enumerate(texts))
    r.shuffle(rows)
    got = h.near_groups(docs(rows), k, percent).collect()
    assert sorted((x.doc_id, x.n_shingles, x.component_id, x.kept) for x in got) == brute(rows, k, percent)


def test_nulls_repeats_and_empty_table(docs):
    rows = [(1, "a b c d"), (2, "A b  c d"), (None, "a b c d"), (None, "alone at last"), (None, None), (4, "x y z"), (4, "x y z")]
    got = {(x.doc_id, x.n_shingles, x.component_id, x.kept) for x in h.near_groups(docs(rows), 3, 85).collect()}
    assert got == {(1, 2, 1, True), (2, 2, 1, False), (None, 2, 1, False), (None, 1, None, True),
                   (None, 0, None, True), (4, 1, 4, True)}
    assert h.near_groups(docs([])).count() == 0


def test_estimate_is_close():
    r = np.random.default_rng(5)
    for shared in (300, 1500, 2700):
        whole = np.unique(r.integers(1, 2 ** 63, 6000, dtype=np.uint64))
        a, b = whole[:3000], whole[3000 - shared:6000 - shared]
        true = shared / (6000 - shared)
        found, filled = h.estimate(h.sketch(a), h.sketch(b), len(a), len(b))
        assert filled == 256 and abs(found - true) < 0.15


def test_registers_hold_zeros_and_mantissa():
    s = np.unique(np.random.default_rng(1).integers(1, 2 ** 63, 5000, dtype=np.uint64))
    own = np.sort(h.mix(s ^ h._GOLD))
    registers = h.sketch(s)
    for register in range(256):
        least = min(int(x) & (2 ** 56 - 1) for x in own if int(x) >> 56 == register)
        zeros = 56 - least.bit_length()
        behind = ((least << (zeros + 1 + 8)) & (2 ** 64 - 1)) >> 54
        assert registers[register] == zeros << 10 | behind


def test_words_and_pieces_hash_alike(monkeypatch):
    text = ("Some  words\tand\nmore words " * 300).encode()
    whole = h.sets_of([text], 3)[0]
    monkeypatch.setattr(h, "_pieces", lambda t, most=0: h_pieces(t, 97))
    assert (h.sets_of([text], 3)[0] == whole).all()


h_pieces = h._pieces


def test_bands_miss_little():
    for t in (0.8, 0.85):
        rows = h.band_rows(t)
        assert (1 - t ** rows) ** (256 // rows) <= h.MISS
