import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tillroll.llm import packing
from tillroll.llm.tokens import Encoder


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 256), max_size=60), st.integers(1, 12))
def test_differencing_is_a_partition(sizes, ways):
    windows = packing.differencing(sizes, ways)
    assert len(windows) == ways and sorted(i for w in windows for i in w) == list(range(len(sizes)))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 100), min_size=1, max_size=60))
def test_windows_never_exceed_the_capacity(sizes):
    windows = packing.windows_of(sizes, 100)
    assert sorted(i for w in windows for i in w) == list(range(len(sizes)))
    assert all(0 < sum(sizes[i] for i in w) <= 100 for w in windows)


def test_differencing_known_cases():
    # 4 5 6 7 8 in two ways: differencing gives 16 and 14.
    assert sorted(sum([4, 5, 6, 7, 8][i] for i in w) for w in packing.differencing([4, 5, 6, 7, 8], 2)) == [14, 16]
    assert len(packing.windows_of([60, 60, 60], 100)) == 3  # two would hold 180 of 200, but none fits two


def test_full_blocks_are_divided_once(monkeypatch):
    tried = []
    plain = packing.differencing
    monkeypatch.setattr(packing, "differencing", lambda sizes, ways: tried.append(ways) or plain(sizes, ways))
    block = packing._Block(1024, 256, 64)
    while block.tokens < block.goal:
        size = min(256, block.goal - block.tokens, 1 + len(block.rows) * 37 % 256)
        block.rows.append((len(block.rows), 0, size, b"", size))
        block.tokens += size
    assert sum(r[2] for w in block.windows() for r in w) == block.goal and tried == [64]


def test_equal_pieces_fall_into_equal_windows():
    windows = packing.windows_of([100] * 24, 400)
    assert sorted(map(len, windows)) == [4] * 6


def brute_force(sizes, ways):
    """The least possible largest window."""
    from itertools import product

    return min(max(sum(s for s, w in zip(sizes, where) if w == k) for k in range(ways))
               for where in product(range(ways), repeat=len(sizes)))


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 50), min_size=1, max_size=7), st.integers(1, 3))
def test_differencing_is_near_the_best(sizes, ways):
    largest = max(sum(sizes[i] for i in w) for w in packing.differencing(sizes, ways))
    best = brute_force(sizes, ways)
    assert best <= largest <= best * (4 / 3 - 1 / (3 * max(ways, 1))) + 1e-9


def test_pieces_hold_every_token_once(docs, vocabulary):
    path = vocabulary("byte_bpe_50k.json")
    rows = [(i, f"word {i} " * (i * 13 % 700)) for i in range(120)] + [(500, None), (None, "x"), (7, "seven again")]
    pieces = packing.with_checksums(packing.pack(docs(rows, parts=2), path, end_id=0)).collect()
    e = Encoder(path)
    want = sorted(zlib.crc32(x + b"\0\0\0\0") for x in e([t or "" for _, t in rows]))
    docs_seen, by_sequence = {}, {}
    for p in pieces:
        docs_seen.setdefault((p.doc_id, p.doc_tokens), []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
    assert sum(p.length for p in pieces) == sum(len(x) // 4 + 1 for x in e([t or "" for _, t in rows]))
    for (_, tokens), own in docs_seen.items():
        own.sort(key=lambda p: p.start)
        assert [p.start for p in own] == np.cumsum([0] + [p.length for p in own])[:-1].tolist()
        assert sum(p.length for p in own) == tokens
    for own in by_sequence.values():
        own.sort(key=lambda p: p.offset)
        assert [p.offset for p in own] == np.cumsum([0] + [p.length for p in own])[:-1].tolist()
        assert sum(p.length for p in own) <= 1024
    whole = [p for p in pieces if p.length == p.doc_tokens]
    assert {p.ids_crc32 for p in whole} <= set(want)
    full = sum(sum(p.length for p in own) for own in by_sequence.values())
    assert full / (1024 * len(by_sequence)) > 0.9


def test_sequences_join_pieces(docs, vocabulary):
    pieces = packing.pack(docs([(i, "some words here " * 90) for i in range(40)], parts=1), vocabulary("byte_bpe_50k.json"), 0)
    rows = packing.sequences(pieces).collect()
    assert all(len(r.ids) == 4 * r.length <= 4096 for r in rows)
    assert sum(r.length for r in rows) == sum(p.length for p in pieces.collect())


def test_empty_table(docs, vocabulary):
    assert packing.pack(docs([]), vocabulary("byte_bpe_50k.json"), 0).count() == 0
