import hashlib
import math
from collections import Counter

import pytest

from tillroll.llm import piece_sampling as p

ODD = ["", "a", " ", "  a  b ", "▁x ▁", "日本語 text 😀", "\n\t\x00z", "É" + "q" * 5000 + " e", "<0x0A> <s> </s>", "then", "x" * 70000, " " * 5000 + "y", "z "* 3000]


@pytest.fixture(scope="module")
def path():
    return pytest.importorskip("public_tokenizers").path("piece_bpe_32k.model")


def test_lossless_and_reproducible(docs, path, monkeypatch):
    rows = list(enumerate(ODD)) + [(100, None), (None, "no id"), (2, "again")]
    once = {(r.doc_id, tuple(r.ids)) for r in p.sample_pieces(docs(rows, parts=4), path).collect()}
    again = {(r.doc_id, tuple(r.ids)) for r in p.sample_pieces(docs(rows[::-1], parts=1), path).collect()}
    assert once == again and len(once) == len(rows)
    out = p.decode_pieces(p.sample_pieces(docs(rows), path), path).collect()
    assert sorted(r.text for r in out) == sorted(t or "" for _, t in rows)
    assert all(hashlib.sha256(r.text.encode()).hexdigest() == r.text_sha256 for r in out)
    assert p.sample_pieces(docs([]), path).count() == 0


def test_noncharacters_come_back(docs, path):
    rows = [(1, "a\ufdd0b \ufdd0"), (2, "\u2581\ufdd0 \u2581"), (3, "\uffff\U0010ffff x")]
    out = p.decode_pieces(p.sample_pieces(docs(rows), path), path).collect()
    assert sorted(r.text for r in out) == sorted(t for _, t in rows)


def test_runs_in_parts_give_the_same(path, monkeypatch):
    v = p.Vocabulary(path)
    texts = ["some words of a text " * 9, "more\nlines here"]
    whole = p.Sampler(v).encode([1, 2], texts)
    monkeypatch.setattr(p, "AT_ONCE", 10)
    assert [x.tolist() for x in p.Sampler(v).encode([1, 2], texts)] == [x.tolist() for x in whole]


def ways(v, text, pieces=None):
    """Every segmentation of a text, as piece ids, with its weight."""
    pieces = pieces or {b.decode(): i for i, b in enumerate(v.bytes_of) if i > 258 and b}
    if not text:
        yield (), 0.0
        return
    for k in range(1, len(text) + 1):
        if text[:k] in pieces:
            for rest, weight in ways(v, text[k:], pieces):
                yield (pieces[text[:k]], *rest), weight + v.weight[pieces[text[:k]]]
    raw = text[0].encode()
    for rest, weight in ways(v, text[1:], pieces):
        yield (*(int(v.byte_ids[b]) for b in raw), *rest), weight + len(raw) * v.byte_weight


@pytest.mark.parametrize("text", ["then", "    i", "a  b ", "x\n  é"])
@pytest.mark.parametrize("long", [False, True])
@pytest.mark.parametrize("temperature", [1.0, 0.3])
def test_draws_follow_the_lattice(path, monkeypatch, temperature, long, text):
    if long:  # every run is drawn window by window
        monkeypatch.setattr(p, "LONG", 0)
        monkeypatch.setattr(p, "WINDOW", 3)
    v = p.Vocabulary(path, temperature)
    n = 1000 if long else 20000
    shares = Counter()
    for way, weight in ways(v, " " + text):
        shares[way] += math.exp(weight)
    total = sum(shares.values())
    got = Counter(tuple(x.tolist()) for x in p.Sampler(v, seed=5).encode(list(range(n)), [text] * n))
    assert set(got) <= set(shares)
    for way, share in shares.items():
        share /= total
        assert abs(got[way] / n - share) < 5 * (share * (1 - share) / n) ** 0.5 + 1 / n


def test_sums_of_random_texts(path, monkeypatch):
    v, random = p.Vocabulary(path), __import__("random").Random(3)
    for _ in range(60):
        text = "".join(random.choices("  ethn\té▁", k=random.randint(1, 7)))
        truth = math.log(sum(math.exp(weight) for _, weight in ways(v, " " + text)))
        runs = v.runs.findall(" " + text)
        found = p.Sampler(v).lattice(runs)
        assert abs(found["sums"][found["last"]].sum() - truth) < 1e-9
        monkeypatch.setattr(p, "WINDOW", random.randint(1, 9))
        assert abs(sum(p.Sampler(v).sums_of(p._points(r))[-1] for r in runs) - truth) < 1e-9


def test_all_pieces_are_in_the_lattice(path):
    import sentencepiece

    v, model = p.Vocabulary(path), sentencepiece.SentencePieceProcessor(model_file=path)
    inner = [model.id_to_piece(i) for i in range(model.get_piece_size()) if p.SIGN in model.id_to_piece(i)[1:]]
    for name in inner:
        run = name.replace(p.SIGN, " ")
        assert v.runs.findall(run + "x")[0] == run + "x"
        assert model.piece_to_id(name) in v.edges(p._points(run), len(run) - p.np.arange(len(run)))[2]


def test_a_full_table_is_emptied(path, monkeypatch):
    v = p.Vocabulary(path)
    texts = [f"some words number{i} of  a text" for i in range(40)]
    whole = [x.tolist() for x in p.Sampler(v).encode(list(range(40)), texts)]
    monkeypatch.setattr(p, "HELD", 10)
    own = p.Sampler(v)
    assert [own.encode([i], [t])[0].tolist() for i, t in enumerate(texts)] == whole
    assert len(own.known) < 20
