import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from tillroll.llm import token_store
from tillroll.llm.common import work_path
from tillroll.llm.tokens import Encoder

ODD = ["", "  a  b\n\n c ", "İstanbul ſ 12½ 3² x's 'S DON'T", "日本 語 text", "á e\x85f\x1cg\xa0 h",
       "<|endoftext|> a", "b<|endoftext|><|startoftext|>", " <|ENDOFTEXT|> <|StartOfText|> c", "<|endoftext| >",
       "\r\n\tx  \n", "'s't it's I'LL", "ǅ ß ĳ İ", "ªº µ_x__y", "Å K", "a \nb", "a\xa0 b", " x",
       "x \t", "a 's b ' s", "q" * 3000, "x\n" * 50]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_encoder_equals_the_library(vocabulary, name):
    e = Encoder(vocabulary(name), held=10)
    plain = Tokenizer.from_file(vocabulary(name))
    truth = [np.asarray(plain.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in ODD]
    assert e.kind == name.split("_")[0]
    assert e(ODD) == truth
    assert e(ODD[::-1]) == truth[::-1]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_added_tokens_are_the_librarys(vocabulary, name):
    plain, e = Tokenizer.from_file(vocabulary(name)), Encoder(vocabulary(name))
    for number, token in plain.get_added_tokens_decoder().items():
        for text in (token.content, f"a {token.content}b", token.content * 3, f"x\n{token.content} "):
            ids = plain.encode(text, add_special_tokens=False).ids
            assert number in ids and e([text]) == [np.asarray(ids, "<u4").tobytes()]


def test_other_rules_go_whole(vocabulary, tmp_path):
    import json

    file = json.load(open(vocabulary("byte_bpe_50k.json")))
    file["pre_tokenizer"] = {"type": "Sequence", "pretokenizers": [
        {"type": "Digits", "individual_digits": True}, file["pre_tokenizer"]]}
    other = tmp_path / "other.json"
    other.write_text(json.dumps(file))
    plain, e = Tokenizer.from_file(str(other)), Encoder(str(other))
    assert e.kind is None
    texts = ["room 1234 and 56", "a b"]
    assert e(texts) == [np.asarray(plain.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]


def test_round_trip_and_digest(spark, docs, vocabulary):
    path = vocabulary("word_bpe_49k.json")
    rows = [(7 * i % 41, ODD[i % len(ODD)]) for i in range(41)] + [(100, None), (None, "null id"), (3, "again")]
    got = token_store.store_digest(docs(rows), path, end_id=2).collect()
    t = Tokenizer.from_file(path)
    start = 0
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    by_start = sorted(got, key=lambda r: r.start)
    assert len(by_start) == len(rows)
    for (i, text), r in zip(ordered, by_start):
        ids = np.array(t.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (i, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_file_format(spark, docs, vocabulary, tmp_path):
    rows = [(i, f"word{i % 7} " * 200) for i in range(400)]
    path = token_store.write_store(docs(rows), work_path(spark, "store"), vocabulary("word_bpe_49k.json"), 2, parts=2,
                                   row_group_bytes=64 << 10, page_bytes=8 << 10, page_rows=50)
    import glob

    files = sorted(glob.glob(path.removeprefix("file:") + "/*.parquet"))
    assert len(files) == 2
    last = -1
    for f in files:
        meta = pq.ParquetFile(f).metadata
        column = {meta.row_group(0).column(i).path_in_schema: meta.row_group(0).column(i)
                  for i in range(meta.num_columns)}
        ids = next(c for name, c in column.items() if name.startswith("ids"))
        assert any("DICTIONARY" in e for e in ids.encodings)
        assert "DELTA_BINARY_PACKED" in column["doc_id"].encodings
        assert ids.has_offset_index and column["doc_id"].has_column_index
        own = pq.read_table(f, columns=["doc_id"])["doc_id"].to_pylist()
        assert own == sorted(own) and own[0] > last
        last = own[-1]
    few = token_store.read_store(spark, path, 10, 12)
    assert sorted(r.doc_id for r in few.select("doc_id").collect()) == [10, 11, 12]
    plan = few.select("n_tokens")._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(doc_id,10)" in plan and "ids" not in plan.split("ReadSchema")[-1].split("\n")[0]


def test_empty_table(docs, vocabulary):
    assert token_store.store_digest(docs([]), vocabulary("word_bpe_49k.json"), 2).count() == 0


def test_a_word_is_remembered_once(vocabulary):
    """A run that is one word and that word share an entry, so a worker holds
    each of them once and never more than its bound in all."""
    e = Encoder(vocabulary("word_bpe_49k.json"), held=1000)
    plain = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    texts = ["zorble quux zorble", "quux, zorble!", "zorble"]
    assert e(texts) == [np.asarray(plain.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert e.runs is e.words and sorted(e.words) == ["!", ",", "quux", "quux,", "zorble", "zorble!"]
