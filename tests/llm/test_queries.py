import os

import duckdb
import pytest

from tillroll.llm.oracle import oracle_sql
from tillroll.llm.queries import QUERIES
from tillroll.sources.tables import table_path

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
COLUMNS = {
    "op1_token_store": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op2_context_mixing": ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    "op3_license_scan": ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
    "op4_packing": ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
    "op5_quality": ["doc_id", "held_out", "score", "predicted"],
    "op6_secret_scan": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op7_winnowing": ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    "op8_hyperminhash": ["doc_id", "n_shingles", "component_id", "kept"],
    "op9_piece_sampling": ["doc_id", "n_pieces", "ids_crc32", "lossless"],
    "op10_exact_dedup": ["doc_id", "keep_id", "group_size", "kept", "text_sha256"],
    "op11_whitening": ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
    "op12_relative_parse": ["doc_id", "n_words", "n_removed", "kept_sha256"],
    "op13_phrases": ["lang", "rank", "phrase", "a", "l", "r", "n", "score"],
}


def test_names():
    assert set(QUERIES) == set(COLUMNS)


@pytest.mark.parametrize("name", list(COLUMNS))
def test_runs_over_all_documents(spark, name):
    df = QUERIES[name](spark, SF)
    assert set(COLUMNS[name]) <= set(df.columns)
    rows = df.collect()
    if name == "op11_whitening":
        assert len({r.vec_id for r in rows}) == 500 and len(rows) == 4000
        assert rows[0].identity_error < 1e-9
    elif name != "op13_phrases":
        assert len({r.doc_id for r in rows}) == 200 and (name == "op4_packing" or len(rows) == 200)
    if name == "op9_piece_sampling":
        assert all(r.lossless for r in rows)
    if name in oracle_sql():
        con = duckdb.connect()
        con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{table_path(SF, 'documents')}')")
        found = con.sql(oracle_sql()[name])
        assert sorted(tuple(r[c] for c in found.columns) for r in rows) == sorted(found.fetchall())
