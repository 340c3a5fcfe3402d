"""Each query over its whole table: rows, contract columns, and the SQL twin where there is one."""

import pytest
from tests.oracle_check import compare, duck

import __spark_entry__ as E

COLUMNS = {
    "op2": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op3": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op4": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    "op5": "page_id payload_bytes payload_digest record_type refers_to",
    "op6": "doc_id size source_size target taken",
    "op7": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op8": "query_id rank vec_id score",
    "op9": "doc_id n_assign n_access n_hex base_sha256 spans",
    "op10": "doc_id fingerprint component_id",
    "op11": "doc_id held_out lang_pred score",
    "op12": "part filter_order step kept removed redundant unique_fails good_lost toxic_lost shapley",
    "op13": "vec_id component n deviation whitened explained identity_error",
}
TABLE = {"op5": "pages"}


@pytest.mark.parametrize("key", sorted(k for k in E.queries() if k.startswith("op")))
def test_contract_columns_and_rows(spark, sf, key):
    op = key.split("_")[0]
    df = E.queries()[key](spark, sf)
    assert set(COLUMNS.get(op, "").split()) <= set(df.columns)
    n = df.count()
    if op in ("op2", "op3", "op5", "op6", "op7", "op9", "op10", "op11"):
        assert n == spark.read.parquet(f"{sf}/{TABLE.get(op, 'documents')}.parquet").count()
    assert n > 0


@pytest.mark.parametrize("key", sorted(k for k in E.oracle_sql() if k.startswith("op")))
def test_query_equals_sql(spark, sf, key):
    r = compare(spark, duck(sf), key, sf)
    assert r["status"] == "ok", r
