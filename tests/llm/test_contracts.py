"""Every corpus query once over a whole small table: its columns, their types and its rows."""

import pytest

from tallyroom.llm.queries import QUERIES

DIR = "/root/testdata/sf0.001"
COLUMNS = {
    "op1": ("documents", "doc_id n_words:bigint word_chars:bigint n_symbols:bigint n_dup_lines:bigint "
            "n_repeat_words:bigint base_failed:boolean kept:boolean"),
    "op2": (None, "query_id:bigint rank:int vec_id:bigint score:double"),
    "op3": ("documents", "doc_id held_out:boolean n_tokens:bigint n_known:bigint train_tokens:bigint "
            "base_score:double score:double"),
    "op4": ("documents", "doc_id n_shingles:bigint component_id kept:boolean"),
    "op5": ("documents", "doc_id size:bigint source_size:bigint target:double taken:bigint"),
    "op6": ("documents", "doc_id held_out:boolean score:double predicted:int"),
    "op7": ("pages", "page_id payload_bytes:bigint payload_digest:string record_type:string refers_to"),
    "op8": ("documents", "doc_id n_tokens:bigint ids_sha256:string decoded_sha256:string"),
    "op9": (None, ""),
    "op10": ("documents", "doc_id n_words:bigint n_base:bigint first_word:bigint last_word:bigint "
             "base_labels:string labels:string score:double"),
    "op11": (None, "vec_id component:int n:bigint deviation:bigint whitened:double explained:double "
             "identity_error:double"),
    "op12": ("documents", "doc_id n_lines:bigint n_dropped:bigint kept_sha256:string"),
    "op13": (None, "item_id rank:int doc_id:bigint score:bigint"),
}


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n.startswith("op")))
def test_columns_types_and_rows(spark, name):
    source, columns = COLUMNS[name.split("_")[0]]
    df = QUERIES[name](spark, DIR)
    kinds = dict(df.dtypes)
    for column in columns.split():
        column, _, kind = column.partition(":")
        assert column in kinds and kind in ("", kinds[column]), (column, kinds)
    rows = df.collect()
    assert rows
    if source:
        key = "page_id" if source == "pages" else "doc_id"
        given = [r[key] for r in spark.read.parquet(f"{DIR}/{source}.parquet").select(key).collect()]
        assert sorted(r[key] for r in rows) == sorted(given)
    for r in rows:
        if "score" in kinds and name.split("_")[0] in ("op6", "op10"):
            assert 0 <= r["score"] <= 1
        if name.startswith("op6"):
            assert r["predicted"] == (r["score"] >= 0.3)
