"""The queries over the smallest tables, and their SQL in DuckDB."""

import duckdb
import pytest

from turnmill.llm.queries import QUERIES
from turnmill.llm.sql import ORACLE

DATA = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_ngram_jaccard": {"doc_id", "n_shingles", "component_id"},
    "op2_substring_dedup": {"doc_id", "n_words", "n_removed", "kept_sha256"},
    "op3_toxicity": {"doc_id", "held_out", "score", "predicted"},
    "op4_language_id": {"doc_id", "held_out", "lang_pred", "score"},
    "op5_mix_sources": {"doc_id", "size", "source_size", "target", "taken"},
    "op6_repetition_rules": {"doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"},
    "op7_pack_tokens": {"ids", "cu_seqlens", "position_resets", "doc_ids"},
    "op8_quality_classifier": {"doc_id", "held_out", "score", "predicted"},
    "op9_decontaminate": {"doc_id", "item_id"},
    "op10_secret_scan": {"doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"},
    "op12_piece_codec": {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "agrees"},
}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql_agrees(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "labels", "embeddings"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    wanted = con.sql(ORACLE[name]).df()
    got = QUERIES[name](spark, DATA).toPandas()
    columns = sorted(wanted.columns)
    assert columns == sorted(got.columns)
    a, b = (x[columns].sort_values(columns).reset_index(drop=True).convert_dtypes() for x in (wanted, got))
    assert a.astype(str).equals(b.astype(str))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_runs_over_all_documents(spark, name):
    rows = QUERIES[name](spark, DATA).toPandas()
    assert COLUMNS[name] <= set(rows.columns)
    documents = spark.read.parquet(f"{DATA}/documents.parquet").count()
    if name == "op7_pack_tokens":
        assert len({d for ids in rows["doc_ids"] for d in ids}) == documents
    elif name != "op9_decontaminate":
        assert len(rows) == documents
