"""Queries with SQL agree with DuckDB; every query keeps all documents and its contract's columns."""

import duckdb
import pytest

from ledgerlens.llm.registry import ORACLES, QUERIES

from .conftest import SMOKE


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMOKE}/{t}.parquet'")
    got = QUERIES[name](spark, SMOKE)
    cols = sorted(got.columns)
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({ORACLES[name]})").fetchall()
    assert sorted(map(repr, (tuple(r[c] for c in cols) for r in got.collect()))) == sorted(map(repr, want))


def test_licence_scan_runs_no_python(spark):
    plan = QUERIES["op7_licence_scan"](spark, SMOKE)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "ExistingRDD"))


@pytest.mark.parametrize("name, cols", [
    ("op1_sharding", "doc_id size text_crc32 law shard slot grown_shard"),
    ("op3_quality_rules", "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept"),
    ("op4_token_counts", "doc_id n_bytes n_tokens over_limit"), ("op5_language_id", "doc_id held_out lang_pred score"),
    ("op6_bpe_round_trip", "doc_id n_tokens ids_sha256 decoded_sha256")])
def test_one_row_per_document(spark, name, cols):
    got = QUERIES[name](spark, SMOKE)
    assert set(cols.split()) <= set(got.columns)
    assert sorted(r[0] for r in got.select("doc_id").collect()) == list(range(200))
