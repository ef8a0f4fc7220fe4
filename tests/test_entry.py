import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
#: Together they touch every operator module; the driver compares all of them.
NAMES = [
    "ingest_records", "trust_scores", "identity_gate", "duplicate_gate", "candidate_claims", "aspect_support", "rating_conflicts", "segment_splits", "option_index", "option_scope", "kept_quotes",
    "quote_verdicts", "quote_outcomes", "quote_walk", "quote_ledger", "quote_gate_summary", "gated_payloads", "unconditional_check", "folded_texts", "tag_partition", "resolved_goods", "claim_confidence", "ingest_profile", "trust_profile", "lineages", "condition_subjects", "claim_contract",
    "golden_contract", "layout_text", "api_reviews", "table_digest", "closed_fields", "review_records", "photo_trust", "claim_rows", "golden_misses", "label_conditions", "array_reviews", "file_codebook",
]


def plain(v):
    return repr(round(v, 9)) if isinstance(v, float) else str(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for p in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    names = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in names) for r in df.collect())
    found = duck.execute(entry.oracle_sql()[name])
    own = [d[0] for d in found.description]
    assert sorted(own) == names
    want = sorted(tuple(plain(r[own.index(c)]) for c in names) for r in found.fetchall())
    assert got == want and got


def test_every_query_has_sql_or_is_tested_otherwise():
    brute = {n for n in entry.queries() if n.startswith("op") and n[2].isdigit()} | {"pipeline"}
    assert set(entry.queries()) - set(entry.oracle_sql()) <= brute


def test_entry(spark):
    assert entry.entry(spark).columns[:4] == ["product_id", "axis", "segment", "aspect"]
