import duckdb
import pytest

import __spark_entry__ as entry
from tools.check_oracle import TABLES, canonical

CHEAP = [
    "ingest_hits", "merge_pages", "hits_audit", "catalogue", "list_to_string", "coerce_dates", "profile",
    "paragraphs", "term_paragraphs", "stem_vocab", "tfidf_top_terms", "duplicate_rows", "missing_files",
    "crosstab_top", "report_class_pct", "report_compare", "stratified_split", "fold_metrics",
    "friedman_stat", "nemenyi_q", "class_report", "model_summary",
]


def test_entry(spark):
    assert entry.entry(spark).columns == ["doc_id", "pos", "terms", "paragraph"]
    assert entry.entry(spark).count() == 346


def test_names():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def con(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", CHEAP)
def test_against_sql(spark, sf, con, name):
    got = entry.queries()[name](spark, sf).toPandas()
    want = con.execute(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert canonical(got) == canonical(want)
