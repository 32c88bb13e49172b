"""Driver contract: entry() smoke and a spot-check of queries against their SQL oracle."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from markerlens.session import TABLES

SF = "/root/testdata/sf0.001"
SPOT = ("clean_corpus", "corpus_stats", "top_bigrams", "marker_density", "fleiss_per_feature",
        "cohen_pairwise", "majority_vote", "bm25_all_terms", "auc_roc", "threshold_sweep",
        "tfidf_vocabulary", "stratified_split")


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "text" in df.columns


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.5f}"
    return "null" if v is None else str(v)


@pytest.mark.parametrize("name", SPOT)
def test_oracle_spot(spark, con, name):
    df = E.queries()[name](spark, SF)
    rows = df.collect()
    res = con.sql(E.oracle_sql()[name])
    cols, ocols = df.columns, res.columns
    assert sorted(cols) == sorted(ocols)
    key = sorted(cols)
    a = sorted("|".join(norm(r[c]) for c in key) for r in rows)
    orows = res.fetchall()
    b = sorted("|".join(norm(r[ocols.index(c)]) for c in key) for r in orows)
    assert a == b
