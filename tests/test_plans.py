"""Physical-plan properties that the scale design relies on (checked on sf0.001 plans)."""

import re

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def plan(spark, name):
    df = E.queries()[name](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


def test_keep_first_uses_map_side_group_limit(spark):
    p = plan(spark, "dedup_clean_key")
    assert "WindowGroupLimit" in p and "Partial" in p


def test_first_n_per_group_limits_before_shuffle(spark):
    p = plan(spark, "first_n_per_source")
    assert re.search(r"WindowGroupLimit .*row_number\(\), 8, Partial", p)


@pytest.mark.parametrize("name", ["top_words", "top_bigrams", "bm25_all_terms", "acquisition_ranking"])
def test_top_k_is_take_ordered(spark, name):
    assert "TakeOrderedAndProject" in plan(spark, name)


def test_scan_prunes_columns_and_pushes_filters(spark):
    p = plan(spark, "dedup_clean_key")
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", p)
    assert scans and all("source" not in s and "n_chars" not in s for s in scans)
    from markerlens.plans.search_queries import sources
    ai = sources(spark, SF)[1]  # the AI source, before the index checkpoint
    s = ai._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(role,assistant\)", s)


@pytest.mark.parametrize("name", ["cohen_pairwise", "fleiss_per_feature", "majority_vote", "tfidf",
                                  "phrase_search", "stratified_split", "auc_roc", "marker_spans"])
def test_no_cartesian_products(spark, name):
    assert "CartesianProduct" not in plan(spark, name)


def test_cohen_has_no_self_join(spark):
    p = plan(spark, "cohen_pairwise")
    # one pivot aggregate per (feature, item); joins only combine small per-pair tables
    assert "SortMergeJoin" not in p or p.count("Scan parquet") <= 3
