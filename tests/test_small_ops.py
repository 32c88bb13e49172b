"""Small library operators without a registered query of their own."""

import os

import pytest
from pyspark.sql import functions as F

from markerlens.operators import consolidate as K
from markerlens.operators import evaluate as V
from markerlens.operators import markers as M
from markerlens.sources import readers as R
from markerlens.sources import writers as W


def test_lenient_int_title_body_subset(spark):
    df = spark.createDataFrame([("1", "t", "b"), ("x", None, "c"), ("", "u", "d")], "a string, title string, text string")
    got = [(r["a"], r["a_raw"]) for r in R.lenient_int(df, ["a"]).collect()]
    assert got == [(1, "1"), (None, "x"), (None, "")]
    tb = [r["text"] for r in R.title_body(df).collect()]
    assert tb == ["t b", None, "u d"]
    assert R.positional_subset(df, 2).columns == ["a", "title"]


def test_json_lines_roundtrip(spark, tmpdir_path):
    df = spark.createDataFrame([(1, "a")], "id long, t string")
    out = os.path.join(tmpdir_path, "j")
    W.write_json_lines(df, out)
    assert spark.read.json(out).first()["t"] == "a"


def test_class_report_rows(spark):
    s = spark.createDataFrame([(0, "t", "m", 0, 0.1, 0), (1, "t", "m", 1, 0.9, 1), (2, "t", "m", 1, 0.2, 0)],
                              "doc_id long, task string, model string, label int, prob double, pred int")
    rep = {r["class"]: r for r in V.class_report(s).collect()}
    assert rep["1"]["recall"] == pytest.approx(0.5) and rep["1"]["support"] == 2
    assert rep["weighted avg"]["support"] == 3


def test_range_assignment_overlaps(spark):
    items = spark.createDataFrame([(i,) for i in range(10)], "item_id long")
    ranges = spark.createDataFrame([("a", 0, 5), ("b", 4, 9)], "annotator string, lo long, hi long")
    got = {r["annotator"]: r["n"] for r in K.range_assignment(items, ranges).groupBy("annotator")
           .agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got == {"a": 6, "b": 6}


def test_marker_kinds(spark):
    docs = spark.createDataFrame([(1, "WOW!! this is hopeless, USA said MAYBE the thing"), (2, "")],
                                 "doc_id long, text string")
    lex = spark.createDataFrame([("m", "maybe"), ("m", "the")], "category string, term string")
    acr = spark.createDataFrame([("USA",)], "term string")
    kinds = {(r[1], r[2]) for r in M.marker_spans(docs, lex, acronyms=acr).collect()}
    assert ("all_caps", "WOW") in kinds and ("all_caps", "USA") not in kinds
    assert ("adjectives", "hopeless") in kinds and ("exclamation_marks", "!!") in kinds
    assert ("hedging", "MAYBE") in kinds


def test_terms_of_several_words_are_never_lost(spark):
    docs = spark.createDataFrame([(1, "I guess it is sort of fine, maybe.")], "doc_id long, text string")
    lex = spark.createDataFrame([("h", "I guess"), ("h", "sort of"), ("h", "maybe")], "category string, term string")
    found = {r["text"] for r in M.marker_spans(docs, lex).where("feature = 'hedging'").collect()}
    assert found == {"I guess", "sort of", "maybe"}
    roots = {r["text"] for r in M.marker_spans(docs, lex, hedge_match="prefix").where("feature = 'hedging'").collect()}
    assert roots == found


from hypothesis import given, settings, strategies as st  # noqa: E402


def greedy_py(spans):
    tags = {}
    for s, e, tag in spans:
        tags.setdefault((s, e), set()).add(tag)
    last, kept = -1, []
    for s, e in sorted(tags):
        if s >= last:
            last = e
            kept.append((s, e, sorted(tags[s, e])))
    return kept


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 40), st.integers(0, 6), st.sampled_from(["a", "b"])), min_size=1, max_size=15))
def test_resolve_spans_matches_greedy(spark, raw):
    spans = [(s, s + ln, tag) for s, ln, tag in raw]
    df = spark.createDataFrame([(1, tag, "x", s, e) for s, e, tag in spans],
                               "doc_id long, feature string, text string, start int, end int")
    assert sorted((r["start"], r["end"], r["tags"]) for r in M.resolve_spans(df).collect()) == greedy_py(spans)
