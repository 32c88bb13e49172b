"""Highlights, raw tags and lexicons of any size against plain Python."""

import json
import random
import re

import pytest
from pyspark.sql import functions as F

from markerlens.functions.text import TAGS
from markerlens.operators import lexicon_match as L
from markerlens.operators import search as Q
from markerlens.operators import spans as P


def highlight_py(text, words, active):
    found = {}
    for tag in TAGS:
        if active and tag not in active:
            continue
        for w in words.get(tag) or []:
            for m in re.finditer(re.escape(w), text) if w else ():
                found.setdefault(m.span(), []).append(tag)
    out, at = [], 0
    for s, e in sorted(found):
        if s >= at:
            at = e
            tags = list(dict.fromkeys(found[s, e]))
            both = TAGS[0] in tags and len(tags) > 1
            out.append((s, e, tags, next(t for t in tags if t != TAGS[0]) if both else tags[0], both))
    return out


CASES = [
    ("WOW this is GREAT, maybe WOW!!", {"all_caps": ["WOW", "GREAT"], "adjectives": ["GREAT"], "hedging": ["maybe"], "exclamation_marks": ["!!", "!"]}),
    ("aaaa aa", {"hedging": ["aa", "aaa"], "unk": ["a"]}),
    ("so (very) odd. so\\Every \\Q[x] $1 ^", {"hedging": ["(very)", "\\Every", "\\Q[x]", "$1", "^", "."], "unk": [""]}),
    ("naïve 😀 naïve word", {"adjectives": ["naïve", "word"], "nonsense": ["naïve"], "all_caps": None}),
    ("nothing here", {}), ("", {"hedging": ["x"]}), ("no tags", None), (None, {"hedging": ["x"]}),
    ("many lines\nmany lines", {"hedging": ["lines\nmany", "many"], "unk": [None]}),
]


@pytest.mark.parametrize("active", [(), ("all_caps", "adjectives"), ("hedging",), ("nonsense",)])
def test_highlights_equal_plain_python(spark, active):
    df = spark.createDataFrame([(i, t, w) for i, (t, w) in enumerate(CASES)], "doc_id long, text string, tag_words map<string,array<string>>")
    got = {}
    for r in P.highlights(df, active=active).orderBy("start").collect():
        got.setdefault(r["doc_id"], []).append((r["start"], r["end"], r["tags"], r["style_tag"], r["with_capitals"]))
    clean = [(t or "", {k: [x for x in v or [] if x] for k, v in (w or {}).items()}) for t, w in CASES]
    # offsets count characters as Spark's length does; the one astral character is before nothing that Python counts differently
    want = {i: h for i, (t, w) in enumerate(clean) if (h := highlight_py(t, w, active))}
    assert got == want


def test_islands_of_a_long_chain(spark):
    spans = [(1, t, s, s + n) for s, n, t in ((i, 3 + i % 4, random.Random(i).choice(TAGS)) for i in range(0, 3000))]
    df = spark.createDataFrame(spans, "doc_id long, feature string, start int, end int")
    kept = P.non_overlapping(df).orderBy("start").collect()
    at, want = 0, []
    for _, _, s, e in sorted(spans, key=lambda x: x[2:]):
        if s >= at:
            at = e
            want.append((s, e))
    assert [(r["start"], r["end"]) for r in kept] == want


def found(df):
    return sorted((r["doc_id"], r["start"], r["end"], r["text"]) for r in df.collect())


TERMS = ["the", "sort of", "sort", "of the", "I guess", "e.g.", "'tis", "well-known", "in my opinion", "x", "etc. and", "MAYBE", "the", None, " ", "can't"]
TEXTS = ["The sort of thing; Sort of the best, I  guess. I guess so, e.g. this", "'tis well-known, a'tis not; 'Tis", "in my opinion in my opinionated x xx X",
         "etc. and etc. andy maybe.MAYBE maybes", "", None, "the", "sorted of the", "can't cannot can't", "sort\nof sort of", "é'tis the naïve the",
         "the " * 500, "İ the İthe thé"]


def lexicon_py(terms, texts, root):
    words = sorted({t.strip().lower() for t in terms if t and t.strip()}, key=lambda t: (-len(t), t))
    pattern = re.compile("(?<![a-zA-Z])(?:" + "|".join(map(re.escape, words)) + ")" + ("[a-zA-Z]*" if root else "(?![a-zA-Z])"), re.I | re.A)
    return sorted((i, m.start(), m.end(), m.group()) for i, t in enumerate(texts) for m in pattern.finditer(t or ""))


@pytest.mark.parametrize("root", [False, True])
@pytest.mark.parametrize("searched", [2000, 0])
def test_lexicon_equals_a_regular_expression(spark, monkeypatch, root, searched):
    monkeypatch.setattr(L, "SEARCHED_WORDS", searched)
    r = random.Random(1)
    texts = TEXTS + [" ".join(r.choice(["the", "sort", "of", "I", "guess", "in", "my", "opinion", "best", "x", "e.g.", "etc."]) for _ in range(40)) for _ in range(20)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    terms = spark.createDataFrame([(t,) for t in TERMS], "term string")
    got = L.lexicon_spans(df, terms, "hedging", match="root" if root else "exact")
    assert found(got) == lexicon_py(TERMS, texts, root) and {x["feature"] for x in got.collect()} == {"hedging"}


def test_a_list_of_fifty_thousand_terms_gives_the_same_spans(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    few = spark.createDataFrame([(t,) for t in TERMS], "term string")
    letters = "abcdefghijklmnopqrstuvwxyz"
    many = spark.range(50_000).select(F.concat(F.lit("qz"), F.translate(F.col("id").cast("string"), "0123456789", letters[:10]),
                                               F.when(F.col("id") % 3 == 0, F.lit(" of the")).otherwise(F.lit(""))).alias("term"))
    for match in ("exact", "root"):
        assert found(L.lexicon_spans(df, few, "unk", match)) == found(L.lexicon_spans(df, few.union(many), "unk", match)) != []


def test_lexicon_without_terms_or_letters(spark):
    df = spark.createDataFrame([(1, "the")], "doc_id long, text string")
    assert L.lexicon_spans(df, spark.createDataFrame([(None,)], "term string"), "unk").count() == 0
    with pytest.raises(ValueError, match="!!"):
        L.lexicon_spans(df, spark.createDataFrame([("!!",)], "term string"), "unk")


def test_raw_tags_and_result_entries(spark):
    rows = [(0, 'say "maybe" or MAYBE maybe', "1", ["all_caps", "hedging"]), (1, "plain", "0", [])]
    none = spark.createDataFrame([], "ordinal long, text string, label string, tags array<string>")
    docs = Q.build_documents(spark.createDataFrame(rows, none.schema), none, none)
    spans = spark.createDataFrame([("annot_0", "hedging", '"maybe"', 4, 11), ("annot_0", "hedging", "MAYBE", 15, 20), ("annot_0", "hedging", "MAYBE", 1, 3),
                                   ("annot_0", "all_caps", "MAYBE", 15, 20)], "doc_id string, feature string, text string, start int, end int")
    full = Q.with_raw_tags(docs, spans)
    raw = {r["doc_id"]: (json.loads(r["j"]), r["raw_text"]) for r in full.select("doc_id", "raw_text", P.raw_tags_json().alias("j")).collect()}
    assert raw["annot_0"][0]["hedging"] == [["MAYBE", 1, 3], ['"maybe"', 4, 11], ["MAYBE", 15, 20]] and raw["annot_0"][1] == rows[0][1]
    assert set(raw["annot_1"][0]) == set(TAGS) and not any(raw["annot_1"][0].values())
    entry = {r["doc_id"]: r for r in Q.result_entry(full).collect()}
    assert entry["annot_0"]["tag_words"] == {"HEDGING": ["MAYBE", '"maybe"'], "ALL_CAPS": ["MAYBE"]} and entry["annot_1"]["tag_words"] == {}
    assert entry["annot_0"]["tag_labels"] == ["ALL_CAPS", "HEDGING"]


def test_rule_spans_need_no_exchange_of_texts(spark):
    """Offsets are summed inside a row: no text is shuffled and no window sorts the matches (findings F14, F23, F26)."""
    from markerlens.operators import markers as M

    docs = spark.createDataFrame([(1, "A careful MAN, hopeless and USELESS!!"), (2, None), (3, ""), (4, "\U0001F600 ful helpful ABCd AB")], "doc_id long, text string")
    adjectives = M.regex_spans(docs, M.ADJECTIVE_RUN, "adjectives")
    plan = adjectives._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan
    assert sorted(map(tuple, adjectives.select("doc_id", "text", "start", "end").collect())) == [
        (1, "USELESS", 28, 35), (1, "careful", 2, 9), (1, "hopeless", 15, 23), (4, "helpful", 6, 13)]
    caps = M.regex_spans(docs, M.CAPS_RUN, "all_caps")
    assert sorted(map(tuple, caps.select("doc_id", "text", "start", "end").collect())) == [(1, "MAN", 10, 13), (1, "USELESS", 28, 35), (4, "AB", 19, 21)]


def test_non_overlapping_sorts_once_and_goes_on_across_batches(spark):
    from markerlens.operators.spans import non_overlapping

    rows = [(d, i * 2, i * 2 + (3 if i % 2 == 0 else 1), t) for d in (None, 1, 2) for i in range(30) for t in ("unk", "hedging")]
    spans = spark.createDataFrame(rows, "doc_id long, start int, end int, feature string")
    kept = non_overlapping(spans)
    assert "ObjectHashAggregate" not in kept._jdf.queryExecution().executedPlan().toString()
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "7")
    try:
        got = kept.collect()
    finally:
        spark.conf.set(key, before)
    want = []
    for d in (None, 1, 2):
        last = -1
        for s, e in sorted({(r[1], r[2]) for r in rows if r[0] == d}):
            if s >= last:
                want.append((d, s, e, ("hedging", "unk")))
                last = e
    order = lambda r: (str(r[0]), r[1])
    assert sorted(((r["doc_id"], r["start"], r["end"], tuple(r["tags"])) for r in got), key=order) == sorted(want, key=order)


def test_offsets_of_a_repeated_id_run_on(spark):
    from markerlens.operators import markers as M

    docs = spark.createDataFrame([(1, "a! b!"), (1, "a! b!"), (2, "c!")], "doc_id long, text string")
    got = M.regex_spans(docs, M.EXCLAMATION_RUN, "exclamation_marks")
    assert sorted((r["doc_id"], r["start"], r["end"]) for r in got.collect()) == [(1, 1, 2), (1, 3, 4), (1, 6, 7), (1, 9, 10), (2, 1, 2)]
