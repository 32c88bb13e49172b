"""Agreement and consolidation on hand-made rating tables (FIXTURES F5), against plain-Python
formulas worked out in the test."""

import math
from collections import Counter

import pytest
from hypothesis import given, settings, strategies as st

from markerlens.operators import agreement as A
from markerlens.operators import consolidate as K

SCHEMA = "annotator string, item_id long, feature string, category string, ord long"


def fleiss_py(table):
    """table: list of per-item category lists (equal length)."""
    n = len(table[0])
    N = len(table)
    cats = sorted({c for row in table for c in row})
    counts = [Counter(row) for row in table]
    p_i = [(sum(v * v for v in c.values()) - n) / (n * (n - 1)) for c in counts]
    p_bar = sum(p_i) / N
    p_j = [sum(c[k] for c in counts) / (N * n) for k in cats]
    p_e = sum(p * p for p in p_j)
    return None if p_e == 1 else (p_bar - p_e) / (1 - p_e)


def cohen_py(a, b):
    n = len(a)
    p_o = sum(x == y for x, y in zip(a, b)) / n
    ca, cb = Counter(a), Counter(b)
    p_e = sum(ca[k] * cb[k] for k in set(a) | set(b)) / (n * n)
    return None if p_e == 1 else (p_o - p_e) / (1 - p_e)


def rows_from(matrix, feature="f"):
    out, o = [], 0
    for item, cats in enumerate(matrix):
        for r, c in enumerate(cats):
            out.append((f"r{r}", item, feature, c, o))
            o += 1
    return out


def test_fleiss_matches_formula(spark):
    m = [["a", "a", "b"], ["a", "a", "a"], ["b", "b", "a"], ["b", "a", "b"], ["a", "b", "b"]]
    df = spark.createDataFrame(rows_from(m), SCHEMA)
    got = A.fleiss(df).first()
    assert got["kappa"] == pytest.approx(fleiss_py(m))
    assert got["items_used"] == 5 and got["raters"] == 3


def test_fleiss_all_agree_is_one_and_single_category_is_null(spark):
    agree = [["a", "a"], ["b", "b"], ["a", "a"]]
    assert A.fleiss(spark.createDataFrame(rows_from(agree), SCHEMA)).first()["kappa"] == pytest.approx(1.0)
    single = [["a", "a"], ["a", "a"]]
    r = A.fleiss(spark.createDataFrame(rows_from(single), SCHEMA)).first()
    assert r["kappa"] is None and r["agreement"] is None


def test_fleiss_uses_items_with_max_raters(spark):
    rows = rows_from([["a", "a", "b"], ["a", "b", "b"]]) + [("r0", 7, "f", "a", 99), ("r1", 7, "f", None, 100)]
    r = A.fleiss(spark.createDataFrame(rows, SCHEMA)).first()
    assert r["items_total"] == 3 and r["items_used"] == 2
    assert r["kappa"] == pytest.approx(fleiss_py([["a", "a", "b"], ["a", "b", "b"]]))


def test_cohen_pairs_and_min_items(spark):
    m = [["a", "a", "b"], ["b", "b", "b"], ["a", "b", "a"], ["b", "b", "a"]]
    df = spark.createDataFrame(rows_from(m), SCHEMA)
    got = {(r["annotator_1"], r["annotator_2"]): r["kappa"] for r in A.cohen_pairwise(df).collect()}
    cols = list(zip(*m))
    for i in range(3):
        for j in range(i + 1, 3):
            want = cohen_py(cols[i], cols[j])
            assert (got[(f"r{i}", f"r{j}")] is None) == (want is None)
            if want is not None:
                assert got[(f"r{i}", f"r{j}")] == pytest.approx(want)
    # a pair sharing one item only → null
    few = spark.createDataFrame([("x", 1, "f", "a", 0), ("y", 1, "f", "a", 1), ("y", 2, "f", "b", 2)], SCHEMA)
    assert A.cohen_pairwise(few).first()["kappa"] is None


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("ab"), st.sampled_from("abc")), min_size=3, max_size=12))
def test_cohen_symmetric_under_swap(spark, pairs):
    rows = [("p", i, "f", a, 2 * i) for i, (a, _) in enumerate(pairs)] + \
           [("q", i, "f", b, 2 * i + 1) for i, (_, b) in enumerate(pairs)]
    swapped = [("q" if r[0] == "p" else "p",) + r[1:] for r in rows]
    k1 = A.cohen_pairwise(spark.createDataFrame(rows, SCHEMA)).first()["kappa"]
    k2 = A.cohen_pairwise(spark.createDataFrame(swapped, SCHEMA)).first()["kappa"]
    assert (k1 is None and k2 is None) or k1 == pytest.approx(k2)


def test_kappa_band(spark):
    df = spark.createDataFrame([(-0.1,), (0.1,), (0.3,), (0.5,), (0.7,), (0.9,), (None,)], "k double")
    got = [r[0] for r in df.select(A.kappa_band("k")).collect()]
    assert got == ["Poor", "Slight", "Fair", "Moderate", "Substantial", "Almost Perfect", None]


def test_ranking_null_mean_last(spark):
    pw = spark.createDataFrame([("f", "a", "b", 5, 0.5), ("f", "a", "c", 5, None), ("f", "b", "c", 5, 0.9)],
                               "feature string, annotator_1 string, annotator_2 string, n_items long, kappa double")
    means = {r["annotator"]: r["mean_kappa"] for r in A.annotator_means(pw).collect()}
    assert means["a"] is None and means["b"] == pytest.approx(0.7)
    ranked = [r["annotator"] for r in K.rank_annotators(A.annotator_means(pw)).orderBy("rank").collect()]
    assert ranked[-1] in ("a", "c") and ranked[0] == "b"


def _rows(spark, data):
    # data: (annotator, item, key) → one feature carries the key
    rows = [(a, i, "all_caps", k, o) for o, (a, i, k) in enumerate(data)]
    return K.annotation_rows(spark.createDataFrame(rows, SCHEMA), ["all_caps"])


def test_majority_vote_tie_and_fallback(spark):
    ranking = spark.createDataFrame([("r2", 1), ("r1", 2), ("r0", 3)], "annotator string, rank int")
    data = [("r0", 1, "[x]"), ("r1", 1, "[x]"), ("r2", 1, "[y]"), ("r3", 1, "[y]"), ("r4", 1, "[z]"),  # 2-2-1 tie
            ("r0", 2, "[a]"), ("r1", 2, "[b]"), ("r2", 2, "[c]"),                                   # no majority
            ("r4", 3, "[q]")]                                                                        # only AI
    res = {r["item_id"]: r for r in K.majority_vote(_rows(spark, data), ranking).collect()}
    assert res[1]["method"] == "majority" and res[1]["vote_key"] == "[x]" and res[1]["annotator"] == "r0"
    assert res[2]["method"] == "ranked" and res[2]["annotator"] == "r2"
    assert res[3]["annotator"] == "r4"


def test_same_spans_in_other_order_agree(spark):
    from markerlens.functions import text as T
    sp = "array<struct<text:string,start:int,end:int>>"
    df = spark.createDataFrame([("p", 1, [("a", 0, 1), ("b", 2, 3)]), ("q", 1, [("b", 2, 3), ("a", 0, 1)])],
                               f"annotator string, item_id long, spans {sp}")
    keys = [r[0] for r in df.select(T.spans_key("spans")).collect()]
    assert keys[0] == keys[1]


def test_cohen_of_an_item_with_many_raters_is_dealt_into_blocks(spark, monkeypatch):
    import random
    r = random.Random(8)
    pairs = A.rater_pairs
    monkeypatch.setattr(A, "rater_pairs", lambda rows, group: pairs(rows, group, block=4, salts=3))
    data = [(f"r{k:02d}", item, "f", r.choice("abc"), 100 * item + k) for item, n in ((1, 23), (2, 30), (3, 4), (4, 17)) for k in range(n)]
    data += [("r00", 1, "f", "z", 5000), (None, 1, "f", "a", 5001), ("r01", None, "f", "a", 5002), ("r02", 5, "f", None, 5003)]
    got = A.cohen_pairwise(spark.createDataFrame(data, SCHEMA).repartition(3)).collect()
    votes = {}
    for a, item, _, c, _ in reversed(data):
        if a and item and c:
            votes[a, item] = c
    names = sorted({a for a, _ in votes})
    assert len(got) == len(names) * (len(names) - 1) // 2
    for row in got:
        both = [i for i in range(1, 5) if (row.annotator_1, i) in votes and (row.annotator_2, i) in votes]
        want = cohen_py(*([votes[a, i] for i in both] for a in (row.annotator_1, row.annotator_2))) if len(both) > 1 else None
        assert row.n_items == len(both)
        assert row.kappa is None if want is None else row.kappa == pytest.approx(want)


def test_a_null_rating_gives_way_without_an_order(spark):
    df = spark.createDataFrame([("p", 1, "f", None), ("p", 1, "f", "b"), ("p", 1, "f", "c")], "annotator string, item_id long, feature string, category string")
    assert [r.category for r in A.one_rating(df).collect()] == ["b"]


def test_range_assignment_equals_all_comparisons(spark):
    import random
    r = random.Random(9)
    items = sorted({r.choice([r.randrange(-50, 50), r.randrange(5000), 10 ** 15 + r.randrange(9)]) for _ in range(400)})
    ranges = [(a, a + r.choice([0, 3, 40, 3000, 10 ** 15]), f"n{k}") for k, a in enumerate(r.randrange(-60, 5000) for _ in range(40))]
    ranges += [(None, 7, "low"), (4000, None, "high"), (None, None, "all"), (9, 3, "none"), (10 ** 17, 10 ** 18, "beyond")]
    got = K.range_assignment(spark.createDataFrame([(i,) for i in items], "item_id long"), spark.createDataFrame(ranges, "lo long, hi long, name string"))
    want = [(i, n) for i in items for lo, hi, n in ranges if (lo is None or i >= lo) and (hi is None or i <= hi)]
    assert sorted((x.item_id, x.name) for x in got.collect()) == sorted(want)


def test_truth_set_routes_items_by_range(spark):
    sp = "array<struct<text:string,start:int,end:int>>"
    one, moved, other = [("so", 0, 2)], [("so", 9, 11)], [("no", 0, 2)]
    data = [("a", 1, one), ("b", 1, moved), ("c", 1, other),           # same texts at other places: a majority
            ("a", 2, one), ("b", 2, other), ("c", 2, None),            # none: the best-ranked annotator
            ("x", 50, one), ("b", 50, one), ("c", 50, other),          # by rank, whatever the votes
            ("x", 51, other), ("a", -1, one), ("a", None, one)]
    df = spark.createDataFrame([(a, i, "unk", o, s) for o, (a, i, s) in enumerate(data)], f"annotator string, item_id long, feature string, ord long, spans {sp}")
    from markerlens.functions import text as T
    rows = K.annotation_rows(df.withColumn("category", T.spans_key("spans")).withColumn("texts", K.span_texts("spans")), ["unk"])
    ranking = spark.createDataFrame([("c", 1), ("b", 2), ("a", 3)], "annotator string, rank int")
    ranges = spark.createDataFrame([(0, 40, "vote"), (41, None, "ranked")], "lo long, hi long, rule string")
    got = {r.item_id: (r.rule, r.method, r.annotator, r.vote_key, r.votes) for r in K.consolidated(rows, ranking, ranges, ["unk"]).collect()}
    assert got == {1: ("vote", "majority", "Majority Vote", '["so"]', 2), 2: ("vote", "ranked", "Majority Vote", "[]", 1),
                   50: ("ranked", "ranked", "c", '["no"]', 2), 51: ("ranked", "ranked", "x", '["no"]', 1)}
