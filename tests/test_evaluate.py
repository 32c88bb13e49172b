"""Scored-set evaluation (FIXTURES F12) against brute-force Python."""

import pytest
from pyspark.sql import functions as F
from pyspark.errors import PySparkException

from markerlens.operators import evaluate as V

SCHEMA = "doc_id long, task string, model string, label int, prob double, pred int"


def scored(spark, labels, probs, model="m", task="t", threshold=0.5):
    rows = [(i, task, model, l, p, int(p >= threshold)) for i, (l, p) in enumerate(zip(labels, probs))]
    return spark.createDataFrame(rows, SCHEMA)


def auc_py(labels, probs):
    pairs = [(p, l) for p, l in zip(probs, labels)]
    pos = [p for p, l in pairs if l == 1]
    neg = [p for p, l in pairs if l == 0]
    s = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a in pos for b in neg)
    return s / (len(pos) * len(neg))


def test_perfect_inverted_constant(spark):
    labels = [0, 1, 0, 1, 1]
    perfect = V.class_metrics(scored(spark, labels, [0.1, 0.9, 0.2, 0.8, 0.7])).first()
    assert perfect["macro_f1"] == pytest.approx(1.0) and perfect["accuracy"] == pytest.approx(1.0)
    inverted = V.class_metrics(scored(spark, labels, [0.9, 0.1, 0.8, 0.2, 0.3])).first()
    assert inverted["macro_f1"] == pytest.approx(0.0)
    constant = V.class_metrics(scored(spark, labels, [0.9] * 5)).first()
    assert constant["f1_class0"] == 0.0  # class never predicted: zero, no error
    assert constant["f1_class1"] == pytest.approx(2 * 0.6 / 1.6)


def test_auc_with_ties(spark):
    labels = [0, 1, 0, 1, 1, 0, 1, 0]
    probs = [0.3, 0.3, 0.5, 0.7, 0.5, 0.1, 0.9, 0.7]
    got = V.auc_roc(scored(spark, labels, probs)).first()["auc_roc"]
    assert got == pytest.approx(auc_py(labels, probs))


def test_fbeta(spark):
    labels = [1, 1, 1, 0, 0, 0]
    probs = [0.9, 0.9, 0.1, 0.9, 0.1, 0.1]
    m = V.class_metrics(scored(spark, labels, probs)).first()
    p, r, b2 = 2 / 3, 2 / 3, 2.25
    assert m["fbeta_class1"] == pytest.approx((1 + b2) * p * r / (b2 * p + r))


def test_soft_vote_of_one_model_is_itself(spark):
    s = scored(spark, [0, 1, 1], [0.2, 0.6, 0.4])
    v = {r["doc_id"]: (r["prob"], r["pred"]) for r in V.soft_vote(s).collect()}
    assert v == {0: (0.2, 0), 1: (0.6, 1), 2: (0.4, 0)}


def test_label_mismatch_fails(spark):
    a = scored(spark, [0, 1], [0.2, 0.6], model="a")
    b = scored(spark, [1, 1], [0.2, 0.6], model="b")
    with pytest.raises(Exception):
        V.soft_vote(a.unionByName(b)).collect()


def test_weighted_vote_and_nonpositive_weight(spark):
    a = scored(spark, [0, 1], [0.2, 0.6], model="a")
    b = scored(spark, [0, 1], [0.6, 1.0], model="b")
    w = spark.createDataFrame([("t", "a", 1.0), ("t", "b", 3.0)], "task string, model string, weight double")
    got = {r["doc_id"]: r["prob"] for r in V.weighted_vote(a.unionByName(b), w).collect()}
    assert got[0] == pytest.approx(0.25 * 0.2 + 0.75 * 0.6)
    bad = spark.createDataFrame([("t", "a", 0.0), ("t", "b", 3.0)], "task string, model string, weight double")
    with pytest.raises(Exception):
        V.weighted_vote(a.unionByName(b), bad).collect()


def test_threshold_sweep_lowest_wins_ties(spark):
    votes = spark.createDataFrame([(0, "t", 0, 0.1), (1, "t", 1, 0.9)], "doc_id long, task string, label int, prob double")
    res = V.threshold_sweep(votes).orderBy("threshold").collect()
    assert len(res) == 9
    best = [r for r in res if r["is_best"]]
    assert len(best) == 1 and best[0]["threshold"] == pytest.approx(0.30)


def test_first_examples(spark):
    s = scored(spark, [0, 0, 0, 1, 1], [0.9, 0.8, 0.1, 0.1, 0.2])
    ex = V.first_examples(s, ("FP", "FN"), 1).collect()
    assert sorted((r["kind"], r["doc_id"]) for r in ex) == [("FN", 3), ("FP", 0)]
