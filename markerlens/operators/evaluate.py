"""Evaluation over scored sets (pipeline D): AGG-24 … AGG-31, AGG-39, FN-25 … FN-28, FN-33,
JN-9, JN-11, WIN-5, WIN-6, WIN-10, FLT-17, ML-14, ML-15.

A scored set is a table ``(doc_id, task, model, label, prob, pred)`` aligned by key, not by
position. Every report is a grouped aggregate of it; model families are column values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from markerlens.operators.ordering import exclusive_prefix_sum

BETA = 1.5
# Decision thresholds tried by the sweep, 0.30 + k·0.05 for k = 0…8.
SWEEP_START, SWEEP_STEP, SWEEP_STEPS = 0.30, 0.05, 9


def _safe_div(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def hard_decision(prob, threshold: float = 0.5) -> Column:
    """FN-28 ``prob >= threshold`` as 0/1."""
    p = F.col(prob) if isinstance(prob, str) else prob
    return (p >= F.lit(threshold)).cast("int")


def confusion(scored: DataFrame, by: Sequence[str] = ("task", "model"), label: str = "label",
              pred: str = "pred") -> DataFrame:
    """AGG-24 tp, tn, fp, fn per group (conditional counts, one pass)."""
    l, p = F.col(label), F.col(pred)
    return scored.groupBy(*by).agg(
        F.count_if((l == 1) & (p == 1)).alias("tp"), F.count_if((l == 0) & (p == 0)).alias("tn"),
        F.count_if((l == 0) & (p == 1)).alias("fp"), F.count_if((l == 1) & (p == 0)).alias("fn"))


def _f1(tp: Column, fp: Column, fn: Column) -> tuple[Column, Column, Column]:
    precision = _safe_div(tp, tp + fp)
    recall = _safe_div(tp, tp + fn)
    f1 = F.when(precision + recall > 0, 2 * precision * recall / (precision + recall)).otherwise(F.lit(0.0))
    return precision, recall, f1


def metrics_from_confusion(conf: DataFrame, by: Sequence[str]) -> DataFrame:
    """AGG-25 per-class F1, macro F1, F-beta (β = 1.5) of class 1, accuracy; zero-safe."""
    tp, tn, fp, fn = (F.col(c) for c in ("tp", "tn", "fp", "fn"))
    p1, r1, f1_1 = _f1(tp, fp, fn)
    _, _, f1_0 = _f1(tn, fn, fp)
    b2 = BETA * BETA
    fbeta = F.when(b2 * p1 + r1 > 0, (1 + b2) * p1 * r1 / (b2 * p1 + r1)).otherwise(F.lit(0.0))
    n = tp + tn + fp + fn
    return conf.select(*by, "tp", "tn", "fp", "fn", f1_0.alias("f1_class0"), f1_1.alias("f1_class1"),
                       ((f1_0 + f1_1) / 2).alias("macro_f1"), fbeta.alias("fbeta_class1"),
                       _safe_div(tp + tn, n).alias("accuracy"))


def class_metrics(scored: DataFrame, by: Sequence[str] = ("task", "model")) -> DataFrame:
    return metrics_from_confusion(confusion(scored, by), by)


def class_report(scored: DataFrame, by: Sequence[str] = ("task", "model")) -> DataFrame:
    """AGG-27 precision, recall, F1, support per class plus macro and weighted averages."""
    conf = confusion(scored, by)
    tp, tn, fp, fn = (F.col(c) for c in ("tp", "tn", "fp", "fn"))
    p1, r1, f1 = _f1(tp, fp, fn)
    p0, r0, f0 = _f1(tn, fn, fp)
    s0, s1 = tn + fp, tp + fn
    tot = s0 + s1
    rows = F.array(
        F.struct(F.lit("0").alias("class"), p0.alias("precision"), r0.alias("recall"), f0.alias("f1"), s0.alias("support")),
        F.struct(F.lit("1").alias("class"), p1.alias("precision"), r1.alias("recall"), f1.alias("f1"), s1.alias("support")),
        F.struct(F.lit("macro avg").alias("class"), ((p0 + p1) / 2).alias("precision"), ((r0 + r1) / 2).alias("recall"),
                 ((f0 + f1) / 2).alias("f1"), tot.alias("support")),
        F.struct(F.lit("weighted avg").alias("class"), _safe_div(p0 * s0 + p1 * s1, tot).alias("precision"),
                 _safe_div(r0 * s0 + r1 * s1, tot).alias("recall"), _safe_div(f0 * s0 + f1 * s1, tot).alias("f1"),
                 tot.alias("support")))
    return conf.select(*by, F.inline(rows))


def auc_roc(scored: DataFrame, by: Sequence[str] = ("task", "model"), label: str = "label",
            prob: str = "prob") -> DataFrame:
    """AGG-26 AUC by the rank-sum formula with average ranks for ties.

    Rows are first counted per distinct score (partial aggregate); ranks come from a
    two-level prefix sum over that table in (group, score) order, so no single task ranks
    all rows. AUC = (Σ rank_pos − n_pos(n_pos+1)/2) / (n_pos·n_neg); null for one class only.
    """
    by = list(by)
    per = scored.groupBy(*by, F.col(prob).alias("_s")).agg(
        F.count_if(F.col(label) == 1).alias("_pos"), F.count_if(F.col(label) == 0).alias("_neg"),
        F.count(F.lit(1)).alias("_c"))
    ranked = exclusive_prefix_sum(per, by + ["_s"], "_c", "_before")
    start = ranked.groupBy(*by).agg(F.min("_before").alias("_start"))
    r = ranked.join(start, by)
    avg_rank = (F.col("_before") - F.col("_start")) + (F.col("_c") + 1) / 2.0
    agg = r.groupBy(*by).agg(F.sum(F.col("_pos") * avg_rank).alias("_rs"), F.sum("_pos").alias("_np"),
                             F.sum("_neg").alias("_nn"))
    npos, nneg = F.col("_np"), F.col("_nn")
    auc = F.when((npos > 0) & (nneg > 0), (F.col("_rs") - npos * (npos + 1) / 2.0) / (npos * nneg))
    return agg.select(*by, auc.alias("auc_roc"))


def check_aligned(scored: DataFrame, key: Sequence[str] = ("doc_id", "task")) -> DataFrame:
    """JN-9: every model must carry the same label for a key; a mismatch fails the job."""
    g = scored.groupBy(*key).agg(F.min("label").alias("label"), F.max("label").alias("_lmax"),
                                 F.avg("prob").alias("_avg"), F.count(F.lit(1)).alias("n_models"))
    return g.withColumn("label", F.when(F.col("label") == F.col("_lmax"), F.col("label")).otherwise(
        F.raise_error(F.lit("model outputs disagree on the label of a document")).cast("int")))


def soft_vote(scored: DataFrame, threshold: float = 0.5, key: Sequence[str] = ("doc_id", "task")) -> DataFrame:
    """AGG-28 mean probability per document and task; labels must agree across models."""
    g = check_aligned(scored, key)
    return g.select(*key, "label", F.col("_avg").alias("prob"), hard_decision("_avg", threshold).alias("pred"),
                    "n_models")


def normalised_weights(weights: DataFrame, by: str = "task", weight: str = "weight") -> DataFrame:
    """Weights per (task, model) normalised to sum 1 per task; a weight ≤ 0 fails the job."""
    w = F.col(weight)
    checked = weights.withColumn(weight, F.when(w > 0, w).otherwise(
        F.raise_error(F.lit("ensemble weights must be positive")).cast("double")))
    total = checked.groupBy(by).agg(F.sum(weight).alias("_wt"))
    return checked.join(total, by).select(by, "model", (F.col(weight) / F.col("_wt")).alias("w"))


def weighted_vote(scored: DataFrame, weights: DataFrame, threshold: float = 0.5,
                  key: Sequence[str] = ("doc_id", "task")) -> DataFrame:
    """AGG-29 Σ prob·w with weights normalised per task (one per model). The weight table has
    one row per (task, model): bounded by the model list, broadcast."""
    w = normalised_weights(weights)
    j = scored.join(F.broadcast(w), ["task", "model"], "inner")
    g = j.groupBy(*key).agg(F.min("label").alias("label"), F.max("label").alias("_lmax"),
                            F.sum(F.col("prob") * F.col("w")).alias("prob"))
    g = g.withColumn("label", F.when(F.col("label") == F.col("_lmax"), F.col("label")).otherwise(
        F.raise_error(F.lit("model outputs disagree on the label of a document")).cast("int")))
    return g.select(*key, "label", "prob", hard_decision("prob", threshold).alias("pred"))


def thresholds() -> Column:
    return F.array(*[F.lit(SWEEP_START) + F.lit(k) * F.lit(SWEEP_STEP) for k in range(SWEEP_STEPS)])


def threshold_sweep(votes: DataFrame, by: Sequence[str] = ("task",)) -> DataFrame:
    """AGG-30 macro F1 per candidate threshold; ``is_best`` marks the best one (lowest wins ties).

    Rows are counted per distinct (prob, label) first; the nine thresholds are an inlined
    array exploded per distinct probability (no join), then conditional sums give the
    confusion per threshold.
    """
    by = list(by)
    per = votes.groupBy(*by, "prob", "label").agg(F.count(F.lit(1)).alias("_c"))
    ex = per.select(*by, "prob", "label", "_c", F.explode(thresholds()).alias("threshold"))
    pr = (F.col("prob") >= F.col("threshold")).cast("int")
    l = F.col("label")
    conf = ex.groupBy(*by, "threshold").agg(
        F.sum(F.when((l == 1) & (pr == 1), F.col("_c")).otherwise(0)).alias("tp"),
        F.sum(F.when((l == 0) & (pr == 0), F.col("_c")).otherwise(0)).alias("tn"),
        F.sum(F.when((l == 0) & (pr == 1), F.col("_c")).otherwise(0)).alias("fp"),
        F.sum(F.when((l == 1) & (pr == 0), F.col("_c")).otherwise(0)).alias("fn"))
    m = metrics_from_confusion(conf, by + ["threshold"])
    best = m.groupBy(*by).agg(F.max(F.struct(F.col("macro_f1"), (-F.col("threshold")).alias("_nt"))).alias("_b"))
    out = m.join(best, by)
    return out.select(*by, "threshold", "macro_f1", "f1_class0", "f1_class1", "accuracy",
                      ((F.col("macro_f1") == F.col("_b.macro_f1")) & (-F.col("threshold") == F.col("_b._nt")))
                      .alias("is_best"))


def leaderboard(metrics: DataFrame, auc: DataFrame) -> DataFrame:
    """WIN-5 models per task ordered by macro F1, then AUC (descending). One row per model."""
    m = metrics.join(auc, ["task", "model"], "left")
    w = Window.partitionBy("task").orderBy(F.desc("macro_f1"), F.desc_nulls_last("auc_roc"), F.asc("model"))
    return m.withColumn("position", F.row_number().over(w))


def best_per_family(board: DataFrame, families: DataFrame) -> DataFrame:
    """WIN-6 best model per (family, task) by (macro F1, AUC); a missing AUC counts as −∞."""
    m = board.join(families, "model", "inner")
    key = F.struct(F.col("macro_f1"), F.coalesce(F.col("auc_roc"), F.lit(float("-inf"))), F.col("model"))
    return m.groupBy("family", "task").agg(F.max_by("model", key).alias("model"),
                                           F.max(F.col("macro_f1")).alias("macro_f1"))


def first_examples(scored: DataFrame, kinds: Sequence[str] = ("FP", "FN"), n: int = 5,
                   by: Sequence[str] = ("task", "model"), order: str = "doc_id") -> DataFrame:
    """WIN-10 / FLT-17 the first ``n`` rows of each confusion quadrant, in ``order``.

    The literal bound ``row_number <= n`` is planned with a map-side window group limit, so
    a quadrant with very many rows ships at most ``n`` per map partition."""
    l, p = F.col("label"), F.col("pred")
    kind = (F.when((l == 1) & (p == 1), "TP").when((l == 0) & (p == 0), "TN")
            .when((l == 0) & (p == 1), "FP").otherwise("FN"))
    k = scored.withColumn("kind", kind).where(F.col("kind").isin(*kinds))
    w = Window.partitionBy(*by, "kind").orderBy(order)
    return k.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def uncertainty(prob) -> Column:
    """FN-25 1 − max(p, 1 − p)."""
    p = F.col(prob) if isinstance(prob, str) else prob
    return 1 - F.greatest(p, 1 - p)


def disagreement(pred_a, pred_b) -> Column:
    """FN-26 1.0 when two models' predictions differ."""
    a = F.col(pred_a) if isinstance(pred_a, str) else pred_a
    b = F.col(pred_b) if isinstance(pred_b, str) else pred_b
    return (a != b).cast("double")
