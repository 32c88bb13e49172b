"""Registered queries, evaluation over scored sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from markerlens.functions import text as T
from markerlens.operators import evaluate as V
from markerlens.operators.ordering import contiguous_index, with_scalars
from markerlens.plans.registry import register
from markerlens.plans.standins import MODELS, SCORED_SQL, scored
from markerlens.session import table

KEYS = ("task", "model")


def r6(c):
    return F.round(c, 6)


def _metric_sql(tp="tp", tn="tn", fp="fp", fn="fn") -> str:
    """SQL of metrics_from_confusion over a CTE with tp, tn, fp, fn."""
    def f1(a, b, c):
        p = f"(CASE WHEN {a} + {b} > 0 THEN {a} / ({a} + {b}) ELSE 0.0 END)"
        r = f"(CASE WHEN {a} + {c} > 0 THEN {a} / ({a} + {c}) ELSE 0.0 END)"
        return p, r, f"(CASE WHEN {p} + {r} > 0 THEN 2 * {p} * {r} / ({p} + {r}) ELSE 0.0 END)"
    p1, r1, f1_1 = f1(tp, fp, fn)
    _, _, f1_0 = f1(tn, fn, fp)
    b2 = "CAST(2.25 AS DOUBLE)"
    fbeta = f"(CASE WHEN {b2} * {p1} + {r1} > 0 THEN (1 + {b2}) * {p1} * {r1} / ({b2} * {p1} + {r1}) ELSE 0.0 END)"
    acc = f"(CASE WHEN {tp} + {tn} + {fp} + {fn} > 0 THEN ({tp} + {tn}) / ({tp} + {tn} + {fp} + {fn}) ELSE 0.0 END)"
    return f1_0, f1_1, fbeta, acc


_F0, _F1, _FB, _ACC = _metric_sql()

CONF_SQL = f"""{SCORED_SQL},
conf AS (SELECT task, model, count(*) FILTER (WHERE label = 1 AND pred = 1) AS tp,
                count(*) FILTER (WHERE label = 0 AND pred = 0) AS tn,
                count(*) FILTER (WHERE label = 0 AND pred = 1) AS fp,
                count(*) FILTER (WHERE label = 1 AND pred = 0) AS fn FROM scored GROUP BY task, model),
met AS (SELECT task, model, tp, tn, fp, fn, {_F0} AS f1_class0, {_F1} AS f1_class1,
               ({_F0} + {_F1}) / 2 AS macro_f1, {_FB} AS fbeta_class1, {_ACC} AS accuracy FROM conf)"""

AUC_SQL = """per AS (SELECT task, model, prob, count(*) FILTER (WHERE label = 1) AS pos,
                count(*) FILTER (WHERE label = 0) AS neg, count(*) AS c FROM scored GROUP BY ALL),
rk AS (SELECT *, coalesce(sum(c) OVER (PARTITION BY task, model ORDER BY prob
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM per),
aucagg AS (SELECT task, model, sum(pos * (before + (c + 1) / CAST(2 AS DOUBLE))) AS rs, sum(pos) AS np, sum(neg) AS nn
           FROM rk GROUP BY ALL),
auc AS (SELECT task, model, CASE WHEN np > 0 AND nn > 0 THEN (rs - np * (np + 1) / CAST(2 AS DOUBLE)) / (np * nn) END AS auc_roc
        FROM aucagg)"""


@register("confusion_matrix", ("AGG-24", "FN-28"), sql=f"""
WITH {CONF_SQL}
SELECT task, model, tp, tn, fp, fn FROM conf""")
def confusion_matrix(spark, sf):
    return V.confusion(scored(spark, sf), KEYS)


@register("class_metrics", ("AGG-25", "AGG-24"), sql=f"""
WITH {CONF_SQL}
SELECT task, model, round(f1_class0, 6) AS f1_class0, round(f1_class1, 6) AS f1_class1, round(macro_f1, 6) AS macro_f1,
       round(fbeta_class1, 6) AS fbeta_class1, round(accuracy, 6) AS accuracy FROM met""")
def class_metrics(spark, sf):
    m = V.class_metrics(scored(spark, sf), KEYS)
    return m.select(*KEYS, *[r6(c).alias(c) for c in ("f1_class0", "f1_class1", "macro_f1", "fbeta_class1", "accuracy")])


def _report_sql() -> str:
    def pr(a, b):
        return f"(CASE WHEN {a} + {b} > 0 THEN {a} / ({a} + {b}) ELSE 0.0 END)"

    def f1(p, r):
        return f"(CASE WHEN {p} + {r} > 0 THEN 2 * {p} * {r} / ({p} + {r}) ELSE 0.0 END)"
    p1, r1 = pr("tp", "fp"), pr("tp", "fn")
    p0, r0 = pr("tn", "fn"), pr("tn", "fp")
    f_1, f_0 = f1(p1, r1), f1(p0, r0)
    s0, s1, tot = "(tn + fp)", "(tp + fn)", "(tn + fp + tp + fn)"

    def wavg(a, b):
        return f"(CASE WHEN {tot} > 0 THEN ({a} * {s0} + {b} * {s1}) / {tot} ELSE 0.0 END)"
    return f"""WITH {CONF_SQL},
rep AS (
  SELECT task, model, '0' AS class, {p0} AS precision, {r0} AS recall, {f_0} AS f1, {s0} AS support FROM conf
  UNION ALL SELECT task, model, '1', {p1}, {r1}, {f_1}, {s1} FROM conf
  UNION ALL SELECT task, model, 'macro avg', ({p0} + {p1}) / 2, ({r0} + {r1}) / 2, ({f_0} + {f_1}) / 2, {tot} FROM conf
  UNION ALL SELECT task, model, 'weighted avg', {wavg(p0, p1)}, {wavg(r0, r1)}, {wavg(f_0, f_1)}, {tot} FROM conf)
SELECT task, model, class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
       CAST(support AS BIGINT) AS support FROM rep"""


@register("class_report", ("AGG-27",), sql=_report_sql())
def class_report(spark, sf):
    r = V.class_report(scored(spark, sf), KEYS)
    return r.select(*KEYS, "class", r6("precision").alias("precision"), r6("recall").alias("recall"),
                    r6("f1").alias("f1"), F.col("support").cast("long").alias("support"))


@register("auc_roc", ("AGG-26",), sql=f"""
WITH {SCORED_SQL},
{AUC_SQL}
SELECT task, model, round(auc_roc, 6) AS auc_roc FROM auc""")
def auc_roc(spark, sf):
    a = V.auc_roc(scored(spark, sf), KEYS)
    return a.select(*KEYS, r6("auc_roc").alias("auc_roc"))


@register("soft_vote", ("AGG-28", "JN-9", "FN-28"), sql=f"""
WITH {SCORED_SQL}
SELECT doc_id, task, min(label) AS label, round(avg(prob), 7) AS prob, CAST(avg(prob) >= 0.5 AS INTEGER) AS pred,
       count(*) AS n_models FROM scored GROUP BY doc_id, task""")
def soft_vote(spark, sf):
    v = V.soft_vote(scored(spark, sf), 0.5)
    # a mean of five k/128 steps is exact at 7 decimals: rounding to 6 would split ties
    # differently in the two engines (decimal half-up against binary rounding)
    return v.select("doc_id", "task", "label", F.round("prob", 7).alias("prob"), "pred", "n_models")


WEIGHTED_SQL = f"""{CONF_SQL},
wn AS (SELECT task, model, macro_f1 / sum(macro_f1) OVER (PARTITION BY task) AS w FROM met),
wv AS (SELECT s.doc_id, s.task, min(s.label) AS label, sum(s.prob * wn.w) AS prob
       FROM scored s JOIN wn ON s.task = wn.task AND s.model = wn.model GROUP BY s.doc_id, s.task)"""


def _weighted(spark, sf):
    sc = scored(spark, sf)
    weights = V.class_metrics(sc, KEYS).select("task", "model", F.col("macro_f1").alias("weight"))
    return V.weighted_vote(sc, weights, 0.5)


@register("weighted_vote", ("AGG-29", "AGG-25", "FN-28"), sql=f"""
WITH {WEIGHTED_SQL}
SELECT doc_id, task, label, round(prob, 6) AS prob, CAST(prob >= 0.5 AS INTEGER) AS pred FROM wv""")
def weighted_vote(spark, sf):
    return _weighted(spark, sf).select("doc_id", "task", "label", r6("prob").alias("prob"), "pred")


_TF0, _TF1, _TFB, _TACC = _metric_sql()


@register("threshold_sweep", ("AGG-30", "JN-11", "AGG-29"), sql=f"""
WITH {WEIGHTED_SQL},
th AS (SELECT CAST(0.30 AS DOUBLE) + k * CAST(0.05 AS DOUBLE) AS threshold FROM range(9) t(k)),
per AS (SELECT task, prob, label, count(*) AS c FROM wv GROUP BY ALL),
cf AS (SELECT task, threshold,
              sum(CASE WHEN label = 1 AND prob >= threshold THEN c ELSE 0 END) AS tp,
              sum(CASE WHEN label = 0 AND prob < threshold THEN c ELSE 0 END) AS tn,
              sum(CASE WHEN label = 0 AND prob >= threshold THEN c ELSE 0 END) AS fp,
              sum(CASE WHEN label = 1 AND prob < threshold THEN c ELSE 0 END) AS fn
       FROM per, th GROUP BY task, threshold),
m AS (SELECT task, threshold, ({_TF0} + {_TF1}) / 2 AS macro_f1, {_TF0} AS f1_class0, {_TF1} AS f1_class1,
             {_TACC} AS accuracy FROM cf),
best AS (SELECT task, threshold AS bt FROM (SELECT *, row_number() OVER (PARTITION BY task ORDER BY macro_f1 DESC, threshold) AS rn
                                            FROM m) WHERE rn = 1)
SELECT m.task, round(threshold, 2) AS threshold, round(macro_f1, 4) AS macro_f1, round(f1_class0, 4) AS f1_class0,
       round(f1_class1, 4) AS f1_class1, round(accuracy, 4) AS accuracy, threshold = best.bt AS is_best
FROM m JOIN best ON m.task = best.task""")
def threshold_sweep(spark, sf):
    s = V.threshold_sweep(_weighted(spark, sf))
    return s.select("task", F.round("threshold", 2).alias("threshold"),
                    *[F.round(c, 4).alias(c) for c in ("macro_f1", "f1_class0", "f1_class1", "accuracy")], "is_best")


def _board(spark, sf):
    sc = scored(spark, sf)
    return V.leaderboard(V.class_metrics(sc, KEYS), V.auc_roc(sc, KEYS))


BOARD_SQL = f"""{CONF_SQL},
{AUC_SQL},
board AS (SELECT met.task, met.model, macro_f1, auc_roc,
                 row_number() OVER (PARTITION BY met.task ORDER BY macro_f1 DESC, auc_roc DESC NULLS LAST, met.model) AS position
          FROM met LEFT JOIN auc ON met.task = auc.task AND met.model = auc.model)"""


@register("leaderboard", ("WIN-5", "AGG-25", "AGG-26"), sql=f"""
WITH {BOARD_SQL}
SELECT task, model, round(macro_f1, 6) AS macro_f1, round(auc_roc, 6) AS auc_roc, CAST(position AS INTEGER) AS position
FROM board""")
def leaderboard(spark, sf):
    b = _board(spark, sf)
    return b.select("task", "model", r6("macro_f1").alias("macro_f1"), r6("auc_roc").alias("auc_roc"), "position")


def _families(spark):
    return spark.createDataFrame([(m, f) for m, f, _, _ in MODELS], "model string, family string")


BEST_SQL = f"""{BOARD_SQL},
fam AS (SELECT DISTINCT model, family FROM scored),
best AS (SELECT family, task, model, macro_f1 FROM (
  SELECT f.family, b.task, b.model, b.macro_f1,
         row_number() OVER (PARTITION BY f.family, b.task ORDER BY b.macro_f1 DESC,
                            coalesce(b.auc_roc, CAST('-inf' AS DOUBLE)) DESC, b.model DESC) AS rn
  FROM board b JOIN fam f ON b.model = f.model) WHERE rn = 1)"""


@register("best_per_family", ("WIN-6",), sql=f"""
WITH {BEST_SQL}
SELECT family, task, model, round(macro_f1, 6) AS macro_f1 FROM best""")
def best_per_family(spark, sf):
    b = V.best_per_family(_board(spark, sf), _families(spark))
    return b.select("family", "task", "model", r6("macro_f1").alias("macro_f1"))


@register("lean_ensemble", ("ML-14", "WIN-6", "AGG-28", "AGG-25"), sql=f"""
WITH {BEST_SQL},
lean AS (SELECT s.doc_id, s.task, min(s.label) AS label, avg(s.prob) AS prob
         FROM scored s JOIN best b ON s.task = b.task AND s.model = b.model GROUP BY s.doc_id, s.task),
lc AS (SELECT task, count(*) FILTER (WHERE label = 1 AND prob >= 0.5) AS tp, count(*) FILTER (WHERE label = 0 AND prob < 0.5) AS tn,
              count(*) FILTER (WHERE label = 0 AND prob >= 0.5) AS fp, count(*) FILTER (WHERE label = 1 AND prob < 0.5) AS fn
       FROM lean GROUP BY task)
SELECT task, tp, tn, fp, fn, round({_F0}, 6) AS f1_class0, round({_F1}, 6) AS f1_class1,
       round(({_F0} + {_F1}) / 2, 6) AS macro_f1, round({_ACC}, 6) AS accuracy FROM lc""")
def lean_ensemble(spark, sf):
    sc = scored(spark, sf)
    best = V.best_per_family(_board(spark, sf), _families(spark)).select("task", "model")
    lean = sc.join(best, ["task", "model"], "left_semi")
    vote = V.soft_vote(lean, 0.5)
    m = V.class_metrics(vote, ["task"])
    return m.select("task", "tp", "tn", "fp", "fn", *[r6(c).alias(c) for c in ("f1_class0", "f1_class1", "macro_f1", "accuracy")])


@register("error_examples", ("WIN-10", "FN-31"), sql=f"""
WITH {SCORED_SQL},
k AS (SELECT s.*, CASE WHEN label = 0 AND pred = 1 THEN 'FP' ELSE 'FN' END AS kind FROM scored s
      WHERE (label = 0 AND pred = 1) OR (label = 1 AND pred = 0)),
r AS (SELECT *, row_number() OVER (PARTITION BY task, model, kind ORDER BY doc_id) AS rn FROM k)
SELECT r.task, r.model, r.kind, r.doc_id, substr(d.text, 1, 120) AS preview
FROM r JOIN documents d ON r.doc_id = d.doc_id WHERE rn <= 5""")
def error_examples(spark, sf):
    ex = V.first_examples(scored(spark, sf), ("FP", "FN"), 5)
    docs = table(spark, sf, "documents").select("doc_id", T.preview("text", 120).alias("preview"))
    return ex.join(docs, "doc_id").select("task", "model", "kind", "doc_id", "preview")


@register("quadrants", ("FLT-17", "ML-15", "AGG-28"), sql=f"""
WITH {SCORED_SQL},
v AS (SELECT doc_id, task, min(label) AS label, CAST(avg(prob) >= 0.5 AS INTEGER) AS pred FROM scored GROUP BY doc_id, task),
k AS (SELECT *, CASE WHEN label = 1 AND pred = 1 THEN 'TP' WHEN label = 0 AND pred = 0 THEN 'TN'
                     WHEN label = 0 AND pred = 1 THEN 'FP' ELSE 'FN' END AS kind FROM v),
r AS (SELECT *, row_number() OVER (PARTITION BY task, kind ORDER BY doc_id) AS rn FROM k)
SELECT task, kind, doc_id, label, pred FROM r WHERE rn <= 3""")
def quadrants(spark, sf):
    vote = V.soft_vote(scored(spark, sf), 0.5)
    ex = V.first_examples(vote, ("TP", "TN", "FP", "FN"), 3, by=("task",))
    return ex.select("task", "kind", "doc_id", "label", "pred")


@register("class_weights", ("AGG-31",), sql="""
WITH t AS (SELECT 'quality' AS task, quality AS label FROM labels UNION ALL SELECT 'toxic', toxic FROM labels),
c AS (SELECT task, count(*) AS n, count(*) FILTER (WHERE label = 1) AS n_pos, count(*) FILTER (WHERE label = 0) AS n_neg
      FROM t GROUP BY task)
SELECT task, n_pos, n_neg, round(CASE WHEN n_pos > 0 THEN n_neg / n_pos END, 6) AS pos_weight,
       round(CASE WHEN n_neg > 0 THEN n / (2 * n_neg) END, 6) AS balanced_w0,
       round(CASE WHEN n_pos > 0 THEN n / (2 * n_pos) END, 6) AS balanced_w1 FROM c""")
def class_weights(spark, sf):
    lab = table(spark, sf, "labels")
    t = lab.select(F.inline(F.array(F.struct(F.lit("quality").alias("task"), F.col("quality").alias("label")),
                                    F.struct(F.lit("toxic").alias("task"), F.col("toxic").alias("label")))))
    c = t.groupBy("task").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("label") == 1).alias("n_pos"),
                              F.count_if(F.col("label") == 0).alias("n_neg"))
    return c.select("task", "n_pos", "n_neg",
                    r6(F.when(F.col("n_pos") > 0, F.col("n_neg") / F.col("n_pos"))).alias("pos_weight"),
                    r6(F.when(F.col("n_neg") > 0, F.col("n") / (2 * F.col("n_neg")))).alias("balanced_w0"),
                    r6(F.when(F.col("n_pos") > 0, F.col("n") / (2 * F.col("n_pos")))).alias("balanced_w1"))


ACQ_SQL = f"""{SCORED_SQL},
a AS (SELECT doc_id, task, prob AS p, pred AS pa FROM scored WHERE model = 'logreg_base'),
b AS (SELECT doc_id, task, pred AS pb FROM scored WHERE model = 'cnn_base'),
j AS (SELECT a.doc_id, a.task, 1 - greatest(a.p, 1 - a.p) AS unc, CAST(a.pa <> b.pb AS DOUBLE) AS dis
      FROM a JOIN b ON a.doc_id = b.doc_id AND a.task = b.task),
acq AS (SELECT doc_id, avg(unc) AS avg_uncertainty, avg(dis) AS avg_disagreement,
               (avg(unc) + avg(dis)) / 2 AS combined_score FROM j GROUP BY doc_id)"""


def _acquisition(spark, sf):
    sc = scored(spark, sf)
    a = sc.where(F.col("model") == "logreg_base").select("doc_id", "task", "prob", F.col("pred").alias("pa"))
    b = sc.where(F.col("model") == "cnn_base").select("doc_id", "task", F.col("pred").alias("pb"))
    j = a.join(b, ["doc_id", "task"]).select("doc_id", V.uncertainty("prob").alias("unc"),
                                             V.disagreement("pa", "pb").alias("dis"))
    return j.groupBy("doc_id").agg(F.avg("unc").alias("avg_uncertainty"), F.avg("dis").alias("avg_disagreement")) \
        .withColumn("combined_score", (F.col("avg_uncertainty") + F.col("avg_disagreement")) / 2)


@register("acquisition_ranking", ("FN-25", "FN-26", "FN-27", "WIN-8", "ML-11"), sql=f"""
WITH {ACQ_SQL}
SELECT doc_id, round(avg_uncertainty, 6) AS avg_uncertainty, round(avg_disagreement, 6) AS avg_disagreement,
       round(combined_score, 6) AS combined_score FROM acq ORDER BY combined_score DESC, doc_id LIMIT 10""")
def acquisition_ranking(spark, sf):
    acq = _acquisition(spark, sf).orderBy(F.desc("combined_score"), "doc_id").limit(10)
    return acq.select("doc_id", *[r6(c).alias(c) for c in ("avg_uncertainty", "avg_disagreement", "combined_score")])


@register("top_p_split", ("WIN-9", "DED-5", "JN-4"), sql=f"""
WITH {ACQ_SQL},
r AS (SELECT doc_id, row_number() OVER (ORDER BY combined_score DESC, doc_id) - 1 AS idx FROM acq),
n AS (SELECT count(*) AS n FROM acq),
p AS (SELECT * FROM (VALUES (5), (10), (15), (20)) v(pct))
SELECT pct, CAST(count(*) FILTER (WHERE idx < round_even(n * pct / 100.0, 0)) AS BIGINT) AS n_top,
       CAST(count(*) FILTER (WHERE idx >= round_even(n * pct / 100.0, 0)) AS BIGINT) AS n_rest
FROM r, n, p GROUP BY pct""")
def top_p_split(spark, sf):
    acq = _acquisition(spark, sf).withColumn("_neg", -F.col("combined_score"))
    idx = contiguous_index(acq.select("doc_id", "_neg"), ["_neg", "doc_id"], "idx")
    n = acq.agg(F.count(F.lit(1)).alias("n"))
    x = with_scalars(idx, n).select("idx", "n", F.explode(F.array(*[F.lit(p) for p in (5, 10, 15, 20)])).alias("pct"))
    cut = F.bround(F.col("n") * F.col("pct") / 100.0, 0)
    return x.groupBy("pct").agg(F.count_if(F.col("idx") < cut).alias("n_top"), F.count_if(F.col("idx") >= cut).alias("n_rest"))
