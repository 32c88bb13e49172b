"""Derived tables that let the driver tables play the reference's inputs.

Each stand-in is a Spark function and the same definition as a SQL common table expression
for the DuckDB oracle. All are derived from the driver tables, so their size grows with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from markerlens.session import table

# ---- labelled corpus: documents with the `quality` label as the corpus label (F2)


def corpus(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang", "source")
    labels = table(spark, sf, "labels").select("doc_id", F.col("quality").alias("label"))
    return docs.join(labels, "doc_id", "left")


CORPUS_SQL = """corpus AS (
  SELECT d.doc_id, d.text, d.lang, d.source, l.quality AS label
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


# ---- ratings: events as annotation rows (F5).
# item = event_id div 5, annotator = rater_<event_id mod 5>; rater_4 plays the AI annotator.
# Each event rates five features; its category per feature is derived from the event's columns,
# and an `error` event leaves `unk` unrated (a missing rating).
ANNOTATORS = ("rater_0", "rater_1", "rater_2", "rater_3", "rater_4")
AI_ANNOTATOR = "rater_4"


def ratings(spark: SparkSession, sf: str) -> DataFrame:
    """Long form (annotator, item_id, feature, category, ord)."""
    ev = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    base = ev.select(
        (F.col("event_id") / 5).cast("long").alias("item_id"),
        F.concat(F.lit("rater_"), (F.col("event_id") % 5).cast("string")).alias("annotator"),
        F.col("event_id").alias("ord"),
        F.col("event_type"), F.col("value"), F.col("user_id"))
    cats = F.array(
        F.struct(F.lit("all_caps").alias("feature"),
                 F.when(F.col("value") < 25, F.lit("[]")).otherwise(F.lit("[caps]")).alias("category")),
        F.struct(F.lit("exclamation_marks").alias("feature"),
                 F.when(F.col("event_type").isin("view", "click"), F.lit("[]"))
                 .otherwise(F.concat(F.lit("[!"), F.col("event_type"), F.lit("]"))).alias("category")),
        F.struct(F.lit("hedging").alias("feature"),
                 F.when(F.col("user_id") % 3 == 0, F.lit("[]"))
                 .otherwise(F.concat(F.lit("[h"), (F.col("user_id") % 3).cast("string"), F.lit("]"))).alias("category")),
        F.struct(F.lit("adjectives").alias("feature"),
                 F.when(F.col("value") < 10, F.lit("[]"))
                 .when(F.col("value") < 60, F.lit("[adj]")).otherwise(F.lit("[adj;ful]")).alias("category")),
        F.struct(F.lit("unk").alias("feature"),
                 F.when(F.col("event_type") == "error", F.lit(None).cast("string"))
                 .when(F.col("value") < 40, F.lit("[]")).otherwise(F.lit("[unk]")).alias("category")),
    )
    return (base.select("annotator", "item_id", "ord", F.inline(cats))
            .select("annotator", "item_id", "feature", "category", "ord"))


RATINGS_SQL = """ev AS (
  SELECT CAST(event_id // 5 AS BIGINT) AS item_id, 'rater_' || CAST(event_id % 5 AS VARCHAR) AS annotator,
         event_id AS ord, event_type, value, user_id FROM events),
ratings AS (
  SELECT annotator, item_id, 'all_caps' AS feature,
         CASE WHEN value < 25 THEN '[]' ELSE '[caps]' END AS category, ord FROM ev
  UNION ALL
  SELECT annotator, item_id, 'exclamation_marks',
         CASE WHEN event_type IN ('view', 'click') THEN '[]' ELSE '[!' || event_type || ']' END, ord FROM ev
  UNION ALL
  SELECT annotator, item_id, 'hedging',
         CASE WHEN user_id % 3 = 0 THEN '[]' ELSE '[h' || CAST(user_id % 3 AS VARCHAR) || ']' END, ord FROM ev
  UNION ALL
  SELECT annotator, item_id, 'adjectives',
         CASE WHEN value < 10 THEN '[]' WHEN value < 60 THEN '[adj]' ELSE '[adj;ful]' END, ord FROM ev
  UNION ALL
  SELECT annotator, item_id, 'unk',
         CASE WHEN event_type = 'error' THEN NULL WHEN value < 40 THEN '[]' ELSE '[unk]' END, ord FROM ev)"""


# ---- scored set: per (doc, task, model) a probability from integer arithmetic on the row (F12).
# Tasks: quality and toxic of `labels`. Models are column values; each has a family.
MODELS = (
    ("logreg_base", "logreg", 37, 11),
    ("logreg_transfer", "logreg", 53, 29),
    ("logreg_cascade", "logreg", 71, 5),
    ("cnn_base", "cnn", 89, 17),
    ("cnn_ling", "cnn", 97, 41),
)


def scored(spark: SparkSession, sf: str) -> DataFrame:
    """(doc_id, task, model, family, label, prob, pred) — prob in [0, 1] with steps of 1/128.

    prob = ((doc_id·a + length(text)·b·t + 38·label) mod 129) / 128 (capped at 1): it carries some
    signal of the label, and ties occur (average-rank AUC matters).
    """
    docs = table(spark, sf, "documents").select("doc_id", F.length("text").alias("_len"))
    labels = table(spark, sf, "labels")
    rows = labels.join(docs, "doc_id", "inner")
    tasks = F.array(F.struct(F.lit("quality").alias("task"), F.col("quality").alias("label"), F.lit(1).alias("_t")),
                    F.struct(F.lit("toxic").alias("task"), F.col("toxic").alias("label"), F.lit(2).alias("_t")))
    models = F.array(*[F.struct(F.lit(m).alias("model"), F.lit(f).alias("family"),
                                F.lit(a).alias("_a"), F.lit(b).alias("_b")) for m, f, a, b in MODELS])
    long = (rows.select("doc_id", "_len", F.inline(tasks)).select("*", F.inline(models)))
    raw = ((F.pmod(F.col("doc_id"), F.lit(129)) * F.col("_a") + F.col("_len") * F.col("_b") * F.col("_t")
            + F.col("label") * 38) % 129)
    # dyadic steps (k / 128): sums of probabilities are exact, whatever the addition order.
    prob = (F.least(raw, F.lit(128)).cast("double") / 128.0)
    return long.select("doc_id", "task", "model", "family", "label", prob.alias("prob"),
                       (prob >= 0.5).cast("int").alias("pred"))


def _models_values() -> str:
    return ", ".join(f"('{m}', '{f}', {a}, {b})" for m, f, a, b in MODELS)


SCORED_SQL = f"""models(model, family, a, b) AS (VALUES {_models_values()}),
tasks(task, t) AS (VALUES ('quality', 1), ('toxic', 2)),
scored0 AS (
  SELECT l.doc_id, t.task, m.model, m.family,
         CASE WHEN t.task = 'quality' THEN l.quality ELSE l.toxic END AS label,
         CAST(least((l.doc_id * m.a + length(d.text) * m.b * t.t
               + (CASE WHEN t.task = 'quality' THEN l.quality ELSE l.toxic END) * 38) % 129, 128) AS DOUBLE)
           / CAST(128 AS DOUBLE) AS prob
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id, tasks t, models m),
scored AS (SELECT *, CAST(prob >= 0.5 AS INTEGER) AS pred FROM scored0)"""
