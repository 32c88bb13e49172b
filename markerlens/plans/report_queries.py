"""Registered queries for the remaining projections, filters, joins and display tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from markerlens.functions import text as T
from markerlens.operators import search as Q
from markerlens.plans import sqlbits as S
from markerlens.plans.evaluate_queries import ACQ_SQL, _acquisition
from markerlens.plans.registry import register
from markerlens.plans.search_queries import DOC_SPANS_SQL, index_with_raw_tags
from markerlens.plans.standins import ANNOTATORS, RATINGS_SQL, ratings
from markerlens.session import table


@register("short_texts", ("FLT-5", "FN-6"), sql="""
SELECT doc_id, length(text) AS text_length FROM documents WHERE length(text) < 10""")
def short_texts(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", T.char_length("text").cast("long").alias("text_length"))
    return d.where(F.col("text_length") < 10)


_SOCIAL = "text"
for _pat, _word in T.SOCIAL_RULES:
    _SOCIAL = f"regexp_replace({_SOCIAL}, {S.q(_pat)}, {S.q(_word)}, 'g')"
_WORDS = ("URL", "MENTION", "HASHTAG", "SMILEY", "EMOJI", "NUMBER")


@register("social_placeholders", ("FN-13",), sql=f"""
WITH p AS (SELECT conv_id, turn, role, {_SOCIAL} AS t FROM conversations)
SELECT conv_id, turn, role, length(t) AS n_chars,
       {", ".join(f"len(regexp_extract_all(t, '{w}')) AS n_{w.lower()}" for w in _WORDS)} FROM p""")
def social_placeholders(spark, sf):
    c = table(spark, sf, "conversations").select("conv_id", "turn", "role", T.social_placeholders("text").alias("t"))
    return c.select("conv_id", "turn", "role", F.length("t").cast("long").alias("n_chars"),
                    *[F.size(F.regexp_extract_all("t", F.lit(w), 0)).cast("long").alias(f"n_{w.lower()}") for w in _WORDS])


@register("elongation_squeeze", ("FN-14",))
def elongation_squeeze(spark, sf):
    """Characters removed per document by cutting runs of one character to three (a
    back-reference pattern: RE2 has none, so this query has no SQL oracle)."""
    d = table(spark, sf, "documents").select("doc_id", "text")
    return d.select("doc_id", (F.length("text") - F.length(T.squeeze_elongation("text"))).alias("removed"))


_HUMANS = [a for a in ANNOTATORS][:4]


@register("annotator_one_hot", ("FN-16", "FN-17"), sql=f"""
WITH {RATINGS_SQL},
r AS (SELECT DISTINCT annotator, item_id FROM ratings)
SELECT annotator, item_id, {", ".join(f"CAST(annotator = '{a}' AS INTEGER) AS {a}" for a in _HUMANS[1:])},
       CASE WHEN annotator IN ('rater_3', 'rater_4') THEN 'other' ELSE annotator END AS annotator_group
FROM r""")
def annotator_one_hot(spark, sf):
    """FN-16 one-hot columns for the kept annotators (the first one is the dropped reference
    level) and FN-17 minor values collapsed into one category."""
    r = ratings(spark, sf).select("annotator", "item_id").distinct()
    return r.select("annotator", "item_id", *[(F.col("annotator") == a).cast("int").alias(a) for a in _HUMANS[1:]],
                    F.when(F.col("annotator").isin("rater_3", "rater_4"), "other").otherwise(F.col("annotator"))
                    .alias("annotator_group"))


_ENTRY_WORDS = ", ".join(
    f"""CASE WHEN len({t}_words) > 0 THEN '{t.upper()}: ' || array_to_string(list_filter({t}_words, lambda w, i: list_position({t}_words, w) = i), ' ') END"""
    for t in T.TAGS)


@register("result_entries", ("FN-19", "FN-24", "SRCH-1"), sql=f"""
WITH {DOC_SPANS_SQL}
SELECT docs.doc_id, array_to_string(list_transform(tags, lambda t: upper(t)), ',') AS tag_labels,
       concat_ws('; ', {_ENTRY_WORDS}) AS tag_words, substr(docs.text, 1, 140) AS preview
FROM docs LEFT JOIN raw ON docs.doc_id = raw.doc_id""")
def result_entries(spark, sf):
    """Tags in upper case, each with the words that carry it, in the order of the text."""
    e = Q.result_entry(index_with_raw_tags(spark, sf))
    words = F.transform(F.map_entries("tag_words"), lambda x: F.concat(x["key"], F.lit(": "), F.array_join(x["value"], " ")))
    return e.select("doc_id", F.array_join("tag_labels", ",").alias("tag_labels"), F.array_join(words, "; ").alias("tag_words"), "preview")


@register("model_task_keys", ("FN-33",), sql="""
WITH k AS (SELECT DISTINCT CAST(quality AS VARCHAR) AS q FROM labels),
m(model) AS (VALUES ('logreg_base'), ('cnn_base')),
t(task) AS (VALUES ('quality'), ('toxic')),
keys AS (SELECT m.model || ' — ' || t.task AS key, count(*) AS n FROM m, t, k GROUP BY ALL)
SELECT key, regexp_replace(key, ' — [a-z_]+$', '') AS model, regexp_extract(key, ' — ([a-z_]+)$', 1) AS task,
       n FROM keys""")
def model_task_keys(spark, sf):
    """FN-33 composite ``"model — task"`` keys split back into model and task."""
    k = table(spark, sf, "labels").select(F.col("quality").cast("string").alias("q")).distinct()
    mt = k.select(F.inline(F.array(*[F.struct(F.lit(m).alias("model"), F.lit(t).alias("task"))
                                     for m in ("logreg_base", "cnn_base") for t in ("quality", "toxic")])))
    keys = mt.groupBy(F.concat_ws(" — ", "model", "task").alias("key")).agg(F.count(F.lit(1)).alias("n"))
    return keys.select("key", F.regexp_replace("key", " — [a-z_]+$", "").alias("model"),
                       F.regexp_extract("key", " — ([a-z_]+)$", 1).alias("task"), "n")


@register("ranked_with_gold", ("JN-3", "WIN-8", "FN-27"), sql=f"""
WITH {ACQ_SQL}
SELECT a.doc_id, round(a.combined_score, 6) AS combined_score, l.quality AS gold_quality, l.toxic AS gold_toxic
FROM acq a LEFT JOIN labels l ON a.doc_id = l.doc_id""")
def ranked_with_gold(spark, sf):
    acq = _acquisition(spark, sf)
    lab = table(spark, sf, "labels").select("doc_id", F.col("quality").alias("gold_quality"),
                                            F.col("toxic").alias("gold_toxic"))
    return acq.join(lab, "doc_id", "left").select("doc_id", F.round("combined_score", 6).alias("combined_score"),
                                                  "gold_quality", "gold_toxic")


@register("benchmark_overlap", ("JN-4", "JN-5", "SET-3", "FN-4"), sql=f"""
WITH b AS (SELECT DISTINCT {S.clean_key('text')} AS k FROM benchmark),
d AS (SELECT doc_id, {S.clean_key('text')} AS k FROM documents)
SELECT 'member' AS kind, count(*) AS n FROM d WHERE k IN (SELECT k FROM b)
UNION ALL
SELECT 'not_member', count(*) FROM d WHERE k NOT IN (SELECT k FROM b)""")
def benchmark_overlap(spark, sf):
    b = table(spark, sf, "benchmark").select(T.clean_key("text").alias("k"))
    d = table(spark, sf, "documents").select("doc_id", T.clean_key("text").alias("k"))
    semi = d.join(b, "k", "left_semi").agg(F.count(F.lit(1)).alias("n")).select(F.lit("member").alias("kind"), "n")
    anti = d.join(b, "k", "left_anti").agg(F.count(F.lit(1)).alias("n")).select(F.lit("not_member").alias("kind"), "n")
    return semi.unionByName(anti)


@register("disagreement_pivot", ("AGG-16", "AGG-17", "WIN-12"), sql=f"""
WITH {RATINGS_SQL},
dis AS (SELECT item_id, feature FROM ratings GROUP BY ALL HAVING count(DISTINCT category) > 1)
SELECT r.item_id, r.feature, {", ".join(f"max(r.category) FILTER (WHERE r.annotator = '{a}') AS {a}" for a in ANNOTATORS)}
FROM ratings r JOIN dis ON r.item_id = dis.item_id AND r.feature = dis.feature GROUP BY r.item_id, r.feature""")
def disagreement_pivot(spark, sf):
    """AGG-16 per disagreeing (item, feature) one column per annotator, sorted for display."""
    r = ratings(spark, sf)
    dis = (r.groupBy("item_id", "feature").agg(F.countDistinct("category").alias("_d"))
           .where(F.col("_d") > 1).select("item_id", "feature"))
    piv = (r.join(dis, ["item_id", "feature"], "left_semi").groupBy("item_id", "feature")
           .pivot("annotator", list(ANNOTATORS)).agg(F.max("category")))
    return piv.orderBy("item_id", "feature")
