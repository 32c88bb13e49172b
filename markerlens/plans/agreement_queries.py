"""Registered queries, agreement and consolidation."""

from __future__ import annotations

from pyspark.sql import functions as F

from markerlens.functions.text import TAGS
from markerlens.operators import agreement as A
from markerlens.operators import consolidate as K
from markerlens.plans import sqlbits as S
from markerlens.plans.registry import register
from markerlens.plans.standins import AI_ANNOTATOR, RATINGS_SQL, ratings


def r6(c):
    return F.round(c, 6)


def _band_sql(k: str) -> str:
    parts = " ".join(f"WHEN {k} < {b} THEN '{n}'" for b, n in A.KAPPA_BANDS)
    return f"CASE WHEN {k} IS NULL OR isnan({k}) THEN NULL {parts} ELSE '{A.TOP_BAND}' END"


def _fleiss_sql(where: str) -> str:
    return f"""WITH {RATINGS_SQL},
r AS (SELECT * FROM ratings {where}),
items_total AS (SELECT feature, count(DISTINCT item_id) AS items_total FROM r GROUP BY feature),
cells AS (SELECT feature, item_id, category, count(*) AS n_ij FROM r WHERE category IS NOT NULL GROUP BY ALL),
per_item AS (SELECT feature, item_id, sum(n_ij) AS n, sum(n_ij * n_ij) AS sq FROM cells GROUP BY ALL),
top AS (SELECT feature, max(n) AS mx FROM per_item GROUP BY feature),
kept AS (SELECT p.* FROM per_item p JOIN top t ON p.feature = t.feature AND p.n = t.mx),
kc AS (SELECT c.* FROM cells c JOIN kept k ON c.feature = k.feature AND c.item_id = k.item_id),
agree AS (SELECT feature, avg(CASE WHEN n > 1 THEN (sq - n) / (n * (n - 1)) END) AS p_bar,
                 count(*) AS items_used, max(n) AS raters FROM kept GROUP BY feature),
pc AS (SELECT feature, category, sum(n_ij) AS c_j FROM kc GROUP BY ALL),
pe AS (SELECT feature, sum(c_j * c_j) / (sum(c_j) * sum(c_j)) AS p_e FROM pc GROUP BY feature),
res AS (SELECT a.feature, CASE WHEN p_e < 1 AND p_bar IS NOT NULL AND NOT isnan(p_bar)
                               THEN (p_bar - p_e) / (1 - p_e) END AS kappa, items_used, raters
        FROM agree a JOIN pe ON a.feature = pe.feature)
SELECT res.feature, round(kappa, 6) AS kappa, {_band_sql('kappa')} AS agreement, items_total, items_used,
       CAST(raters AS BIGINT) AS raters
FROM res JOIN items_total ON res.feature = items_total.feature WHERE items_used >= 2"""


def _fleiss_spark(spark, sf, excl):
    f = A.fleiss(ratings(spark, sf), exclude_annotators=excl)
    return f.select("feature", r6("kappa").alias("kappa"), "agreement", "items_total", "items_used",
                    F.col("raters").cast("long").alias("raters"))


@register("fleiss_per_feature", ("AGG-18", "FLT-13", "FN-20", "FN-23"), sql=_fleiss_sql(""))
def fleiss_per_feature(spark, sf):
    return _fleiss_spark(spark, sf, ())


@register("fleiss_per_feature_humans", ("AGG-18", "FLT-7", "FLT-13", "FN-23"),
          sql=_fleiss_sql(f"WHERE annotator <> '{AI_ANNOTATOR}'"))
def fleiss_per_feature_humans(spark, sf):
    return _fleiss_spark(spark, sf, (AI_ANNOTATOR,))


def _overall_sql(where: str) -> str:
    absent = S.str_list(A.ABSENT)
    return f"""WITH {RATINGS_SQL},
r AS (SELECT * FROM ratings WHERE category IS NOT NULL {where}),
per0 AS (SELECT feature, item_id, count(*) AS n,
                count(*) FILTER (WHERE NOT list_contains({absent}, category)) AS yes FROM r GROUP BY ALL),
per1 AS (SELECT * FROM per0 WHERE n >= 2),
top AS (SELECT feature, max(n) AS mx FROM per1 GROUP BY feature),
per AS (SELECT p.* FROM per1 p JOIN top t ON p.feature = t.feature AND p.n = t.mx),
mode AS (SELECT n AS m FROM per GROUP BY n ORDER BY count(*) DESC, n ASC LIMIT 1),
rows_ AS (SELECT per.* FROM per JOIN mode ON per.n = mode.m),
pi AS (SELECT n, CASE WHEN n > 1 THEN (yes * yes + (n - yes) * (n - yes) - n) / (n * (n - 1)) END AS p_i, yes FROM rows_),
agg AS (SELECT avg(p_i) AS p_bar, count(*) AS pairs, max(n) AS raters,
               sum(yes) / sum(n) AS p_yes FROM pi),
res AS (SELECT p_bar, pairs, raters, p_yes * p_yes + (1 - p_yes) * (1 - p_yes) AS p_e FROM agg)
SELECT round(CASE WHEN p_e < 1 AND p_bar IS NOT NULL THEN (p_bar - p_e) / (1 - p_e) END, 6) AS kappa,
       {_band_sql('CASE WHEN p_e < 1 AND p_bar IS NOT NULL THEN (p_bar - p_e) / (1 - p_e) END')} AS agreement,
       pairs, CAST(raters AS BIGINT) AS raters
FROM res WHERE pairs > 0"""


def _overall_spark(spark, sf, excl):
    f = A.fleiss_overall(ratings(spark, sf), exclude_annotators=excl)
    return f.select(r6("kappa").alias("kappa"), "agreement", "pairs", F.col("raters").cast("long").alias("raters"))


@register("fleiss_overall", ("AGG-19", "FN-21", "FLT-12", "FLT-13", "FLT-14"), sql=_overall_sql(""))
def fleiss_overall(spark, sf):
    return _overall_spark(spark, sf, ())


@register("fleiss_overall_humans", ("AGG-19", "FLT-7", "FLT-14"),
          sql=_overall_sql(f"AND annotator <> '{AI_ANNOTATOR}'"))
def fleiss_overall_humans(spark, sf):
    return _overall_spark(spark, sf, (AI_ANNOTATOR,))


COHEN_SQL = f"""rr AS (SELECT feature, item_id, annotator, category FROM ratings WHERE category IS NOT NULL),
pairs AS (SELECT a.feature, a.annotator AS annotator_1, b.annotator AS annotator_2, a.category AS c1, b.category AS c2
          FROM rr a JOIN rr b ON a.feature = b.feature AND a.item_id = b.item_id AND a.annotator < b.annotator),
obs AS (SELECT feature, annotator_1, annotator_2, count(*) AS n_items, count(*) FILTER (WHERE c1 = c2) AS agree
        FROM pairs GROUP BY ALL),
m1 AS (SELECT feature, annotator_1, annotator_2, c1 AS category, count(*) AS m FROM pairs GROUP BY ALL),
m2 AS (SELECT feature, annotator_1, annotator_2, c2 AS category, count(*) AS m FROM pairs GROUP BY ALL),
expct AS (SELECT m1.feature, m1.annotator_1, m1.annotator_2, sum(m1.m * m2.m) AS e FROM m1 JOIN m2
          ON m1.feature = m2.feature AND m1.annotator_1 = m2.annotator_1 AND m1.annotator_2 = m2.annotator_2
          AND m1.category = m2.category GROUP BY ALL),
names AS (SELECT DISTINCT annotator FROM ratings),
grid AS (SELECT f.feature, a.annotator AS annotator_1, b.annotator AS annotator_2
         FROM (SELECT DISTINCT feature FROM ratings) f, names a, names b WHERE a.annotator < b.annotator),
cohen AS (
  SELECT g.feature, g.annotator_1, g.annotator_2, CAST(coalesce(o.n_items, 0) AS BIGINT) AS n_items,
         CASE WHEN o.n_items >= 2 AND coalesce(x.e, 0) / (o.n_items * o.n_items) < 1
              THEN (o.agree / o.n_items - coalesce(x.e, 0) / (o.n_items * o.n_items))
                   / (1 - coalesce(x.e, 0) / (o.n_items * o.n_items)) END AS kappa
  FROM grid g
  LEFT JOIN obs o ON g.feature = o.feature AND g.annotator_1 = o.annotator_1 AND g.annotator_2 = o.annotator_2
  LEFT JOIN expct x ON g.feature = x.feature AND g.annotator_1 = x.annotator_1 AND g.annotator_2 = x.annotator_2)"""


@register("cohen_pairwise", ("AGG-20", "JN-1", "FN-20"), sql=f"""
WITH {RATINGS_SQL},
{COHEN_SQL}
SELECT feature, annotator_1, annotator_2, n_items, round(kappa, 6) AS kappa FROM cohen""")
def cohen_pairwise(spark, sf):
    c = A.cohen_pairwise(ratings(spark, sf))
    return c.select("feature", "annotator_1", "annotator_2", "n_items", r6("kappa").alias("kappa"))


RANKING_SQL = f"""both_ AS (
  SELECT annotator_1 AS annotator, kappa FROM cohen
  WHERE annotator_1 <> '{AI_ANNOTATOR}' AND annotator_2 <> '{AI_ANNOTATOR}'
  UNION ALL
  SELECT annotator_2, kappa FROM cohen
  WHERE annotator_1 <> '{AI_ANNOTATOR}' AND annotator_2 <> '{AI_ANNOTATOR}'),
means AS (SELECT annotator, CASE WHEN count(*) = count(kappa) THEN avg(kappa) END AS mean_kappa
          FROM both_ GROUP BY annotator),
ranking AS (SELECT annotator, mean_kappa,
                   row_number() OVER (ORDER BY mean_kappa DESC NULLS LAST, annotator) AS rank FROM means)"""


def _ranking(spark, sf):
    pw = A.cohen_pairwise(ratings(spark, sf))
    return K.rank_annotators(A.annotator_means(pw, (AI_ANNOTATOR,)))


@register("annotator_ranking", ("AGG-21", "WIN-4"), sql=f"""
WITH {RATINGS_SQL},
{COHEN_SQL},
{RANKING_SQL}
SELECT annotator, round(mean_kappa, 6) AS mean_kappa, CAST(rank AS INTEGER) AS rank FROM ranking""")
def annotator_ranking(spark, sf):
    return _ranking(spark, sf).select("annotator", r6("mean_kappa").alias("mean_kappa"), "rank")


_ROW_COLS = ",\n         ".join(f"max(category) FILTER (WHERE feature = '{t}') AS {t}" for t in TAGS)
_KEY_LIST = ", ".join(TAGS)
ROWS_SQL = f"""rows0 AS (
  SELECT annotator, item_id, min(ord) AS ord,
         {_ROW_COLS}
  FROM ratings GROUP BY annotator, item_id),
rows_ AS (SELECT *, array_to_string(list_sort(list_filter([{_KEY_LIST}],
              lambda c: c IS NOT NULL AND NOT list_contains({S.str_list(A.ABSENT)}, c))), '|') AS vote_key FROM rows0),
ranked AS (SELECT r.*, coalesce(k.rank, {1 << 30}) AS rk FROM rows_ r LEFT JOIN ranking k ON r.annotator = k.annotator),
fallback AS (SELECT item_id, annotator, ord, vote_key FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY rk, ord) AS rn FROM ranked) WHERE rn = 1)"""


@register("ranked_selection", ("WIN-2", "WIN-3", "WIN-4"), sql=f"""
WITH {RATINGS_SQL},
{COHEN_SQL},
{RANKING_SQL},
{ROWS_SQL}
SELECT item_id, annotator, ord, vote_key FROM fallback""")
def ranked_selection(spark, sf):
    rows = K.annotation_rows(ratings(spark, sf))
    return K.ranked_selection(rows, _ranking(spark, sf))


@register("majority_vote", ("WIN-1", "WIN-2", "FN-22"), sql=f"""
WITH {RATINGS_SQL},
{COHEN_SQL},
{RANKING_SQL},
{ROWS_SQL},
per_key AS (SELECT item_id, vote_key, count(*) AS votes, min(ord) AS first_ord, arg_min(annotator, ord) AS first_annotator
            FROM rows_ GROUP BY item_id, vote_key),
top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY votes DESC, first_ord ASC) AS rn
                       FROM per_key) WHERE rn = 1)
SELECT f.item_id,
       CASE WHEN coalesce(t.votes, 0) >= 2 THEN t.first_annotator ELSE f.annotator END AS annotator,
       CASE WHEN coalesce(t.votes, 0) >= 2 THEN t.vote_key ELSE f.vote_key END AS vote_key,
       CASE WHEN coalesce(t.votes, 0) >= 2 THEN 'majority' ELSE 'ranked' END AS method,
       CAST(coalesce(t.votes, 0) AS BIGINT) AS votes
FROM fallback f LEFT JOIN top t ON f.item_id = t.item_id""")
def majority_vote(spark, sf):
    rows = K.annotation_rows(ratings(spark, sf))
    return K.majority_vote(rows, _ranking(spark, sf))


@register("disagreement_items", ("AGG-17", "AGG-13"), sql=f"""
WITH {RATINGS_SQL},
per AS (SELECT item_id, feature, count(DISTINCT category) AS d FROM ratings GROUP BY ALL)
SELECT item_id, count(*) AS n_features FROM per WHERE d > 1 GROUP BY item_id""")
def disagreement_items(spark, sf):
    return A.disagreement_items(ratings(spark, sf))


@register("rater_counts", ("AGG-13", "AGG-15"), sql=f"""
WITH {RATINGS_SQL}
SELECT feature, count(DISTINCT annotator) AS n_annotators, count(DISTINCT item_id) AS n_items,
       count(*) AS n_rows, count(*) - count(DISTINCT (annotator, item_id)) AS n_duplicate_cells
FROM ratings GROUP BY feature""")
def rater_counts(spark, sf):
    r = ratings(spark, sf)
    per_cell = r.groupBy("feature", "annotator", "item_id").agg(F.count(F.lit(1)).alias("_c"))
    dup = per_cell.groupBy("feature").agg(F.sum(F.col("_c") - 1).cast("long").alias("n_duplicate_cells"))
    base = r.groupBy("feature").agg(F.countDistinct("annotator").alias("n_annotators"),
                                    F.countDistinct("item_id").alias("n_items"), F.count(F.lit(1)).alias("n_rows"))
    return base.join(dup, "feature").select("feature", "n_annotators", "n_items", "n_rows", "n_duplicate_cells")


@register("assignment_range_join", ("JN-13",), sql=f"""
WITH {RATINGS_SQL},
items AS (SELECT DISTINCT item_id FROM ratings),
span AS (SELECT (max(item_id) + 1 + 4) // 5 AS w FROM items),
ranges AS (SELECT 'rater_' || CAST(k AS VARCHAR) AS annotator, k * w AS lo, (k + 2) * w - 1 AS hi
           FROM range(5) t(k), span)
SELECT r.annotator, count(*) AS n_assigned, min(i.item_id) AS first_item, max(i.item_id) AS last_item
FROM items i JOIN ranges r ON i.item_id BETWEEN r.lo AND r.hi GROUP BY r.annotator""")
def assignment_range_join(spark, sf):
    items = ratings(spark, sf).select("item_id").distinct()
    w = items.agg(F.expr("(max(item_id) + 1 + 4) div 5").alias("w"))
    ranges = w.select(F.inline(F.array(*[F.struct(
        F.lit(f"rater_{k}").alias("annotator"), (F.lit(k) * F.col("w")).alias("lo"),
        (F.lit(k + 2) * F.col("w") - 1).alias("hi")) for k in range(5)])))
    joined = K.range_assignment(items, ranges)
    return joined.groupBy("annotator").agg(F.count(F.lit(1)).alias("n_assigned"),
                                           F.min("item_id").alias("first_item"), F.max("item_id").alias("last_item"))


# The reference's own rule: items 0 to 40 by vote, the others by rank.
TRUTH_RANGES = ((0, 40, "vote"), (41, None, "ranked"))


def with_texts(r):
    """Stand-in span texts of a rating: the words in the brackets of its category."""
    inner = F.expr("substring(category, 2, length(category) - 2)")
    return r.withColumn("texts", F.when(F.length("category") > 2, F.split(inner, ";")).otherwise(F.array().cast("array<string>")))


@register("consolidated", ("FLT-6", "SET-1", "JN-13", "WIN-1", "WIN-2", "WIN-3", "FN-22"), sql=f"""
WITH {RATINGS_SQL},
{COHEN_SQL},
{RANKING_SQL},
rows0 AS (
  SELECT annotator, item_id, min(ord) AS ord, {_ROW_COLS},
         flatten(list(CASE WHEN length(category) > 2 THEN string_split(substring(category, 2, length(category) - 2), ';')
                           ELSE [] END)) AS texts
  FROM ratings GROUP BY annotator, item_id),
rows_ AS (SELECT *, CAST(to_json(list_sort(texts)) AS VARCHAR) AS vote_key FROM rows0),
cast_ AS (SELECT r.*, coalesce(k.rank, {1 << 30}) AS rk, count(*) OVER (PARTITION BY item_id, vote_key) AS n,
                 min(ord) OVER (PARTITION BY item_id, vote_key) AS first_ord
          FROM rows_ r LEFT JOIN ranking k ON r.annotator = k.annotator),
top AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY n DESC, first_ord, ord) AS rn FROM cast_),
best AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY rk, ord) AS rn FROM cast_),
voted AS (SELECT * FROM top WHERE rn = 1 AND item_id BETWEEN 0 AND 40 AND n >= 2),
picked AS (
  SELECT item_id, 'vote' AS rule, 'majority' AS method, 'Majority Vote' AS annotator, vote_key, {_KEY_LIST} FROM voted
  UNION ALL
  SELECT item_id, 'vote', 'ranked', 'Majority Vote', vote_key, {_KEY_LIST} FROM best
  WHERE rn = 1 AND item_id BETWEEN 0 AND 40 AND item_id NOT IN (SELECT item_id FROM voted)
  UNION ALL
  SELECT item_id, 'ranked', 'ranked', annotator, vote_key, {_KEY_LIST} FROM best WHERE rn = 1 AND item_id >= 41)
SELECT p.*, t.n AS votes FROM picked p JOIN top t ON p.item_id = t.item_id AND t.rn = 1""")
def consolidated(spark, sf):
    rows = K.annotation_rows(with_texts(ratings(spark, sf)))
    ranges = spark.createDataFrame(TRUTH_RANGES, "lo long, hi long, rule string")
    return K.consolidated(rows, _ranking(spark, sf), ranges)
