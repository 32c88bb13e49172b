"""Consolidation of many annotators into one truth set (WIN-1 … WIN-4, FN-22, FLT-6, SET-1, JN-13).

Rows are one per (annotator, item): the five feature categories and an input-order column.
Voting and fallback are aggregations (``max``/``min`` of a struct per item), not windows, so
an item with very many rows is reduced map-side before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from markerlens.functions.text import TAGS
from markerlens.operators.agreement import ABSENT
from markerlens.operators.ordering import with_scalars

_NO_RANK = 1 << 30


def span_texts(spans) -> Column:
    """The texts of a feature's spans (structs with ``text``), for the vote key; no spans → no texts."""
    c = F.col(spans) if isinstance(spans, str) else spans
    return F.coalesce(F.transform(c, lambda s: s["text"]), F.array().cast("array<string>"))


def annotation_rows(ratings: DataFrame, features: Sequence[str] = TAGS) -> DataFrame:
    """Long ratings → one row per (annotator, item) with a column per feature, the input
    order (first ``ord``) and the FN-22 combined vote key: the texts of all spans of all features, sorted, as
    a JSON list. Texts are the column ``texts`` (see ``span_texts``) of the ratings. Without that column the
    key joins the non-empty categories, which tell spans at different places apart."""
    texts = "texts" in ratings.columns
    wide = (ratings.groupBy("annotator", "item_id")
            .agg(F.min("ord").alias("ord"),
                 *[F.max(F.when(F.col("feature") == f, F.col("category"))).alias(f)
                   for f in features],
                 *([F.flatten(F.collect_list("texts")).alias("_texts")] if texts else [])))
    if texts:
        return wide.withColumn("vote_key", F.to_json(F.array_sort(F.filter("_texts", lambda t: t.isNotNull())))).drop("_texts")
    cats = F.filter(F.array(*[F.col(f) for f in features]), lambda c: c.isNotNull() & ~c.isin(*ABSENT))
    return wide.withColumn("vote_key", F.array_join(F.array_sort(cats), "|"))


def rank_annotators(means: DataFrame) -> DataFrame:
    """WIN-4 rank by mean kappa, descending; a null mean ranks last, then by name.
    The table has one row per annotator."""
    w = Window.orderBy(F.desc_nulls_last("mean_kappa"), F.asc("annotator"))
    return means.withColumn("rank", F.row_number().over(w))


def ranked_selection(rows: DataFrame, ranking: DataFrame) -> DataFrame:
    """WIN-2/3 per item the row of the best-ranked annotator; unranked annotators sort last,
    then input order. The ranking table is one row per annotator (broadcast)."""
    r = rows.join(F.broadcast(ranking.select("annotator", "rank")), "annotator", "left")
    best = r.groupBy("item_id").agg(F.min(F.struct(
        F.coalesce(F.col("rank"), F.lit(_NO_RANK)).alias("_r"), F.col("ord"), F.col("annotator"),
        F.col("vote_key"))).alias("_b"))
    return best.select("item_id", F.col("_b.annotator").alias("annotator"), F.col("_b.ord").alias("ord"),
                       F.col("_b.vote_key").alias("vote_key"))


def majority_vote(rows: DataFrame, ranking: DataFrame, voters: Sequence[str] | None = None,
                  min_votes: int = 2) -> DataFrame:
    """WIN-1 the most common vote key per item wins with at least ``min_votes`` votes (ties:
    the key seen first), and its first row is returned; else WIN-2 the best-ranked row."""
    v = rows.where(F.col("annotator").isin(*voters)) if voters else rows
    per_key = v.groupBy("item_id", "vote_key").agg(
        F.count(F.lit(1)).alias("votes"),
        F.min(F.struct(F.col("ord"), F.col("annotator"))).alias("_first"))
    top = per_key.groupBy("item_id").agg(F.max(F.struct(
        F.col("votes"), (-F.col("_first.ord")).alias("_neg"), F.col("_first.annotator").alias("annotator"),
        F.col("vote_key"))).alias("_t"))
    fallback = ranked_selection(rows, ranking)
    res = fallback.join(top, "item_id", "left")
    won = F.coalesce(F.col("_t.votes"), F.lit(0)) >= min_votes
    return res.select(
        "item_id",
        F.when(won, F.col("_t.annotator")).otherwise(F.col("annotator")).alias("annotator"),
        F.when(won, F.col("_t.vote_key")).otherwise(F.col("vote_key")).alias("vote_key"),
        F.when(won, F.lit("majority")).otherwise(F.lit("ranked")).alias("method"),
        F.coalesce(F.col("_t.votes"), F.lit(0)).alias("votes"))


#: Bits by which the bucket levels of ranges differ; a range touches at most 2 ** LEVEL_BITS + 1 buckets.
LEVEL_BITS = 4


def range_assignment(items: DataFrame, ranges: DataFrame) -> DataFrame:
    """JN-13 items ↔ ranges by ``item_id BETWEEN lo AND hi``; ranges may overlap, a null ``lo`` or ``hi`` is open.

    An equality join on buckets: each range takes the bucket width 2^level that cuts it into a few pieces, and
    an item looks into its bucket of each width that some range uses. The range columns follow the item's."""
    ends = items.agg(F.min("item_id").alias("_min"), F.max("item_id").alias("_max"))  # one row
    lo, hi = (F.coalesce(f(c, m), m) for f, c, m in
              ((F.greatest, F.col("lo"), F.col("_min")), (F.least, F.col("hi"), F.col("_max"))))
    # open ends stop at the items' own; what holds no item is left out
    cut = with_scalars(ranges, ends).select(*ranges.columns, lo.cast("long").alias("_lo"), hi.cast("long").alias("_hi")).where("_lo <= _hi")
    levels = F.sequence(F.lit(0), F.lit(60), F.lit(LEVEL_BITS))
    fits = F.filter(levels, lambda k: F.call_function("shiftright", F.col("_hi") - F.col("_lo"), k) < (1 << LEVEL_BITS))
    buckets = (cut.withColumn("_level", fits[0])
               .withColumn("_bucket", F.explode(F.sequence(F.expr("shiftright(_lo, _level)"), F.expr("shiftright(_hi, _level)"))))
               .drop("_lo", "_hi"))
    used = cut.agg(F.collect_set(fits[0]).alias("_levels"))  # one row of at most 16 levels
    probes = (with_scalars(items, used).withColumn("_level", F.explode("_levels")).drop("_levels")
              .withColumn("_bucket", F.expr("shiftright(cast(item_id as long), _level)")))
    inside = (F.col("lo").isNull() | (F.col("item_id") >= F.col("lo"))) & (F.col("hi").isNull() | (F.col("item_id") <= F.col("hi")))
    return probes.join(buckets, ["_level", "_bucket"]).where(inside).select(*items.columns, *ranges.columns)


def consolidated(rows: DataFrame, ranking: DataFrame, ranges: DataFrame, features: Sequence[str] = TAGS,
                 min_votes: int = 2, voted_as: str = "Majority Vote") -> DataFrame:
    """The truth set: one row per item, with the features of the row that won (WIN-1, WIN-2, WIN-3, FLT-6, SET-1).

    ``ranges`` (lo, hi, rule) routes items by id: rule ``vote`` takes the first row of the most common vote key
    if it has ``min_votes``, else the best-ranked annotator's row, and names the annotator ``voted_as``; rule ``ranked``
    takes the best-ranked annotator's row under that annotator's name. Of overlapping ranges the lowest counts;
    items in no range (and without an id) are left out.

    One pass: votes per (item, key) with map-side counts, then the winners per item; only these meet the ranges.
    """
    kept = F.struct("annotator", "vote_key", *features).alias("row")
    r = rows.where(F.col("item_id").isNotNull()).join(ranking.select("annotator", "rank"), "annotator", "left")
    per_key = r.groupBy("item_id", "vote_key").agg(
        F.count(F.lit(1)).alias("votes"), F.min(F.struct("ord", kept)).alias("first"),
        F.min(F.struct(F.coalesce("rank", F.lit(_NO_RANK)).alias("rank"), "ord", kept)).alias("best"))
    winners = per_key.groupBy("item_id").agg(
        F.max(F.struct("votes", (-F.col("first.ord")).alias("neg"), F.col("first.row").alias("row"))).alias("top"),
        F.min("best").alias("best"))
    routes = (range_assignment(winners.select("item_id"), ranges).groupBy("item_id")
              .agg(F.min_by("rule", F.struct("lo", "rule")).alias("rule")))
    vote = F.col("rule") == "vote"
    won = vote & (F.col("top.votes") >= min_votes)
    row = F.when(won, F.col("top.row")).otherwise(F.col("best.row"))
    return (winners.join(routes, "item_id")
            .select("item_id", "rule", F.when(won, "majority").otherwise("ranked").alias("method"),
                    F.col("top.votes").alias("votes"), row.alias("row"))
            .select("item_id", "rule", "method", "votes", F.when(vote, F.lit(voted_as)).otherwise(F.col("row.annotator")).alias("annotator"),
                    "row.vote_key", *[F.col(f"row.{f}").alias(f) for f in features]))
