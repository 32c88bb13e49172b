"""Inter-annotator agreement (pipeline B): AGG-18 … AGG-21, FLT-7, FLT-12 … FLT-14, FN-20, FN-23.

Input is the long rating table ``(annotator, item_id, feature, category)``; ``category`` is
the canonical span-set string (FN-20) and null means "not rated". Every kappa is a few
grouped sums over all features (and all annotator pairs) at once — there are no per-feature
or per-pair loops and nothing is gathered on the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from markerlens.operators.ordering import with_scalars
from markerlens.session import checkpointed

# Kappa interpretation bands (upper bounds, exclusive) and their names.
KAPPA_BANDS = ((0.0, "Poor"), (0.20, "Slight"), (0.40, "Fair"), (0.60, "Moderate"), (0.80, "Substantial"))
TOP_BAND = "Almost Perfect"
# Strings that mean "no span" for the presence predicate.
ABSENT = ("[]", "", "nan", "None")


def kappa_band(k) -> Column:
    """FN-23 band of a kappa; null kappa → null band."""
    k = F.col(k) if isinstance(k, str) else k
    expr = None
    for bound, name in KAPPA_BANDS:
        expr = F.when(k < bound, F.lit(name)) if expr is None else expr.when(k < bound, F.lit(name))
    return F.when(k.isNull() | F.isnan(k), F.lit(None).cast("string")).otherwise(expr.otherwise(F.lit(TOP_BAND)))


def is_present(category) -> Column:
    """FN-21 presence: non-null and not an empty-set spelling."""
    c = F.col(category) if isinstance(category, str) else category
    return F.coalesce(~c.isin(*ABSENT), F.lit(False))


def exclude(ratings: DataFrame, annotators: Sequence[str] = ()) -> DataFrame:
    """FLT-7 drop the listed annotators (e.g. the AI annotator)."""
    return ratings.where(~F.col("annotator").isin(*annotators)) if annotators else ratings


def _kappa_from_items(items: DataFrame, by: list[str]) -> DataFrame:
    """Fleiss kappa from per-item rows (by…, n, sq, cats) of items with equal rater count, where
    ``cats`` holds the item's (category, n_ij) pairs.

    P_i = (Σ_j n_ij² − n)/(n(n−1)), P̄ = mean P_i, p_j = Σ_i n_ij/(N n), P_e = Σ p_j², κ = (P̄ − P_e)/(1 − P_e).
    """
    n = F.col("n")
    pi = F.when(n > 1, (F.col("sq") - n) / (n * (n - 1)))
    agree = items.groupBy(*by).agg(F.avg(pi).alias("p_bar"), F.count(F.lit(1)).alias("items_used"),
                                   F.max("n").alias("raters"))
    per_cat = (items.select(*by, F.inline("cats")).groupBy(*by, "category")
               .agg(F.sum("n_ij").alias("c_j")))
    tot = per_cat.groupBy(*by).agg(F.sum("c_j").alias("_tot"), F.sum(F.col("c_j") * F.col("c_j")).alias("_sq"))
    pe = tot.select(*by, (F.col("_sq") / (F.col("_tot") * F.col("_tot"))).alias("p_e"))
    out = agree.join(pe, by, "inner")
    kappa = F.when((F.col("p_e") < 1) & F.col("p_bar").isNotNull() & ~F.isnan("p_bar"),
                   (F.col("p_bar") - F.col("p_e")) / (1 - F.col("p_e")))
    return out.withColumn("kappa", kappa)


def one_rating(ratings: DataFrame) -> DataFrame:
    """One row per (annotator, item, feature): the first by ``ord`` where there is one. Rows without an
    item id are no ratings of one common item and are put aside."""
    # without ``ord`` the least category; a null is no rating and gives way to one
    pick = F.min(F.struct("ord", "category"))["category"] if "ord" in ratings.columns else F.min("category")
    return (ratings.where(F.col("item_id").isNotNull()).groupBy("annotator", "item_id", "feature")
            .agg(pick.alias("category")))


def fleiss(ratings: DataFrame, by: Sequence[str] = ("feature",), exclude_annotators: Sequence[str] = (),
           min_items: int = 2) -> DataFrame:
    """AGG-18 Fleiss kappa per feature over exact span-set categories.

    Missing ratings are not counted; only items with the largest rater count of their
    feature enter (FLT-13). ``items_total`` is every item with a row for the feature (the
    reference's ``Items``), ``items_used`` the items that entered. Features with fewer than
    ``min_items`` items give no row.

    Plan: one cell aggregate (feature, item, category) with map-side partial counts, one
    per-item aggregate carrying the item's category counts (bounded by its raters), and a
    per-feature maximum joined back by broadcast (one row per feature).
    """
    by = list(by)
    r = one_rating(exclude(ratings, exclude_annotators)) if by == ["feature"] else exclude(ratings, exclude_annotators)
    cells = r.groupBy(*by, "item_id", "category").agg(F.count(F.lit(1)).alias("n_ij"))
    rated = F.col("category").isNotNull()
    items = cells.groupBy(*by, "item_id").agg(
        F.sum(F.when(rated, F.col("n_ij")).otherwise(0)).alias("n"),
        F.sum(F.when(rated, F.col("n_ij") * F.col("n_ij")).otherwise(0)).alias("sq"),
        F.collect_list(F.when(rated, F.struct("category", "n_ij"))).alias("cats"))
    top = items.groupBy(*by).agg(F.max("n").alias("_max"), F.count(F.lit(1)).alias("items_total"))
    kept = items.join(F.broadcast(top), by).where((F.col("n") == F.col("_max")) & (F.col("n") > 0))
    res = _kappa_from_items(kept, by)
    return (res.join(F.broadcast(top.select(*by, "items_total")), by, "inner")
            .where(F.col("items_used") >= min_items)
            .select(*by, "kappa", kappa_band("kappa").alias("agreement"), "items_total", "items_used", "raters"))


def fleiss_overall(ratings: DataFrame, exclude_annotators: Sequence[str] = ()) -> DataFrame:
    """AGG-19 one Fleiss kappa over all (item, feature) pairs as yes/no ratings.

    Per feature: items with ≥ 2 ratings (FLT-12), then those with the feature's largest rater
    count (FLT-13); then rows whose rater count is the mode over all rows, the smallest on
    ties (FLT-14).
    """
    r = one_rating(exclude(ratings, exclude_annotators)).where(F.col("category").isNotNull())
    per = r.groupBy("feature", "item_id").agg(F.count(F.lit(1)).alias("n"),
                                              F.count_if(is_present("category")).alias("yes"))
    per = per.where(F.col("n") >= 2)
    top = per.groupBy("feature").agg(F.max("n").alias("_max"))
    per = per.join(F.broadcast(top), "feature").where(F.col("n") == F.col("_max"))
    # mode of the row sums: the distinct rater counts form a table of at most a few rows.
    mode = (per.groupBy("n").agg(F.count(F.lit(1)).alias("_c"))
            .orderBy(F.desc("_c"), F.asc("n")).limit(1).select(F.col("n").alias("_mode")))
    rows = per.join(F.broadcast(mode), F.col("n") == F.col("_mode"), "left_semi")
    items = rows.select(F.lit("all").alias("_g"), "n",
                        (F.col("yes") * F.col("yes") + (F.col("n") - F.col("yes")) * (F.col("n") - F.col("yes"))).alias("sq"),
                        F.array(F.struct(F.lit("yes").alias("category"), F.col("yes").alias("n_ij")),
                                F.struct(F.lit("no").alias("category"), (F.col("n") - F.col("yes")).alias("n_ij")))
                        .alias("cats"))
    res = _kappa_from_items(items, ["_g"])
    return res.select("kappa", kappa_band("kappa").alias("agreement"), F.col("items_used").alias("pairs"), "raters")


#: Raters of one item that stand in a block; a work unit holds two blocks at most.
BLOCK_RATERS = 256
#: Parts that the ratings of an item with more raters are spread over while they learn its number of blocks.
SALTS = 64


def rater_pairs(rows: DataFrame, group: Sequence[str], block: int = BLOCK_RATERS, salts: int = SALTS) -> DataFrame:
    """JN-1 (group…, annotator_1, annotator_2, c1, c2) for the rows (group…, annotator, category) of each group,
    annotator_1 < annotator_2; an annotator stands in a group once.

    A group of more than ``block`` raters is dealt into hash blocks, and two blocks are a work unit, so a
    group of any size is the work of many tasks. The number of blocks reaches the rows by a join on the
    group and a salt: the rows of a large group do not meet in one task there either.
    """
    group = list(group)
    salt = F.pmod(F.xxhash64("annotator", F.lit(1)), F.lit(salts)).cast("int").alias("_salt")
    large = (rows.groupBy(*group).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > block)
             .select(*group, F.ceil(F.col("_n") / block).cast("int").alias("_blocks"),
                     F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt")))
    dealt = (rows.select(*group, "annotator", "category", salt).join(large, [*group, "_salt"], "left")
             .select(*group, "annotator", "category", F.coalesce("_blocks", F.lit(1)).alias("_blocks"))
             .withColumn("_blk", F.pmod(F.xxhash64("annotator"), F.col("_blocks")).cast("int")))
    units = (dealt.select("*", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("_o"))
             .groupBy(*group, F.least("_blk", "_o").alias("_ua"), F.greatest("_blk", "_o").alias("_ub"))
             .agg(F.array_sort(F.collect_list(F.struct("annotator", "category", "_blk"))).alias("_r")))
    # two different blocks: only pairs across them, the others have units of their own
    ones = units.select(*group, "_ua", "_ub", "_r", F.posexplode("_r").alias("_i", "_a"))
    after = F.filter(F.slice("_r", F.col("_i") + 2, F.size("_r")),
                     lambda b: (F.col("_ua") == F.col("_ub")) | (b["_blk"] != F.col("_a._blk")))
    pairs = ones.select(*group, "_a", F.explode(after).alias("_b"))
    return pairs.select(*group, F.col("_a.annotator").alias("annotator_1"), F.col("_b.annotator").alias("annotator_2"),
                        F.col("_a.category").alias("c1"), F.col("_b.category").alias("c2"))


def cohen_pairwise(ratings: DataFrame, annotators: Sequence[str] | None = None,
                   min_items: int = 2) -> DataFrame:
    """AGG-20 Cohen kappa for every annotator pair (a < b) and feature, on aligned items.

    The raters of an item are paired block by block (``rater_pairs``) and counted map-side per annotator pair and
    pair of categories. Pairs with fewer than ``min_items`` aligned items, or with expected agreement 1, give a
    null kappa; a pair without a common item has a row too, for each feature of the table.
    """
    named = ratings.where(F.col("annotator").isNotNull())
    if annotators is not None:
        named = named.where(F.col("annotator").isin(*annotators))
    rated = one_rating(named).where(F.col("category").isNotNull())
    keys = ["feature", "annotator_1", "annotator_2"]
    # joint table: one row per (feature, pair, category of 1, category of 2) — small.
    joint = rater_pairs(rated, ["feature", "item_id"]).groupBy(*keys, "c1", "c2").agg(F.count(F.lit(1)).alias("c"))
    # both marginals in one pass: each cell counts for its category of 1 and for its category of 2
    none = F.lit(0).cast("long")
    sides = F.array(F.struct(F.col("c1").alias("category"), F.col("c").alias("m1"), none.alias("m2"),
                             F.when(F.col("c1") == F.col("c2"), F.col("c")).otherwise(none).alias("agree")),
                    F.struct(F.col("c2").alias("category"), none.alias("m1"), F.col("c").alias("m2"), none.alias("agree")))
    marginals = (joint.select(*keys, F.inline(sides)).groupBy(*keys, "category")
                 .agg(F.sum("m1").alias("m1"), F.sum("m2").alias("m2"), F.sum("agree").alias("agree")))
    sums = marginals.groupBy(*keys).agg(F.sum("m1").alias("n_items"), F.sum("agree").alias("agree"),
                                        F.sum(F.col("m1") * F.col("m2")).alias("_e"))
    # every (feature, pair) is a row of the result: the annotators of the table are paired like the raters of one item
    seen = checkpointed(ratings.select("feature", "annotator").distinct())
    names = seen.where(F.col("annotator").isNotNull())
    if annotators is not None:
        names = names.where(F.col("annotator").isin(*annotators))
    names = names.select(F.lit(0).alias("_g"), "annotator", F.lit("").alias("category")).distinct()
    features = seen.agg(F.collect_set("feature").alias("_features"))  # one row
    grid = (with_scalars(rater_pairs(names, ["_g"]).select("annotator_1", "annotator_2"), features)
            .select(F.explode("_features").alias("feature"), "annotator_1", "annotator_2"))
    res = grid.join(sums, keys, "left")
    n = F.col("n_items")
    p_o = F.col("agree") / n
    p_e = F.coalesce(F.col("_e"), F.lit(0)) / (n * n)
    kappa = F.when((n >= min_items) & (p_e < 1), (p_o - p_e) / (1 - p_e))
    return res.select(*keys, F.coalesce(n, F.lit(0)).alias("n_items"), kappa.alias("kappa"))


def annotator_means(pairwise: DataFrame, exclude_annotators: Sequence[str] = ()) -> DataFrame:
    """AGG-21 mean kappa per annotator over all its pairs and features, pairs with an
    excluded annotator left out; one null (NaN) kappa makes the mean null."""
    p = pairwise
    if exclude_annotators:
        p = p.where(~F.col("annotator_1").isin(*exclude_annotators) & ~F.col("annotator_2").isin(*exclude_annotators))
    both = p.select(F.inline(F.array(
        F.struct(F.col("annotator_1").alias("annotator"), F.col("kappa")),
        F.struct(F.col("annotator_2").alias("annotator"), F.col("kappa")))))
    agg = both.groupBy("annotator").agg(F.count(F.lit(1)).alias("_n"), F.count("kappa").alias("_k"),
                                        F.avg("kappa").alias("_m"))
    return agg.select("annotator", F.when(F.col("_n") == F.col("_k"), F.col("_m")).alias("mean_kappa"))


def disagreement_items(ratings: DataFrame) -> DataFrame:
    """AGG-17 items where some feature has more than one distinct category."""
    per = ratings.groupBy("item_id", "feature").agg(F.countDistinct("category").alias("_d"))
    return per.where(F.col("_d") > 1).groupBy("item_id").agg(F.count(F.lit(1)).alias("n_features"))
