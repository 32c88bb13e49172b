"""Corpus build, cleaning and statistics (pipeline A): FLT-1…5, DED-1…5, AGG-1…12, SRC-5.

Every function takes and returns DataFrames. Order-dependent operators take an explicit
order column (the reference relies on file order; here it is a column, e.g. ``doc_id``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from markerlens.functions import text as T
from markerlens.functions.lexicons import ENGLISH_STOPWORDS
from markerlens.operators.ordering import contiguous_index, exclusive_prefix_sum, with_scalars


# ---------------------------------------------------------------- cleaning (FLT-1…4, DED-1)

def clean(df: DataFrame, text: str = "text", label: str = "label", order: str = "doc_id",
          max_chars: int = 560, labels: Sequence[int] = (0, 1),
          exclude_terms: Sequence[str] = ("reuters",)) -> DataFrame:
    """Filters of the cleaning step, then full-row dedup on (text, label) keeping the first row.

    The filters are row-local and come first so that the dedup shuffle carries fewer rows;
    the dedup is an aggregate (map-side partial ``min``), not a window.
    """
    cond = F.col(label).isin(*labels) & ~T.is_blank(text) & (T.char_length(text) <= max_chars)
    for term in exclude_terms:
        cond = cond & ~F.lower(F.col(text)).contains(term.lower())
    return (df.where(cond)
            .groupBy(text, label)
            .agg(F.min(order).alias(order)))


def clean_indexed(df: DataFrame, order: str = "doc_id", **kw) -> DataFrame:
    """SNK-2 shape: cleaned rows with a contiguous ``id`` 0..n-1 in first-occurrence order."""
    return contiguous_index(clean(df, order=order, **kw), order, "id")


def label_conflicts(df: DataFrame, text: str = "text", label: str = "label") -> DataFrame:
    """DED-4 texts that survive DED-1 with more than one label."""
    return (df.groupBy(text).agg(F.countDistinct(label).alias("n_labels"),
                                 F.count(F.lit(1)).alias("n_rows"))
            .where(F.col("n_labels") > 1))


def keep_first(df: DataFrame, key: Column | str | Sequence, order: str | Sequence[str],
               name: str = "_key") -> DataFrame:
    """DED-2 keyed dedup keeping the first row in ``order`` (never ``dropDuplicates(subset)``)."""
    keys = [key] if isinstance(key, (str, Column)) else list(key)
    key_cols = [F.col(k) if isinstance(k, str) else k for k in keys]
    orders = [order] if isinstance(order, str) else list(order)
    w = Window.partitionBy(*key_cols).orderBy(*[F.col(o) for o in orders])
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def first_n_per_group(df: DataFrame, group: str, order: str, quotas: DataFrame,
                      quota_col: str = "quota") -> DataFrame:
    """SRC-5 first ``quota`` rows per group in ``order``; groups without a quota are dropped.

    The largest quota, read from the table, bounds the row number, which lets Spark limit the groups
    before the shuffle: a hot group ships at most that many rows per map partition.
    """
    w = Window.partitionBy(group).orderBy(order)
    most = quotas.agg(F.max(quota_col)).first()[0] or 0
    ranked = df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= most)
    return (ranked.join(quotas, group, "inner")
            .where(F.col("_rn") <= F.col(quota_col)).drop("_rn", quota_col))


# ---------------------------------------------------------------- counts (AGG-1…7)

def value_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """AGG-1/6 rows per value combination."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))


def value_shares(df: DataFrame, col: str) -> DataFrame:
    """AGG-4 share of each non-null value: counts per value over a one-row total (broadcast),
    so no window gathers the value table into one task."""
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("_total"))
    return with_scalars(counts, total).select(col, "n", (F.col("n") / F.col("_total")).alias("share"))


def null_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """AGG-2 one row, a null count per column."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in cols])


def duplicate_count(df: DataFrame, col: str = "text") -> DataFrame:
    """AGG-3 rows minus distinct values; a null counts as one value (pandas ``duplicated``).

    Pre-aggregates per value (partial hash aggregate), so the shuffle carries one row per
    value and map partition, not one per input row.
    """
    per_value = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return per_value.agg(F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_distinct")) \
        .select("n_rows", "n_distinct", (F.col("n_rows") - F.col("n_distinct")).alias("n_duplicates"))


def describe(df: DataFrame, col: str) -> DataFrame:
    """AGG-5 count, mean, sample std, min, quartiles (linear interpolation), max.

    Exact quartiles without gathering the column into one task: values are counted per
    distinct value (partial aggregate), a two-level prefix sum over the distinct values gives
    cumulative counts, and those locate the order statistics k and k + 1.
    """
    x = F.col(col)
    moments = df.agg(F.count(x).alias("count"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"),
                     F.min(x).alias("min"), F.max(x).alias("max"))
    per_value = df.where(x.isNotNull()).groupBy(x.alias("v")).agg(F.count(F.lit(1)).alias("c"))
    # cumulative counts over the distinct values, two-level (no one-partition window)
    cum = exclusive_prefix_sum(per_value, "v", "c", "lo").withColumn("hi", F.col("lo") + F.col("c"))
    cum = with_scalars(cum, moments.select(F.col("count").alias("_n")))
    exprs, finals = [], []
    for p, name in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75")):
        pos = (F.col("_n") - 1) * F.lit(p)
        k = F.floor(pos)
        exprs += [F.max(F.when((F.col("lo") <= k) & (k < F.col("hi")), F.col("v"))).alias(f"_a_{name}"),
                  F.max(F.when((F.col("lo") <= k + 1) & (k + 1 < F.col("hi")), F.col("v"))).alias(f"_b_{name}"),
                  F.first(pos - k).alias(f"_f_{name}")]
        a, b, f = F.col(f"_a_{name}"), F.col(f"_b_{name}"), F.col(f"_f_{name}")
        finals.append((a + (F.coalesce(b, a) - a) * f).cast("double").alias(name))
    quart = cum.agg(*exprs).select(*finals)
    return with_scalars(moments, quart).select("count", "mean", "std", "min", "p25", "p50", "p75", "max")


def length_histogram(df: DataFrame, col: str = "n_chars", bins: int = 100) -> DataFrame:
    """AGG-7 equal-width histogram from min to max; the maximum falls in the last bin.

    Bin = (bins * (x - min)) div (max - min) + 1 in integer arithmetic, folded into ``bins``.
    """
    bounds = df.agg(F.min(col).alias("_lo"), F.max(col).alias("_hi"))
    x = with_scalars(df.where(F.col(col).isNotNull()).select(col), bounds)
    b = F.when(F.col("_hi") == F.col("_lo"), F.lit(1)).otherwise(
        F.least(F.lit(bins).cast("long"), F.expr(f"({bins} * ({col} - _lo)) div (_hi - _lo)") + 1))
    counted = x.groupBy(b.alias("bin"), "_lo", "_hi").agg(F.count(F.lit(1)).alias("n"))
    width = (F.col("_hi") - F.col("_lo")).cast("double") / bins
    return counted.select(F.col("bin").cast("long").alias("bin"),
                          (F.col("_lo") + (F.col("bin") - 1) * width).alias("bin_lo"),
                          (F.col("_lo") + F.col("bin") * width).alias("bin_hi"), "n")


# ---------------------------------------------------------------- tokens and statistics

def stats(df: DataFrame, text: str = "text", group_cols: Sequence[str] = ()) -> DataFrame:
    """AGG-8 articles, tokens, types, sentences and average lengths, zero-safe.

    Tokens are ``[a-z]+`` (FN-8). Types need a distinct count over exploded tokens: the
    tokens are pre-aggregated per (group, token) with a partial hash aggregate, and the
    document-level sums travel in the same union, so no join and no multi-column DISTINCT.
    """
    g = list(group_cols)
    docs = df.select(*g, T.alpha_tokens(text).alias("_tok"), T.sentence_count(text).alias("_sent"))
    per_token = (docs.select(*g, F.explode("_tok").alias("_t"))
                 .groupBy(*g, "_t").agg(F.count(F.lit(1)).alias("_c"))
                 .select(*g, F.lit(1).alias("_type"), F.col("_c").alias("_tokens"),
                         (F.length("_t") * F.col("_c")).alias("_chars"),
                         F.lit(0).alias("_article"), F.lit(0).alias("_sents")))
    per_doc = docs.select(*g, F.lit(0).alias("_type"), F.lit(0).cast("long").alias("_tokens"),
                          F.lit(0).cast("long").alias("_chars"), F.lit(1).alias("_article"),
                          F.col("_sent").alias("_sents"))
    u = per_token.unionByName(per_doc)
    agg = (u.groupBy(*g) if g else u.groupBy()).agg(
        F.sum("_article").cast("long").alias("articles"), F.sum("_tokens").cast("long").alias("tokens"),
        F.sum("_type").cast("long").alias("types"), F.sum("_sents").cast("long").alias("sentences"),
        F.sum("_chars").cast("long").alias("chars"))

    def ratio(a, b):
        return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))

    return agg.select(*g, "articles", "tokens", "types", "sentences",
                      ratio("chars", "tokens").alias("avg_word_len"),
                      ratio("tokens", "sentences").alias("avg_sent_len"),
                      ratio("tokens", "articles").alias("avg_article_len"))


def occurrence_key(order: str, pos: str = "pos") -> Column:
    """(order, pos) of a token: comparable for ids of any type and size and texts of any length."""
    return F.struct(F.col(order).alias("order"), F.col(pos).alias("pos"))


def token_stream(df: DataFrame, text: str = "text", order: str = "doc_id",
                 stopwords: Sequence[str] | None = ENGLISH_STOPWORDS) -> DataFrame:
    """One row per token: (order, pos, token), ``[a-z]+`` tokens, optional stop-word removal."""
    toks = T.alpha_tokens(text)
    if stopwords:
        toks = T.remove_stopwords(toks, stopwords)
    return df.select(order, F.posexplode(toks).alias("pos", "token"))


def top_words(df: DataFrame, k: int = 20, text: str = "text", order: str = "doc_id",
              stopwords: Sequence[str] | None = ENGLISH_STOPWORDS) -> DataFrame:
    """AGG-11 the ``k`` most frequent tokens; ties by first occurrence in (order, pos)."""
    counted = (token_stream(df, text, order, stopwords).groupBy("token")
               .agg(F.count(F.lit(1)).alias("n"), F.min(occurrence_key(order)).alias("_first")))
    return counted.orderBy(F.desc("n"), F.asc("_first")).limit(k).select("token", "n")


def type_token_ratio(df: DataFrame, sizes: Sequence[int] = (1000, 10000, 50000),
                     text: str = "text", order: str = "doc_id") -> DataFrame:
    """AGG-10 TTR of the first N tokens of the document stream, for each N, and of all tokens.

    A token is a type within the first N tokens when its first occurrence has a global offset
    below N. The first occurrence per token is the least (doc, position); only those first occurrences (one row per distinct token) join the per-document
    prefix sums (two-level, one row per document) to get the global offset.
    Sizes larger than the stream are skipped.
    """
    spark = df.sparkSession
    counts = df.select(order, F.regexp_count(F.lower(F.col(text)), F.lit(T.ALPHA_TOKEN)).alias("_n"))
    offs = exclusive_prefix_sum(counts, order, "_n", "_before")
    first = (df.select(order, F.posexplode(T.alpha_tokens(text)).alias("pos", "token"))
             .groupBy("token").agg(F.min(occurrence_key(order)).alias("_k")))
    located = first.select("token", F.col("_k.order").alias(order), F.col("_k.pos").alias("_pos"))
    typed0 = located.join(offs.select(order, "_before"), order) \
        .select((F.col("_before") + F.col("_pos")).alias("_first"))
    total = offs.agg(F.sum("_n").alias("_total"))
    size_tab = spark.createDataFrame([(int(n),) for n in sizes], "n long")
    wanted = with_scalars(size_tab, total).where(F.col("n") <= F.col("_total")).select("n")
    sized = wanted.unionByName(total.select(F.col("_total").cast("long").alias("n"))).distinct()
    typed = typed0.join(F.broadcast(sized), F.col("_first") < F.col("n"), "inner")
    return (typed.groupBy("n").agg(F.count(F.lit(1)).alias("types"))
            .select(F.col("n").alias("num_words"), "types", (F.col("types") / F.col("n")).alias("ttr")))


def top_bigrams(df: DataFrame, k: int = 10, text: str = "text", order: str = "doc_id",
                stopwords: Sequence[str] | None = ENGLISH_STOPWORDS,
                cross_document: bool = True) -> DataFrame:
    """AGG-12 the ``k`` most frequent bigrams of the stop-word-free token stream.

    In-document pairs come from FN-11. With ``cross_document`` the stream runs on from one
    text into the next (as the concatenated stream does): the last token of each non-empty
    document pairs with the first token of the next non-empty one, found by numbering the
    non-empty documents (DED-5) and an equi-join on ``idx + 1``. Ties by first occurrence.
    """
    toks = T.alpha_tokens(text)
    if stopwords:
        toks = T.remove_stopwords(toks, stopwords)
    docs = df.select(order, toks.alias("_tok"))
    inner = (docs.select(order, F.posexplode(T.ngrams("_tok", 2)).alias("pos", "bigram")))
    pairs = inner
    if cross_document:
        ends = docs.where(F.size("_tok") > 0).select(
            order, F.element_at("_tok", 1).alias("_first"), F.element_at("_tok", -1).alias("_last"),
            (F.size("_tok") - 1).alias("_lastpos"))
        idx = contiguous_index(ends, order, "_i")
        nxt = idx.select((F.col("_i") - 1).alias("_i"), F.col("_first").alias("_next_first"))
        border = (idx.join(nxt, "_i").select(
            order, F.col("_lastpos").alias("pos"),
            F.concat_ws(" ", "_last", "_next_first").alias("bigram")))
        pairs = inner.unionByName(border)
    counted = pairs.groupBy("bigram").agg(F.count(F.lit(1)).alias("n"),
                                          F.min(occurrence_key(order)).alias("_first"))
    return counted.orderBy(F.desc("n"), F.asc("_first")).limit(k).select("bigram", "n")
