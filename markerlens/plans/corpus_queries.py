"""Registered queries, pipeline A: corpus cleaning and statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from markerlens.functions import text as T
from markerlens.operators import corpus as C
from markerlens.plans import sqlbits as S
from markerlens.plans.registry import register
from markerlens.plans.standins import CORPUS_SQL, corpus
from markerlens.session import table


def r6(c):
    return F.round(c, 6)


_CLEAN_SQL = f"""WITH {CORPUS_SQL},
kept AS (
  SELECT text, label, min(doc_id) AS doc_id FROM corpus
  WHERE label IN (0, 1) AND {S.not_blank('text')} AND length(text) <= 560
    AND NOT contains(lower(text), 'reuters')
  GROUP BY text, label)"""


@register("clean_corpus", ("FLT-1", "FLT-2", "FLT-3", "FLT-4", "DED-1", "DED-5", "SNK-2"),
          sql=_CLEAN_SQL + """
SELECT CAST(row_number() OVER (ORDER BY doc_id) - 1 AS BIGINT) AS id, doc_id, text, label FROM kept""")
def clean_corpus(spark, sf):
    return C.clean_indexed(corpus(spark, sf)).select("id", "doc_id", "text", "label")


@register("clean_corpus_stats", ("FLT-1", "FLT-3", "DED-1", "FN-6", "FN-7", "AGG-1"),
          sql=_CLEAN_SQL + f"""
SELECT label, count(*) AS n_docs, CAST(sum({S.ws_count('text')}) AS BIGINT) AS n_tokens,
       CAST(sum(length(text)) AS BIGINT) AS n_chars
FROM kept GROUP BY label""")
def clean_corpus_stats(spark, sf):
    kept = C.clean(corpus(spark, sf))
    return kept.groupBy("label").agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.sum(T.whitespace_token_count("text")).cast("long").alias("n_tokens"),
        F.sum(T.char_length("text")).cast("long").alias("n_chars"))


@register("corpus_stats", ("FN-8", "FN-12", "AGG-8", "AGG-9"), sql=f"""
WITH docs AS (SELECT lang, {S.alpha_tokens('text')} AS tok, {S.sentence_count('text')} AS sent FROM documents),
toks AS (SELECT lang, unnest(tok) AS t FROM docs),
tt AS (SELECT lang, count(*) AS tokens, count(DISTINCT t) AS types, sum(length(t)) AS chars FROM toks GROUP BY lang),
dd AS (SELECT lang, count(*) AS articles, sum(sent) AS sentences FROM docs GROUP BY lang)
SELECT dd.lang, CAST(dd.articles AS BIGINT) AS articles, CAST(coalesce(tt.tokens, 0) AS BIGINT) AS tokens,
       CAST(coalesce(tt.types, 0) AS BIGINT) AS types, CAST(dd.sentences AS BIGINT) AS sentences,
       round(CASE WHEN coalesce(tt.tokens, 0) > 0 THEN tt.chars / tt.tokens ELSE 0 END, 6) AS avg_word_len,
       round(CASE WHEN dd.sentences > 0 THEN coalesce(tt.tokens, 0) / dd.sentences ELSE 0 END, 6) AS avg_sent_len,
       round(CASE WHEN dd.articles > 0 THEN coalesce(tt.tokens, 0) / dd.articles ELSE 0 END, 6) AS avg_article_len
FROM dd LEFT JOIN tt ON dd.lang IS NOT DISTINCT FROM tt.lang""")
def corpus_stats(spark, sf):
    st = C.stats(table(spark, sf, "documents"), "text", ["lang"])
    return st.select("lang", "articles", "tokens", "types", "sentences",
                     r6("avg_word_len").alias("avg_word_len"), r6("avg_sent_len").alias("avg_sent_len"),
                     r6("avg_article_len").alias("avg_article_len"))


@register("label_counts", ("AGG-1",), sql="""
SELECT quality AS label, count(*) AS n FROM labels GROUP BY quality""")
def label_counts(spark, sf):
    return C.value_counts(table(spark, sf, "labels").withColumnRenamed("quality", "label"), ["label"])


@register("group_sizes", ("AGG-6", "FN-17"), sql="""
SELECT quality, toxic, CASE WHEN quality = toxic THEN 'agree' ELSE 'differ' END AS pair_kind, count(*) AS n
FROM labels GROUP BY ALL""")
def group_sizes(spark, sf):
    lab = table(spark, sf, "labels").withColumn(
        "pair_kind", F.when(F.col("quality") == F.col("toxic"), "agree").otherwise("differ"))
    return C.value_counts(lab, ["quality", "toxic", "pair_kind"])


@register("null_counts", ("AGG-2",), sql="""
SELECT count(*) FILTER (WHERE text IS NULL) AS text_nulls, count(*) FILTER (WHERE lang IS NULL) AS lang_nulls,
       count(*) FILTER (WHERE source IS NULL) AS source_nulls FROM documents""")
def null_counts(spark, sf):
    return C.null_counts(table(spark, sf, "documents"), ["text", "lang", "source"])


@register("duplicate_count", ("AGG-3",), sql="""
SELECT CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_distinct, CAST(sum(n) AS BIGINT) - count(*) AS n_duplicates
FROM (SELECT text, count(*) AS n FROM documents GROUP BY text)""")
def duplicate_count(spark, sf):
    return C.duplicate_count(table(spark, sf, "documents"), "text")


@register("value_shares", ("AGG-4",), sql="""
SELECT lang, count(*) AS n, round(CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (), 6) AS share
FROM documents WHERE lang IS NOT NULL GROUP BY lang""")
def value_shares(spark, sf):
    vs = C.value_shares(table(spark, sf, "documents"), "lang")
    return vs.select("lang", "n", r6("share").alias("share"))


@register("describe_length", ("AGG-5", "FN-6"), sql="""
SELECT count(x) AS count, round(avg(x), 6) AS mean, round(stddev_samp(x), 6) AS std, CAST(min(x) AS BIGINT) AS min,
       round(quantile_cont(x, 0.25), 6) AS p25, round(quantile_cont(x, 0.5), 6) AS p50,
       round(quantile_cont(x, 0.75), 6) AS p75, CAST(max(x) AS BIGINT) AS max
FROM (SELECT length(text) AS x FROM documents)""")
def describe_length(spark, sf):
    d = C.describe(table(spark, sf, "documents").select(T.char_length("text").alias("x")), "x")
    return d.select("count", r6("mean").alias("mean"), r6("std").alias("std"), F.col("min").cast("long").alias("min"),
                    r6("p25").alias("p25"), r6("p50").alias("p50"), r6("p75").alias("p75"),
                    F.col("max").cast("long").alias("max"))


@register("length_histogram", ("AGG-7", "FN-6"), sql="""
WITH x AS (SELECT length(text) AS v FROM documents),
b AS (SELECT min(v) AS lo, max(v) AS hi FROM x),
binned AS (SELECT CAST(CASE WHEN hi = lo THEN 1 ELSE least(100, (100 * (v - lo)) // (hi - lo) + 1) END AS BIGINT) AS bin,
                  lo, hi FROM x, b)
SELECT bin, round(lo + (bin - 1) * (CAST(hi - lo AS DOUBLE) / 100), 6) AS bin_lo,
       round(lo + bin * (CAST(hi - lo AS DOUBLE) / 100), 6) AS bin_hi, count(*) AS n
FROM binned GROUP BY bin, lo, hi""")
def length_histogram(spark, sf):
    h = C.length_histogram(table(spark, sf, "documents").select(T.char_length("text").alias("n_chars")), "n_chars")
    return h.select("bin", r6("bin_lo").alias("bin_lo"), r6("bin_hi").alias("bin_hi"), "n")


@register("top_words", ("FN-8", "FN-10", "AGG-11"), sql=f"""
WITH docs AS (SELECT doc_id, {S.no_stops(S.alpha_tokens('text'))} AS tok FROM documents),
toks AS (SELECT doc_id, unnest(tok) AS token, unnest(range(len(tok))) AS pos FROM docs)
SELECT token, count(*) AS n FROM toks GROUP BY token
ORDER BY n DESC, min(doc_id * 100000000 + pos) LIMIT 20""")
def top_words(spark, sf):
    return C.top_words(table(spark, sf, "documents"), 20)


@register("top_bigrams", ("FN-8", "FN-10", "FN-11", "AGG-12", "DED-5"), sql=f"""
WITH docs AS (SELECT doc_id, {S.no_stops(S.alpha_tokens('text'))} AS tok FROM documents),
inner_pairs AS (SELECT doc_id, unnest(range(len(tok) - 1)) AS pos, unnest({S.bigrams('tok')}) AS bigram
                FROM docs WHERE len(tok) >= 2),
ends AS (SELECT doc_id, tok[1] AS first_tok, tok[len(tok)] AS last_tok, len(tok) - 1 AS lastpos,
                row_number() OVER (ORDER BY doc_id) AS i FROM docs WHERE len(tok) > 0),
border AS (SELECT a.doc_id, a.lastpos AS pos, a.last_tok || ' ' || b.first_tok AS bigram
           FROM ends a JOIN ends b ON b.i = a.i + 1),
pairs AS (SELECT * FROM inner_pairs UNION ALL SELECT * FROM border)
SELECT bigram, count(*) AS n FROM pairs GROUP BY bigram
ORDER BY n DESC, min(doc_id * 100000000 + pos) LIMIT 10""")
def top_bigrams(spark, sf):
    return C.top_bigrams(table(spark, sf, "documents"), 10)


@register("ttr_first_n", ("FN-8", "AGG-10"), sql=f"""
WITH docs AS (SELECT doc_id, {S.alpha_tokens('text')} AS tok FROM documents),
offs AS (SELECT tok, coalesce(sum(len(tok)) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
         FROM docs),
toks0 AS (SELECT before, unnest(range(len(tok))) AS pos, unnest(tok) AS token FROM offs),
toks AS (SELECT before + pos AS off, token FROM toks0),
total AS (SELECT count(*) AS n FROM toks),
sizes AS (SELECT v.n FROM (VALUES (1000), (10000), (50000)) v(n), total WHERE v.n <= total.n
          UNION SELECT n FROM total),
firsts AS (SELECT token, min(off) AS f FROM toks GROUP BY token)
SELECT CAST(s.n AS BIGINT) AS num_words, count(*) AS types, round(count(*) / s.n, 6) AS ttr
FROM sizes s JOIN firsts ON firsts.f < s.n GROUP BY s.n""")
def ttr_first_n(spark, sf):
    t = C.type_token_ratio(table(spark, sf, "documents"), (1000, 10000, 50000))
    return t.select("num_words", "types", r6("ttr").alias("ttr"))


@register("dedup_clean_key", ("FN-4", "DED-2"), sql=f"""
SELECT doc_id, lang FROM (
  SELECT doc_id, lang, row_number() OVER (PARTITION BY {S.clean_key('text')} ORDER BY doc_id) AS rn FROM documents)
WHERE rn = 1""")
def dedup_clean_key(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang", "text")
    return C.keep_first(docs, T.clean_key("text"), "doc_id").select("doc_id", "lang")


@register("dedup_before_url", ("FN-5", "DED-2"), sql=f"""
SELECT page_id, prefix_len FROM (
  SELECT page_id, length({S.before_url('html')}) AS prefix_len,
         row_number() OVER (PARTITION BY {S.before_url('html')} ORDER BY page_id) AS rn FROM pages)
WHERE rn = 1""")
def dedup_before_url(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", T.before_url("html").alias("_k"))
    return C.keep_first(pages, "_k", "page_id").select("page_id", F.length("_k").cast("long").alias("prefix_len"))


@register("label_conflicts", ("DED-1", "DED-4"), sql=f"""
WITH {CORPUS_SQL},
dedup AS (SELECT DISTINCT text, label FROM corpus WHERE label IN (0, 1))
SELECT length(text) AS text_len, count(DISTINCT label) AS n_labels, count(*) AS n_rows
FROM dedup GROUP BY text HAVING count(DISTINCT label) > 1""")
def label_conflicts(spark, sf):
    dedup = corpus(spark, sf).where(F.col("label").isin(0, 1)).select("text", "label").distinct()
    lc = C.label_conflicts(dedup)
    return lc.select(F.length("text").cast("long").alias("text_len"), "n_labels", "n_rows")


@register("first_n_per_source", ("SRC-5", "SET-1"), sql="""
WITH quotas AS (SELECT source, CASE WHEN CAST(substr(source, 4) AS INTEGER) % 2 = 0 THEN 2 ELSE 8 END AS quota
                FROM (SELECT DISTINCT source FROM documents)),
ranked AS (SELECT d.doc_id, d.source, q.quota, row_number() OVER (PARTITION BY d.source ORDER BY d.doc_id) AS rn
           FROM documents d JOIN quotas q ON d.source = q.source)
SELECT doc_id, source FROM ranked WHERE rn <= quota""")
def first_n_per_source(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "source")
    quotas = docs.select("source").distinct().select(
        "source", F.when(F.substring("source", 4, 10).cast("int") % 2 == 0, 2).otherwise(8).alias("quota"))
    return C.first_n_per_group(docs, "source", "doc_id", quotas).select("doc_id", "source")
