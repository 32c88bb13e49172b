"""Registered queries, search: SRCH-1 … SRCH-7, DED-3, JN-2, JN-5."""

from __future__ import annotations

from pyspark.sql import functions as F

from markerlens.functions import text as T
from markerlens.functions.lexicons import STANDIN_LEXICON
from markerlens.operators import markers as M
from markerlens.operators import search as Q
from markerlens.operators import spans as P
from markerlens.plans import sqlbits as S
from markerlens.plans.marker_queries import ACRONYMS, PROFANITY, SPANS_SQL, _inputs
from markerlens.plans.registry import register
from markerlens.session import table

LEX_TERMS = sorted({t for _, t in STANDIN_LEXICON})
ALL_TERMS = ("that", "this")
ANY_TERMS = ("worthless", "shall", "ought")
PHRASE = ("of", "the")


def _tagged(df):
    return df.withColumn("tags", Q.rule_tags("text", LEX_TERMS, ACRONYMS, PROFANITY))


def sources(spark, sf):
    ann = _tagged(table(spark, sf, "benchmark").select(F.col("item_id").alias("ordinal"), "text",
                                                       F.lit("").alias("label")))
    ai = _tagged(table(spark, sf, "conversations").where(F.col("role") == "assistant")
                 .select((F.col("conv_id") * 1000 + F.col("turn")).alias("ordinal"), "text", F.lit("").alias("label")))
    labels = table(spark, sf, "labels").select("doc_id", F.col("quality").cast("string").alias("label"))
    cor = _tagged(table(spark, sf, "documents").select(F.col("doc_id").alias("ordinal"), "text")
                  .join(labels.withColumnRenamed("doc_id", "ordinal"), "ordinal", "left"))
    return ann, ai, cor


def index(spark, sf):
    return Q.build_index(*sources(spark, sf))


def _exists(words: str, pred: str) -> str:
    return f"len(list_filter({words}, lambda t: {pred})) > 0"


_W = "regexp_extract_all(text, '[a-zA-Z]+')"
_CHECKS = {
    "all_caps": _exists(_W, f"length(t) >= 2 AND upper(t) = t AND NOT list_contains({S.str_list(ACRONYMS)}, t)"),
    "exclamation_marks": "contains(text, '!')",
    "hedging": _exists(_W, f"list_contains({S.str_list(LEX_TERMS)}, lower(t))"),
    "adjectives": _exists(_W, f"regexp_matches(lower(t), {S.q(Q.ADJECTIVE)})"),
    "unk": _exists(_W, f"list_contains({S.str_list([p.lower() for p in PROFANITY])}, lower(t))"),
}
_TAGS_SQL = "list_filter([" + ", ".join(f"CASE WHEN {_CHECKS[t]} THEN '{t}' END" for t in T.TAGS) + "], lambda x: x IS NOT NULL)"

DOCS_SQL = f"""src0 AS (
  SELECT 'annot_' || CAST(item_id AS VARCHAR) AS doc_id, text, 'annotated' AS source, 0 AS source_rank,
         item_id AS ordinal, '' AS doc_label FROM benchmark
  UNION ALL
  SELECT 'ai_' || CAST(conv_id * 1000 + turn AS VARCHAR), text, 'ai', 1, conv_id * 1000 + turn, '' FROM conversations
  WHERE role = 'assistant'
  UNION ALL
  SELECT 'corpus_' || CAST(d.doc_id AS VARCHAR), d.text, 'corpus', 2, d.doc_id, coalesce(CAST(l.quality AS VARCHAR), '')
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
src AS (SELECT doc_id, {S.strip_ws('text')} AS text, source, source_rank, ordinal, doc_label,
               {_TAGS_SQL} AS tags FROM src0),
docs AS (SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY CASE WHEN source = 'ai' THEN 'ai' ELSE 'main' END, {S.clean_key('text')}
                               ORDER BY source_rank, ordinal) AS rn
  FROM src WHERE length(text) > 0) WHERE rn = 1),
tok AS (SELECT doc_id, unnest(st) AS term, unnest(range(len(st))) AS pos FROM (SELECT doc_id, {S.search_tokens('text')} AS st FROM docs)),
post AS (SELECT term, doc_id, count(*) AS tf FROM tok GROUP BY ALL),
lens AS (SELECT doc_id, len({S.search_tokens('text')}) AS doc_len FROM docs),
stats AS (SELECT count(*) AS n_docs, avg(doc_len) AS avg_len FROM lens)"""


def _bm25_sql(tf: str, df: str) -> str:
    return (f"((ln(s.n_docs / ({df} + 1)) + 1) * ({tf} * CAST(2.2 AS DOUBLE))) / ({tf} + CAST(1.2 AS DOUBLE) * "
            f"(CAST(0.25 AS DOUBLE) + (CAST(0.75 AS DOUBLE) * l.doc_len) / s.avg_len))")


def _search_sql(terms, mode: str, where: str, limit: int = 50) -> str:
    tl = ", ".join(S.q(t) for t in terms)
    having = f"WHERE matched = {len(set(terms))}" if mode == "all" else ""
    return f"""WITH {DOCS_SQL},
hits AS (SELECT * FROM post WHERE term IN ({tl})),
dfs AS (SELECT term, count(*) AS df FROM hits GROUP BY term),
sc0 AS (SELECT h.doc_id, sum({_bm25_sql('h.tf', 'd.df')}) AS score, count(*) AS matched
        FROM hits h JOIN dfs d ON h.term = d.term JOIN lens l ON h.doc_id = l.doc_id, stats s GROUP BY h.doc_id),
sc AS (SELECT * FROM sc0 {having})
SELECT docs.doc_id, source, array_to_string(tags, ' ') AS tags, round(score, 6) AS score
FROM docs JOIN sc ON docs.doc_id = sc.doc_id WHERE {where}
ORDER BY sc.score DESC, source_rank, ordinal LIMIT {limit}"""


def _out(df):
    return df.select("doc_id", "source", F.array_join("tags", " ").alias("tags"), F.round("score", 6).alias("score"))


DOC_SPANS_SQL = f"""{DOCS_SQL},
{SPANS_SQL.replace('FROM documents', 'FROM docs')},
raw AS (SELECT doc_id, {", ".join(f"""array_to_string(list(to_json([text])[:-2] || ', ' || start || ', ' || "end" || ']' ORDER BY start)
          FILTER (WHERE feature = '{t}'), ', ') AS {t}_spans, list(text ORDER BY start) FILTER (WHERE feature = '{t}') AS {t}_words"""
                                  for t in T.TAGS)} FROM spans GROUP BY doc_id)"""
_RAW_JSON = " || ', ' || ".join(f"""'"{t}": [' || coalesce({t}_spans, '') || ']'""" for t in T.TAGS)


def index_with_raw_tags(spark, sf):
    docs = index(spark, sf).documents
    lex, acr, prof = _inputs(spark)
    return Q.with_raw_tags(docs, M.marker_spans(docs.select("doc_id", "text"), lex, acronyms=acr, profanity=prof))


@register("search_documents", ("SRCH-1", "DED-3", "FN-4", "FN-18", "FN-24", "JN-5", "SET-1"), sql=f"""
WITH {DOC_SPANS_SQL}
SELECT docs.doc_id, source, ordinal, array_to_string(tags, ' ') AS tags, doc_label, length(docs.text) AS n_chars,
       docs.text AS raw_text, '{{' || {_RAW_JSON} || '}}' AS raw_tags
FROM docs LEFT JOIN raw ON docs.doc_id = raw.doc_id""")
def search_documents(spark, sf):
    docs = index_with_raw_tags(spark, sf)
    return docs.select("doc_id", "source", "ordinal", F.array_join("tags", " ").alias("tags"), "doc_label",
                       F.length("text").cast("long").alias("n_chars"), "raw_text", P.raw_tags_json().alias("raw_tags"))


@register("postings", ("SRCH-2",), sql=f"""
WITH {DOCS_SQL}
SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf, CAST(max(tf) AS BIGINT) AS max_tf FROM post GROUP BY term""")
def postings(spark, sf):
    return index(spark, sf).terms.select("term", "df", "cf", "max_tf")


@register("bm25_all_terms", ("SRCH-3", "JN-10", "WIN-11", "FLT-9"),
          sql=_search_sql(ALL_TERMS, "all", "source IN ('annotated', 'corpus')"))
def bm25_all_terms(spark, sf):
    return _out(Q.search_index(index(spark, sf), list(ALL_TERMS), mode="all"))


@register("bm25_any_term", ("SRCH-7", "SRCH-3", "WIN-11"),
          sql=_search_sql(ANY_TERMS, "any", "source IN ('annotated', 'corpus')"))
def bm25_any_term(spark, sf):
    return _out(Q.search_index(index(spark, sf), list(ANY_TERMS), mode="any"))


@register("faceted_search", ("SRCH-5", "FLT-9", "FLT-10", "FLT-11"),
          sql=_search_sql(("the",), "all", "source IN ('annotated', 'corpus') AND list_has_all(tags, ['adjectives']) "
                                           "AND doc_label = '1'"))
def faceted_search(spark, sf):
    return _out(Q.search_index(index(spark, sf), ["the"], source="all", tags=["adjectives"], label="1"))


@register("faceted_search_annotated", ("SRCH-5", "FLT-9", "FLT-10"),
          sql=_search_sql(("the",), "all", "source = 'annotated' AND list_has_all(tags, ['hedging', 'adjectives'])"))
def faceted_search_annotated(spark, sf):
    return _out(Q.search_index(index(spark, sf), ["the"], source="annotated", tags=["hedging", "adjectives"]))


@register("match_all", ("SRCH-4", "WIN-11"), sql=f"""
WITH {DOCS_SQL}
SELECT doc_id, source, array_to_string(tags, ' ') AS tags, CAST(NULL AS DOUBLE) AS score
FROM docs WHERE source IN ('annotated', 'corpus') ORDER BY source_rank, ordinal LIMIT 50""")
def match_all(spark, sf):
    return _out(Q.search_index(index(spark, sf), []))


@register("phrase_search", ("SRCH-7",), sql=f"""
WITH {DOCS_SQL},
a AS (SELECT doc_id, pos FROM tok WHERE term = {S.q(PHRASE[0])}),
b AS (SELECT doc_id, pos - 1 AS pos FROM tok WHERE term = {S.q(PHRASE[1])}),
occ AS (SELECT a.doc_id, count(*) AS tf FROM a JOIN b ON a.doc_id = b.doc_id AND a.pos = b.pos GROUP BY a.doc_id),
nw AS (SELECT count(*) AS df FROM occ),
sc AS (SELECT o.doc_id, o.tf, {_bm25_sql('o.tf', 'nw.df')} AS score FROM occ o JOIN lens l ON o.doc_id = l.doc_id, stats s, nw)
SELECT docs.doc_id, source, tf, round(score, 6) AS score FROM docs JOIN sc ON docs.doc_id = sc.doc_id
WHERE source IN ('annotated', 'corpus') ORDER BY sc.score DESC, source_rank, ordinal LIMIT 50""")
def phrase_search(spark, sf):
    res = Q.search_phrase(index(spark, sf), list(PHRASE))
    return res.select("doc_id", "source", "tf", F.round("score", 6).alias("score"))


@register("two_panel_search", ("SRCH-6", "SRCH-3"), sql=f"""
WITH {DOCS_SQL},
hits AS (SELECT * FROM post WHERE term IN ('that')),
dfs AS (SELECT term, count(*) AS df FROM hits GROUP BY term),
sc AS (SELECT h.doc_id, sum({_bm25_sql('h.tf', 'd.df')}) AS score
       FROM hits h JOIN dfs d ON h.term = d.term JOIN lens l ON h.doc_id = l.doc_id, stats s GROUP BY h.doc_id),
main AS (SELECT 'main' AS panel, docs.doc_id, source, round(score, 6) AS score FROM docs JOIN sc ON docs.doc_id = sc.doc_id
         WHERE source IN ('annotated', 'corpus') ORDER BY sc.score DESC, source_rank, ordinal LIMIT 50),
ai AS (SELECT 'ai' AS panel, docs.doc_id, source, round(score, 6) AS score FROM docs JOIN sc ON docs.doc_id = sc.doc_id
       WHERE source = 'ai' ORDER BY sc.score DESC, source_rank, ordinal LIMIT 50)
SELECT * FROM main UNION ALL SELECT * FROM ai""")
def two_panel_search(spark, sf):
    res = Q.search_panels(index(spark, sf), ["that"])
    return res.select("panel", "doc_id", "source", F.round("score", 6).alias("score"))


@register("human_ai_pairing", ("JN-2", "SRCH-1"), sql=f"""
WITH {DOCS_SQL},
ai AS (SELECT lower({S.strip_ws('text')}) AS k, arg_max(doc_id, ordinal) AS ai_doc_id FROM docs
       WHERE source = 'ai' GROUP BY k)
SELECT d.doc_id, ai.ai_doc_id FROM docs d LEFT JOIN ai ON lower({S.strip_ws('d.text')}) = ai.k
WHERE d.source IN ('annotated', 'corpus')""")
def human_ai_pairing(spark, sf):
    docs = index(spark, sf).documents
    main = docs.where(F.col("source").isin("annotated", "corpus")).select("doc_id", "text")
    ai = docs.where(F.col("source") == "ai").select("doc_id", "text", "ordinal")
    return Q.pair_with_ai(main, ai).select("doc_id", "ai_doc_id")


@register("search_source_counts", ("SRCH-1", "AGG-1"), sql=f"""
WITH {DOCS_SQL}
SELECT source, count(*) AS n_docs FROM docs GROUP BY source""")
def search_source_counts(spark, sf):
    docs = index(spark, sf).documents
    return Q.source_counts(docs)
