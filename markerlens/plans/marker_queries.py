"""Registered queries, markers: MRK-1…6, FN-15, FN-18, FN-30, AGG-22/23."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from markerlens.functions.lexicons import STANDIN_LEXICON
from markerlens.functions.text import TAGS
from markerlens.operators import lexicon_match as L
from markerlens.operators import markers as M
from markerlens.operators import spans as P
from markerlens.plans import sqlbits as S
from markerlens.plans.registry import register
from markerlens.session import ensure_checkpoint_dir, stored, table
from markerlens.sources import readers as R

# Stand-in word lists (parameters of the marker rules; the data is the documents table).
ACRONYMS = ("USA", "UK", "EU", "UN", "NATO", "FBI", "CEO", "TV", "IT")
PROFANITY = ("damn", "crap", "worthless")
# Words and phrases with overlaps, and word beginnings, for the lexicon queries.
PHRASE_TERMS = ("the", "of the", "the the", "the of", "and the", "worthless")
ROOT_TERMS = ("thor", "worth", "ha", "onin")
# Letter runs, runs of "!" and the rest cover a text end to end.
PIECE = "[a-zA-Z]+|!+|[^a-zA-Z!]+"


def _inputs(spark):
    lex = spark.createDataFrame(list(STANDIN_LEXICON), "category string, term string")
    acr = spark.createDataFrame([(a,) for a in ACRONYMS], "term string")
    prof = spark.createDataFrame([(p,) for p in PROFANITY], "term string")
    return lex, acr, prof


def spans_df(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    lex, acr, prof = _inputs(spark)
    return M.marker_spans(docs, lex, acronyms=acr, profanity=prof)


def counts_df(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return M.marker_counts(docs, spans_df(spark, sf))


_TERMS = S.str_list(sorted({t for _, t in STANDIN_LEXICON}))
SPANS_SQL = f"""d AS (SELECT doc_id, text, regexp_extract_all(text, {S.q(PIECE)}) AS p FROM documents),
pc AS (SELECT doc_id, unnest(p) AS piece, unnest(range(len(p))) AS pos FROM d),
po AS (SELECT doc_id, pos, piece, CAST(coalesce(sum(length(piece)) OVER (PARTITION BY doc_id ORDER BY pos
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS INTEGER) AS start FROM pc),
sp AS (SELECT doc_id, pos, piece, start, CAST(start + length(piece) AS INTEGER) AS "end",
              regexp_matches(piece, '^[a-zA-Z]+$') AS is_word FROM po),
spans AS (
  SELECT doc_id, 'exclamation_marks' AS feature, piece AS text, start, "end" FROM sp WHERE regexp_matches(piece, '^!+$')
  UNION ALL
  SELECT doc_id, 'all_caps', piece, start, "end" FROM sp
  WHERE is_word AND length(piece) >= 2 AND upper(piece) = piece AND NOT list_contains({S.str_list(ACRONYMS)}, piece)
  UNION ALL
  SELECT doc_id, 'adjectives', piece, start, "end" FROM sp WHERE is_word AND regexp_matches(lower(piece), {S.q(M.ADJECTIVE)})
  UNION ALL
  SELECT doc_id, 'hedging', piece, start, "end" FROM sp WHERE is_word AND list_contains({_TERMS}, lower(piece))
  UNION ALL
  SELECT doc_id, 'unk', piece, start, "end" FROM sp WHERE is_word AND list_contains({S.str_list(PROFANITY)}, lower(piece)))"""

_COUNT_COLS = ",\n       ".join(
    f"count(s.feature) FILTER (WHERE s.feature = '{t}') AS n_{t}" for t in TAGS)
COUNTS_SQL = f"""{SPANS_SQL},
cnt AS (
  SELECT d.doc_id, length(d.text) AS n_chars,
       {_COUNT_COLS}
  FROM d LEFT JOIN spans s ON d.doc_id = s.doc_id GROUP BY d.doc_id, d.text)"""


@register("marker_spans", ("MRK-1", "MRK-2", "MRK-3", "MRK-4", "MRK-5"), sql=f"""
WITH {SPANS_SQL}
SELECT doc_id, feature, text, start, "end" FROM spans""")
def marker_spans(spark, sf):
    return spans_df(spark, sf).select("doc_id", "feature", "text", "start", "end")


_DENS = ",\n       ".join(
    f"n_{t}, round(CASE WHEN n_chars > 0 THEN n_{t} / n_chars ELSE 0 END, 6) AS density_{t}" for t in TAGS)


@register("marker_density", ("MRK-1", "MRK-2", "MRK-3", "MRK-4", "MRK-5", "MRK-6"), sql=f"""
WITH {COUNTS_SQL}
SELECT doc_id, n_chars,
       {_DENS}
FROM cnt""")
def marker_density(spark, sf):
    c = counts_df(spark, sf)
    cols = ["doc_id", F.col("n_chars").cast("long").alias("n_chars")]
    for t in TAGS:
        cols += [f"n_{t}", F.round(f"density_{t}", 6).alias(f"density_{t}")]
    return c.select(*cols)


_FLAGS = ", ".join(f"CAST(n_{t} > 0 AS INTEGER) AS {t}_bin" for t in TAGS)
_PRESENT = " || ".join(f"(CASE WHEN n_{t} > 0 THEN ' {t}' ELSE '' END)" for t in TAGS)


@register("marker_flags", ("FN-15", "FN-18"), sql=f"""
WITH {COUNTS_SQL}
SELECT doc_id, {_FLAGS}, ltrim({_PRESENT}) AS tags FROM cnt""")
def marker_flags(spark, sf):
    fl = M.marker_flags(counts_df(spark, sf))
    return fl.select("doc_id", *[f"{t}_bin" for t in TAGS], F.array_join("tags", " ").alias("tags"))


_TAG_VALUES = ", ".join(f"('{t}', {i})" for i, t in enumerate(TAGS))


@register("tag_distribution", ("AGG-22", "AGG-23", "FN-18"), sql=f"""
WITH {COUNTS_SQL},
per_tag AS (
  {" UNION ALL ".join(f"SELECT '{t}' AS tag, count(*) FILTER (WHERE n_{t} > 0) AS n FROM cnt" for t in TAGS)}),
all_tags(tag, tag_order) AS (VALUES {_TAG_VALUES}),
dist AS (SELECT a.tag, a.tag_order, CAST(coalesce(p.n, 0) AS BIGINT) AS n FROM all_tags a LEFT JOIN per_tag p ON a.tag = p.tag)
SELECT tag, tag_order, n, round(n / greatest(max(n) OVER (), 1) * 100, 6) AS share_of_max FROM dist""")
def tag_distribution(spark, sf):
    td = M.tag_distribution(M.marker_flags(counts_df(spark, sf)))
    return td.select("tag", "tag_order", "n", F.round("share_of_max", 6).alias("share_of_max"))


def tag_list_sql(tags: str) -> str:
    """The distinct features of a group as words in the fixed tag order."""
    return f"array_to_string(list_filter({S.str_list(TAGS)}, lambda t: list_contains(list(DISTINCT {tags}), t)), ' ')"


def sweep_sql(grouped: str, by: str = '"end"') -> str:
    """Kept rows (doc_id, start, "end", tags) of the CTE ``grouped``: a fold over each document's sorted spans."""
    return f"""SELECT doc_id, x.s AS start, x.e AS "end", x.t AS tags FROM (
  SELECT doc_id, unnest(list_reduce(l, lambda acc, x: CASE WHEN x.k[1].s >= acc.e
           THEN {{'e': x.e, 'k': list_concat(acc.k, x.k)}} ELSE acc END).k) AS x
  FROM (SELECT doc_id, list({{'e': "end", 'k': [{{'s': start, 'e': "end", 't': tags}}]}} ORDER BY start, {by}) AS l
        FROM {grouped} GROUP BY doc_id))"""


@register("resolve_spans", ("FN-30", "MRK-1", "MRK-4"), sql=f"""
WITH {SPANS_SQL},
grouped AS (SELECT doc_id, start, "end", {tag_list_sql('feature')} AS tags FROM spans GROUP BY doc_id, start, "end")
{sweep_sql('grouped')}""")
def resolve_spans(spark, sf):
    kept = M.resolve_spans(spans_df(spark, sf))
    return kept.select("doc_id", "start", "end", F.array_join("tags", " ").alias("tags"))


def _highlight_sql(active: tuple[str, ...]) -> str:
    return f"""
WITH {SPANS_SQL},
words AS (SELECT doc_id, text AS word, feature FROM spans WHERE list_contains({S.str_list(active)}, feature) GROUP BY ALL),
gaps AS (SELECT w.doc_id, w.word, unnest(list_transform(l[:-2], lambda g: length(g))) AS gap, unnest(range(len(l) - 1)) AS i
         FROM (SELECT DISTINCT x.doc_id, word, string_split(d.text, word) AS l FROM words x JOIN documents d ON x.doc_id = d.doc_id) w),
hit AS (SELECT doc_id, word, CAST(sum(gap) OVER (PARTITION BY doc_id, word ORDER BY i ROWS UNBOUNDED PRECEDING) + i * length(word) AS INTEGER) AS start
        FROM gaps),
grouped AS (SELECT h.doc_id, h.start, CAST(h.start + length(h.word) AS INTEGER) AS "end", {tag_list_sql('w.feature')} AS tags
            FROM hit h JOIN words w ON h.doc_id = w.doc_id AND h.word = w.word GROUP BY h.doc_id, h.start, h.word),
kept AS ({sweep_sql('grouped')})
SELECT doc_id, start, "end", tags,
       CASE WHEN starts_with(tags, 'all_caps ') THEN string_split(tags, ' ')[2] ELSE string_split(tags, ' ')[1] END AS style_tag,
       starts_with(tags, 'all_caps ') AS with_capitals FROM kept"""


def _highlights(spark, sf, active=()):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    own = P.raw_tags(spans_df(spark, sf)).select("doc_id", P.tag_words().alias("tag_words"))
    out = P.highlights(docs.join(own, "doc_id"), active=active)
    return out.select("doc_id", "start", "end", F.array_join("tags", " ").alias("tags"), "style_tag", "with_capitals")


@register("highlight_spans", ("FN-30", "FN-19"), sql=_highlight_sql(TAGS))
def highlight_spans(spark, sf):
    """Each document's own tag words, wherever they stand in its text, without overlaps."""
    return _highlights(spark, sf)


ACTIVE = ("all_caps", "adjectives")


@register("highlight_active_tags", ("FN-30",), sql=_highlight_sql(ACTIVE))
def highlight_active_tags(spark, sf):
    return _highlights(spark, sf, ACTIVE)


def _phrase_sql(term: str) -> str:
    words = term.split(" ")
    joins = "".join(f" JOIN sp s{k} ON s{k}.doc_id = w0.doc_id AND s{k}.pos = w0.pos + {2 * k - 1} AND s{k}.piece = ' '"
                    f" JOIN sp w{k} ON w{k}.doc_id = w0.doc_id AND w{k}.pos = w0.pos + {2 * k} AND lower(w{k}.piece) = {S.q(w)}"
                    for k, w in enumerate(words) if k)
    return f'SELECT w0.doc_id, w0.start, w{len(words) - 1}."end" FROM sp w0{joins} WHERE lower(w0.piece) = {S.q(words[0])}'


@register("marker_phrases", ("MRK-3",), sql=f"""
WITH {SPANS_SQL},
found AS ({" UNION ".join(_phrase_sql(t) for t in PHRASE_TERMS)}),
grouped AS (SELECT *, '' AS tags FROM found),
kept AS ({sweep_sql('grouped', '"end" DESC')})
SELECT k.doc_id, substr(d.text, k.start + 1, k."end" - k.start) AS text, k.start, k."end" FROM kept k JOIN documents d ON k.doc_id = d.doc_id""")
def marker_phrases(spark, sf):
    """Words and phrases of a list; of overlapping ones the leftmost longest."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    terms = spark.createDataFrame([(t,) for t in PHRASE_TERMS], "term string")
    return L.lexicon_spans(docs, terms, "hedging").select("doc_id", "text", "start", "end")


@register("marker_roots", ("MRK-3", "MRK-5"), sql=f"""
WITH {SPANS_SQL}
SELECT doc_id, piece AS text, start, "end" FROM sp
WHERE is_word AND ({" OR ".join(f"starts_with(lower(piece), '{t}')" for t in ROOT_TERMS)})""")
def marker_roots(spark, sf):
    """Words that begin with a term of a list."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    terms = spark.createDataFrame([(t,) for t in ROOT_TERMS], "term string")
    return L.lexicon_spans(docs, terms, "hedging", match="root").select("doc_id", "text", "start", "end")


_ROUND_TRIP_TAGS = "UNION ALL".join(f"""
SELECT a.annotator, d.doc_id AS item_id, '{t}' AS feature,
       coalesce((SELECT string_agg(text || '@' || start || '-' || "end", ' ' ORDER BY start) FROM spans s
                 WHERE s.doc_id = d.doc_id AND s.feature = '{t}' AND (a.annotator = 'rules' OR s.start < 200)), '') AS spans
FROM documents d, (VALUES ('rules'), ('beginnings')) a(annotator)
""" for t in TAGS)


@register("annotation_round_trip", ("SRC-8", "SNK-3", "AGG-14", "FN-2", "SRC-13"), sql=f"""
WITH {SPANS_SQL}
{_ROUND_TRIP_TAGS}""")
def annotation_round_trip(spark, sf):
    """Two annotators' spans of every document (all rule spans, and those of its beginning), written as annotation files and read as ratings."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    spans = stored(spans_df(spark, sf), "spans")  # both annotators take theirs from it
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/annotations-{uuid.uuid4().hex}"
    for annotator, own in (("rules", spans), ("beginnings", spans.where(F.col("start") < 200))):
        tagged = docs.join(P.raw_tags(own), "doc_id", "left").withColumn("raw_tags", F.coalesce("raw_tags", P.no_raw_tags()))
        arrays = [F.transform(F.col("raw_tags")[t], lambda s: F.array(s["text"], s["start"].cast("string"), s["end"].cast("string"))).alias(t) for t in TAGS]
        tagged.select(F.col("doc_id").alias("ID"), F.col("text").alias("Text"), *arrays).write.json(f"{folder}/{annotator}_annotations_cleaned.json")
    long = R.read_annotators(spark, f"{folder}/*_annotations_cleaned.json", lines=True)
    shown = F.array_join(F.transform("spans", lambda s: F.concat(s["text"], F.lit("@"), s["start"].cast("string"), F.lit("-"), s["end"].cast("string"))), " ")
    return long.select("annotator", "item_id", "feature", shown.alias("spans"))
