"""Registered queries, features."""

from __future__ import annotations

from pyspark.sql import functions as F

from markerlens.functions import text as T
from markerlens.functions.lexicons import STANDIN_LEXICON
from markerlens.operators import features as X
from markerlens.operators import search as Q
from markerlens.plans import sqlbits as S
from markerlens.plans.marker_queries import ACRONYMS, PROFANITY
from markerlens.plans.registry import register
from markerlens.session import stored, table

DIM = 64


def r6(c):
    return F.round(c, 6)


def train_rows(spark, sf):
    """Training rows: the labelled documents, in doc_id order."""
    lab = table(spark, sf, "labels").select("doc_id", "quality", "toxic")
    return table(spark, sf, "documents").select("doc_id", "text").join(lab, "doc_id", "inner")


def vocab_df(spark, sf):
    return X.vocabulary(train_rows(spark, sf), "doc_id")


def vectors_df(spark, sf, vocab):
    """Stand-in vector file: the token of rank r (= token_id − 2) takes the vector of row
    r mod (number of vectors) of `embeddings`."""
    emb = table(spark, sf, "embeddings").select("vec_id", "embedding")
    n = emb.agg(F.count(F.lit(1)).alias("_nv"))
    from markerlens.operators.ordering import with_scalars
    ranked = with_scalars(vocab.where(F.col("token_id") >= 2), n).select(
        "token", ((F.col("token_id") - 2) % F.col("_nv")).alias("vec_id"))
    return ranked.join(emb, "vec_id").select("token", F.col("embedding").alias("vector"))


TRAIN_SQL = "tr AS (SELECT d.doc_id, d.text FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"
VOCAB_SQL = f"""{TRAIN_SQL},
tk AS (SELECT doc_id, unnest(t) AS token, unnest(range(len(t))) AS pos FROM (SELECT doc_id, {S.word_tokens('text')} AS t FROM tr)),
firsts AS (SELECT token, min(doc_id * 16777216 + pos) AS f FROM tk GROUP BY token),
vocab AS (SELECT token, CAST(row_number() OVER (ORDER BY f) + 1 AS BIGINT) AS token_id FROM firsts
          UNION ALL SELECT '<PAD>', 0 UNION ALL SELECT '<OOV>', 1)"""


@register("vocabulary", ("WIN-7", "FN-9", "DED-5"), sql=f"""
WITH {VOCAB_SQL}
SELECT token, token_id FROM vocab""")
def vocabulary(spark, sf):
    return vocab_df(spark, sf)


@register("encode_sequences", ("FN-29", "WIN-7", "JN-7"), sql=f"""
WITH {VOCAB_SQL},
dt AS (SELECT doc_id, unnest(t) AS token, unnest(range(len(t))) AS pos FROM (SELECT doc_id, {S.word_tokens('text')} AS t FROM documents)),
ids AS (SELECT dt.doc_id, dt.pos, coalesce(v.token_id, 1) AS id FROM dt LEFT JOIN vocab v ON dt.token = v.token),
agg AS (SELECT doc_id, count(*) AS n_tokens, count(*) FILTER (WHERE id = 1) AS n_oov, CAST(sum(id) AS BIGINT) AS id_sum,
               arg_min(id, pos) AS first_id, arg_max(id, pos) AS last_id FROM ids GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_tokens, 0) AS n_tokens, coalesce(n_oov, 0) AS n_oov, coalesce(id_sum, 0) AS id_sum,
       first_id, last_id
FROM documents d LEFT JOIN agg ON d.doc_id = agg.doc_id""")
def encode_sequences(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    enc = X.encode(docs, vocab_df(spark, sf))
    ids = F.col("ids")
    return enc.select("doc_id", F.size(ids).cast("long").alias("n_tokens"),
                      F.size(F.filter(ids, lambda i: i == X.OOV_ID)).cast("long").alias("n_oov"),
                      F.aggregate(ids, F.lit(0).cast("long"), lambda a, b: a + b).alias("id_sum"),
                      F.element_at(ids, 1).alias("first_id"), F.element_at(ids, -1).alias("last_id"))


_TOKS_SQL = f"regexp_extract_all({S.fold_accents('lower(text)')}, {S.q(T.WORD_TOKEN)})"
TFIDF_SQL = f"""{TRAIN_SQL},
tt AS (SELECT doc_id, {_TOKS_SQL} AS t FROM tr),
terms AS (SELECT doc_id, unnest(list_concat(t, {S.bigrams('t')})) AS term FROM tt),
tf AS (SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY ALL),
st AS (SELECT term, count(*) AS df, sum(tf) AS cf FROM tf GROUP BY term),
n AS (SELECT count(*) AS n FROM tr),
model AS (SELECT term, df, ln((1 + n.n) / (1 + df)) + 1 AS idf FROM
          (SELECT * FROM st WHERE df >= 2 ORDER BY cf DESC, term LIMIT 10000), n),
all_tf AS (SELECT doc_id, term, count(*) AS tf FROM (
             SELECT doc_id, unnest(list_concat(t, {S.bigrams('t')})) AS term FROM (SELECT doc_id, {_TOKS_SQL} AS t FROM documents))
           GROUP BY ALL),
w0 AS (SELECT tf.doc_id, tf.term, (1 + ln(tf.tf)) * m.idf AS w FROM all_tf tf JOIN model m ON tf.term = m.term),
tfidf AS (SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM w0)"""


def all_rows(spark, sf):
    """Every document: the model of the training rows is applied to all."""
    return table(spark, sf, "documents").select("doc_id", "text")


def _tfidf(spark, sf):
    model = X.tfidf_fit(train_rows(spark, sf))
    return model, X.tfidf_transform(all_rows(spark, sf), model)


@register("tfidf_vocabulary", ("ML-1", "AGG-32", "FLT-15", "FN-32", "FN-11"), sql=f"""
WITH {TFIDF_SQL}
SELECT term, df, round(idf, 6) AS idf FROM model""")
def tfidf_vocabulary(spark, sf):
    model, _ = _tfidf(spark, sf)
    return model.select("term", "df", r6("idf").alias("idf"))


@register("tfidf", ("ML-1", "AGG-32", "FN-32"), sql=f"""
WITH {TFIDF_SQL}
SELECT doc_id, term, round(weight, 6) AS weight FROM tfidf""")
def tfidf(spark, sf):
    _, w = _tfidf(spark, sf)
    return w.select("doc_id", "term", r6("weight").alias("weight"))


_LEX = sorted({t for _, t in STANDIN_LEXICON})
FEATS = ("all_caps_bin", "exclamation_marks_bin", "hedging_bin", "adjectives_bin", "unk_bin", "text_length")


def flag_sql(t: str) -> str:
    from markerlens.plans.search_queries import _CHECKS
    return f"CAST(CASE WHEN {_CHECKS[t]} THEN 1 ELSE 0 END AS DOUBLE) AS {t}_bin"


@register("standardise", ("ML-2", "ML-3", "AGG-33", "FN-15"), sql=f"""
WITH {TRAIN_SQL},
f AS (SELECT d.doc_id, {", ".join(flag_sql(t) for t in T.TAGS)}, CAST(length(d.text) AS DOUBLE) AS text_length,
             l.doc_id IS NOT NULL AS is_train
      FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
fit AS (SELECT {", ".join(f"avg({c}) AS {c}_m, stddev_pop({c}) AS {c}_s" for c in FEATS)} FROM f WHERE is_train)
SELECT doc_id, {", ".join(f"round(({c} - {c}_m) / (CASE WHEN {c}_s = 0 THEN 1.0 ELSE {c}_s END), 6) AS {c}" for c in FEATS)}
FROM f, fit""")
def standardise(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    lab = table(spark, sf, "labels").select("doc_id", F.lit(True).alias("is_train"))
    tags = Q.rule_tags("text", _LEX, ACRONYMS, PROFANITY)
    f = docs.join(lab, "doc_id", "left").select(
        "doc_id", F.coalesce("is_train", F.lit(False)).alias("is_train"),
        *[F.array_contains(tags, t).cast("double").alias(f"{t}_bin") for t in T.TAGS],
        F.length("text").cast("double").alias("text_length"))
    f = X.marker_features(f, list(FEATS))
    fit = X.standardise_fit(f.where("is_train"), FEATS)
    out = X.standardise_apply(f, fit, FEATS)
    return out.select("doc_id", *[r6(c).alias(c) for c in FEATS])


EMB_SQL = f"""{VOCAB_SQL},
nv AS (SELECT count(*) AS nv FROM embeddings),
vec AS (SELECT v.token_id, e.embedding FROM vocab v, nv JOIN embeddings e ON e.vec_id = (v.token_id - 2) % nv.nv
        WHERE v.token_id >= 2),
dtok AS (SELECT doc_id, unnest({S.word_tokens('text')}) AS token FROM documents),
tfc AS (SELECT doc_id, token, count(*) AS tf FROM dtok GROUP BY ALL),
tv AS (SELECT t.doc_id, t.token, t.tf, coalesce(v.token_id, 1) AS token_id FROM tfc t LEFT JOIN vocab v ON t.token = v.token),
comp AS (SELECT tv.doc_id, tv.token, tv.tf, unnest(range(64)) AS dim, unnest(CAST(vec.embedding AS DOUBLE[])) AS x
         FROM tv JOIN vec ON tv.token_id = vec.token_id)"""


def _emb(spark, sf, weighted: bool):
    docs = all_rows(spark, sf)
    vocab = stored(vocab_df(spark, sf), "vocabulary")
    vecs = X.token_vectors(vocab, vectors_df(spark, sf, vocab), DIM)
    weights = X.tfidf_transform(docs, X.tfidf_fit(train_rows(spark, sf)), lists=True) if weighted else None
    e = X.doc_embedding(docs, vocab, vecs, DIM, weights=weights)
    return e.select("doc_id", F.posexplode("embedding").alias("dim", "value")) \
        .select("doc_id", F.col("dim").cast("long").alias("dim"), r6("value").alias("value"))


@register("doc_embedding_mean", ("AGG-35", "JN-7", "WIN-7"), sql=f"""
WITH {EMB_SQL},
ntok AS (SELECT doc_id, sum(tf) AS n FROM tfc GROUP BY doc_id),
s AS (SELECT doc_id, dim, sum(tf * x) AS sx FROM comp GROUP BY doc_id, dim),
grid AS (SELECT doc_id, unnest(range(64)) AS dim FROM documents)
SELECT g.doc_id, CAST(g.dim AS BIGINT) AS dim, round(coalesce(s.sx / ntok.n, 0), 6) AS value
FROM grid g LEFT JOIN ntok ON g.doc_id = ntok.doc_id LEFT JOIN s ON g.doc_id = s.doc_id AND g.dim = s.dim""")
def doc_embedding_mean(spark, sf):
    return _emb(spark, sf, False)


@register("doc_embedding_weighted", ("AGG-36", "JN-7", "JN-8", "ML-1"), sql=f"""
WITH {TFIDF_SQL},
{EMB_SQL.replace(TRAIN_SQL + ",", "", 1)},
tw AS (SELECT tfc.doc_id, tfc.token, tfc.tf * coalesce(tfidf.weight, 0.001::DOUBLE) AS c
       FROM tfc LEFT JOIN tfidf ON tfc.doc_id = tfidf.doc_id AND tfc.token = tfidf.term),
wsum AS (SELECT doc_id, sum(c) AS ws FROM tw GROUP BY doc_id),
s AS (SELECT comp.doc_id, comp.dim, sum(tw.c * comp.x) AS sx FROM comp JOIN tw ON comp.doc_id = tw.doc_id AND comp.token = tw.token
      GROUP BY comp.doc_id, comp.dim),
grid AS (SELECT doc_id, unnest(range(64)) AS dim FROM documents)
SELECT g.doc_id, CAST(g.dim AS BIGINT) AS dim, round(coalesce(s.sx / wsum.ws, 0), 6) AS value
FROM grid g LEFT JOIN wsum ON g.doc_id = wsum.doc_id LEFT JOIN s ON g.doc_id = s.doc_id AND g.dim = s.dim""")
def doc_embedding_weighted(spark, sf):
    return _emb(spark, sf, True)


@register("vocab_coverage", ("AGG-37", "JN-7"), sql=f"""
WITH {VOCAB_SQL}
SELECT CAST(count(*) FILTER (WHERE token_id >= 2) AS BIGINT) AS n_found, count(*) AS vocab_size,
       round(100.0 * count(*) FILTER (WHERE token_id >= 2) / count(*), 6) AS coverage_pct FROM vocab""")
def vocab_coverage(spark, sf):
    vocab = vocab_df(spark, sf)
    vecs = X.token_vectors(vocab, vectors_df(spark, sf, vocab), DIM)
    c = X.vocab_coverage(vecs)
    return c.select("n_found", "vocab_size", r6("coverage_pct").alias("coverage_pct"))


@register("vector_std", ("AGG-34",), sql="""
SELECT round(stddev_pop(x), 6) AS std, count(*) AS n_components FROM (SELECT unnest(embedding) AS x FROM embeddings)""")
def vector_std(spark, sf):
    emb = table(spark, sf, "embeddings").select(F.col("embedding").alias("vector"))
    ex = emb.select(F.explode("vector").alias("_x"))
    return ex.agg(r6(F.stddev_pop("_x")).alias("std"), F.count(F.lit(1)).alias("n_components"))


# Stand-in token classes (the tagger's output as a table): a suffix and word-list rule over the
# vocabulary tokens.
CLASS_WORDS = {
    "DET": ("the", "a", "an", "this", "that", "le", "la", "les", "der", "die", "das", "el", "los"),
    "ADP": ("of", "in", "on", "to", "for", "with", "by", "at", "de", "en", "von", "mit", "con", "por"),
    "CCONJ": ("and", "or", "but", "et", "und", "oder", "y", "o"),
    "PRON": ("it", "he", "she", "they", "we", "i", "you", "il", "elle", "er", "sie", "es", "yo"),
    "AUX": ("is", "are", "was", "were", "be", "been", "est", "ist", "sind", "es"),
}


def _class_expr(tok):
    e = F.when(tok.rlike("^[0-9]+$"), "NUM")
    for cls, words in CLASS_WORDS.items():
        e = e.when(tok.isin(list(words)), cls)
    return (e.when(tok.rlike("ly$"), "ADV").when(tok.rlike("(ing|ed)$"), "VERB")
            .when(tok.rlike("(ful|less|ible|able|ous)$"), "ADJ").when(tok.rlike("(tion|ment|ness)$"), "NOUN")
            .otherwise("X"))


def token_classes(vocab):
    """(token, class, token_id) of the vocabulary's words."""
    return vocab.where(F.col("token_id") >= 2).select("token", _class_expr(F.col("token")).alias("class"), "token_id")


def _class_sql(tok: str) -> str:
    parts = [f"WHEN regexp_matches({tok}, '^[0-9]+$') THEN 'NUM'"]
    for cls, words in CLASS_WORDS.items():
        parts.append(f"WHEN list_contains({S.str_list(words)}, {tok}) THEN '{cls}'")
    parts += [f"WHEN regexp_matches({tok}, 'ly$') THEN 'ADV'", f"WHEN regexp_matches({tok}, '(ing|ed)$') THEN 'VERB'",
              f"WHEN regexp_matches({tok}, '(ful|less|ible|able|ous)$') THEN 'ADJ'",
              f"WHEN regexp_matches({tok}, '(tion|ment|ness)$') THEN 'NOUN'"]
    return "CASE " + " ".join(parts) + " ELSE 'X' END"


_SHARES = ", ".join(
    f"round(CASE WHEN n > 0 THEN count(*) FILTER (WHERE cls = '{c}') / n ELSE 0 END, 6) AS {c}" for c in X.POS_CLASSES)


@register("tag_distribution_vector", ("AGG-38",), sql=f"""
WITH {VOCAB_SQL},
dtok AS (SELECT doc_id, unnest({S.word_tokens('text')}) AS token FROM documents),
cls AS (SELECT dtok.doc_id, CASE WHEN v.token IS NULL THEN NULL ELSE {_class_sql('v.token')} END AS cls
        FROM dtok LEFT JOIN (SELECT token FROM vocab WHERE token_id >= 2) v ON dtok.token = v.token),
n AS (SELECT doc_id, count(*) AS n FROM dtok GROUP BY doc_id)
SELECT d.doc_id, {_SHARES.replace("ELSE 0 END", "ELSE 0.0 END")}
FROM documents d LEFT JOIN cls ON d.doc_id = cls.doc_id LEFT JOIN n ON d.doc_id = n.doc_id GROUP BY d.doc_id, n.n""")
def tag_distribution_vector(spark, sf):
    d = X.tag_distribution_vector(all_rows(spark, sf), token_classes(stored(vocab_df(spark, sf), "vocabulary")))
    return d.select("doc_id", *[r6(c).alias(c) for c in X.POS_CLASSES])


# ---- ML-13: the labelled documents are the first training set; unlabelled documents with marker tags as span strings are the extra
# annotated rows, whose labels come from another table (two of three have one); assistant turns are the generated rows. Every
# tenth generated row repeats the id of a document, as a set that was generated from training rows would.
EXTRA_ANNOTATOR, TRAIN_ANNOTATORS = "rater_3", ("rater_0", "rater_1", "rater_2", "rater_3")


def _training_parts(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    lab = table(spark, sf, "labels").select("doc_id", "quality", "toxic")
    ident = F.col("doc_id").cast("string").alias("id")
    base = docs.join(lab, "doc_id").select(ident, "text", "lang", F.col("quality").cast("int").alias("quality"), F.col("toxic").cast("int").alias("toxic"),
                                           F.concat(F.lit("rater_"), (F.col("doc_id") % 3).cast("string")).alias("annotator"))
    base = base.withColumns({a: (F.col("annotator") == a).cast("int") for a in TRAIN_ANNOTATORS} | {"split": F.lit("train")})
    spans = lambda c, name: F.when(c, F.lit(f"[{name}]")).otherwise(F.lit("[]")).alias(name)
    extra = docs.join(lab.select("doc_id"), "doc_id", "left_anti").select(
        ident, "text", F.lit(9).alias("quality"), F.lit(9).alias("toxic"),
        spans(F.col("text").contains("!"), "exclamation_marks"), spans(F.col("text").rlike("[0-9]"), "unk"))
    found = docs.where(F.col("doc_id") % 3 != 0).select(ident, (F.length("text") % 2).cast("int").alias("quality"),
                                                        (F.length("text") % 5 == 0).cast("int").alias("toxic"))
    turns = table(spark, sf, "conversations").where(F.col("role") == "assistant")
    made = F.concat_ws("/", F.lit("c"), F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    llm = turns.select(F.when(F.col("conv_id") % 10 == 0, F.col("conv_id").cast("string")).otherwise(made).alias("id"), "text",
                       (F.col("conv_id") % 2).cast("int").alias("quality"), F.lit(0).alias("toxic"))
    return base, extra, found, llm


@register("augmented_train", ("ML-13", "JN-3", "SET-2", "FN-15", "FN-16"), sql=f"""
WITH base AS (
  SELECT CAST(d.doc_id AS VARCHAR) AS id, d.text, d.lang, CAST(l.quality AS INTEGER) AS quality, CAST(l.toxic AS INTEGER) AS toxic,
         'rater_' || CAST(d.doc_id % 3 AS VARCHAR) AS annotator, NULL::VARCHAR AS exclamation_marks, NULL::VARCHAR AS unk,
         NULL::INTEGER AS exclamation_marks_bin, NULL::INTEGER AS unk_bin, 'train' AS split, 'original' AS provenance
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
extra AS (
  SELECT CAST(d.doc_id AS VARCHAR) AS id, d.text, NULL AS lang,
         CASE WHEN doc_id % 3 <> 0 THEN CAST(length(text) % 2 AS INTEGER) END AS quality,
         CASE WHEN doc_id % 3 <> 0 THEN CAST(length(text) % 5 = 0 AS INTEGER) END AS toxic, 'rater_3' AS annotator,
         CASE WHEN contains(text, '!') THEN '[exclamation_marks]' ELSE '[]' END AS exclamation_marks,
         CASE WHEN regexp_matches(text, '[0-9]') THEN '[unk]' ELSE '[]' END AS unk,
         CAST(coalesce(contains(text, '!'), FALSE) AS INTEGER), CAST(coalesce(regexp_matches(text, '[0-9]'), FALSE) AS INTEGER), 'train', 'annotated'
  FROM documents d WHERE doc_id NOT IN (SELECT doc_id FROM labels)),
llm AS (
  SELECT CASE WHEN conv_id % 10 = 0 THEN CAST(conv_id AS VARCHAR) ELSE 'c/' || conv_id || '/' || turn END AS id, text, NULL,
         CAST(conv_id % 2 AS INTEGER), 0, NULL, NULL, NULL, NULL, NULL, NULL, 'generated'
  FROM conversations WHERE role = 'assistant'),
kept AS (
  SELECT * FROM base
  UNION ALL SELECT * FROM extra WHERE id NOT IN (SELECT id FROM base)
  UNION ALL SELECT * FROM llm WHERE id NOT IN (SELECT id FROM base) AND id NOT IN (SELECT id FROM extra))
SELECT *, {", ".join(f"CAST(annotator = '{a}' AS INTEGER) AS {a}" for a in TRAIN_ANNOTATORS)} FROM kept""")
def augmented_train(spark, sf):
    base, extra, found, llm = _training_parts(spark, sf)
    extra = X.binarised(extra, ("exclamation_marks", "unk"), EXTRA_ANNOTATOR, TRAIN_ANNOTATORS)
    extra = X.replace_labels(extra, found, ("quality", "toxic"))
    return X.augmented_train([("original", base), ("annotated", extra), ("generated", llm)])
