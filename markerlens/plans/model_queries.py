"""Registered queries, sampling and models.

The split has an SQL oracle (its order key is integer arithmetic both engines share). Model
fits are iterative (L-BFGS), so their queries are checked on rows only, and their logic is
tested in ``tests/test_models.py``.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from markerlens.functions import text as T
from markerlens.operators import evaluate as V
from markerlens.operators import features as X
from markerlens.operators import models as M
from markerlens.operators.ordering import contiguous_index
from markerlens.plans import feature_queries as E
from markerlens.plans.registry import register
from markerlens.plans.search_queries import LEX_TERMS
from markerlens.plans.marker_queries import ACRONYMS, PROFANITY
from markerlens.operators import search as Q
from markerlens.session import checkpointed, stored, table

LANGS = ("en", "fr", "de", "es")
STRATA = ("quality", "toxic") + tuple(f"lang_{x}" for x in LANGS)
FLAG_COLS = tuple(f"{t}_bin" for t in T.TAGS) + ("text_length",)


def _order_key():
    # portable seeded order: integer arithmetic that the SQL oracle repeats exactly
    return F.pmod(F.pmod(F.col("doc_id"), F.lit(1000003)) * 7919 + M.SPLIT_SEED * 104729, F.lit(1000003))


def modelling_rows(spark, sf):
    """F10 stand-in: labelled documents with six 0/1 strata columns and marker flags."""
    lab = table(spark, sf, "labels").select("doc_id", "quality", "toxic")
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    tags = Q.rule_tags("text", LEX_TERMS, ACRONYMS, PROFANITY)
    return docs.join(lab, "doc_id", "inner").select(
        "doc_id", "text", "quality", "toxic",
        *[(F.col("lang") == x).cast("int").alias(f"lang_{x}") for x in LANGS],
        *[F.array_contains(tags, t).cast("double").alias(f"{t}_bin") for t in T.TAGS],
        F.length("text").cast("double").alias("text_length"))


def split_rows(spark, sf):
    return M.stratified_split(modelling_rows(spark, sf), STRATA, order_key=_order_key())


_SPLIT_ROWS_SQL = f"""r AS (
  SELECT d.doc_id, l.quality, l.toxic, {", ".join(f"CAST(d.lang = '{x}' AS INTEGER) AS lang_{x}" for x in LANGS)},
         (d.doc_id * 7919 + {M.SPLIT_SEED} * 104729) % 1000003 AS ok
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
pos AS (SELECT *, row_number() OVER (PARTITION BY {", ".join(STRATA)} ORDER BY ok, doc_id) - 1 AS p,
               count(*) OVER (PARTITION BY {", ".join(STRATA)}) AS n FROM r),
strata AS (SELECT DISTINCT {", ".join(STRATA)}, n FROM pos),
sp(split, split_order, pct) AS (VALUES ('train', 0, 60), ('dev', 1, 20), ('test', 2, 20)),
q0 AS (SELECT s.*, sp.split, sp.split_order, (s.n * sp.pct) // 100 AS base, (s.n * sp.pct) % 100 AS rem FROM strata s, sp),
q1 AS (SELECT *, n - sum(base) OVER (PARTITION BY {", ".join(STRATA)}) AS lft,
              row_number() OVER (PARTITION BY {", ".join(STRATA)} ORDER BY rem DESC, split_order) AS rk FROM q0),
q2 AS (SELECT *, base + CASE WHEN rk <= lft THEN 1 ELSE 0 END AS quota FROM q1),
q3 AS (SELECT *, sum(quota) OVER (PARTITION BY {", ".join(STRATA)} ORDER BY split_order ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upper FROM q2),
assigned AS (SELECT pos.doc_id, pos.quality, pos.toxic, {", ".join(f"pos.lang_{x}" for x in LANGS)},
                    arg_min(q3.split, q3.split_order) AS split
             FROM pos JOIN q3 ON {" AND ".join(f"pos.{c} = q3.{c}" for c in STRATA)} AND pos.p < q3.upper
             GROUP BY ALL)"""


@register("stratified_split", ("ML-8", "SNK-4", "DED-5"), sql=f"""
WITH {_SPLIT_ROWS_SQL}
SELECT doc_id, split FROM assigned""")
def stratified_split(spark, sf):
    return split_rows(spark, sf).select("doc_id", "split")


@register("split_shares", ("ML-9", "AGG-4", "FLT-16"), sql=f"""
WITH {_SPLIT_ROWS_SQL}
SELECT split, count(*) AS n, {", ".join(f"round(avg(CAST({c} AS DOUBLE)), 6) AS {c}_share" for c in STRATA)}
FROM assigned GROUP BY split""")
def split_shares(spark, sf):
    s = M.split_shares(split_rows(spark, sf), "split", STRATA)
    return s.select("split", "n", *[F.round(f"{c}_share", 6).alias(f"{c}_share") for c in STRATA])


# ---------------------------------------------------------------- model fits (rows-only checks)

def _blocks(spark, sf, rows, train, wanted=("base", "transfer", "cascaded")):
    """ML-4 the blocks of ``rows`` (doc_id, text, FLAG_COLS), fitted on ``train``: rows with standardised flags,
    TF-IDF vectors, weighted embeddings and tag shares; and the columns of each wanted variant."""
    # tables of max_features rows at most, read by the weights, by the block and by its size
    model = checkpointed(X.tfidf_fit(train))
    vocab_index = checkpointed(contiguous_index(model.select("term"), "term", "idx"))
    weights = X.tfidf_transform(rows, model.join(vocab_index, "term"), lists=True)
    flags = X.standardise_apply(rows, X.standardise_fit(train, FLAG_COLS), FLAG_COLS)
    base = ["terms", *FLAG_COLS]
    variants = {"base": base, "transfer": [*base, "embedding"], "cascaded": [*base, "embedding", *X.POS_CLASSES]}
    blocks = [flags, M.term_block(rows, weights, vocab_index)]
    if set(wanted) != {"base"}:
        vocab = stored(X.vocabulary(train, "doc_id"), "vocabulary")
        vecs = X.token_vectors(vocab, E.vectors_df(spark, sf, vocab), E.DIM)
        embedding = X.doc_embedding(rows, vocab, vecs, E.DIM, weights=weights)
        blocks += [embedding.select("doc_id", array_to_vector("embedding").alias("embedding", metadata=M.vector_size(E.DIM))),
                   X.tag_distribution_vector(rows, E.token_classes(vocab))]
    return blocks, {v: variants[v] for v in wanted}


def _features(spark, sf, *wanted):
    """Split rows with the vector of each wanted variant, fitted on the train split; without any, the base
    vector as ``features``."""
    rows = checkpointed(split_rows(spark, sf))
    blocks, variants = _blocks(spark, sf, rows, rows.where(F.col("split") == "train"), wanted or ("base",))
    out = M.assembled(blocks, variants).drop("text")
    # written once to the shared checkpoint folder: every fit and every scoring pass below
    # reads these rows instead of re-running the feature lineage
    return checkpointed(out if wanted else out.withColumnRenamed("base", "features"))


_FLAGS_SQL = f"""f AS (SELECT d.doc_id, {", ".join(E.flag_sql(t) for t in T.TAGS)}, CAST(length(d.text) AS DOUBLE) AS text_length,
             l.doc_id IS NOT NULL AS is_train FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
fit AS (SELECT {", ".join(f"avg({c}) AS {c}_m, stddev_pop({c}) AS {c}_s" for c in FLAG_COLS)} FROM f WHERE is_train),
flags AS (SELECT doc_id, {" + ".join(f"({c} - {c}_m) / (CASE WHEN {c}_s = 0 THEN 1.0 ELSE {c}_s END)" for c in FLAG_COLS)} AS v FROM f, fit)"""


@register("feature_variants", ("ML-4", "JN-12", "ML-1", "ML-3", "AGG-36", "AGG-38"), sql=f"""
WITH {E.TFIDF_SQL},
{E.EMB_SQL.replace(E.TRAIN_SQL + ",", "", 1)},
{_FLAGS_SQL},
terms_of AS (SELECT doc_id, count(*) AS k, sum(weight) AS v FROM tfidf GROUP BY doc_id),
tw AS (SELECT tfc.doc_id, tfc.token, tfc.tf * coalesce(tfidf.weight, 0.001::DOUBLE) AS c
       FROM tfc LEFT JOIN tfidf ON tfc.doc_id = tfidf.doc_id AND tfc.token = tfidf.term),
wsum AS (SELECT doc_id, sum(c) AS ws FROM tw GROUP BY doc_id),
emb AS (SELECT comp.doc_id, sum(tw.c * comp.x) / any_value(wsum.ws) AS v FROM comp JOIN tw ON comp.doc_id = tw.doc_id AND comp.token = tw.token
        JOIN wsum ON comp.doc_id = wsum.doc_id GROUP BY comp.doc_id),
shares AS (SELECT tfc.doc_id, sum(tf) FILTER (WHERE v.token IS NOT NULL) / sum(tf) AS v
           FROM tfc LEFT JOIN (SELECT token FROM vocab WHERE token_id >= 2) v ON tfc.token = v.token GROUP BY tfc.doc_id),
parts AS (SELECT d.doc_id, coalesce(t.k, 0) AS n_terms, coalesce(t.v, 0) + flags.v AS base, coalesce(emb.v, 0) AS emb, coalesce(shares.v, 0) AS shares,
                 (SELECT count(*) FROM model) + {len(FLAG_COLS)} AS width
          FROM documents d JOIN flags ON d.doc_id = flags.doc_id LEFT JOIN terms_of t ON d.doc_id = t.doc_id
          LEFT JOIN emb ON d.doc_id = emb.doc_id LEFT JOIN shares ON d.doc_id = shares.doc_id)
SELECT doc_id, 'base' AS variant, width AS n_features, n_terms, round(base, 4) AS total FROM parts
UNION ALL SELECT doc_id, 'transfer', width + {E.DIM}, n_terms, round(base + emb, 4) FROM parts
UNION ALL SELECT doc_id, 'cascaded', width + {E.DIM + len(X.POS_CLASSES)}, n_terms, round(base + emb + shares, 4) FROM parts""")
def feature_variants(spark, sf):
    """Each document's three vectors (fitted on the labelled documents): length, terms and sum of the entries."""
    tags = Q.rule_tags("text", LEX_TERMS, ACRONYMS, PROFANITY)
    docs = table(spark, sf, "documents").select(
        "doc_id", "text", *[F.array_contains(tags, t).cast("double").alias(f"{t}_bin") for t in T.TAGS], F.length("text").cast("double").alias("text_length"))
    docs = checkpointed(docs)
    train = docs.join(table(spark, sf, "labels").select("doc_id"), "doc_id")
    blocks, variants = _blocks(spark, sf, docs, train)
    rows = M.assembled(blocks, variants)
    names = list(variants)

    def digest(batches):
        # a vector is (type, size, indices, values), of a dense one the values alone count
        for batch in batches:
            cells = {c: batch.column(c) for c in ("terms", *names)}
            values = {c: pc.struct_field(v, "values") for c, v in cells.items()}
            n = {c: pc.list_value_length(v).to_numpy(zero_copy_only=False).astype(np.int64) for c, v in values.items()}
            owner = {c: np.repeat(np.arange(batch.num_rows), k) for c, k in n.items()}
            flat = {c: v.flatten().to_numpy(zero_copy_only=False) for c, v in values.items()}
            n_terms = np.bincount(owner["terms"][flat["terms"] != 0], minlength=batch.num_rows)
            for c in names:
                size = pc.coalesce(pc.struct_field(cells[c], "size").cast(pa.int64()), pa.array(n[c]))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([c] * batch.num_rows), size, pa.array(n_terms.astype(np.int64)),
                                                  pa.array(np.bincount(owner[c], flat[c], minlength=batch.num_rows))], names=["doc_id", "variant", "n_features", "n_terms", "total"])

    # rows carry the length and the sum of a vector; its entries are added inside the batch
    return rows.select("doc_id", "terms", *names).mapInArrow(digest, f"doc_id {dict(docs.dtypes)['doc_id']}, variant string, n_features long, n_terms long, total double") \
        .withColumn("total", F.round("total", 4))


def _fit_and_score(train, evalset, task, name, c_value=1.0, features="features"):
    w, n = M.fit_frame(M.balanced_weights(train.withColumn("label", F.col(task)), "label"), features, "weight", "label")
    lr = M.logreg(c_value, n, "label", features).fit(w)
    w.unpersist()
    return lr, M.score(lr, evalset.withColumn("label", F.col(task)), task, name, "label")


def _scores(feats, variants):
    train, dev = feats.where("split = 'train'"), feats.where("split = 'dev'")
    outs = M.side_by_side([lambda v=v, task=task: _fit_and_score(train, dev, task, f"logreg_{v}", features=v)[1]
                           for v in variants for task in ("quality", "toxic")])
    return reduce(lambda a, b: a.unionByName(b), outs)


@register("logreg_scores", ("ML-4", "ML-5", "ML-7", "AGG-31", "JN-12"))
def logreg_scores(spark, sf):
    return _scores(_features(spark, sf, "base"), ["base"])


@register("logreg_variant_scores", ("ML-4", "ML-5", "ML-7", "AGG-31", "JN-12"))
def logreg_variant_scores(spark, sf):
    """The variants with embeddings, and with embeddings and tag shares."""
    return _scores(_features(spark, sf, "transfer", "cascaded"), ["transfer", "cascaded"])


@register("grid_search", ("ML-6", "ML-8", "AGG-25"))
def grid_search(spark, sf):
    feats = _features(spark, sf).where("split = 'train'")
    folds = M.fold_ids(feats.select("doc_id", *STRATA), STRATA, k=5).select("doc_id", "fold")
    data = M.balanced_weights(feats.join(folds, "doc_id").withColumn("label", F.col("quality")), "label")
    cv = M.grid_search(data, "label", M.C_GRID, 5, "fold")
    rows = [(float(c), float(m)) for c, m in zip(M.C_GRID, cv.avgMetrics)]
    best = max(rows, key=lambda r: r[1])[0]
    return spark.createDataFrame([(c, m, c == best) for c, m in rows], "C double, cv_macro_f1 double, is_best boolean")


@register("self_training", ("ML-10", "SET-2", "ML-7"))
def self_training(spark, sf):
    feats = _features(spark, sf)
    train, dev, pool = (feats.where("split = 'train'"), feats.where("split = 'dev'"),
                        feats.where("split = 'test'"))
    out = []
    for task in ("quality", "toxic"):
        base, _ = _fit_and_score(train, dev, task, "base")
        pseudo = base.transform(M.balanced_weights(pool.withColumn("label", F.col(task)), "label").drop("weight")) \
            .select(*[c for c in pool.columns if c != task],
                    F.col("prediction").cast("int").alias(task))
        grown = train.unionByName(pseudo.select(*train.columns), allowMissingColumns=True)
        _, scored = _fit_and_score(grown, dev, task, "self_trained")
        out.append(scored)
    s = out[0].unionByName(out[1])
    return V.class_metrics(s, ("task", "model"))


@register("accumulation_test", ("ML-11", "ML-12", "WIN-9", "JN-4", "FN-25", "AGG-39", "SET-2"))
def accumulation_test(spark, sf):
    """For p in 5, 10, 15, 20 %: the most uncertain pool rows keep their gold label, the rest
    take the base model's label; refit on train + pool; macro F1 on dev."""
    feats = _features(spark, sf)
    train, dev, pool = (feats.where("split = 'train'"), feats.where("split = 'dev'"),
                        feats.where("split = 'test'"))
    task = "quality"
    base, _ = _fit_and_score(train, dev, task, "base")
    scored = M.score(base, pool.withColumn("label", F.col(task)), task, "base", "label")
    ranked = scored.select("doc_id", V.uncertainty("prob").alias("unc"), F.col("pred").alias("_model_label"))
    results = []
    for pct in (0.05, 0.10, 0.15, 0.20):
        top = M.top_fraction(ranked, [-F.col("unc")], pct)
        labelled = pool.join(top.select("doc_id", "top", "_model_label"), "doc_id") \
            .withColumn(task, F.when(F.col("top"), F.col(task)).otherwise(F.col("_model_label"))) \
            .drop("top", "_model_label")
        grown = train.unionByName(labelled.select(*train.columns))
        _, sc = _fit_and_score(grown, dev, task, f"accumulate_{int(pct * 100)}")
        results.append(sc)
    allsc = results[0]
    for r in results[1:]:
        allsc = allsc.unionByName(r)
    return V.class_metrics(allsc, ("task", "model"))
