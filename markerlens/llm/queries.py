"""The queries opN_<name> and pipeline, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from markerlens.llm import (bottomk_dedup, bwt_dedup, debruijn_dedup, decontaminate, jaccard_join, jd_whitening, lattice_lm,
                            orchard_codes, packing, quality, token_counts, toxicity, warc_revisits)
from markerlens.llm.common import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_toxicity(spark, sf_dir):
    return toxicity.toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@query
def op2_decontaminate(spark, sf_dir):
    return decontaminate.leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


@query
def op3_token_counts(spark, sf_dir):
    return token_counts.token_counts(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op4_best_fit_packing(spark, sf_dir):
    return packing.best_fit_packing(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op5_byte_dedup(spark, sf_dir):
    return bwt_dedup.byte_dedup(read_table(spark, sf_dir, "documents")).drop("kept")


@query
def op6_substring_dedup(spark, sf_dir):
    out = debruijn_dedup.substring_dedup(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", "kept_sha256")


@query
def op7_warc_revisits(spark, sf_dir):
    return warc_revisits.resolved_pages(read_table(spark, sf_dir, "pages"))


ORACLE["op7_warc_revisits"] = warc_revisits.RESOLVED_PAGES_SQL.strip()


@query
def op8_jaccard_join(spark, sf_dir):
    return jaccard_join.jaccard_join(read_table(spark, sf_dir, "documents"))


@query
def op9_quality_rules(spark, sf_dir):
    return quality.quality_rules(read_table(spark, sf_dir, "documents"))


@query
def op10_lattice_lm(spark, sf_dir):
    return lattice_lm.lm_scores(read_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op11_bottomk_near_dedup(spark, sf_dir):
    return bottomk_dedup.near_duplicates(read_table(spark, sf_dir, "documents"))


@query
def op12_jd_whitening(spark, sf_dir):
    return jd_whitening.whiten(read_table(spark, sf_dir, "embeddings"))


@query
def op13_orchard_codes(spark, sf_dir):
    return orchard_codes.compress(read_table(spark, sf_dir, "embeddings"))


@query
def pipeline(spark, sf_dir):
    return corpus_pipeline.run(spark, sf_dir)
