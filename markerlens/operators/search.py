"""Faceted, BM25-ranked keyword search as Spark jobs (pipeline C): SRCH-1 … SRCH-7, DED-3,
FN-18, FN-24, FLT-9 … FLT-11, JN-2, JN-5, JN-10, WIN-11.

The index is written once, as four Parquet tables under one path (``write_index``, ``open_index``): ``documents`` (a row
per searchable document, with its source, tags, label, insertion order and length in tokens), ``postings`` (term, doc_id,
tf, positions, doc_len) and ``terms`` (term, df, cf, max_tf), both in folders by the hash of the term and sorted by term,
and ``stats`` (one row). A search reads the folders of its terms, sums the BM25 parts per document, joins the facet
columns of the documents, and ``orderBy(...).limit(k)`` becomes a top-k (TakeOrderedAndProject). No search reads a text.
"""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Sequence
from functools import reduce
from operator import and_, or_
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from markerlens.functions import text as T
from markerlens.operators.markers import ADJECTIVE, ADJECTIVE_RUN, CAPS_RUN  # noqa: F401
from markerlens.operators.ordering import with_scalars
from markerlens.operators.spans import no_raw_tags, raw_tags, tag_words
from markerlens.session import shared_path

# BM25F parameters of the search library's default scorer.
K1 = 1.2
B = 0.75
# Insertion order of the sources in the index: annotated, AI, corpus.
SOURCE_RANK = {"annotated": 0, "ai": 1, "corpus": 2}
MAIN_SOURCES = ("annotated", "corpus")


# Word lists up to this length are searched for by one expression.
SEARCHED_WORDS = 200


def _holds_word(text: str, words: Sequence[str]) -> Column:
    """Whether a maximal ASCII letter run of the text is one of ``words`` (lower case), without regard to case."""
    words = list(dict.fromkeys(w for w in words if re.fullmatch("[a-z]+", w)))
    if not words:
        return F.lit(False)
    if len(words) > SEARCHED_WORDS:
        return F.exists(F.regexp_extract_all(F.col(text), F.lit("[a-zA-Z]+"), 0), lambda t: F.lower(t).isin(words))
    initials = "".join(sorted({w[0] + w[0].upper() for w in words}))
    return F.col(text).rlike(f"(?=[{initials}])(?<![a-zA-Z])(?i:{'|'.join(words)})(?![a-zA-Z])")


def rule_tags(text: str, lexicon: Sequence[str], acronyms: Sequence[str] = (),
              profanity: Sequence[str] = ()) -> Column:
    """FN-18 present tags, in fixed tag order, from the marker rules (MRK-1…5) as existence tests on the text:
    a search ends at the first word that a rule takes, and no word list is made."""
    prof = [p.lower() for p in profanity]
    acr = [a for a in acronyms if re.fullmatch("[A-Z]{2,}", a)]
    caps = CAPS_RUN.replace("[A-Z]{2,}+", f"(?!(?:{'|'.join(acr)})(?![a-zA-Z]))[A-Z]{{2,}}+") if acr else CAPS_RUN
    checks = {
        "all_caps": F.col(text).rlike(caps),
        "exclamation_marks": F.col(text).contains("!"),
        "hedging": _holds_word(text, [w.lower() for w in lexicon]),
        "adjectives": F.col(text).rlike(ADJECTIVE_RUN),
        "unk": _holds_word(text, prof),
    }
    return F.filter(F.array(*[F.when(checks[t], F.lit(t)) for t in T.TAGS]), lambda x: x.isNotNull())


def build_documents(annotated: DataFrame, ai: DataFrame, corpus: DataFrame) -> DataFrame:
    """SRCH-1 the document table from three sources.

    Each input has (ordinal BIGINT, text, label STRING, tags ARRAY<STRING>). Text is stripped;
    blank text is skipped; the annotated and corpus sources share one seen-set of clean keys
    with annotated first (DED-3), the AI source has its own. Keep-first is a window over the
    clean key whose ``row_number() = 1`` filter is planned with a map-side group limit.
    """
    def prep(df: DataFrame, source: str, prefix: str) -> DataFrame:
        t = T.strip_ws("text")
        return (df.select("ordinal", t.alias("text"), "label", "tags")
                .where(F.length("text") > 0)
                .select(F.concat(F.lit(prefix), F.col("ordinal").cast("string")).alias("doc_id"),
                        "text", F.lit(source).alias("source"), F.lit(SOURCE_RANK[source]).alias("source_rank"),
                        "ordinal", "tags", F.coalesce(F.col("label"), F.lit("")).alias("doc_label")))

    docs = (prep(annotated, "annotated", "annot_").unionByName(prep(ai, "ai", "ai_"))
            .unionByName(prep(corpus, "corpus", "corpus_")))
    # Seen-set per group: main (annotated + corpus) and AI apart; first by (source_rank, ordinal).
    # The key is a digest, so that a text passes the exchange once.
    group = F.when(F.col("source") == "ai", F.lit("ai")).otherwise(F.lit("main"))
    w = Window.partitionBy(group, F.sha2(T.clean_key("text"), 256)).orderBy("source_rank", "ordinal")
    return docs.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


INDEX_SCHEMAS = {
    "documents": "doc_id string, text string, source string, source_rank int, ordinal long, tags array<string>, doc_label string, doc_len int",
    "postings": "term string, doc_id string, tf long, positions array<int>, doc_len int, bucket int",
    "terms": "term string, df long, cf long, max_tf long, bucket int",
    "stats": "n_docs long, avg_len double, buckets int",
}


# Tasks that a folder of postings is dealt to.
SLICES = 8
# Tokens that a task groups into postings, so that its sort stays in memory.
TOKENS_PER_TASK = 2_000_000


class SearchIndex(NamedTuple):
    """SRCH-2 the tables of an index; ``buckets`` is the number of folders by term, None for frames that are not stored."""

    documents: DataFrame
    postings: DataFrame
    terms: DataFrame
    stats: DataFrame
    buckets: int | None = None


def write_index(annotated: DataFrame, ai: DataFrame, corpus: DataFrame, path: str, buckets: int | None = None) -> SearchIndex:
    """SRCH-1 + SRCH-2 write the index under ``path`` and open it.

    Texts are tokenised from the stored documents, dealt by document, so that a document's postings are grouped and
    get its length where they are made. They pass one exchange, by folder and hash of the document: a term that
    every document holds is written by ``SLICES`` tasks, each task writes to few folders, and no sampling pass is needed.
    """
    spark = annotated.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = build_documents(annotated, ai, corpus)
    docs.withColumn("doc_len", _doc_len()).write.option("compression", "zstd").parquet(f"{path}/documents")
    docs = spark.read.schema(INDEX_SCHEMAS["documents"]).parquet(f"{path}/documents")
    stats = index_stats(docs).first()
    n_tokens = int(stats["n_docs"] * (stats["avg_len"] or 0))
    dealt = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_tokens // TOKENS_PER_TASK))
    named = docs.where(F.col("doc_id").isNotNull()).select("doc_id", "text", "doc_len")
    posts = _document_terms(named.repartition(dealt, "doc_id"), "doc_len")
    posts = posts.withColumn("bucket", term_bucket(F.col("term"), buckets))
    posts = posts.select("term", "doc_id", "tf", "positions", "doc_len", "bucket").repartition(dealt, "bucket", F.pmod(F.xxhash64("doc_id"), F.lit(SLICES)))
    posts.sortWithinPartitions("bucket", "term", "doc_id").write.option("compression", "zstd").partitionBy("bucket").parquet(f"{path}/postings")
    terms = term_table(spark.read.schema(INDEX_SCHEMAS["postings"]).parquet(f"{path}/postings"), "bucket")
    terms.repartition(dealt, "bucket").sortWithinPartitions("bucket", "term").write.option("compression", "zstd").partitionBy("bucket").parquet(f"{path}/terms")
    index_stats(docs).withColumn("buckets", F.lit(buckets)).write.option("compression", "zstd").parquet(f"{path}/stats")
    return open_index(spark, path)


def open_index(spark: SparkSession, path: str) -> SearchIndex:
    """The index that ``write_index`` left under ``path``."""
    tables = {name: spark.read.schema(schema).parquet(f"{path}/{name}") for name, schema in INDEX_SCHEMAS.items()}
    return SearchIndex(**tables, buckets=tables["stats"].first()["buckets"])


def build_index(annotated: DataFrame, ai: DataFrame, corpus: DataFrame) -> SearchIndex:
    """An index in the shared folder, under a name of its own."""
    return write_index(annotated, ai, corpus, shared_path(annotated.sparkSession, f"index-{uuid.uuid4().hex}"))


def index_of(docs: DataFrame, postings: DataFrame) -> SearchIndex:
    """An index of frames that are not stored; its searches compute lengths and statistics from the texts."""
    docs = docs if "doc_len" in docs.columns else docs.withColumn("doc_len", _doc_len())
    return SearchIndex(docs, with_lengths(postings, docs), term_table(postings), index_stats(docs))


def term_bucket(term: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def of_terms(df: DataFrame, terms: Sequence[str], buckets: int | None) -> DataFrame:
    """The rows of ``terms`` in a table with a term column; of a stored one only the folders of the terms are read."""
    if buckets:
        df = df.where(reduce(or_, [F.col("bucket") == term_bucket(F.lit(t), buckets) for t in dict.fromkeys(terms)]))
    return df.where(F.col("term").isin(*dict.fromkeys(terms)))


def with_raw_tags(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """SRCH-1 the stored fields of a result: raw_text, and raw_tags, a map of every tag to its spans (text, start, end) in
    the document's text; documents without a span have every tag with none."""
    own = raw_tags(spans)
    return (docs.join(own, "doc_id", "left").withColumn("raw_tags", F.coalesce("raw_tags", no_raw_tags()))
            .withColumn("raw_text", F.col("text")))


def result_entry(docs: DataFrame) -> DataFrame:
    """FN-19 what a result card shows: doc_id, tag_labels (upper-case tags), tag_words (upper-case tag to the different words of its
    spans, tags with words only) and a preview."""
    words = F.map_filter(tag_words("raw_tags"), lambda _, w: F.size(w) > 0)
    return docs.select("doc_id", F.transform("tags", lambda t: F.upper(t)).alias("tag_labels"),
                       F.transform_keys(words, lambda t, _: F.upper(t)).alias("tag_words"), T.preview("text", 140).alias("preview"))


def source_counts(docs: DataFrame) -> DataFrame:
    """Documents per source (the counts the index build reports)."""
    return docs.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"))


def _document_terms(docs: DataFrame, *lengths: str) -> DataFrame:
    """(term, doc_id, tf, positions, the named length) with a row per document and different token, stop words kept.

    The engine tokenises; an Arrow batch of token lists is numbered and sorted as whole numbers, so no row is made for an
    occurrence. Texts that share an id are one document, with a row for each of their lengths."""
    kept = F.collect_list(F.struct("text", *lengths)).alias("_t")
    own = docs.groupBy("doc_id").agg(kept)
    tokens = F.transform("_t.text", lambda t: T.search_tokens(t))
    rows = own.select("doc_id", F.flatten(tokens).alias("tokens"), F.when(F.size("_t") > 1, F.transform(tokens, lambda x: F.size(x))).alias("parts"),
                      *[F.col(f"_t.{c}").alias(c) for c in lengths])
    schema = (f"term string, doc_id {dict(docs.dtypes)['doc_id']}, tf long, positions array<int>" + "".join(f", {c} int" for c in lengths))

    def group(batches):
        for whole in batches:
            step = 2_000  # rows, so that the arrays below stay small beside the batch
            for batch in (whole.slice(k, step) for k in range(0, whole.num_rows, step)):
                sizes = pc.fill_null(pc.list_value_length(batch.column("tokens")), 0).to_numpy(zero_copy_only=False).astype(np.int64)
                owner = np.repeat(np.arange(len(sizes)), sizes)
                place = np.arange(len(owner)) - (np.cumsum(sizes) - sizes)[owner]
                for k in np.flatnonzero(batch.column("parts").is_valid().to_numpy(zero_copy_only=False)):
                    place[owner == k] = np.concatenate([np.arange(n) for n in batch.column("parts")[k].as_py()])
                words = batch.column("tokens").flatten().dictionary_encode()
                code = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
                key = owner * max(1, len(words.dictionary)) + code
                order = np.lexsort((place, key)) if batch.column("parts").null_count < batch.num_rows else np.argsort(key, kind="stable")
                at = np.flatnonzero(np.diff(key[order], prepend=-1))
                ends = np.append(at[1:], len(order))
                spots = pa.ListArray.from_arrays(pa.array(np.append(at, len(order)).astype(np.int32)), pa.array(place[order].astype(np.int32)))
                mine = owner[order[at]]
                out = [words.dictionary.take(pa.array(code[order[at]])), batch.column("doc_id").take(pa.array(mine)), pa.array(ends - at), spots]
                if lengths:
                    n = pc.list_value_length(batch.column(lengths[0])).to_numpy(zero_copy_only=False).astype(np.int64)[mine]
                    again = np.repeat(np.arange(len(at)), n)
                    nth = np.arange(len(again)) - (np.cumsum(n) - n)[again]
                    out = out if len(again) == len(at) else [c.take(pa.array(again)) for c in out]
                    out += [batch.column(c).values.take(pa.array(batch.column(c).offsets.to_numpy()[:-1][mine[again]] + nth)) for c in lengths]
                yield pa.RecordBatch.from_arrays(out, names=["term", "doc_id", "tf", "positions", *lengths])

    return rows.mapInArrow(group, schema)


def build_postings(docs: DataFrame) -> DataFrame:
    """SRCH-2 (term, doc_id, tf, positions) of the documents (doc_id, text), stop words kept."""
    return _document_terms(docs.where(F.col("text").isNotNull()))


def term_table(postings: DataFrame, *keys: str) -> DataFrame:
    """Per term the documents that hold it, its occurrences and the most in one document."""
    return postings.groupBy(*keys, "term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").cast("long").alias("cf"),
                                               F.max("tf").cast("long").alias("max_tf"))


def _doc_len() -> Column:
    """Field length in index tokens (a match count; no token array is built)."""
    return F.regexp_count(F.lower(F.col("text")), F.lit(T.SEARCH_TOKEN))


def with_lengths(postings: DataFrame, docs: DataFrame) -> DataFrame:
    return postings.join(docs.select("doc_id", "doc_len"), "doc_id")


def index_stats(lengths: DataFrame) -> DataFrame:
    """One row: number of documents and average field length over the whole index."""
    return lengths.agg(F.count(F.lit(1)).alias("n_docs"), F.avg("doc_len").alias("avg_len"))


def facet_filter(docs: DataFrame, source: str = "all", tags: Sequence[str] = (),
                 label: str = "all") -> DataFrame:
    """SRCH-5 facets AND-ed: FLT-9 source, FLT-10 all requested tags, FLT-11 label."""
    if source in ("annotated", "ai", "corpus"):
        d = docs.where(F.col("source") == source)
    else:
        d = docs.where(F.col("source").isin(*MAIN_SOURCES))
    if tags:
        d = d.where(F.size(F.array_except(F.array(*[F.lit(t) for t in tags]), F.col("tags"))) == 0)
    if label in ("0", "1"):
        d = d.where(F.col("doc_label") == label)
    return d


def _bm25(tf: Column, df: Column, doc_len: Column, n_docs: Column, avg_len: Column) -> Column:
    idf = F.log(n_docs / (df + 1)) + 1
    return idf * (tf * (K1 + 1)) / (tf + K1 * ((1 - B) + B * doc_len / avg_len))


def search(docs: DataFrame, postings: DataFrame, terms: Sequence[str], **options) -> DataFrame:
    """``search_index`` over frames that are not stored."""
    return search_index(index_of(docs, postings), terms, **options)


def search_index(index: SearchIndex, terms: Sequence[str], mode: str = "all", source: str = "all", tags: Sequence[str] = (),
                 label: str = "all", limit: int | None = 50) -> DataFrame:
    """SRCH-3/4/5/7 ranked search. ``terms`` empty → every document in insertion order.

    Scores use statistics of the whole index (facets never change them). ``mode='all'`` keeps
    documents holding every term, ``'any'`` those holding at least one.
    """
    cand = facet_filter(index.documents, source, tags, label)
    terms = list(dict.fromkeys(t.lower() for t in terms if t and t.strip()))
    columns = ["doc_id", "source", "tags", "doc_label", "source_rank", "ordinal"]
    if not terms:
        ordered = cand.select(*columns, F.lit(None).cast("double").alias("score")).orderBy("source_rank", "ordinal")
        return ordered.limit(limit) if limit else ordered
    hits = of_terms(index.postings, terms, index.buckets).select("term", "doc_id", "tf", "doc_len")
    # a row per query term
    dfs = F.broadcast(of_terms(index.terms, terms, index.buckets).select("term", "df"))
    scored = with_scalars(hits.join(dfs, "term"), index.stats.select("n_docs", "avg_len"))
    part = _bm25(F.col("tf"), F.col("df"), F.col("doc_len"), F.col("n_docs"), F.col("avg_len"))
    per_doc = scored.groupBy("doc_id").agg(F.sum(part).alias("score"), F.count(F.lit(1)).alias("_matched"))
    if mode == "all":
        per_doc = per_doc.where(F.col("_matched") == len(terms))
    ordered = cand.join(per_doc, "doc_id").select(*columns, "score").orderBy(F.desc("score"), "source_rank", "ordinal")
    return ordered.limit(limit) if limit else ordered


def phrase_search(docs: DataFrame, postings: DataFrame, phrase: Sequence[str], **options) -> DataFrame:
    """``search_phrase`` over frames that are not stored."""
    return search_phrase(index_of(docs, postings), phrase, **options)


def _moved_back(positions: Column, k: int) -> Column:
    return F.transform(positions, lambda x: x - k)


def phrase_counts(index: SearchIndex, phrase: Sequence[str]) -> DataFrame:
    """(doc_id, doc_len, tf) of the documents that hold the words side by side. A document's position lists, one per
    different word, are brought together; the k-th word's, moved back by k, are intersected."""
    words = [w.lower() for w in phrase]
    different = list(dict.fromkeys(words))
    hits = of_terms(index.postings, different, index.buckets)
    lists = hits.groupBy("doc_id").agg(F.max("doc_len").alias("doc_len"), *[
        F.collect_list(F.when(F.col("term") == w, F.col("positions"))).alias(f"_p{i}") for i, w in enumerate(different)])
    lists = lists.where(reduce(and_, [F.size(f"_p{i}") > 0 for i in range(len(different))]))
    starts = reduce(F.array_intersect, [_moved_back(F.get(f"_p{different.index(w)}", 0), k) for k, w in enumerate(words)])
    return lists.select("doc_id", "doc_len", F.size(starts).cast("long").alias("tf")).where("tf > 0")


def search_phrase(index: SearchIndex, phrase: Sequence[str], source: str = "all", tags: Sequence[str] = (), label: str = "all",
                  limit: int | None = 50) -> DataFrame:
    """SRCH-7 phrase match, scored by BM25 with the phrase count as tf and the number of documents holding the phrase as df."""
    per_doc = phrase_counts(index, phrase)
    n_with = per_doc.agg(F.count(F.lit(1)).alias("df"))
    scored = with_scalars(with_scalars(per_doc, index.stats.select("n_docs", "avg_len")), n_with)
    scored = scored.select("doc_id", "tf", _bm25(F.col("tf"), F.col("df"), F.col("doc_len"), F.col("n_docs"),
                                                 F.col("avg_len")).alias("score"))
    cand = facet_filter(index.documents, source, tags, label)
    res = cand.join(scored, "doc_id").select("doc_id", "source", "source_rank", "ordinal", "tf", "score")
    ordered = res.orderBy(F.desc("score"), "source_rank", "ordinal")
    return ordered.limit(limit) if limit else ordered


def two_panel(docs: DataFrame, postings: DataFrame, terms: Sequence[str], show_ai: bool = True, **facets) -> DataFrame:
    """``search_panels`` over frames that are not stored."""
    return search_panels(index_of(docs, postings), terms, show_ai, **facets)


def search_panels(index: SearchIndex, terms: Sequence[str], show_ai: bool = True, **facets) -> DataFrame:
    """SRCH-6 main panel and, on request, the same query over the AI documents."""
    main = search_index(index, terms, **facets).withColumn("panel", F.lit("main"))
    if not show_ai:
        return main
    ai = search_index(index, terms, **{**facets, "source": "ai"})
    return main.unionByName(ai.withColumn("panel", F.lit("ai")))


def pair_with_ai(main: DataFrame, ai_docs: DataFrame) -> DataFrame:
    """JN-2 left join of results to AI documents on lower(strip(text)); on duplicate AI keys the
    last one (largest ordinal) wins — an aggregate per key, then an equi-join."""
    key = F.lower(T.strip_ws("text"))
    right = (ai_docs.select(key.alias("_k"), F.struct("ordinal", "doc_id").alias("_s"))
             .groupBy("_k").agg(F.max("_s").alias("_s"))
             .select("_k", F.col("_s.doc_id").alias("ai_doc_id")))
    return main.withColumn("_k", key).join(right, "_k", "left").drop("_k")
