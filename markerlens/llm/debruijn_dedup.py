"""Removal of repeated passages by de Bruijn compaction over word windows.

Windows of K words are the edges of a graph whose nodes are the K - 1 words that neighbours
share. Only windows near an anchor that occurs twice (see ``anchors``) can repeat; runs of such windows
that occur everywhere alike are paths already, all others are opened into single edges, counted, and
closed again into paths of repeated edges. Paths that follow each other without a branch (the only
successor of the one, the only predecessor of the other) are compacted through joins on the path ids,
and the source coordinates of each compacted occurrence have to tile without a gap. The words
under the windows of the occurrences are removed. Windows count as equal when two independent
64-bit hashes agree.

Defined cases: null and empty texts and texts of fewer than K words keep all words; repeated rows
remove each other's words; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from markerlens.llm.anchors import covered, distinct_runs, repeated_runs, run_rows, with_requests, with_spans
from markerlens.llm.common import drop_stored, stored, text_rows
from markerlens.llm.text_arrays import window_hashes, word_hashes, word_spans

K = 35
ANCHOR = 16


def word_units(buf, offsets):
    starts, ends, bounds = word_spans(buf, offsets)
    return word_hashes(buf, starts, ends), bounds


def opened(batches):
    """The edges of the runs asked for: one row per window, with its place in the run."""
    for batch in batches:
        for text, wants in zip(batch.column("text"), batch.column("wants")):
            buf = np.frombuffer(text.as_py().encode(), np.uint8)
            units, _ = word_units(buf, np.array([0, len(buf)]))
            edges = window_hashes(units, K).view(np.int64)
            rows = wants.as_py()
            n = np.array([w["n"] for w in rows])
            place = np.concatenate([np.arange(k) for k in n])
            start = np.repeat([w["start"] for w in rows], n)
            cols = [np.repeat([w[c] for w in rows], n) for c in ("anchor", "content", "times")]
            yield pa.RecordBatch.from_arrays([*map(pa.array, cols), pa.array(place.astype(np.int32)), pa.array(edges[start + place])],
                                             names=["anchor", "content", "times", "place", "edge"])


def path_segments(rows: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """Occurrences (doc_id, text_key, start, n, path) of runs of repeated edges, and stored tables under them."""
    runs = run_rows(rows, word_units, ANCHOR, K)
    repeated = repeated_runs(runs)
    drop_stored(runs)
    edges = stored(with_requests(rows, distinct_runs(repeated)).mapInArrow(
        opened, "anchor long, content long, times long, place int, edge long"), "edges")
    counted = edges.groupBy("anchor", "edge").agg(F.sum("times").alias("seen")).where("seen > 1")
    live = edges.join(counted.select("anchor", "edge"), ["anchor", "edge"], "left_semi")
    # neighbouring live edges of a run make a path: their place less their rank is the same
    rank = F.dense_rank().over(Window.partitionBy("anchor", "content").orderBy("place"))
    closed = (live.withColumn("island", F.col("place") - rank).groupBy("anchor", "content", "island")
              .agg(F.min("place").alias("place"), (F.max("place") - F.min("place") + 1).alias("len"),
                   F.xxhash64(F.array_sort(F.collect_set(F.struct("place", "edge")))["edge"]).alias("path")))
    uniform = repeated.where("NOT mixed").select("doc_id", "text_key", "start", "n", F.xxhash64("anchor", "content").alias("path"))
    broken = (repeated.where("mixed").select("doc_id", "text_key", "start", "anchor", "content").join(closed, ["anchor", "content"])
              .select("doc_id", "text_key", (F.col("start") + F.col("place")).alias("start"), F.col("len").alias("n"), "path"))
    segments = stored(uniform.union(broken), "segments")
    drop_stored(edges, repeated)
    return segments, [segments]


def compacted(segments: DataFrame) -> DataFrame:
    """Join neighbouring segments along links without a branch: (doc_id, text_key, start, n, path).

    A row of the result is one occurrence of a compacted path; its segments tile its coordinates."""
    order = Window.partitionBy("doc_id", "text_key").orderBy("start", "n", "path")
    rows = segments.dropDuplicates(["doc_id", "text_key", "start", "n", "path"])
    tiles = F.lag(F.col("start") + F.col("n")).over(order) == F.col("start")
    rows = stored(rows.withColumn("before", F.when(tiles, F.lag("path").over(order))), "links")
    links = rows.where("before IS NOT NULL")
    # links without a branch, from one row per different link; stored, so that the join with all
    # occurrences has plain exchanges, which Spark splits at a frequent path
    kinds = stored(links.select("before", "path").distinct(), "kinds")
    follows = kinds.groupBy(F.col("before").alias("x")).count().where(F.col("count") == 1).select("x")
    leads = kinds.groupBy(F.col("path").alias("y")).count().where(F.col("count") == 1).select("y")
    straight = stored(kinds.join(follows, F.col("before") == F.col("x"), "left_semi")
                      .join(leads, F.col("path") == F.col("y"), "left_semi").withColumn("joined", F.lit(1)), "straight")
    marked = rows.join(straight, ["before", "path"], "left")
    turn = F.sum(F.when(F.col("joined").isNull(), 1).otherwise(0)).over(order)
    return (marked.withColumn("no", turn).groupBy("doc_id", "text_key", "no")
            .agg(F.min("start").alias("start"), F.sum("n").alias("n"), F.min_by("path", "start").alias("path")))


def repeated_spans(docs: DataFrame) -> DataFrame:
    """Every row of ``docs`` as (doc_id, text, text_key, spans): spans are (start, n) in windows of words."""
    rows = text_rows(docs)
    segments, _ = path_segments(rows)
    return with_spans(rows, compacted(segments).select("doc_id", "text_key", "start", "n"))


def substring_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and kept_text (kept words joined by one space)."""

    def run(batches):
        for batch in batches:
            out = [[], [], [], []]
            for text, spans in zip(batch.column("text"), batch.column("spans")):
                words = text.as_py().encode().split()
                kept = words
                if spans.is_valid:
                    gone = covered(spans.as_py(), K, len(words))
                    kept = [w for w, g in zip(words, gone.tolist()) if not g]
                data = b" ".join(kept)
                for o, v in zip(out, (len(words), len(words) - len(kept), hashlib.sha256(data).hexdigest(), data.decode())):
                    o.append(v)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(o, t) for o, t in zip(out, (pa.int64(), pa.int64(), pa.string(), pa.string())))],
                                             names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"])

    return repeated_spans(docs).mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string")


def cut(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeated words cut from ``text`` (other white space stays) and n_chars, if
    there, counted anew; all rows and columns stay."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    segments, _ = path_segments(text_rows(docs))
    spans = compacted(segments).select("doc_id", "text_key", "start", "n")
    lists = (spans.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("start", "n")).alias("__spans"))
             .withColumnsRenamed({"doc_id": "__s_id", "text_key": "__s_key"}))
    joined = docs.join(lists, F.col("doc_id").cast("long").eqNullSafe(F.col("__s_id")) & (F.xxhash64(text) == F.col("__s_key")), "left")

    columns = list(docs.columns)

    def run(batches):
        for batch in batches:
            at = batch.schema.get_field_index("text")
            new = []
            for value, spans in zip(batch.column("text"), batch.column("__spans")):
                value = value.as_py()
                if spans.is_valid:
                    data = value.encode()
                    starts, _, _ = word_spans(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
                    gone = covered(spans.as_py(), K, len(starts))
                    ends = np.append(starts[1:], len(data))
                    value = (data[: starts[0]] + b"".join(data[a:b] for a, b in zip(starts[~gone], ends[~gone]))).decode()
                new.append(value)
            yield batch.set_column(at, "text", pa.array(new, batch.schema.field("text").type)).select(columns)

    out = joined.select(*docs.columns, "__spans").mapInArrow(run, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
