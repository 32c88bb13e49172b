"""Runs of windows that share an anchor, the common ground of the two exact repeat removers.

A window is W consecutive units (words or bytes) of one text. Its anchor is the run of ``a`` units
in it with the least hash (the leftmost of equals), so equal windows have equal anchors at the
same place. Consecutive windows with the same anchor form a run; a corpus has about one run for
each (W - a) / 2 units, and a run whose anchor occurs once anywhere holds no repeated window. Anchors
therefore decide which small part of the corpus needs closer comparison, exactly and for whole texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from markerlens.llm.common import stored
from markerlens.llm.text_arrays import BASES, BLOCK, mix, owners, powers, row_slices, sliding_min, utf8, window_hashes

PLACE = np.uint64((1 << 28) - 1)


def window_runs(units: np.ndarray, bounds: np.ndarray, anchor: int, window: int) -> dict[str, np.ndarray]:
    """text (index), start (unit within the text), n (windows), anchor and content hash of each run."""
    out = {k: [] for k in ("text", "start", "n", "anchor", "content")}
    of = owners(bounds)
    total = len(units)
    for p in range(0, max(0, total - window + 1), BLOCK):
        q = min(total, p + BLOCK + window - 1)
        part = units[p:q].astype(np.uint64)
        hashes = window_hashes(part, anchor)
        packed = (hashes & ~PLACE) | np.arange(len(hashes), dtype=np.uint64)
        least = (sliding_min(packed, window - anchor + 1) & PLACE).astype(np.int64)
        valid = of[p: p + len(least)] == of[p + window - 1: p + window - 1 + len(least)]
        label = np.where(valid, least, -1)
        edge = np.flatnonzero(np.concatenate([[True], label[1:] != label[:-1], [True]]))
        begin, end = edge[:-1], edge[1:]
        real = label[begin] >= 0
        begin, end = begin[real], end[real]
        stop = end + window - 1
        up, down = powers(BASES[2], len(part) + 1)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((part + np.uint64(1)) * up[: len(part)], out=sums[1:])
        content = mix((sums[stop] - sums[begin]) * down[begin] + (stop - begin).astype(np.uint64))
        text = of[p + begin]
        for k, v in (("text", text), ("start", p + begin - bounds[text]), ("n", end - begin),
                     ("anchor", hashes[label[begin]]), ("content", content)):
            out[k].append(v)
    return {k: np.concatenate(v) if v else np.zeros(0, np.uint64 if k in ("anchor", "content") else np.int64) for k, v in out.items()}


RUNS = "doc_id long, text_key long, start long, n int, anchor long, content long"


def run_rows(rows: DataFrame, units_of, anchor: int, window: int) -> DataFrame:
    """The runs of all texts of ``rows`` (doc_id, text, text_key); ``units_of(buf, offsets)`` gives
    the units and their bounds."""

    def emit(batches):
        for batch in batches:
            for part in row_slices(batch, "text"):
                units, bounds = units_of(*utf8(part.column("text")))
                r = window_runs(units, bounds, anchor, window)
                at = pa.array(r["text"])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(at), part.column("text_key").take(at), pa.array(r["start"]),
                     pa.array(r["n"].astype(np.int32)), pa.array(r["anchor"].view(np.int64)), pa.array(r["content"].view(np.int64))],
                    names=["doc_id", "text_key", "start", "n", "anchor", "content"])

    return stored(rows.mapInArrow(emit, RUNS), "runs")


def repeated_runs(runs: DataFrame) -> DataFrame:
    """Runs whose anchor occurs twice or more; ``mixed`` says that the runs of the anchor differ."""
    # stored, so that both sides of the join are plain exchanges, which Spark splits where an anchor is frequent
    anchors = stored(runs.groupBy("anchor").agg(F.count("*").alias("times"), (F.min("content") != F.max("content")).alias("mixed"))
                     .where("times > 1").select("anchor", "mixed"), "anchors")
    return stored(runs.join(anchors, "anchor"), "repeated")


def with_requests(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """Texts with the list ``wants`` of (start, n, anchor, content, times) that are to be read from them.

    A repeated row is read as often as it is there; that changes no verdict, as its runs repeat anyway."""
    lists = wanted.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("start", "n", "anchor", "content", "times")).alias("wants"))
    lists = lists.withColumnsRenamed({"doc_id": "w_id", "text_key": "w_key"})
    on = F.col("doc_id").eqNullSafe(F.col("w_id")) & (F.col("text_key") == F.col("w_key"))
    return rows.join(lists, on).select("text", "wants")


def distinct_runs(repeated: DataFrame) -> DataFrame:
    """One row per different run of the anchors with differing runs, with one place to read it from."""
    return (repeated.where("mixed").groupBy("anchor", "content")
            .agg(F.count("*").alias("times"), F.min(F.struct("doc_id", "text_key", "start", "n")).alias("at"))
            .select("at.*", "anchor", "content", "times"))


def with_spans(rows: DataFrame, spans: DataFrame) -> DataFrame:
    """Every row of ``rows`` (doc_id, text_key, ...) with the list ``spans`` of (start, n) of its text."""
    lists = spans.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("start", "n")).alias("spans"))
    lists = lists.withColumnsRenamed({"doc_id": "s_id", "text_key": "s_key"})
    on = F.col("doc_id").eqNullSafe(F.col("s_id")) & (F.col("text_key") == F.col("s_key"))
    return rows.join(lists, on, "left").drop("s_id", "s_key")


def covered(spans, window: int, length: int) -> np.ndarray:
    """Mask of the units inside the windows of the spans (start, n) of one text."""
    depth = np.zeros(length + 1, np.int32)
    starts = np.array([s["start"] for s in spans], np.int64)
    stops = starts + np.array([s["n"] for s in spans], np.int64) + window - 1
    np.add.at(depth, starts, 1)
    np.add.at(depth, stops, -1)
    return np.cumsum(depth[:-1]) > 0
