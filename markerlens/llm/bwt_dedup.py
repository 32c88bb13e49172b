"""Removal of repeated byte strings by threshold-bounded interval expansion on a Burrows-Wheeler transform.

Strings of LENGTH bytes are windows over the bytes of one text. Only windows near an anchor that
occurs twice can repeat (see ``anchors``); where all runs of an anchor are the same bytes, the run
repeats as a whole. The bytes of the other runs, each different one once, meet in groups by anchor. A
group goes into a text for which the transform is built; intervals of suffixes are extended
backwards breadth-first, which finds the common prefixes of neighbouring suffixes by increasing value, and the
expansion stops at LENGTH: neighbours without a value by then share LENGTH bytes. Groups too
large for one text are cut by longer anchors, up to the window itself, so no group has to fit
a task. Runs count as the same when two independent 64-bit hashes agree.

Defined cases: null and empty texts and texts shorter than LENGTH bytes keep all bytes; repeated rows
remove each other's bytes; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from markerlens.llm.anchors import covered, distinct_runs, repeated_runs, run_rows, window_runs, with_requests, with_spans
from markerlens.llm.common import drop_stored, stored, text_rows

LENGTH = 200
#: Anchor lengths: the first for all texts, the next where a group stays too large.
ANCHORS = (64, 128, 184, 200)
#: Bytes of one transform, and of the groups that share a task.
CHUNK, TASK = 1 << 20, 4 << 20


def bounded_order(t: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of ``t`` (symbols 0-257) ordered by their first ``depth`` symbols, by prefix doubling."""
    n = len(t)
    padded = np.concatenate([t.astype(np.int64), np.zeros(7, np.int64)])
    key = np.zeros(n, np.int64)
    for i in range(6):
        key = key * 258 + padded[i: i + n]
    have, rank = 6, np.unique(key, return_inverse=True)[1]
    while have < depth:
        ahead = np.zeros(n, np.int64)
        ahead[: n - have] = rank[have:] + 1
        distinct, rank = np.unique(rank * (n + 2) + ahead, return_inverse=True)
        have *= 2
        if len(distinct) == n:
            break
    return np.argsort(rank, kind="stable")


def long_prefix_pairs(t: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffix order, and for each place whether it shares ``length`` symbols with the place before.

    An interval of the order holds the suffixes that start with some string; extending it backwards by a
    symbol maps it through the transform. The interval's right border gets the common prefix length
    of the round that first reaches it; a border that no round below ``length`` reaches is a pair."""
    n = len(t)
    order = bounded_order(t, length)
    transform = t[order - 1]  # the symbol before each suffix; before the first stands the end mark
    back = np.empty(n, np.int64)
    back[np.argsort(transform, kind="stable")] = np.arange(n)
    open_border = np.ones(n + 1, bool)
    open_border[0] = False
    low, high = np.array([0]), np.array([n])
    for _ in range(length):
        single = high - low == 1
        to_low = [back[low[single]]]
        to_high = [to_low[0] + 1]
        wide_low, wide_high = low[~single], high[~single]
        if len(wide_low):
            size = wide_high - wide_low
            stop = np.cumsum(size)
            member = np.repeat(wide_low - (stop - size), size) + np.arange(int(stop[-1]))
            group = np.repeat(np.arange(len(size)), size) * 258 + transform[member]
            by = np.argsort(group, kind="stable")
            edge = np.flatnonzero(np.concatenate([[True], group[by][1:] != group[by][:-1]]))
            count = np.diff(np.append(edge, len(by)))
            first = back[member[by[edge]]]
            to_low.append(first)
            to_high.append(first + count)
        low, high = np.concatenate(to_low), np.concatenate(to_high)
        # one interval for each border that is still open
        fresh = open_border[high]
        low, high = low[fresh], high[fresh]
        high, pick = np.unique(high, return_index=True)
        low = low[pick]
        open_border[high] = False
        if not len(low):
            break
    shared = open_border[:n].copy()
    return order, shared


def repeated_starts(texts: list[bytes], length: int) -> list[np.ndarray]:
    """For each text, the starts of strings of ``length`` bytes that start more than once in all of them."""
    sizes = np.array([len(x) + 1 for x in texts])
    first = np.cumsum(sizes) - sizes
    t = np.frombuffer(b"\x00".join(texts) + b"\x00\x00", np.uint8).astype(np.int16) + 2
    t[first + sizes - 1] = 1  # ends a text
    t[-1] = 0  # ends all of them, and is met once
    order, shared = long_prefix_pairs(t, length)
    hit = np.zeros(len(t), bool)
    at = np.flatnonzero(shared)
    hit[order[at]] = True
    hit[order[at - 1]] = True
    return [np.flatnonzero(hit[f: f + max(s - length, 0)]) for f, s in zip(first.tolist(), sizes.tolist())]


def expand(table: pa.Table) -> pa.Table:
    """Groups of a task (columns grp, piece, from_, bytes), some groups per transform: repeated starts as islands."""
    table = table.sort_by("grp")
    grp, texts = table.column("grp").to_pylist(), table.column("bytes").to_pylist()
    pieces, begins = table.column("piece").to_numpy(), table.column("from_").to_numpy()
    out, lo = [], 0

    def flush(hi):
        for row, starts in enumerate(repeated_starts(texts[lo:hi], LENGTH), lo):
            if len(starts):
                cut = np.flatnonzero(np.concatenate([[True], np.diff(starts) > 1, [True]]))
                for a, b in zip(cut[:-1], cut[1:]):
                    out.append((pieces[row], begins[row] + starts[a], b - a))

    size = 0
    for i, x in enumerate(texts):
        if size > CHUNK and grp[i] != grp[i - 1]:
            flush(i)
            lo, size = i, 0
        size += len(x) + 1
    if texts:
        flush(len(texts))
    cols = np.array(out, np.int64).reshape(-1, 3)
    return pa.table({"piece": cols[:, 0], "place": cols[:, 1], "len": cols[:, 2].astype(np.int32)})


def read_runs(batches):
    """The bytes of the runs asked for."""
    for batch in batches:
        for text, wants in zip(batch.column("text"), batch.column("wants")):
            data, rows = text.as_py().encode(), wants.as_py()
            yield pa.RecordBatch.from_arrays(
                [pa.array([w["anchor"] for w in rows], pa.int64()), pa.array([w["content"] for w in rows], pa.int64()), pa.array([0] * len(rows), pa.int64()),
                 pa.array([data[w["start"]: w["start"] + w["n"] + LENGTH - 1] for w in rows], pa.binary())], names=["grp", "piece", "from_", "bytes"])


PARTS = "grp long, piece long, from_ long, bytes binary"


def recut(parts: DataFrame, anchor: int) -> DataFrame:
    """Cut the bytes of large groups by a longer anchor; the new group is the old one and the anchor."""

    def run(batches):
        for batch in batches:
            for grp, piece, begin, data in zip(*(batch.column(c).to_pylist() for c in ("grp", "piece", "from_", "bytes"))):
                units = np.frombuffer(data, np.uint8)
                r = window_runs(units, np.array([0, len(units)]), anchor, LENGTH)
                n = len(r["n"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([grp] * n, pa.int64()), pa.array([piece] * n, pa.int64()), pa.array(begin + r["start"]),
                     pa.array([data[s: s + k + LENGTH - 1] for s, k in zip(r["start"], r["n"])], pa.binary()), pa.array(r["anchor"].view(np.int64))],
                    names=["grp", "piece", "from_", "bytes", "anchor"])

    cut = parts.mapInArrow(run, PARTS + ", anchor long")
    return cut.withColumn("grp", F.xxhash64("grp", "anchor")).drop("anchor")


def expanded(parts: DataFrame) -> DataFrame:
    """(piece, place, len): islands of repeated starts in the runs."""
    found = []
    for k, anchor in enumerate(ANCHORS):
        sizes = stored(parts.groupBy("grp").agg(F.sum(F.length("bytes") + 1).alias("load"), F.count("*").alias("runs"))
                       .where("runs > 1"), "sizes")
        load = sizes.agg(F.sum("load").alias("all"), F.max("load").alias("most")).first()
        last = k + 1 == len(ANCHORS)  # groups of equal windows: whatever is left repeats
        small = parts.join(sizes.where(F.lit(last) | (F.col("load") <= CHUNK)).select("grp"), "grp", "left_semi")
        if last:
            found.append(small.select("piece", F.col("from_").alias("place"), F.lit(1).alias("len")))
            break
        tasks = max(1, -(-(load["all"] or 0) // TASK))
        found.append(small.withColumn("task", F.pmod(F.xxhash64("grp"), F.lit(tasks))).groupBy("task")
                     .applyInArrow(lambda t: expand(t.drop_columns(["task"])), "piece long, place long, len int"))
        if (load["most"] or 0) <= CHUNK:
            break
        parts = stored(recut(parts.join(sizes.where(F.col("load") > CHUNK).select("grp"), "grp", "left_semi"), ANCHORS[k + 1]), "parts")
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out


def repeated_spans(rows: DataFrame) -> DataFrame:
    """(doc_id, text_key, start, n): windows of LENGTH bytes that occur more than once."""
    runs = run_rows(rows, lambda buf, offsets: (buf, offsets), ANCHORS[0], LENGTH)
    repeated = repeated_runs(runs)
    drop_stored(runs)
    chosen = stored(distinct_runs(repeated), "chosen")
    parts = stored(with_requests(rows, chosen).mapInArrow(read_runs, PARTS), "parts")
    # runs that occur twice as a whole repeat anyway; stored sides, so that Spark can split a frequent run
    mixed = repeated.where("mixed")
    whole = repeated.where("NOT mixed").unionByName(
        mixed.join(chosen.where("times > 1").select("anchor", "content"), ["anchor", "content"], "left_semi").select(*repeated.columns))
    islands = stored(expanded(parts).distinct(), "islands")
    single = mixed.select("doc_id", "text_key", "start", F.col("content").alias("piece")).join(islands, "piece")
    spans = whole.select("doc_id", "text_key", "start", "n").union(
        single.select("doc_id", "text_key", (F.col("start") + F.col("place")).alias("start"), F.col("len").alias("n")))
    return stored(spans, "spans")


def byte_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept (the bytes that stay)."""
    rows = text_rows(docs)

    def run(batches):
        for batch in batches:
            out = [[], [], [], [], []]
            for text, spans in zip(batch.column("text"), batch.column("spans")):
                data = text.as_py().encode()
                kept, runs = data, 0
                if spans.is_valid:
                    gone = covered(spans.as_py(), LENGTH, len(data))
                    kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
                    runs = int(np.count_nonzero(gone[1:] & ~gone[:-1])) + int(gone[0])
                for o, v in zip(out, (len(data), len(data) - len(kept), runs, hashlib.sha256(kept).hexdigest(), kept)):
                    o.append(v)
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(o, t) for o, t in zip(out, types))],
                                             names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return with_spans(rows, repeated_spans(rows)).mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
