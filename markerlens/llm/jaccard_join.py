"""N-gram Jaccard self-join with Bayesian candidate pruning.

Shingles are runs of five words (a text with fewer words is one shingle). Texts with the same
word sequence are one class member with copies. Candidates come from bands of MinHash values.
Inside a bucket, pairs are compared chunk by chunk of MinHash values; a pair is dropped as soon as
the posterior probability that its similarity reaches the threshold falls below the tolerance.
Survivors join their texts into groups, and within a group all survivors are verified on the whole
shingle sets. Buckets and groups of any size are cut into blocks, and pairs of blocks are the unit
of work, so no bucket or group has to fit one task and no pair becomes a row.

Defined cases: null and empty texts (no words) have no shingles, no links, and are each in a class of their own id;
repeated rows are copies; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from functools import lru_cache
from math import lgamma

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from markerlens.llm.common import drop_stored, stored, text_rows
from markerlens.llm.text_arrays import (BASES, mix, owners, row_slices, segment_sums, utf8,
                                       window_hashes, word_hashes, word_spans)

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 32, 4
HASHES = BANDS * ROWS
CHUNK = 16
TOLERANCE = 1e-6
BLOCK_ROWS = 512
#: Shingles that the texts of a block hold together, about.
BLOCK_SHINGLES = 1 << 17


@lru_cache
def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> tuple[int, ...]:
    """By chunk: least number of equal MinHash values with which a pair stays.

    Uniform prior on the similarity; m of n equal values give Beta(m + 1, n - m + 1); a pair stays
    while P(similarity >= threshold) is at least the tolerance."""
    grid = (np.arange(20000) + 0.5) / 20000
    out = []
    for n in range(CHUNK, HASHES + 1, CHUNK):
        for m in range(n + 1):
            log = lgamma(n + 2) - lgamma(m + 1) - lgamma(n - m + 1) + m * np.log(grid) + (n - m) * np.log1p(-grid)
            if np.exp(log)[grid >= threshold].sum() / 20000 >= tolerance:
                out.append(m)
                break
    return tuple(out)


def shingle_sets(buf, offsets) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shingle hashes of all texts (with repeats), their bounds, and a hash of each word sequence."""
    starts, ends, bounds = word_spans(buf, offsets)
    words = word_hashes(buf, starts, ends)
    n = np.diff(bounds)
    of = owners(bounds)
    full = window_hashes(words, SHINGLE)
    inside = np.flatnonzero(of[: len(full)] == of[SHINGLE - 1:]) if len(full) else np.zeros(0, np.int64)
    short = np.flatnonzero((n > 0) & (n < SHINGLE))
    lone = np.array([window_hashes(words[bounds[i]: bounds[i + 1]], int(n[i]))[0] for i in short], np.uint64)
    values = np.concatenate([full[inside], lone])
    doc = np.concatenate([of[inside], short])
    order = np.argsort(doc, kind="stable") if len(short) else slice(None)
    place = (np.arange(len(words)) - bounds[of]).astype(np.uint64)
    turned = mix(words ^ mix(place + np.uint64(1)))
    sequence = mix(segment_sums(turned.view(np.int64), bounds).view(np.uint64) + n.astype(np.uint64))
    return values[order], np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(n)))]), sequence


def minhashes(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """(texts, HASHES) values, of which the low 16 bits are kept; texts without shingles get all ones."""
    out = np.full((len(bounds) - 1, HASHES), 0xFFFF, np.uint16)
    some = np.flatnonzero(np.diff(bounds) > 0)
    factors = mix(np.arange(1, HASHES + 1, dtype=np.uint64) * np.uint64(BASES[2])) | np.uint64(1)
    at = 0
    while at < len(some):  # runs of texts with about 32 thousand shingles
        to = max(at + 1, int(np.searchsorted(bounds[some], bounds[some[at]] + (1 << 15))))
        rows = some[at:to]
        lo, hi = bounds[rows[0]], bounds[rows[-1] + 1]
        part, cuts = values[lo:hi], bounds[rows] - lo
        for j in range(HASHES):
            out[rows, j] = np.minimum.reduceat(part * factors[j] >> np.uint64(16), cuts).astype(np.uint16)
        at = to
    return out


def band_keys(sig: np.ndarray) -> np.ndarray:
    """(texts, BANDS) int64 keys; the band number is part of the key."""
    parts = sig.reshape(len(sig), BANDS, ROWS).astype(np.uint64)
    key = np.arange(BANDS, dtype=np.uint64)[None, :] * np.uint64(BASES[1])
    for r in range(ROWS):
        key = mix(key ^ (parts[:, :, r] + np.uint64(r + 1)))
    return key.view(np.int64)


def surviving(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of the rows of two signature matrices that survive all chunks."""
    least = least_matches()
    count = (a[:, None, :CHUNK] == b[None, :, :CHUNK]).sum(2, dtype=np.int16)
    i, j = np.nonzero(count >= least[0])
    seen = count[i, j].astype(np.int32)
    for c in range(1, HASHES // CHUNK):
        seen = seen + (a[i, c * CHUNK: (c + 1) * CHUNK] == b[j, c * CHUNK: (c + 1) * CHUNK]).sum(1)
        stay = seen >= least[c]
        i, j, seen = i[stay], j[stay], seen[stay]
    return i, j


def set_overlaps(sets_a: list[np.ndarray], sets_b: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Exact intersection sizes of the pairs: by merging when pairs are few, else as a product of 0/1 matrices."""
    if len(i) * 8 < len(sets_a) + len(sets_b) or len(i) < 64:
        return np.array([len(np.intersect1d(sets_a[x], sets_b[y], assume_unique=True)) for x, y in zip(i, j)], np.int64)
    of_a = np.repeat(np.arange(len(sets_a)), [len(s) for s in sets_a])
    of_b = np.repeat(np.arange(len(sets_b)), [len(s) for s in sets_b])
    vals_a, vals_b = np.concatenate(sets_a), np.concatenate(sets_b)
    both = np.intersect1d(vals_a, vals_b)
    in_a, in_b = np.isin(vals_a, both), np.isin(vals_b, both)
    of_a, of_b = of_a[in_a], of_b[in_b]
    col_a, col_b = np.searchsorted(both, vals_a[in_a]), np.searchsorted(both, vals_b[in_b])
    total = np.zeros((len(sets_a), len(sets_b)), np.float32)
    for lo in range(0, len(both), 4096):
        hi = min(len(both), lo + 4096)
        m = np.zeros((len(sets_a), hi - lo), np.float32)
        n = np.zeros((len(sets_b), hi - lo), np.float32)
        for mat, of, col in ((m, of_a, col_a), (n, of_b, col_b)):
            at = (col >= lo) & (col < hi)
            mat[of[at], col[at] - lo] = 1
        total += m @ n.T
    return np.rint(total[i, j]).astype(np.int64)


def block_pairs(rows: DataFrame, key: str, weight: str | None, least: int = BLOCK_ROWS) -> DataFrame:
    """Deal the rows of each key into blocks and repeat a row for each pair of blocks it is in.

    Blocks hold about BLOCK_ROWS rows, and BLOCK_SHINGLES of ``weight`` if given. A row of a key
    with n blocks appears n times; columns blk_a, blk_b name the pair, ``blk`` the row's own block.
    """
    size = [F.count("*").alias("rows_in_key")] + ([F.sum(weight).alias("load")] if weight else [])
    sizes = rows.groupBy(key).agg(*size)
    n = F.ceil(F.col("rows_in_key") / least)
    if weight:
        n = F.greatest(n, F.ceil(F.col("load") / BLOCK_SHINGLES))
    # stored, so that both sides of the join are plain exchanges, which Spark splits at a frequent key
    sizes = stored(sizes.where("rows_in_key > 1").select(key, n.cast("int").alias("blocks")), "sizes")
    dealt = rows.join(sizes, key).withColumn("blk", F.pmod(F.xxhash64("rid"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    return (dealt.select("*", other)
            .withColumns({"blk_a": F.least("blk", "other"), "blk_b": F.greatest("blk", "other")}).drop("other", "blocks"))


def split_blocks(batch: pa.Table):
    """Row numbers of the two sides of a pair of blocks (the same rows twice for a block with itself)."""
    blk = batch.column("blk").to_numpy()
    a, b = batch.column("blk_a")[0].as_py(), batch.column("blk_b")[0].as_py()
    return np.flatnonzero(blk == a), np.flatnonzero(blk == b), a == b


def signature(column: pa.ChunkedArray, rows: np.ndarray) -> np.ndarray:
    """Rows of a binary column as signatures."""
    data = b"".join(x.as_py() for x in column.take(pa.array(rows)))
    return np.frombuffer(data, np.uint16).reshape(len(rows), HASHES)


def local_groups(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Linked ids, the least id of each one's connected group, and each one's number of links."""
    names, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = at[: len(a)], at[len(a):]
    root = np.arange(len(names))
    while True:
        least = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        new = np.minimum(new, new[new])
        if (new == root).all():
            return names, names[root], np.bincount(at, minlength=len(names)).astype(np.int64)
        root = new


def bucket_links(table: pa.Table) -> pa.Table:
    """Links (rid, root) that join the survivors of a pair of blocks of one bucket."""
    x, y, same = split_blocks(table)
    rid = table.column("rid").to_numpy()
    empty = pa.table({"rid": pa.array([], pa.int64()), "root": pa.array([], pa.int64())})
    if not len(x) or not len(y):
        return empty
    i, j = surviving(signature(table.column("sig"), x), signature(table.column("sig"), y))
    a, b = rid[x[i]], rid[y[j]]
    if same:
        a, b = a[i < j], b[i < j]
    names, root, _ = local_groups(a, b)
    moved = root != names
    return pa.table({"rid": names[moved], "root": root[moved]})


def group_of(links: DataFrame) -> DataFrame:
    """(rid, grp) for each linked row: smallest rid of its connected group, by rounds of
    neighbour minima with stored tables, until a round changes nothing."""
    edges = stored(links.select(F.col("rid").alias("u"), F.col("root").alias("v")).distinct(), "edges")
    both = edges.union(edges.select("v", "u"))
    label = stored(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("grp")), "labels")
    while True:
        # the smallest label around a row, then the label of that label (a row's group is itself a row)
        near = (both.join(label.withColumnRenamed("u", "v"), "v").groupBy("u").agg(F.min("grp").alias("near"))
                .join(label, "u").select("u", "grp", F.least("near", "grp").alias("next")))
        jump = label.select(F.col("u").alias("next"), F.col("grp").alias("far"))
        new = stored(near.join(jump, "next", "left").select("u", F.least("next", F.coalesce("far", "next")).alias("grp"),
                                                            (F.least("next", F.coalesce("far", "next")) < F.col("grp")).alias("moved")), "labels")
        changed = new.where("moved").limit(1).count()
        drop_stored(label)
        label = new.drop("moved")
        if not changed:
            drop_stored(edges)
            return label.withColumnRenamed("u", "rid")


def verified(table: pa.Table) -> pa.Table:
    """Links (rid, n_links, least rid of its group) that exact verification leaves in a pair of blocks."""
    x, y, same = split_blocks(table)
    if not len(x) or not len(y):
        return pa.table({"rid": pa.array([], pa.int64()), "n_links": pa.array([], pa.int64()), "root": pa.array([], pa.int64())})
    rid = table.column("rid").to_numpy()
    i, j = surviving(signature(table.column("sig"), x), signature(table.column("sig"), y))
    if same:
        i, j = i[i < j], j[i < j]
    column = table.column("shingles")
    sets = [[np.frombuffer(column[int(r)].as_py(), np.uint64) for r in side] for side in (x, y)]
    shared = set_overlaps(sets[0], sets[1], i, j)
    sizes = [np.array([len(s) for s in side]) for side in sets]
    # J >= 4/5 in whole numbers: 5 * |both| >= 4 * |either|
    good = 5 * shared >= 4 * (sizes[0][i] + sizes[1][j] - shared)
    a, b = rid[x[i[good]]], rid[y[j[good]]]
    names, root, count = local_groups(a, b)
    return pa.table({"rid": names, "n_links": count, "root": root})


def describe(batches):
    for batch in batches:
        for part in row_slices(batch, "text", 2 << 20):
            values, bounds, sequence = shingle_sets(*utf8(part.column("text")))
            sig = minhashes(values, bounds)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("text_key"), pa.array(sequence.view(np.int64)),
                 pa.array(np.diff(bounds) > 0), pa.array([s.tobytes() for s in sig], pa.binary())],
                names=["doc_id", "text_key", "seq", "worded", "sig"])


def bands(batches):
    for batch in batches:
        keys = band_keys(signature(pa.chunked_array([batch.column("sig")]), np.arange(batch.num_rows)))
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(batch.column("rid").to_numpy(), BANDS)), pa.array(keys.reshape(-1))],
                                         names=["rid", "bucket"])


def sets(batches):
    for batch in batches:
        for part in row_slices(batch, "text", 2 << 20):
            values, bounds, sequence = shingle_sets(*utf8(part.column("text")))
            own = [np.unique(values[bounds[i]: bounds[i + 1]]) for i in range(part.num_rows)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(sequence.view(np.int64)), pa.array([s.tobytes() for s in own], pa.binary()),
                 pa.array([len(s) for s in own], pa.int64())], names=["rid", "shingles", "n_set"])


def classified(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, rid (names the word sequence; null without words), rep_id, n_copies, n_links, grp."""
    rows = text_rows(docs)
    described = stored(rows.mapInArrow(describe, "doc_id long, text_key long, seq long, worded boolean, sig binary"), "minhash")
    reps = stored(described.where("worded").groupBy(F.col("seq").alias("rid")).agg(
        F.min(F.struct("doc_id", "text_key")).alias("rep"), F.min("doc_id").alias("rep_id"), F.count("*").alias("n_copies"),
        F.min("sig").alias("sig")), "reps")

    buckets = reps.select("rid", "sig").mapInArrow(bands, "rid long, bucket long")
    # buckets with the same members are compared once: count, least member and sum name the member set
    full = buckets.groupBy("bucket").agg(F.count("*").alias("n"), F.min("rid").alias("low"),
                                         F.sum(F.col("rid").cast("decimal(38,0)")).alias("total"))
    pick = full.where("n > 1").groupBy("n", "low", "total").agg(F.min("bucket").alias("bucket")).select("bucket")
    members = buckets.join(pick, "bucket", "left_semi").join(reps.select("rid", "sig"), "rid")
    work = block_pairs(stored(members, "members"), "bucket", None)
    groups = group_of(work.groupBy("bucket", "blk_a", "blk_b").applyInArrow(bucket_links, "rid long, root long"))

    grouped = groups.join(reps.select("rid", "sig", "rep"), "rid")
    wanted = grouped.select(F.col("rep.doc_id").alias("w_id"), F.col("rep.text_key").alias("w_key"))
    chosen = rows.join(wanted, F.col("doc_id").eqNullSafe(F.col("w_id")) & (F.col("text_key") == F.col("w_key")), "left_semi")
    found = chosen.select("text").mapInArrow(sets, "rid long, shingles binary, n_set long").dropDuplicates(["rid"])
    exact = block_pairs(stored(grouped.select("rid", "grp", "sig").join(found, "rid"), "sets"), "grp", "n_set")
    parts = stored(exact.groupBy("grp", "blk_a", "blk_b").applyInArrow(verified, "rid long, n_links long, root long"), "verified")
    counts = parts.groupBy("rid").agg(F.sum("n_links").alias("n_links"))
    classes = group_of(parts.select("rid", "root").where("rid != root"))
    info = (reps.select("rid", "rep_id", "n_copies").join(counts, "rid", "left").join(classes, "rid", "left")
            .withColumn("grp", F.coalesce("grp", "rid")).withColumn("n_links", F.coalesce("n_links", F.lit(0))))
    return described.select("doc_id", "text_key", F.when(F.col("worded"), F.col("seq")).alias("rid")).join(info, "rid", "left")


def jaccard_join(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, class_id (least doc_id of the texts reachable by links of
    similarity >= 0.8), rep_id (least doc_id with the same words), n_copies (rows with the same
    words), n_links (different word sequences that it is similar to)."""
    rows = stored(classified(docs), "classified")
    names = rows.where("rid IS NOT NULL").groupBy("grp").agg(F.min("doc_id").alias("class_id"))
    return rows.join(names, "grp", "left").select(
        "doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("rep_id", "doc_id").alias("rep_id"),
        F.coalesce("n_copies", F.lit(1)).alias("n_copies"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with their columns: of each class the one with the least doc_id
    (one of equal rows), and all rows without words."""
    rows = classified(docs)
    keep = (rows.where("rid IS NOT NULL").groupBy("grp").agg(F.min(F.struct("doc_id", "text_key")).alias("k"))
            .select(F.col("k.doc_id").alias("__k_id"), F.col("k.text_key").alias("__k_text")))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    worded = text.rlike("[^\\x20\\x09-\\x0D]")
    own = docs.withColumns({"__id": F.col("doc_id").cast("long"), "__text": F.xxhash64(text),
                            "__lone": F.when(~worded, F.monotonically_increasing_id())})
    kept = own.where("__lone IS NULL").join(
        keep, F.col("__id").eqNullSafe(F.col("__k_id")) & (F.col("__text") == F.col("__k_text")), "left_semi")
    kept = kept.dropDuplicates(["__id", "__text"])
    return kept.unionByName(own.where("__lone IS NOT NULL")).select(*docs.columns)
