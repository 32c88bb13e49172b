"""Vectors as one byte a part, with codebooks searched by Orchard's algorithm.

Entries become whole numbers floor(SCALE * entry), and a vector is cut into PARTS equal runs. Each part position has a codebook of
at most ENTRIES entries, first those of the least vec_ids. A round gives every part its nearest entry (squared distance, the
lower number of equals) and moves each used entry to the floor of its parts' mean; sums and counts are added up by Spark in whole numbers.

Search. For every entry the others stand sorted by their distance from it. A part walks along the list of its best entry so far;
an entry that is better makes the walk jump to its list, entries met before are marked and skipped, and the walk stops at
the first entry further away than twice the part's own distance, since by the triangle inequality none from there on is
nearer. All is in whole numbers, so the stop is exact and ties are found. The parts of an Arrow batch walk side by side.

Defined cases: see ``whole_vectors`` for null and non-finite vectors; vectors that don't divide into PARTS equal parts end
the job with a ValueError; with fewer rows than ENTRIES the codebooks have as many entries as rows; null vec_ids come last
among the first entries; repeated rows each count, and equal vec_ids are taken in the order of their vectors; rows without a label share one
sum; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from markerlens.llm.common import stored
from markerlens.llm.whole_vectors import grid, whole_rows, width_of

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
#: Parts that walk side by side.
BATCH = 8192


class Codebook:
    """Entries of one part position with the neighbours of each, nearest first."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        apart = ((entries[:, None, :] - entries[None, :, :]) ** 2).sum(2)
        self.order = np.argsort(apart, axis=1, kind="stable")
        self.apart = np.take_along_axis(apart, self.order, 1)
        # walks start at the entry that is next in the sum of its numbers
        self.by_sum = np.argsort(entries.sum(1), kind="stable")
        self.sums = entries.sum(1)[self.by_sum]

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest entry of each row and the squared distance."""
        code, error = np.empty(len(parts), np.int64), np.empty(len(parts), np.int64)
        for p in range(0, len(parts), BATCH):
            code[p: p + BATCH], error[p: p + BATCH] = self.walk(parts[p: p + BATCH])
        return code, error

    def walk(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        k = len(self.entries)
        best = self.by_sum[np.minimum(np.searchsorted(self.sums, q.sum(1)), k - 1)]
        error = ((q - self.entries[best]) ** 2).sum(1)
        marked = np.zeros((len(q), k), bool)
        marked[np.arange(len(q)), best] = True
        place = np.zeros(len(q), np.int64)
        walking = np.arange(len(q))
        while len(walking):
            # a walk ends with its list, or where entries are over twice as far from the best one (four times squared)
            at = place[walking]
            going = at < k
            going[going] = self.apart[best[walking[going]], at[going]] <= 4 * error[walking[going]]
            walking = walking[going]
            if not len(walking):
                break
            entry = self.order[best[walking], place[walking]]
            place[walking] += 1
            new = ~marked[walking, entry]
            who, entry = walking[new], entry[new]
            marked[who, entry] = True
            far = ((q[who] - self.entries[entry]) ** 2).sum(1)
            jump = (far < error[who]) | ((far == error[who]) & (entry < best[who]))
            who, entry = who[jump], entry[jump]
            best[who], error[who], place[who] = entry, far[jump], 0
        return best, error


def moved(rows: DataFrame, books: list[np.ndarray], width: int) -> list[np.ndarray]:
    """The codebooks after one round."""
    part = width // PARTS

    def assign(batches):
        made = [Codebook(b) for b in books]
        count = np.zeros((PARTS, len(books[0])), np.int64)
        total = np.zeros((PARTS, len(books[0]), part), np.int64)
        for batch in batches:
            x = grid(batch.column("x"), width)
            for p, book in enumerate(made):
                own = x[:, p * part: (p + 1) * part]
                code, _ = book.nearest(own)
                count[p] += np.bincount(code, minlength=len(book.entries))
                np.add.at(total[p], code, own)
        p, e = np.nonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(p.astype(np.int32)), pa.array(e.astype(np.int32)), pa.array(count[p, e]),
                                          pa.array(total[p, e].tolist(), pa.list_(pa.int64()))], names=["part", "entry", "n", "total"])

    sums = rows.select("x").mapInArrow(assign, "part int, entry int, n long, total array<long>")
    each = (sums.select("part", "entry", "n", F.posexplode("total").alias("place", "v"))
            .groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), F.sum("v").alias("v")))
    out = [b.copy() for b in books]
    for r in each.collect():  # PARTS * ENTRIES * numbers of a part at most
        out[r["part"]][r["entry"], r["place"]] = r["v"] // r["n"]
    return out


CODES = "vec_id long, label long, code string, error long"


def compress(vectors: DataFrame) -> DataFrame:
    """One row per row of ``vectors`` (vec_id, embedding, label): vec_id, code (two hex digits a part), error (squared distances of its
    parts), label_error (errors summed over rows of the label), codebooks_sha256 (of all final entries' numbers)."""
    rows = stored(whole_rows(vectors, SCALE, "label"), "whole")
    spark = rows.sparkSession
    width = width_of(rows)
    if not width:
        return spark.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    if width % PARTS:
        raise ValueError(f"vectors of {width} entries cannot be cut into {PARTS} equal parts")
    part = width // PARTS
    first = np.array([r["x"] for r in rows.orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(ENTRIES).select("x").collect()], np.int64)
    books = [first[:, p * part: (p + 1) * part] for p in range(PARTS)]
    for _ in range(ROUNDS):
        books = moved(rows, books, width)
    name = sha256(",".join(str(v) for b in books for v in b.reshape(-1).tolist()).encode()).hexdigest()

    def encode(batches):
        made = [Codebook(b) for b in books]
        for batch in batches:
            x = grid(batch.column("x"), width)
            found = [book.nearest(x[:, p * part: (p + 1) * part]) for p, book in enumerate(made)]
            codes = np.stack([c for c, _ in found], 1).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array([c.tobytes().hex() for c in codes], pa.string()),
                                              pa.array(sum(e for _, e in found))], names=["vec_id", "label", "code", "error"])

    coded = stored(rows.select("vec_id", F.col("label").cast("long").alias("label"), "x").mapInArrow(encode, CODES), "codes")
    of_label = stored(coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")), "labels")
    return (coded.join(of_label, F.col("label").eqNullSafe(F.col("of"))).select("vec_id", "code", "error", "label_error")
            .withColumn("codebooks_sha256", F.lit(name)))
