"""Best-fit packing of tokenised documents into sequences of fixed capacity.

Token ids come from the tokenizer library, asked once per different word and task: the tokenizer
drops white space and its splits never cross it, nor the place where an ASCII letter and a mark meet, so a
text's ids are its words' ids in a row. Packing
needs only how many pieces have each length, a table of at most CAPACITY rows: pieces over a third
of the capacity are matched greedily, at most two to a sequence, and smaller ones best-fit the gaps
that remain, the longest first. The plan (runs of equal pieces with their place) depends on the capacity
alone in size; each piece finds its place by its rank among the pieces of its length, and ranks come from
counts by hash bucket, so that a length that a third of all pieces have is not one task's work.

Defined cases: null and empty texts are the end token alone; repeated rows are packed each; an empty
table gives an empty result; texts of any length are cut into full pieces; extra columns are ignored.
"""

from __future__ import annotations

import os
import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from markerlens.llm.common import stored
from markerlens.llm.text_arrays import row_slices, utf8, word_hashes, word_spans

CAPACITY = 4096
END = 1
#: Different words that a task remembers before it starts anew, and pieces in a rank bucket, about.
MEMORY, BUCKET_ROWS = 1_200_000, 50_000


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
LETTERS = np.zeros(256, bool)
LETTERS[65:91] = LETTERS[97:123] = True
#: ASCII marks that the tokenizer always parts from an ASCII letter; not the apostrophe, nor what special strings hold.
MARKS = np.zeros(256, bool)
MARKS[list(b"!\"#$%&()*+,-./:;=?@[\\]^_`{}~")] = True


def token_spans(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, cut where an ASCII letter and a mark meet: start and end bytes, and the bounds of the texts."""
    starts, ends, bounds = word_spans(buf, offsets)
    if not len(starts):
        return starts, ends, bounds
    letter, mark = LETTERS[buf], MARKS[buf]
    meet = np.flatnonzero((letter[:-1] & mark[1:]) | (mark[:-1] & letter[1:])) + 1
    inner = meet[~np.isin(meet, offsets, assume_unique=False)]
    starts, ends = np.sort(np.concatenate([starts, inner])), np.sort(np.concatenate([ends, inner]))
    return starts, ends, np.searchsorted(starts, offsets)


class WordIds:
    """Ids of words, asked from the tokenizer once each and kept as one flat array."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.clear()

    def clear(self):
        self.names, self.slots = np.zeros(0, np.uint64), np.zeros(0, np.int64)  # sorted by name
        self.flat, self.used = np.zeros(1 << 16, np.uint32), 0
        self.first, self.count = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)

    def learn(self, names: np.ndarray, words: list[str]) -> None:
        base, at = len(self.names), np.searchsorted(self.names, names)
        self.names = np.insert(self.names, at, names)
        self.slots = np.insert(self.slots, at, np.arange(base, base + len(names)))
        while len(self.names) > len(self.first):
            self.first, self.count = (np.concatenate([x, np.zeros_like(x)]) for x in (self.first, self.count))
        for lo in range(0, len(words), 4096):
            ids = [e.ids for e in self.tokenizer.encode_batch_fast(words[lo: lo + 4096], add_special_tokens=False)]
            n = np.array([len(x) for x in ids], np.int64)
            total = int(n.sum())
            while self.used + total > len(self.flat):
                self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
            self.flat[self.used: self.used + total] = np.fromiter((i for x in ids for i in x), np.uint32, total)
            at = slice(base + lo, base + lo + len(ids))
            self.count[at], self.first[at] = n, self.used + np.cumsum(n) - n
            self.used += total

    def ids(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and the bounds of the texts."""
        starts, ends, bounds = token_spans(buf, offsets)
        data = buf.tobytes()
        if b"<|" not in data:  # special strings are told by case; all else the tokenizer lowers itself
            buf = LOWER[buf]
            data = buf.tobytes()
        names, first, of = np.unique(word_hashes(buf, starts, ends), return_index=True, return_inverse=True)
        if len(self.names) + len(names) > MEMORY:
            self.clear()
        new = np.flatnonzero(~np.isin(names, self.names, assume_unique=True))
        self.learn(names[new], [data[starts[j]: ends[j]].decode() for j in first[new]])
        slots = self.slots[np.searchsorted(self.names, names)][of]
        n = self.count[slots]
        stop = np.cumsum(n)
        where = np.repeat(self.first[slots] - (stop - n), n) + np.arange(int(stop[-1]) if len(stop) else 0)
        return self.flat[where], np.concatenate([[0], stop])[bounds]


_IDS: dict[str, WordIds] = {}
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """The pieces of each row's ids followed by END, at most ``capacity`` long."""

    def cut(batches):
        if tokenizer not in _IDS:
            _IDS[tokenizer] = WordIds(tokenizer)
        for batch in batches:
            for part in row_slices(batch, "text", 2 << 20):
                ids, bounds = _IDS[tokenizer].ids(*utf8(part.column("text")))
                rows = []
                for d, (lo, hi) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
                    own = np.append(ids[lo:hi], np.uint32(END)).astype("<u4")
                    for k, start in enumerate(range(0, len(own), capacity)):
                        one = own[start: start + capacity]
                        rows.append((d, k, start, len(one), zlib.crc32(one.tobytes())))
                cols = np.array(rows, np.int64).reshape(-1, 5)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(cols[:, 0])), pa.array(cols[:, 1].astype(np.int32)), *(pa.array(cols[:, c]) for c in (2, 3, 4))],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).mapInArrow(cut, PIECES)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Runs (length, first rank, pieces per sequence, first sequence, offset), by length and rank.

    Piece ``rank`` of a run's length stands in sequence first + (rank - first rank) // per."""
    left, used, runs, fresh = dict(counts), dict.fromkeys(counts, 0), [], 0
    gaps: dict[int, list[tuple[int, int]]] = {}  # room left -> groups (first sequence, sequences)
    sizes: list[int] = []

    def put(length, n, per, sequence, offset):
        runs.append((length, used[length], per, sequence, offset))
        used[length] += n
        left[length] -= n

    def room(gap, first, n):
        if gap and n:
            if gap not in gaps:
                gaps[gap] = []
                insort(sizes, gap)
            gaps[gap].append((first, n))

    large = sorted(x for x in counts if 3 * x > capacity)
    for a in reversed(large):
        while left[a]:
            fits = [b for b in large[: bisect_left(large, min(a, capacity - a) + 1)] if left[b]]
            b = fits[-1] if fits else 0
            if b == a and left[a] > 1:
                n = left[a] // 2
                put(a, 2 * n, 2, fresh, 0)
                room(capacity - 2 * a, fresh, n)
            else:
                b = next((x for x in reversed(fits) if x != a), 0)
                n = min(left[a], left[b]) if b else left[a]
                put(a, n, 1, fresh, 0)
                if b:
                    put(b, n, 1, fresh, a)
                room(capacity - a - b, fresh, n)
            fresh += n
    for length in sorted((x for x in counts if 3 * x <= capacity), reverse=True):
        while left[length]:
            at = bisect_left(sizes, length)
            if at == len(sizes):  # no gap is left: open what these pieces need
                n = -(-left[length] // (capacity // length))
                room(capacity, fresh, n)
                fresh += n
                at = bisect_left(sizes, capacity)
            gap = sizes[at]
            first, n = gaps[gap].pop()
            if not gaps[gap]:
                del gaps[gap], sizes[at]
            per = gap // length
            whole = min(n, left[length] // per)
            if whole:
                put(length, whole * per, per, first, capacity - gap)
                room(gap - per * length, first, whole)
            if whole < n and left[length]:  # fewer than ``per`` are left
                rest = left[length]
                put(length, rest, rest, first + whole, capacity - gap)
                room(gap - rest * length, first + whole, 1)
                whole += 1
            room(gap, first + whole, n - whole)
    return np.array(sorted(runs), np.int64).reshape(-1, 5)


def best_fit_packing(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: PIECES, sequence_id and offset."""
    cut = stored(pieces(docs, tokenizer, capacity), "pieces")
    counts = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}
    shared = docs.sparkSession.sparkContext.broadcast(plan(counts, capacity))
    buckets = max(64, -(-max(counts.values(), default=0) // BUCKET_ROWS))
    rows = cut.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)))
    sizes = rows.groupBy("length", "bucket").count()
    before = F.sum("count").over(Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    bases = sizes.select("length", "bucket", F.coalesce(before, F.lit(0)).alias("base"))
    number = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32"))
    ranked = rows.withColumn("number", number).join(bases, ["length", "bucket"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("number") - 1).alias("rank"))

    def place(batches):
        runs = shared.value
        keys = runs[:, 0] << 44 | runs[:, 1]
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            run = runs[np.searchsorted(keys, length << 44 | rank, "right") - 1] if len(length) else runs[:0]
            step = rank - run[:, 1]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(run[:, 3] + step // run[:, 2]), pa.array(run[:, 4] + step % run[:, 2] * length)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.mapInArrow(place, PIECES + ", sequence_id long, offset long")
