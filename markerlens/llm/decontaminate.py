"""Benchmark decontamination by latent semantic retrieval.

Words are folded (case, ASCII marks) and hashed to 2^15 terms. Passages are windows over cells of
eight words; every cell of every document is indexed. The TF-IDF weights count the cells of all
documents. A randomised SVD of the TF-IDF vectors of the benchmark items and of all different passages
of the documents gives the latent space; an item without a vector in it is searched without it: Spark sums the partial products of the
power step, and the driver only orthogonalises a matrix of fixed size. Passages and benchmark items meet by
cosine in the whitened latent space; candidates are checked by the shared words that bound the longest
common subsequence, then by that, and doubtful ones (paraphrases) by whether the answer, the last sentence of the
item, stands in the passage.

The benchmark is the stated query set: it is taken in blocks of at most BLOCK_BYTES of text, each
searched against all rows.

Items of fewer than LEAST_WORDS words match where their whole run of folded words stands.

Defined cases: null and empty texts match nothing, items without a folded word neither; repeated rows match alike; empty tables give an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from markerlens.llm.common import drop_stored, stored, text_rows
from markerlens.llm.text_arrays import BASES, mix, owners, row_slices, utf8, window_hashes, word_hashes, word_spans

CELL = 8
TERMS = 1 << 15
RANK, EXTRA = 64, 8
PASSAGE_CELLS = 5
#: Passages whose weights are one dense block (of some hundred terms, in the processor's cache).
GRID_PASSAGES = 48
#: Nothing reads it any more (the space is fitted on all passages); a test sets it.
SAMPLE_WORDS = 2_000_000
COSINE = 0.5
#: Items of fewer folded words are matched exactly.
LEAST_WORDS = 8
#: Share of the item's words in the common subsequence: alone, and with the answer found.
SURE, LIKELY = 0.75, 0.5
BLOCK_BYTES = 8 << 20


def folding() -> np.ndarray:
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    for c in range(33, 128):
        if not chr(c).isalnum():
            t[c] = 32
    return t


FOLD = folding()


def folded_words(buf, offsets) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the folded words of the texts, and the bounds of the texts."""
    buf = FOLD[buf]
    starts, ends, bounds = word_spans(buf, offsets)
    return word_hashes(buf, starts, ends), bounds


def terms_of(words: np.ndarray) -> np.ndarray:
    return (words >> np.uint64(64 - 15)).astype(np.int32)


def cells_of(bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First word of each cell, and the bounds of the texts in cells; texts begin a cell."""
    counts = -(-np.diff(bounds) // CELL)
    cut = np.concatenate([[0], np.cumsum(counts)])
    place = np.arange(cut[-1]) - np.repeat(cut[:-1], counts)
    return np.repeat(bounds[:-1], counts) + place * CELL, cut


@dataclass
class Space:
    """IDF weights and the whitened projection (TERMS, RANK), already weighted by IDF."""

    idf: np.ndarray
    project: np.ndarray


def term_weights(rows: DataFrame) -> np.ndarray:
    """IDF over the cells of all documents."""

    def count(batches):
        df, cells = np.zeros(TERMS, np.int64), 0
        for batch in batches:
            for part in row_slices(batch, "text"):
                words, bounds = folded_words(*utf8(part.column("text")))
                first, _ = cells_of(bounds)
                if not len(words):
                    continue
                cell = np.zeros(len(words), np.int64)
                cell[first[1:]] = 1
                grid = np.full((len(first), CELL), TERMS, np.int64)
                cell = np.cumsum(cell)
                grid[cell, np.arange(len(words)) - first[cell]] = terms_of(words)
                grid.sort(axis=1)
                fresh = np.ones(grid.shape, bool)
                fresh[:, 1:] = grid[:, 1:] != grid[:, :-1]
                df += np.bincount(grid[fresh & (grid < TERMS)], minlength=TERMS)
                cells += len(first)
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(df[at], cells))], names=["term", "c"])

    got = {r["term"]: r["c"] for r in rows.select("text").mapInArrow(count, "term long, c long").groupBy("term").agg(F.sum("c").alias("c")).collect()}
    cells = got.pop(-1, 0)
    df = np.zeros(TERMS)
    df[list(got)] = list(got.values())
    return np.log((cells + 1) / (df + 1)) + 1


def passages(rows: DataFrame) -> DataFrame:
    """(hash, terms) of the passages of ``rows`` (text): their terms as int32."""

    def pick(batches):
        span = CELL * PASSAGE_CELLS
        for batch in batches:
            for part in row_slices(batch, "text", 1 << 20):
                words, bounds = folded_words(*utf8(part.column("text")))
                if not len(words):
                    continue
                place = np.arange(len(words)) - np.repeat(bounds[:-1], np.diff(bounds))
                cut = np.flatnonzero(place % span == 0)
                keys = mix(np.add.reduceat(mix(words + place.astype(np.uint64) % np.uint64(span) * np.uint64(BASES[0])), cut))
                at = np.append(cut, len(words)).astype(np.int32) * np.int32(4)
                terms = pa.Array.from_buffers(pa.binary(), len(cut), [None, pa.py_buffer(at.tobytes()), pa.py_buffer(terms_of(words).tobytes())])
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), terms], names=["hash", "terms"])

    return rows.select("text").mapInArrow(pick, "hash long, terms binary")


def grids(batches, idf: np.ndarray):
    """Blocks of GRID_PASSAGES passages as (terms, rows): the different terms of the block and the normalised TF-IDF weights of its
    passages over them, dense, so that a product with a basis is one of small matrices."""
    for batch in batches:
        column = batch.column("terms")
        if not len(column):
            continue
        column = column.cast(pa.large_binary())
        _, offsets, data = column.buffers()
        offsets = np.frombuffer(offsets, np.int64)[column.offset: column.offset + len(column) + 1]
        terms, cut = np.frombuffer(data, np.uint8)[offsets[0]: offsets[-1]].view(np.int32), (offsets - offsets[0]) // 4
        for lo in range(0, len(column), GRID_PASSAGES):
            hi = min(len(column), lo + GRID_PASSAGES)
            term, passage = terms[cut[lo]: cut[hi]], np.repeat(np.arange(hi - lo), np.diff(cut[lo: hi + 1]))
            seen = np.zeros(TERMS, bool)
            seen[term] = True
            names = np.flatnonzero(seen)
            place = np.empty(TERMS, np.int32)
            place[names] = np.arange(len(names), dtype=np.int32)
            w = idf[term]
            w /= np.sqrt(np.bincount(passage, w * w))[passage]
            yield names, np.bincount(passage * len(names) + place[term], w, (hi - lo) * len(names)).astype(np.float32).reshape(hi - lo, -1)


def fit(rows: DataFrame, benchmark: DataFrame) -> Space:
    """The latent space of ``rows`` and ``benchmark`` (text)."""
    spark = rows.sparkSession
    idf = term_weights(rows)
    items = benchmark.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    different = stored(passages(rows).union(passages(items)).dropDuplicates(["hash"]).select("terms"), "passages")
    width = RANK + EXTRA
    basis = np.random.default_rng(11).standard_normal((TERMS, width)).astype(np.float32)

    weights = spark.sparkContext.broadcast(idf)

    def multiplied(basis):
        """A'A basis, summed over the partitions, where the rows of A are normalised TF-IDF passages."""
        shared = spark.sparkContext.broadcast(basis)

        def partial(batches):
            out = np.zeros((TERMS, width), np.float32)
            for names, a in grids(batches, weights.value):
                out[names] += a.T @ (a @ shared.value[names])
            for lo in range(0, TERMS, 1024):
                yield pa.RecordBatch.from_arrays([pa.array([lo]), pa.array([out[lo: lo + 1024].tobytes()], pa.binary())], names=["lo", "data"])

        def total(table: pa.Table) -> pa.Table:
            s = sum(np.frombuffer(x.as_py(), np.float32).astype(np.float64) for x in table.column("data"))
            return pa.table({"lo": [table.column("lo")[0].as_py()], "data": pa.array([s.astype(np.float32).tobytes()], pa.binary())})

        out = np.zeros((TERMS, width), np.float32)
        for r in different.mapInArrow(partial, "lo long, data binary").groupBy("lo").applyInArrow(total, "lo long, data binary").collect():
            out[r["lo"]: r["lo"] + 1024] = np.frombuffer(r["data"], np.float32).reshape(-1, width)
        return out

    def inner(basis):
        """basis' A'A basis: the products of the rows of A basis, (width, width) a partition, summed in groups of partitions."""
        shared = spark.sparkContext.broadcast(basis)

        def partial(batches):
            out = np.zeros((width, width))
            for names, a in grids(batches, weights.value):
                y = a @ shared.value[names]
                out += y.T @ y
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), pa.array([r.tobytes() for r in out], pa.binary())], names=["lo", "data"])

        def total(table: pa.Table) -> pa.Table:
            s = sum(np.frombuffer(x.as_py(), np.float64) for x in table.column("data"))
            return pa.table({"lo": [table.column("lo")[0].as_py()], "data": pa.array([s.tobytes()], pa.binary())})

        out = np.zeros((width, width))
        for r in different.mapInArrow(partial, "lo long, data binary").groupBy("lo").applyInArrow(total, "lo long, data binary").collect():
            out[r["lo"]] = np.frombuffer(r["data"])
        return out

    basis = np.linalg.qr(multiplied(basis))[0].astype(np.float32)
    small = inner(basis)
    drop_stored(different)
    values, vectors = np.linalg.eigh((small + small.T) / 2)
    values, vectors = values[::-1][:RANK], vectors[:, ::-1][:, :RANK]
    scale = np.where(values > 1e-6 * max(values[0], 1e-30), 1 / np.sqrt(np.maximum(values, 1e-30)), 0)
    return Space(idf, (idf[:, None] * (basis @ vectors) * scale).astype(np.float32))


def unit(m: np.ndarray) -> np.ndarray:
    return m / np.maximum(np.sqrt((m * m).sum(1, keepdims=True)), 1e-12)


@dataclass
class Item:
    item_id: int
    words: np.ndarray
    answer: np.ndarray

    def index(self) -> None:
        """Counts of the different terms in order, and the place of each term (0: none)."""
        names, at = np.unique(terms_of(self.words), return_inverse=True)
        self.counts = np.bincount(at)
        self.place = np.zeros(TERMS, np.uint16)
        self.place[names] = np.arange(1, len(names) + 1)


def item_of(item_id, text: str) -> Item | None:
    """An item with its folded words; the answer is its last sentence, a third of its words at most."""

    def words(t):
        data = np.frombuffer(t.encode(), np.uint8)
        return folded_words(data, np.array([0, len(data)]))[0]

    own = words(text or "")
    if not len(own):
        return None
    sentences = [w for w in map(words, re.split(r"(?<=[.!?])\s+", text.strip())) if len(w)]
    return Item(item_id, own, sentences[-1][-max(1, len(own) // 3):])


def common_lengths(item: np.ndarray, passages: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """Length of the longest common subsequence of the item with each row of passages."""
    row = np.zeros((len(passages), passages.shape[1] + 1), np.int16)
    for x in item:
        match = row[:, :-1] + ((passages == x) & inside)
        np.maximum(row[:, 1:], match, out=row[:, 1:])
        np.maximum.accumulate(row, axis=1, out=row)
    return row[:, -1]


def contains(run: np.ndarray, words: np.ndarray) -> bool:
    n = len(words) - len(run) + 1
    return n > 0 and bool(np.logical_and.reduce([words[i: i + n] == x for i, x in enumerate(run)]).any())


class Searcher:
    """Items of a block by their window width in cells, with their latent vectors; short ones by hash."""

    def __init__(self, space: Space, items: list[Item]):
        self.id, self.space, self.by_width = uuid.uuid4().hex, space, {}
        runs: dict[int, list[tuple[int, int]]] = {}
        for it in items:
            m = len(it.words)
            if m < LEAST_WORDS:
                runs.setdefault(m, []).append((int(window_hashes(it.words, m)[0]), it.item_id))
                continue
            it.index()
            self.by_width.setdefault(-(-(len(it.words) + CELL - 1) // CELL), []).append(it)
        self.vectors = {c: unit(np.stack([space.project[terms_of(i.words)].sum(0) for i in g])) for c, g in self.by_width.items()}
        for g in runs.values():
            g.sort(key=lambda run: run[0])  # item ids may be null
        self.short = {m: (np.array([h for h, _ in g], np.uint64), [i for _, i in g]) for m, g in runs.items()}
        self.unplaced = {c: ~v.any(1) for c, v in self.vectors.items()}

    def search(self, buf, offsets) -> list[tuple]:
        """(text index, item id, common words, item words, answer found) of the leaks; the best for each pair."""
        words, bounds = folded_words(buf, offsets)
        if not len(words):
            return []
        best: dict[tuple, tuple] = {}
        owner = owners(bounds)
        for m, (runs, ids) in self.short.items():
            if len(words) < m:
                continue
            hashes = window_hashes(words, m)
            lo, hi = np.searchsorted(runs, hashes), np.searchsorted(runs, hashes, "right")
            for at in np.flatnonzero((hi > lo) & (owner[: len(hashes)] == owner[m - 1:])):
                for k in range(lo[at], hi[at]):
                    best[int(owner[at]), ids[k]] = (m, m, True)
        if not self.by_width:
            return [(d, i, *v) for (d, i), v in best.items()]
        first, cut = cells_of(bounds)
        of = np.repeat(np.arange(len(cut) - 1), np.diff(cut))
        term = terms_of(words)
        vectors = np.empty((len(first), RANK), np.float32)
        ends = np.append(first[1:], len(words))
        for lo in range(0, len(first), 4096):
            hi = min(len(first), lo + 4096)
            vectors[lo:hi] = np.add.reduceat(self.space.project[term[first[lo]: ends[hi - 1]]], first[lo:hi] - first[lo])
        widest = max(self.by_width, default=0)
        for lo in range(0, len(first), 8192):
            at = np.arange(lo, min(len(first), lo + 8192))
            over = min(len(first), lo + 8192 + widest)
            sums = np.zeros((over - lo + 1, RANK), np.float32)
            np.cumsum(vectors[lo:over], axis=0, out=sums[1:])
            for width, items in self.by_width.items():
                stop = np.minimum(at + width, cut[of[at] + 1])
                window = sums[stop - lo]
                window -= sums[: len(at)]
                # the cosine times the window's length, so that no second array of windows is made
                length = np.maximum(np.sqrt(np.einsum("ij,ij->i", window, window)), 1e-12)
                near = window @ self.vectors[width].T >= COSINE * length[:, None]
                near |= self.unplaced[width]
                for k in np.flatnonzero(near.any(0)):
                    hit = at[near[:, k]]
                    self.verify(items[k], hit, words, term, first, np.minimum(first[hit] + width * CELL, bounds[of[hit] + 1]), of, best)
        return [(d, i, *v) for (d, i), v in best.items()]

    @staticmethod
    def verify(item: Item, hit, words, term, first, stops, of, best) -> None:
        m = len(item.words)
        size = stops - first[hit]
        grid = np.minimum(first[hit][:, None] + np.arange(size.max()), len(words) - 1)
        inside = np.arange(size.max()) < size[:, None]
        place = np.where(inside, item.place[term[grid]], 0)
        some = np.flatnonzero((place > 0).sum(1) >= LIKELY * m)
        if not len(some):
            return
        row, col = np.nonzero(place[some])
        bag = np.bincount(row * len(item.counts) + place[some][row, col] - 1, minlength=len(some) * len(item.counts))
        bag = np.minimum(bag.reshape(len(some), -1), item.counts)  # its size bounds the common subsequence
        stay = some[bag.sum(1) >= LIKELY * m]
        if not len(stay):
            return
        common = common_lengths(item.words, words[grid[stay]], inside[stay])
        for h, c in zip(stay[common >= LIKELY * m].tolist(), common[common >= LIKELY * m].tolist()):
            answered = contains(item.answer, words[first[hit[h]]: stops[h]])
            if c >= SURE * m or answered:
                key = (int(of[hit[h]]), item.item_id)
                best[key] = max(best.get(key, (0, m, False)), (c, m, answered))


def item_blocks(benchmark: DataFrame):
    """Blocks of items of about BLOCK_BYTES of text; the driver holds one block at a time."""
    block, size = [], 0
    for r in benchmark.select("item_id", "text").toLocalIterator():
        if (it := item_of(r["item_id"], r["text"])) is not None:
            block, size = [*block, it], size + len(r["text"])
            if size >= BLOCK_BYTES:
                yield block
                block, size = [], 0
    if block:
        yield block


LEAKS = "doc_id long, item_id long, common_words long, item_words long, answer_found boolean"


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each document and benchmark item that stands in it, word for word or paraphrased."""
    spark, rows = docs.sparkSession, text_rows(docs)
    space = fit(rows, benchmark)

    def search_block(items):
        shared = spark.sparkContext.broadcast(Searcher(space, items))

        def run(batches):
            for batch in batches:
                for part in row_slices(batch, "text", 2 << 20):
                    found = shared.value.search(*utf8(part.column("text")))
                    doc = part.column("doc_id").take(pa.array([f[0] for f in found], pa.int64()))
                    rest = [pa.array([f[i] for f in found], t) for i, t in ((1, pa.int64()), (2, pa.int64()), (3, pa.int64()), (4, pa.bool_()))]
                    yield pa.RecordBatch.from_arrays([doc, *rest], names=["doc_id", "item_id", "common_words", "item_words", "answer_found"])

        return rows.select("doc_id", "text").mapInArrow(run, LEAKS)

    out = spark.createDataFrame([], LEAKS)
    for items in item_blocks(benchmark):
        out = out.union(search_block(items))
    return out


def keep_uncontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` in which no benchmark item stands, with their columns; no shuffle."""
    spark = docs.sparkSession
    space = fit(text_rows(docs), benchmark)
    for items in item_blocks(benchmark):
        shared = spark.sparkContext.broadcast(Searcher(space, items))

        def run(batches, shared=shared):
            for batch in batches:
                for part in row_slices(batch, "text", 2 << 20):
                    good = np.ones(part.num_rows, bool)
                    good[[f[0] for f in shared.value.search(*utf8(part.column("text")))]] = False
                    yield part.filter(pa.array(good))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
