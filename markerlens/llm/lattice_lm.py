"""Language-model scoring with a subword lattice.

The pieces of an existing vocabulary get log probabilities from their counts in the training documents, and a
text's probability is the sum over all segmentations of its words into pieces (single bytes always
are pieces, so every text has one). Pieces do not cross words, so the sum factorises: the log-space
forward recursion runs once per different word of the corpus, in the task that holds the word, and a
text adds up its words. Word values reach the texts by blocks of texts: a block asks for each of its
different words once, so a frequent word costs a row per block, not per text.

A held-out text (crc32 of doc_id mod FOLDS is 0) is scored but not learnt from.

Defined cases: null and empty texts are the end token alone; a null doc_id is held out; repeated
rows are counted and scored each; an empty table gives an empty result; with no training rows
all counts are 0; extra columns are ignored. Words are told apart by a 64-bit hash when blocks ask.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from markerlens.llm.common import drop_stored, is_held_out, stored
from markerlens.llm.text_arrays import (BASES, mix, owners, powers, row_slices, segment_sums,
                                       span_hashes, utf8, word_hashes, word_spans)

FOLDS = 10
SMOOTHING = 0.1
PIECE_SMOOTHING = 0.5
BLOCK_BYTES = 16 << 20
#: Words up to this many bytes go through the recursion side by side.
SIDE_BY_SIDE = 48

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def strings_at(buf, starts, ends) -> pa.Array:
    """The byte spans as a string column."""
    n = ends - starts
    stop = np.cumsum(n)
    data = buf[np.repeat(starts - (stop - n), n) + np.arange(int(stop[-1]) if len(stop) else 0)]
    offsets = np.concatenate([[0], stop]).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(n), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))).cast(pa.string())


def word_counts(rows: DataFrame) -> DataFrame:
    """(word, c): all different words of the texts and their count in the training texts."""

    def count(batches):
        for batch in batches:
            for part in row_slices(batch, "text", 16 << 20):
                buf, offsets = utf8(part.column("text"))
                buf = LOWER[buf]
                starts, ends, bounds = word_spans(buf, offsets)
                train = (~part.column("held_out").to_numpy(zero_copy_only=False).astype(bool)).astype(np.int64)
                _, first, of = np.unique(word_hashes(buf, starts, ends), return_index=True, return_inverse=True)
                c = np.bincount(of, train[owners(bounds)], len(first)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([strings_at(buf, starts[first], ends[first]), pa.array(c)], names=["word", "c"])

    return rows.mapInArrow(count, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))


class Pieces:
    """The vocabulary as byte strings, with log10 probabilities by sorted hash."""

    def __init__(self, path: str):
        import sentencepiece

        self.path = path
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.spelled = []
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.spelled.append(bytes([int(piece[3:5], 16)]))
            else:
                self.spelled.append(b"" if sp.is_control(i) or sp.is_unknown(i) else piece.replace("▁", " ").encode())

    def weigh(self, counts: np.ndarray, n_ends: int) -> None:
        """Probabilities from counts, smoothed; bytes without a piece of their own get one; the end of a text counts too."""
        weight = {bytes([b]): PIECE_SMOOTHING for b in range(256)}
        for piece, c in zip(self.spelled, counts.tolist()):
            # a piece without a space inside can be met in a word; the space can only come first
            if piece and b" " not in piece[1:] and piece != b" ":
                weight[piece] = weight.get(piece, 0) + c + PIECE_SMOOTHING
        weight[b" "] = weight[b" "] + float(sum(c for p, c in zip(self.spelled, counts.tolist()) if p == b" "))
        total = sum(weight.values()) + n_ends + PIECE_SMOOTHING
        self.end = float(np.log10((n_ends + PIECE_SMOOTHING) / total))
        names = sorted(weight)
        self.most = max(map(len, names))
        data = np.frombuffer(b"".join(names), np.uint8)
        stop = np.cumsum([len(x) for x in names])
        start = np.concatenate([[0], stop[:-1]])
        keys = span_hashes(data, start, stop)
        order = np.argsort(keys)
        self.keys, self.logs = keys[order], np.log10(np.array([weight[x] for x in names]) / total)[order]

    def find(self, keys: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.logs[at], -np.inf)

    def windows(self, grid: np.ndarray):
        """For rows of bytes, a function (start, length) -> log probability of the piece there."""
        up, down = powers(BASES[0], grid.shape[1] + 1)
        sums = np.zeros((grid.shape[0], grid.shape[1] + 1), np.uint64)
        np.cumsum((grid.astype(np.uint64) + np.uint64(1)) * up[: grid.shape[1]], axis=1, out=sums[:, 1:])
        return lambda i, n: self.find(mix((sums[:, i + n] - sums[:, i]) * down[i] + np.uint64(n)))

    def side_by_side(self, grid: np.ndarray) -> np.ndarray:
        """log10 of the sum over all segmentations, for words of one length."""
        n, length = grid.shape
        at = self.windows(grid)
        alpha = np.full((n, length + 1), -np.inf)
        alpha[:, 0] = 0
        for i in range(length):
            for k in range(1, min(self.most, length - i) + 1):
                log = at(i, k)
                some = np.flatnonzero(log > -np.inf)
                if len(some):
                    alpha[some, i + k] = np.logaddexp(alpha[some, i + k] * LN10, (alpha[some, i] + log[some]) * LN10) / LN10
        return alpha[:, length]

    def alone(self, word: bytes) -> float:
        """The same for one long word."""
        data = np.frombuffer(word, np.uint8)
        alpha, found = [-np.inf] * (len(data) + 1), {}
        alpha[0] = 0.0
        up, down = powers(BASES[0], len(data) + 1)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)])])
        for k in range(1, min(self.most, len(data)) + 1):
            log = self.find(mix((sums[k:] - sums[:-k]) * down[: len(sums) - k] + np.uint64(k)))
            for i in np.flatnonzero(log > -np.inf).tolist():
                found.setdefault(i, []).append((k, float(log[i])))
        for i in range(len(data)):
            for k, log in found.get(i, ()):
                alpha[i + k] = float(np.logaddexp(alpha[i + k] * LN10, (alpha[i] + log) * LN10) / LN10)
        return alpha[-1]

    def score(self, words: pa.Array) -> np.ndarray:
        """log10 probability of each word with the space before it."""
        buf, offsets = utf8(words)
        n, out = np.diff(offsets) + 1, np.empty(len(words))
        order = np.argsort(n, kind="stable")
        sizes, first = np.unique(n[order], return_index=True)
        for size, lo, hi in zip(sizes.tolist(), first, np.append(first[1:], len(order))):
            rows = order[lo:hi]
            if size > SIDE_BY_SIDE:
                for r in rows:
                    out[r] = self.alone(b" " + buf[offsets[r]: offsets[r + 1]].tobytes())
                continue
            for at in range(0, len(rows), 8192):
                some = rows[at: at + 8192]
                grid = np.full((len(some), size), 32, np.uint8)
                grid[:, 1:] = buf[offsets[some][:, None] + np.arange(size - 1)]
                out[some] = self.side_by_side(grid)
        return out


LN10 = float(np.log(10))


def learnt_pieces(words: DataFrame, path: str, n_ends: int) -> Pieces:
    """The vocabulary weighed by its pieces' counts in the training words; a row per piece comes to the driver."""

    def split(batches):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        total = np.zeros(sp.get_piece_size())
        for batch in batches:
            c = batch.column("c").to_numpy()
            ids = sp.encode(batch.column("word").to_pylist(), num_threads=1)
            n = np.array([len(x) for x in ids], np.int64)
            flat = np.fromiter((i for x in ids for i in x), np.int64, int(n.sum()))
            total += np.bincount(flat, np.repeat(c, n), len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at].astype(np.int64))], names=["piece", "c"])

    pieces = Pieces(path)
    counts = np.zeros(len(pieces.spelled))
    for r in words.where("c > 0").mapInArrow(split, "piece long, c long").groupBy("piece").agg(F.sum("c").alias("c")).collect():
        counts[r["piece"]] = r["c"]
    pieces.weigh(counts, n_ends)
    return pieces


SCORES = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def lm_scores(docs: DataFrame, vocabulary: str) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): SCORES."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), is_held_out("doc_id", FOLDS).alias("held_out"), text.alias("text"))
    words = stored(word_counts(rows.select("held_out", "text")), "words")
    facts = rows.agg(F.sum(F.octet_length("text")).alias("bytes"), F.count(F.when(~F.col("held_out"), 1)).alias("ends")).first()
    seen = words.agg(F.sum("c").alias("n"), F.count(F.when(F.col("c") > 0, 1)).alias("v")).first()
    ends = facts["ends"]
    n, v = (seen["n"] or 0) + ends, seen["v"] + (ends > 0)
    norm = float(n + SMOOTHING * (v + 1))
    pieces = spark.sparkContext.broadcast(learnt_pieces(words, vocabulary, ends))

    def weigh(batches):
        for batch in batches:
            buf, offsets = utf8(batch.column("word"))
            keys = word_hashes(buf, offsets[:-1], offsets[1:])
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), batch.column("c"), pa.array(pieces.value.score(batch.column("word")))],
                                             names=["key", "c", "log"])

    model = stored(words.mapInArrow(weigh, "key long, c long, log double"), "model")
    drop_stored(words)
    blocks = max(1, -(-(facts["bytes"] or 0) // BLOCK_BYTES))
    parts = max(blocks, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = rows.withColumn("blk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks))).repartition(parts, "blk")

    def keys_of(column):
        buf, offsets = utf8(column)
        buf = LOWER[buf]
        starts, ends_, bounds = word_spans(buf, offsets)
        return word_hashes(buf, starts, ends_).view(np.int64), bounds

    def ask(table: pa.Table) -> pa.Table:
        keys = np.unique(keys_of(table.column("text"))[0])
        return pa.table({"blk": pa.array(np.full(len(keys), table.column("blk")[0].as_py(), np.int64)), "key": keys})

    def answer(texts: pa.Table, known: pa.Table) -> pa.Table:
        keys, bounds = keys_of(texts.column("text"))
        own = known.column("key").to_numpy()
        order = np.argsort(own)
        at = order[np.searchsorted(own, keys, sorter=order)] if len(keys) else np.zeros(0, np.int64)
        c, log = known.column("c").to_numpy()[at], known.column("log").to_numpy()[at]
        base = segment_sums(np.log10((c + SMOOTHING) / norm), bounds) + np.log10((ends + SMOOTHING) / norm)
        n_texts = len(bounds) - 1
        return pa.table({"doc_id": texts.column("doc_id"), "held_out": texts.column("held_out"),
                         "n_tokens": np.diff(bounds) + 1, "n_known": segment_sums((c > 0).astype(np.int64), bounds) + int(ends > 0),
                         "train_tokens": np.full(n_texts, n, np.int64), "base_score": base,
                         "score": segment_sums(log, bounds) + pieces.value.end})

    asked = dealt.groupBy("blk").applyInArrow(ask, "blk long, key long")
    answers = asked.join(model, "key").select("blk", "key", "c", "log")
    return dealt.groupBy("blk").cogroup(answers.groupBy("blk")).applyInArrow(answer, SCORES)
