"""Quality rules with n-gram perplexity bands.

A modified Kneser-Ney model over 4-grams of code points (lower case; ASCII digits, white space and marks
are a symbol each) is counted by Spark for each language, with as many rows as the corpus has different
4-grams. Counting is by exact keys: three code points are 63 bits, so no two grams are counted as one. Orders
are joined by Spark; each gram is scored without one occurrence of its own, so that a text can't vouch for
itself. The finished model is stored as sorted hash arrays, one row for each range of hashes: the 64-bit
hashes of the grams in order and their bits. (Among 10^9 different grams, two share a hash with probability
0.03; one of them then has the other's bits.) The texts of a language are dealt into blocks of about
BLOCK_BYTES; a block asks for each of its different grams once, and the arrays answer by binary search.
A block is worked on in slices of SLICE code points, a text longer than a slice in several.
The distribution of bits per letter of all documents of a language gives its bands; a document outside
its language's band is rejected, as is one that fails the base rules. Every language has its own model and
band, whatever its share; a small one leans on the model and the deviations of all rows by its counts.

Defined cases: null or empty text has no words and fails the base rule; null language is a
language of its own; repeated rows are judged alike; an empty table gives an empty result; extra
columns are ignored (``keep_clean`` passes them through).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from markerlens.llm.common import drop_stored, stored
from markerlens.llm.text_arrays import mix, owners, row_slices, segment_sums, utf8, window_hashes, word_hashes, word_spans

ORDER = 4
#: Bits of a code point; of a symbol in the small dense model.
POINT, BITS = 21, 5
BLOCK_BYTES = 8 << 20
#: Code points that are worked on at once.
SLICE = 1 << 20
#: Keys below this number are counted in place; others are sorted.
DENSE = 1 << 22
#: Tables of a row a language are broadcast up to so many languages, about 64 MB.
MOST_MODELS = 500_000
#: Below the order 1: as many symbols as there are assigned characters, about.
UNIFORM = 1 / (1 << 17)
NO_LANGUAGE = "\x00none"
#: The model of all rows; a language's model is mixed with it, so that a passage in another language isn't junk.
EVERY = "\x00every"
#: A language of n symbols has the weight OWN_WEIGHT * n / (n + PRIOR_TEXT) in the mixture.
OWN_WEIGHT = 0.5
PRIOR_TEXT = 20_000
#: As many documents does the common deviation count for in that of a language.
PRIOR_DOCS = 30
#: Half width of a band in robust standard deviations, and the least such deviation in bits.
BAND_WIDTH = 4.5
LEAST_DEVIATION = 0.05
#: Symbols of evidence at the median that a document's own bits are averaged with.
PRIOR_SYMBOLS = 200
REPEAT_WORDS = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
SYMBOLS = b"#*$%&|<>"


def symbol_table() -> np.ndarray:
    """Code point to symbol, itself a code point: lower case; one for white space, for digits, for sentence
    marks and for all other ASCII. Code points behind the table, which have no case, stand for themselves."""
    t = np.arange(0x1F000, dtype=np.int32)
    t[:128] = ord("#")
    t[[32, 9, 10, 11, 12, 13]] = ord(" ")
    t[48:58] = ord("0")
    t[list(b".,;:!?'()-\"")] = ord(".")
    for c in [*range(65, 91), *range(97, 123), *range(128, len(t))]:
        low = chr(c).lower()
        t[c] = ord(low) if len(low) == 1 else c
    return t


_TABLE: list[np.ndarray] = []


def symbols_of(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbol of each code point of the texts, and the bounds of the texts in code points."""
    if not _TABLE:
        _TABLE.append(symbol_table())
    table = _TABLE[0]
    lead = lambda a, b: (buf[a:b] & 0xC0) != 0x80
    out = np.empty(sum(np.count_nonzero(lead(a, b)) for a, b in slices(len(buf))), np.int32)
    bounds, n = np.full(len(offsets), len(out), np.int64), 0
    for a, b in slices(len(buf)):  # whole columns of 64-bit places would take many times the texts' bytes
        heads = np.zeros(b - a + 1, np.int64)
        np.cumsum(lead(a, b), out=heads[1:])
        lo, hi = np.searchsorted(offsets, [a, b])
        bounds[lo:hi] = n + heads[offsets[lo:hi] - a]
        if heads[-1] == b - a and buf[a:b].max() < 128:
            point = table[buf[a:b]]
        else:
            point = decoded(buf, a + np.flatnonzero(lead(a, b)))
            small = point < len(table)
            point[small] = table[point[small]]
        out[n: n + len(point)] = point
        n += len(point)
    return out, bounds


def decoded(buf: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The code points that begin at the places ``at``."""
    first = buf[at].astype(np.int32)
    size = 1 + (first >= 0xC0) + (first >= 0xE0) + (first >= 0xF0)
    point = np.where(first < 0x80, first, first & (0x7F >> size))
    for k in (1, 2, 3):
        more = np.flatnonzero(size > k)
        point[more] = point[more] << 6 | (buf[np.minimum(at[more] + k, len(buf) - 1)] & 0x3F)
    return point


def slices(n: int):
    """Bounds of the slices of ``n`` code points."""
    return ((a, min(a + SLICE, n)) for a in range(0, n, SLICE))


class Grams:
    """The 4-grams of texts of one language. A key is the ranks of its two pairs of symbols, so equal texts
    in any order have equal keys. Texts start after spaces."""

    def __init__(self, texts):
        self.buf, self.offsets = utf8(texts)
        self.symbols, self.bounds = symbols_of(self.buf, self.offsets)
        size = max(33, int(self.symbols.max(initial=0)) + 1)
        seen = np.zeros(size, np.int64)
        for a, b in slices(len(self.symbols)):
            seen += np.bincount(self.symbols[a:b], minlength=size)
        seen[32] += 1
        self.names = np.flatnonzero(seen)
        n = len(self.names)
        dense = np.zeros(size, np.int64)
        dense[self.names] = np.arange(n)
        space = dense[32]
        blank = space * n + space
        starts = self.bounds[:-1][self.bounds[:-1] < self.bounds[1:]]

        def pairs(a, b):
            out = dense[self.symbols[a:b]]
            out[1:] += out[:-1] * n
            if a:
                out[0] += dense[self.symbols[a - 1]] * n
            own = starts[np.searchsorted(starts, a):np.searchsorted(starts, b)]
            out[own - a] = space * n + dense[self.symbols[own]]
            return out

        self.rank = np.empty(len(self.symbols), np.int32)
        if n * n <= DENSE:
            found = np.zeros(n * n, bool)
            for a, b in slices(len(self.symbols)):
                found[pairs(a, b)] = True
            found[blank] = True
            self.pairs = np.flatnonzero(found)
            place = np.zeros(n * n, np.int32)
            place[self.pairs] = np.arange(len(self.pairs), dtype=np.int32)
            for a, b in slices(len(self.symbols)):
                self.rank[a:b] = place[pairs(a, b)]
            self.blank = int(place[blank])
        else:
            self.pairs = np.unique(np.concatenate([[blank], *[np.unique(pairs(a, b)) for a, b in slices(len(self.symbols))]]))
            for a, b in slices(len(self.symbols)):
                self.rank[a:b] = np.searchsorted(self.pairs, pairs(a, b))
            self.blank = int(np.searchsorted(self.pairs, blank))

    def keys(self, a: int, b: int) -> np.ndarray:
        """Keys of the 4-grams that end at the symbols from a to b."""
        head = np.full(b - a, self.blank, np.int64)
        early = self.rank[max(a - 2, 0):max(b - 2, 0)]
        head[b - a - len(early):] = early
        for k in (0, 1):
            at = self.bounds[:-1] + k
            at = at[(at < self.bounds[1:]) & (at >= a) & (at < b)]
            head[at - a] = self.blank
        return head * len(self.pairs) + self.rank[a:b]

    def counted(self) -> tuple[np.ndarray, np.ndarray]:
        """The different keys in order, and their counts."""
        size = len(self.pairs) ** 2
        if size <= DENSE:
            total = np.zeros(size, np.int64)
            for a, b in slices(len(self.symbols)):
                total += np.bincount(self.keys(a, b), minlength=size)
            keys = np.flatnonzero(total)
            return keys, total[keys]
        parts = [np.unique(self.keys(a, b), return_counts=True) for a, b in slices(len(self.symbols))]
        keys, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
        counts = np.zeros(len(keys), np.int64)
        np.add.at(counts, at, np.concatenate([c for _, c in parts]))
        return keys, counts

    def parts(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Context of three symbols and last symbol of each key."""
        n = len(self.names)
        head, tail = self.pairs[keys // len(self.pairs)], self.pairs[keys % len(self.pairs)]
        point = lambda x: self.names[x]
        context = point(head // n) << (2 * POINT) | point(head % n) << POINT | point(tail // n)
        return context, point(tail % n).astype(np.int32)

    def sums(self, keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per text, the sum of the values of its grams, and the number of its symbols other than marks."""
        total, letters = np.zeros(len(self.bounds) - 1), np.zeros(len(self.bounds) - 1, np.int64)
        size = len(self.pairs) ** 2
        place = None
        if size <= DENSE:
            place = np.zeros(size, np.int32)
            place[keys] = np.arange(len(keys), dtype=np.int32)
        for a, b in slices(len(self.symbols)):
            part = self.keys(a, b)
            at = place[part] if place is not None else np.searchsorted(keys, part)
            inside = np.clip(self.bounds, a, b) - a
            total += segment_sums(values[at], inside)
            symbols = self.symbols[a:b]
            letters += segment_sums(((symbols != ord(".")) & (symbols != ord("#"))).astype(np.int64), inside)
        return total, letters


# -- model -------------------------------------------------------------------------------------


@dataclass
class Model:
    """The same estimate over 32 symbols in one table, to hold the joined orders against: sorted keys and
    counts by order, raw counts for the highest, continuation counts below."""

    keys: dict[int, np.ndarray]
    counts: dict[int, np.ndarray]

    def find(self, order: int, query: np.ndarray) -> np.ndarray:
        keys = self.keys[order]
        if not len(keys):
            return np.zeros(len(query), np.float64)
        at = np.minimum(np.searchsorted(keys, query), len(keys) - 1)
        return np.where(keys[at] == query, self.counts[order][at], 0).astype(np.float64)

    def discounts(self, order: int) -> np.ndarray:
        """D(0..3+) of modified Kneser-Ney from the counts of counts, held within [0, count]."""
        n = [0.0] + [float((self.counts[order] == k).sum()) for k in range(1, 5)]
        y = n[1] / (n[1] + 2 * n[2]) if n[1] + n[2] else 0.5
        d = [0.0]
        for k in (1, 2, 3):
            d.append(min(max(k - (k + 1) * y * n[k + 1] / n[k], 0.1), k - 0.1) if n[k] else 0.5)
        return np.array(d)

    def probabilities(self) -> np.ndarray:
        """p(last symbol | the symbols before) for each of the 2^20 keys."""
        size = 1 << BITS
        p = np.full(size, 1.0 / size)
        for order in range(1, ORDER + 1):
            c = self.find(order, np.arange(size ** order)).reshape(-1, size)
            d = self.discounts(order)
            lower = np.tile(p, (size, 1)).reshape(-1, size) if order > 1 else p.reshape(1, size)
            total = c.sum(1, keepdims=True)
            held = sum(d[k] * ((c == k) if k < 3 else (c >= 3)).sum(1, keepdims=True) for k in (1, 2, 3))
            own = np.maximum(c - d[np.minimum(c, 3).astype(int)], 0)
            with np.errstate(invalid="ignore", divide="ignore"):
                mixed = own / total + held / total * lower
            p = np.where(total > 0, mixed, lower).reshape(-1)
        return p


def orders(grams: DataFrame, small=F.broadcast) -> DataFrame:
    """(model, ctx, w, p, q): p(w | ctx) of each 4-gram (model, ctx, w, c), and q, the same when one occurrence
    is taken away. A row joins as many others as there are symbols at most. ``small`` marks a table of a row a model."""
    counts = [grams]
    for order in range(ORDER - 1, 0, -1):
        shorter = F.col("ctx").bitwiseAND(F.lit((1 << (POINT * (order - 1))) - 1))
        counts.append(counts[-1].groupBy("model", shorter.alias("ctx"), "w").agg(F.count("*").alias("c")))
    lower = None
    for order, table in zip(range(1, ORDER + 1), reversed(counts)):
        of = table.groupBy("model").agg(*[F.count(F.when(F.col("c") == k, 1)).alias(f"k{k}") for k in range(1, 5)])
        y = F.when(F.col("k1") + F.col("k2") > 0, F.col("k1") / (F.col("k1") + 2 * F.col("k2"))).otherwise(0.5)
        bound = lambda k: F.least(F.greatest(k - (k + 1) * y * F.col(f"k{k + 1}") / F.col(f"k{k}"), F.lit(0.1)), F.lit(k - 0.1))
        of = of.select("model", *[F.when(F.col(f"k{k}") > 0, bound(k)).otherwise(0.5).alias(f"d{k}") for k in (1, 2, 3)])
        same = Window.partitionBy("model", "ctx")
        classes = [F.col("c") == 1, F.col("c") == 2, F.col("c") >= 3]
        rows = table.select("*", F.sum("c").over(same).alias("total"),
                            *[F.sum(x.cast("long")).over(same).alias(f"n{k}") for k, x in enumerate(classes, 1)])
        rows = rows.join(small(of), "model")
        if lower is None:
            rows = rows.select("*", F.lit(UNIFORM).alias("lp"), F.lit(UNIFORM).alias("lq"))
        else:
            rows = rows.withColumn("low", F.col("ctx").bitwiseAND(F.lit((1 << (POINT * (order - 2))) - 1)))
            rows = rows.join(lower.select("model", F.col("ctx").alias("low"), "w", F.col("p").alias("lp"), F.col("q").alias("lq")), ["model", "low", "w"])
        n = [F.col(f"n{k}") for k in (1, 2, 3)]
        less = [n[0] - (F.col("c") == 1).cast("long") + (F.col("c") == 2).cast("long"),
                n[1] - (F.col("c") == 2).cast("long") + (F.col("c") == 3).cast("long"), n[2] - (F.col("c") == 3).cast("long")]
        lower = rows.select("model", "ctx", "w",
                            estimate(F.col("c"), F.col("total"), n, F.col("lp")).alias("p"),
                            estimate(F.col("c") - 1, F.col("total") - 1, less, F.when(F.col("c") == 1, F.col("lq")).otherwise(F.col("lp"))).alias("q"))
    return lower


def estimate(c: Column, total: Column, n: list[Column], lower: Column) -> Column:
    """Interpolated probability from a count, its context's total and numbers of counts 1, 2, 3 and more."""
    d = [F.col(f"d{k}") for k in (1, 2, 3)]
    cut = F.when(c <= 0, 0.0).when(c == 1, d[0]).when(c == 2, d[1]).otherwise(d[2])
    held = d[0] * n[0] + d[1] * n[1] + d[2] * n[2]
    return F.when(total > 0, F.greatest(c - cut, F.lit(0.0)) / total + held / total * lower).otherwise(lower)


def gram_bits(rows: DataFrame, small=F.broadcast) -> tuple[DataFrame, DataFrame]:
    """(model, ctx, w, bits) of every different 4-gram of ``rows`` (model, text), and the stored counts it reads."""

    def count(batches):
        for batch in batches:
            for part in row_slices(batch, "text", BLOCK_BYTES):
                models = part.column("model").to_numpy()
                order = np.argsort(models, kind="stable")
                cuts = np.flatnonzero(np.diff(models[order])) + 1
                for which in np.split(order, cuts):
                    grams = Grams(part.column("text").take(pa.array(which)))
                    keys, counts = grams.counted()
                    model = np.full(len(keys), models[which[0]])
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (model, *grams.parts(keys), counts)], names=["model", "ctx", "w", "c"])

    found = rows.mapInArrow(count, "model long, ctx long, w int, c long").groupBy("model", "ctx", "w").agg(F.sum("c").alias("c"))
    grams = stored(found, "grams")
    name = F.xxhash64(F.lit(EVERY))
    both = grams.union(grams.groupBy(name.alias("model"), "ctx", "w").agg(F.sum("c").alias("c")))
    p = orders(both, small).select("model", "ctx", "w", "q")
    every = p.where(F.col("model") == name).select("ctx", "w", F.col("q").alias("every"))
    own = grams.groupBy("model").agg(F.sum("c").alias("size"))
    mixed = p.where(F.col("model") != name).join(every, ["ctx", "w"]).join(small(own), "model")
    weight = OWN_WEIGHT * F.col("size") / (F.col("size") + PRIOR_TEXT)
    bits = -F.log2(weight * F.col("q") + (1 - weight) * F.col("every"))
    return mixed.select("model", "ctx", "w", bits.alias("bits")), grams


def hash_arrays(bits: DataFrame, ranges: int) -> DataFrame:
    """(bucket, hashes, bits): the model, a row for each of ``ranges`` classes of hashes. The 64-bit hashes
    of the grams in order and their bits, as little-endian arrays."""

    def build(table: pa.Table) -> pa.Table:
        h, value = table.column("h").to_numpy(), table.column("bits").to_numpy()
        order = np.argsort(h)
        return pa.table({"bucket": pa.array([table.column("bucket")[0].as_py()], pa.int32()), "hashes": pa.array([h[order].tobytes()], pa.binary()),
                         "bits": pa.array([value[order].tobytes()], pa.binary())})

    return hashed(bits, ranges).select("bucket", "h", "bits").groupBy("bucket").applyInArrow(build, "bucket int, hashes binary, bits binary")


def hashed(grams: DataFrame, ranges: int) -> DataFrame:
    """``grams`` with the hash h of (model, ctx, w) and its class."""
    h = F.xxhash64("model", "ctx", "w")
    return grams.withColumn("h", h).withColumn("bucket", F.pmod(F.shiftright("h", 20), F.lit(ranges)).cast("int"))


# -- rules -------------------------------------------------------------------------------------


def repeated_words(values: np.ndarray, bounds: np.ndarray, k: int = REPEAT_WORDS) -> np.ndarray:
    """Per text, words inside k-word windows that the same text holds twice or more."""
    n = len(values) - k + 1
    if n <= 0:
        return np.zeros(len(bounds) - 1, np.int64)
    of = owners(bounds)
    inside = np.flatnonzero(of[:n] == of[k - 1:])
    keys = mix(window_hashes(values, k)[inside] + of[inside].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(keys)
    same = keys[order][1:] == keys[order][:-1]
    hit = np.zeros(len(inside), bool)
    hit[order[1:][same]] = True
    hit[order[:-1][same]] = True
    cover = np.zeros(len(values) + 1, np.int64)
    starts = inside[hit]
    np.add.at(cover, starts, 1)
    np.add.at(cover, starts + k, -1)
    return segment_sums((np.cumsum(cover[:-1]) > 0).astype(np.int64), bounds)


def repeated_lines(buf, offsets, starts, bounds) -> np.ndarray:
    """Per text, lines with a word that equal an earlier line of the text."""
    newline = np.flatnonzero(buf == 10)
    begins = np.unique(np.concatenate([offsets[:-1], newline + 1]))
    begins = begins[begins < len(buf)]
    if not len(begins):
        return np.zeros(len(offsets) - 1, np.int64)
    nexts = np.append(begins[1:], len(buf))
    ends = nexts - ((buf[nexts - 1] == 10) & (nexts > begins))
    worded = np.searchsorted(starts, ends) > np.searchsorted(starts, begins)
    begins, ends = begins[worded], ends[worded]
    of = np.searchsorted(offsets, begins, "right") - 1
    keys = mix(word_hashes(buf, begins, ends) + of.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, first = np.unique(keys, return_index=True)
    n = len(offsets) - 1
    return np.bincount(of, minlength=n) - np.bincount(of[first], minlength=n)


def measures(buf: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The base counts of each text."""
    starts, ends, bounds = word_spans(buf, offsets)
    heads = np.zeros(len(buf) + 1, np.int64)
    np.cumsum((buf & 0xC0) != 0x80, out=heads[1:])
    values = word_hashes(buf, starts, ends)
    symbols = np.zeros(256, np.int64)
    symbols[list(SYMBOLS)] = 1
    return {"n_words": np.diff(bounds), "word_chars": segment_sums(heads[ends] - heads[starts], bounds),
            "n_symbols": segment_sums(symbols[buf], offsets), "n_dup_lines": repeated_lines(buf, offsets, starts, bounds),
            "n_repeat_words": repeated_words(values, bounds)}


def measured(buf: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """``measures``, for about SLICE bytes of whole texts at a time."""
    ends = np.searchsorted(offsets, np.arange(SLICE, len(buf), SLICE))
    cuts = np.unique(np.concatenate([[0], ends, [len(offsets) - 1]]))
    parts = [measures(buf[offsets[i]: offsets[j]], offsets[i: j + 1] - offsets[i]) for i, j in zip(cuts, cuts[1:])]
    return {x: np.concatenate([part[x] for part in parts]) for x in parts[0]} if parts else measures(buf, offsets)


MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, perplexity double"
NAMES = [x.split()[0] for x in MEASURES.split(", ")]


def scored(docs: DataFrame, columns: list[Column]) -> DataFrame:
    """``columns`` of each row as c0, c1, ..., with MEASURES, base_failed and kept; stored."""
    text = F.coalesce("text", F.lit(""))
    own = [c.alias(f"c{i}") for i, c in enumerate(columns)]
    carried = [f"c{i}" for i in range(len(own))]
    kinds = [(f"c{i}", name, kind) for i, (name, kind) in enumerate(docs.select(*columns).dtypes)]
    # a text that is carried anyway doesn't stand in the rows twice
    body = next((c for c, name, kind in kinds if (name.lower(), kind) == ("text", "string")), "text")
    model = F.xxhash64(F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANGUAGE)))
    rows = docs.select(*own, model.alias("model"), *[text.alias("text")][:body == "text"], F.xxhash64("doc_id", "text").alias("spread"))
    whole = F.coalesce(F.col(body), F.lit(""))
    sizes = stored(rows.groupBy("model").agg(F.sum(F.octet_length(whole)).alias("bytes")), "sizes")
    models, size = sizes.agg(F.count("*"), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    small = F.broadcast if models <= MOST_MODELS else lambda x: x
    parts = max(-(-size // BLOCK_BYTES), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    bits, grams = gram_bits(rows.select("model", whole.alias("text")), small)
    arrays = stored(hash_arrays(bits, parts), "arrays")
    drop_stored(grams)
    blocks = F.greatest(F.ceil(F.col("bytes") / BLOCK_BYTES), F.lit(1))
    dealt = (rows.join(small(sizes.select("model", blocks.alias("blocks"))), "model")
             .select(*carried, "model", *["text"][:body == "text"], F.pmod("spread", "blocks").cast("int").alias("blk")).repartition(parts, "model", "blk"))

    def ask(table: pa.Table) -> pa.Table:
        block = Grams(table.column(body))
        keys, _ = block.counted()
        context, last = block.parts(keys)
        n = len(keys)
        return pa.table([pa.array(np.full(n, table.column("model")[0].as_py(), np.int64)), pa.array(np.full(n, table.column("blk")[0].as_py(), np.int32)),
                         pa.array(np.arange(n, dtype=np.int32)), pa.array(context), pa.array(last)], names=["model", "blk", "at", "ctx", "w"])

    def look_up(asked: pa.Table, array: pa.Table) -> pa.Table:
        names = ["model", "blk", "at"]
        if not asked.num_rows:
            return asked.select(names).append_column("bits", pa.array([], pa.float64()))
        hashes = np.frombuffer(array.column("hashes")[0].as_py(), "<i8")
        values = np.frombuffer(array.column("bits")[0].as_py(), "<f8")
        h = asked.column("h").to_numpy()
        order = np.argsort(h)
        out = np.empty(len(h))
        out[order] = values[np.searchsorted(hashes, h[order])]
        return asked.select(names).append_column("bits", pa.array(out))

    def answer(table: pa.Table, known: pa.Table) -> pa.Table:
        block = Grams(table.column(body))
        keys, _ = block.counted()
        value = np.empty(len(keys))
        value[known.column("at").to_numpy()] = known.column("bits").to_numpy()
        # marks add bits but no length
        total, letters = block.sums(keys, value)
        per = total / np.maximum(letters, 1)
        n = np.diff(block.bounds)
        buf, offsets = block.buf, block.offsets
        del block
        out = measured(buf, offsets)
        out["perplexity"] = np.exp2(per)
        return pa.table({**{x: table.column(x) for x in carried}, "model": table.column("model"), "bits": per,
                         "n": n, **{x: out[x] for x in NAMES}})

    schema = ", ".join(f"{c} {kind}" for c, _, kind in kinds)
    asked = dealt.groupBy("model", "blk").applyInArrow(ask, "model long, blk int, at int, ctx long, w int")
    asked = hashed(asked, parts).select("bucket", "model", "blk", "at", "h")
    answers = asked.groupBy("bucket").cogroup(arrays.groupBy("bucket")).applyInArrow(look_up, "model long, blk int, at int, bits double")
    out = stored(dealt.groupBy("model", "blk").cogroup(answers.groupBy("model", "blk"))
                 .applyInArrow(answer, f"{schema}, model long, bits double, n long, {MEASURES}"), "scored")
    drop_stored(arrays, sizes)
    return verdicts(out, small)


def verdicts(rows: DataFrame, small=F.broadcast) -> DataFrame:
    """``rows`` with base_failed and kept: base rules, and the band of each language.

    A band lies about the median of its language. Its deviation is drawn towards the common one, that of
    all documents about their own languages' medians, by the number of documents."""
    some = rows.where("n > 0")
    q = lambda x: F.percentile_approx(x, [0.25, 0.5, 0.75], 10000)
    spread = lambda x: (x[2] - x[0]) / 1.349
    bands = some.groupBy("model").agg(q("bits").alias("q"), F.count("*").alias("docs")).select("model", "docs", F.col("q")[1].alias("mid"), spread(F.col("q")).alias("dev"))
    common = some.join(small(bands), "model").agg(spread(q(F.col("bits") - F.col("mid"))).alias("common"))
    drawn = (F.col("docs") * F.col("dev") + PRIOR_DOCS * F.col("common")) / (F.col("docs") + PRIOR_DOCS)
    wide = BAND_WIDTH * F.greatest(drawn, F.lit(LEAST_DEVIATION))
    bands = bands.crossJoin(F.broadcast(common)).select("model", "mid", wide.alias("wide"))
    off = F.abs(F.col("bits") - F.col("mid")) * F.col("n") / (F.col("n") + PRIOR_SYMBOLS)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return (rows.join(small(bands), "model", "left").withColumn("base_failed", failed)
            .withColumn("kept", ~failed & F.coalesce(off <= F.col("wide"), F.lit(True))))


def quality_rules(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, lang) with the base counts and the verdict."""
    return scored(docs, [F.col("doc_id").cast("long")]).select(F.col("c0").alias("doc_id"), *NAMES[:-1], "base_failed", "kept", "perplexity")


def keep_clean(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns."""
    out = scored(docs, [F.col(f"`{c}`") for c in docs.columns]).where("kept")
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])
