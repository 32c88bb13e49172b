"""Text features (pipeline D): WIN-7, FN-29, ML-1 … ML-4, JN-7, JN-8, AGG-32 … AGG-38.

Texts are processed whole. The engine tokenises, with a row per document id, and Arrow batches
of token lists are counted with numpy, a slice of a bounded number of tokens at a time: no row
is made for an occurrence. Tables bounded by a parameter (the TF-IDF vocabulary of
``max_features`` terms, the tokens with an id below ``HOT_TOKENS`` or ``HOT_IDS``) are broadcast;
of tables that grow with the data (the token vocabulary, vectors) the rest is joined by a shuffle.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from markerlens.functions import text as T
from markerlens.operators import agreement as A
from markerlens.operators.ordering import contiguous_index, with_scalars
from markerlens.session import stored

# The batch functions below travel with the job: workers need not find this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PAD_ID, OOV_ID = 0, 1
PAD, OOV = "<PAD>", "<OOV>"
# The 15 part-of-speech classes of the tag-distribution vector, in order.
POS_CLASSES = ("ADJ", "ADP", "ADV", "AUX", "CCONJ", "DET", "INTJ", "NOUN", "NUM", "PART",
               "PRON", "PROPN", "SCONJ", "VERB", "X")
DEFAULT_WEIGHT = 0.001
# Tokens whose vectors and classes are broadcast (51 MB of floats at 64 dimensions); the others are joined by a shuffle.
HOT_TOKENS = 200_000
# Tokens whose ids are broadcast to encode with; the others are joined by a shuffle.
HOT_IDS = 200_000
# Tokens of a slice of an Arrow batch that are counted together: bounds the arrays a Python worker holds.
SLICE_TOKENS = 500_000


def _by_doc(df: DataFrame, doc: str) -> DataFrame:
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, doc)


def word_token_column(text: str = "text") -> Column:
    """The default tokenizer (``tokenize_fn``): lowercase Unicode word tokens (FN-9)."""
    return T.word_tokens(text)


# ---------------------------------------------------------------- token lists in Arrow batches

# Texts of these characters alone are tokenised inside the batch: Latin letters, whose classes and cases have been the same in
# all versions of Unicode since 5.0, and general punctuation. U+0130 has a lower case of two characters, so it is left to the engine.
# (A search for another character takes Java some 20 times as long as this match.)
PLAIN_TEXT = r"\A[\x00-\u012F\u0131-\u024F\u2000-\u206F]*+\z"
_PLAIN = [c for c in (*range(0x250), *range(0x2000, 0x2070)) if c != 0x130]


def _plain_table(fold: bool) -> np.ndarray:
    """For each character of a plain text the one that stands for it in a word, 0 if it ends a word."""
    base, out = dict(zip(T.ACCENTED, T.UNACCENTED)) if fold else {}, np.zeros(0x2070, dtype=np.uint32)
    for c in _PLAIN:
        low = chr(c).lower()
        low = base.get(low, low).lower()
        if unicodedata.category(low)[0] in "LN" or low == "_":
            out[c] = ord(low)
    return out


# Words as they are, and with their accents folded.
_TABLES = (_plain_table(False), _plain_table(True))


def token_lists(df: DataFrame, doc: str, text: str, tokens: Callable[[Column], Column] = T.word_tokens) -> DataFrame:
    """(doc, tokens, parts, plain): a row per document id, for ``_slices``. Texts that share an id are one document, and
    ``parts`` has their token counts (null with one text). Of a document whose texts have plain characters alone ``plain`` has
    the texts in place of tokens."""
    lists = F.transform("_t", tokens)
    # a sum, so that a text is looked through once and not by each column
    plain = F.coalesce(F.every(F.col("_x").rlike(PLAIN_TEXT)), F.lit(True))
    return (df.select(doc, F.col(text).alias("_x")).groupBy(doc).agg(F.collect_list("_x").alias("_t"), plain.alias("_p"))
            .select(doc, F.when(~F.col("_p"), F.flatten(lists)).alias("tokens"),
                    F.when(~F.col("_p") & (F.size("_t") > 1), F.transform(lists, lambda x: F.size(x))).alias("parts"), F.when(F.col("_p"), F.col("_t")).alias("plain")))


class _Slice:
    """Rows of an Arrow batch of ``token_lists``: the different ``words``, and of each token its word (``code``), its row
    (``owner``) and its ``text`` (a number of its own for each text, of which ``runs`` has the token counts)."""

    def __init__(self, batch: pa.RecordBatch, tokens: pa.Array, runs: np.ndarray, texts: np.ndarray):
        self.batch, self.rows, self.runs, self.texts = batch, batch.num_rows, runs, texts
        self.sizes = np.bincount(np.repeat(np.arange(self.rows), texts), runs, minlength=self.rows).astype(np.int64)
        found = tokens.dictionary_encode()
        self.words, self.code = found.dictionary, found.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.owner = np.repeat(np.arange(self.rows), self.sizes)
        self.text = np.repeat(np.arange(len(runs)), runs)

    def counted(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, word and count of each different token of a row, in order of rows."""
        key, n = np.unique(self.owner * max(1, len(self.words)) + self.code, return_counts=True)
        return key // max(1, len(self.words)), key % max(1, len(self.words)), n


def _sizes(lists: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def _plain_words(texts: pa.Array, table: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The words of plain texts, one after the other, and their number in each text."""
    ends = np.concatenate([[0], np.cumsum(pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))])
    at = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else [0, 0]
    data = (texts.buffers()[2] or b"")[at[0]:at[-1]]
    chars = table[np.frombuffer(bytes(data).decode().encode("utf-32-le"), dtype=np.uint32)]
    word = chars != 0
    first = word.copy()
    first[1:] &= ~word[:-1]
    heads = ends[:-1][ends[:-1] < ends[1:]]
    first[heads] = word[heads]
    starts = np.flatnonzero(first)
    kept = chars[word]
    # where each word starts among the bytes of the characters that stay
    after = np.cumsum(1 + (kept >= 0x80) + (kept >= 0x800))
    place = np.cumsum(word)[starts] - 1
    offsets = np.append(np.concatenate([[0], after])[place], after[-1] if len(after) else 0)
    words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(kept.tobytes().decode("utf-32-le").encode()))
    return words, np.diff(np.searchsorted(starts, ends))


def _slices(batches, fold: bool = False) -> Iterator[_Slice]:
    """``fold``: the words of plain texts are folded, as by ``_folded_tokens``."""
    for whole in batches:
        kept = whole.drop_columns(["tokens", "parts", "plain"])
        plain = whole.column("plain").is_valid().to_numpy(zero_copy_only=False)
        for name, rows in (("plain", np.flatnonzero(plain)), ("tokens", np.flatnonzero(~plain))):
            if len(rows) == 0:
                continue
            mine = whole if len(rows) == whole.num_rows else whole.take(pa.array(rows))
            others = kept if len(rows) == whole.num_rows else kept.take(pa.array(rows))
            lists = mine.column(name)
            texts = _sizes(lists)
            weight = texts
            if name == "plain":
                flat = lists.flatten()
                weight = np.bincount(np.repeat(np.arange(len(texts)), texts), pc.binary_length(flat).to_numpy(zero_copy_only=False) // 6, minlength=len(texts)).astype(np.int64)
            at = np.flatnonzero(np.diff(np.cumsum(weight) // SLICE_TOKENS, prepend=-1))
            for a, b in zip(at, np.append(at[1:], len(texts))):
                part, n = lists.slice(a, b - a), texts[a:b]
                if name == "plain":
                    words, runs = _plain_words(part.flatten(), _TABLES[fold])
                else:
                    words, parts = part.flatten(), mine.column("parts").slice(a, b - a)
                    runs = n
                    if parts.null_count < b - a:
                        own = [[k] if p is None else p for k, p in zip(n.tolist(), parts.to_pylist())]
                        runs, n = np.concatenate(own).astype(np.int64), np.array([len(p) for p in own])
                    else:
                        n = np.ones(b - a, dtype=np.int64)
                yield _Slice(others.slice(a, b - a), words, runs, n)


def _lists(sizes: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), values)


def _places(words: pa.Array, known: pa.Array) -> np.ndarray:
    """Place of each word among the ``known`` ones, -1 for others."""
    return pc.fill_null(pc.index_in(words, value_set=known), -1).to_numpy(zero_copy_only=False).astype(np.int64)


# ---------------------------------------------------------------- vocabulary and encoding

def _first_occurrences(df: DataFrame, order: str, tokens: str = "_toks", text: str = "text") -> DataFrame:
    """(token, _o, _p): the least (order, position) of each token, a null order first. Tokens are those of the column
    ``tokens``, or the words of ``text`` if there is no such column.

    Rows that share an order become one; a slice of an Arrow batch keeps the first place of each of its words. Orders and
    positions are reduced in columns of their own: a minimum of structs would sort."""
    if tokens in df.columns:
        own = (df.select(order, tokens).groupBy(order).agg(F.collect_list(tokens).alias("_l"))
               .select(order, F.flatten("_l").alias("tokens"), F.when(F.size("_l") > 1, F.transform("_l", lambda x: F.size(x))).alias("parts"),
                       F.lit(None).cast("array<string>").alias("plain")))
    else:
        own = token_lists(df, order, text)
    name = order

    def first(batches):
        for x in _slices(batches):
            rank = pc.rank(x.batch.column(name), null_placement="at_start", tiebreaker="first").to_numpy()
            place = np.arange(len(x.code)) - (np.cumsum(x.runs) - x.runs)[x.text]
            by = np.lexsort((place, rank[x.owner]))
            code, at = np.unique(x.code[by], return_index=True)
            at = by[at]
            yield pa.RecordBatch.from_arrays([x.batch.column(name).take(pa.array(x.owner[at])), x.words.take(pa.array(code)), pa.array(place[at].astype(np.int32))],
                                             names=[name, "token", "pos"])

    firsts = (own.mapInArrow(first, f"`{order}` {dict(df.dtypes)[order]}, token string, pos int").groupBy("token")
              .agg(F.min(order).alias("_least"), F.min_by("pos", order).alias("_pos"), F.min(F.when(F.col(order).isNull(), F.col("pos"))).alias("_none")))
    return firsts.select("token", F.when(F.col("_none").isNull(), F.col("_least")).alias("_o"), F.coalesce("_none", "_pos").alias("_p"))


def vocabulary(df: DataFrame, order: str = "doc_id", text: str = "text",
               max_len: int | None = None, tokens: Column | None = None) -> DataFrame:
    """WIN-7 (token, token_id): ids 0 and 1 reserved for PAD and OOV, then tokens numbered in
    order of first appearance over (row order, position). ``max_len`` limits each row to its
    first tokens (the sequence models' setting); by default the whole text counts."""
    if tokens is not None or max_len:
        toks = tokens if tokens is not None else word_token_column(text)
        df = df.withColumn("_toks", F.slice(toks, 1, max_len) if max_len else toks)
    numbered = contiguous_index(_first_occurrences(df, order, text=text), ["_o", "_p"], "_idx")
    spark = df.sparkSession
    reserved = spark.createDataFrame([(PAD, PAD_ID), (OOV, OOV_ID)], "token string, token_id long")
    return reserved.unionByName(numbered.select("token", (F.col("_idx") + 2).alias("token_id")))


def _hot_ids(tokens: DataFrame, doc: str, hot: DataFrame) -> DataFrame:
    """(doc, ids, spots, cold): the ids of the tokens of ``hot``, OOV for the others, which ``cold`` lists with their places; of several
    texts ``spots`` has each token's place in its own."""
    known = hot.toArrow()
    shared = tokens.sparkSession.sparkContext.broadcast((known.column("token").combine_chunks(), known.column("token_id").to_numpy()))
    name, oov = doc, OOV_ID

    def look_up(batches):
        words, ids = shared.value
        for x in _slices(batches):
            at = _places(x.words, words)
            got, away = np.append(ids, oov)[at][x.code], np.flatnonzero(at[x.code] < 0)
            first = np.cumsum(x.sizes) - x.sizes
            cold = pa.StructArray.from_arrays([pa.array((away - first[x.owner[away]]).astype(np.int32)), x.words.take(pa.array(x.code[away]))], names=["at", "token"])
            spots = pa.nulls(x.rows, pa.list_(pa.int32()))
            if (x.texts > 1).any():
                place = np.arange(len(x.code)) - (np.cumsum(x.runs) - x.runs)[x.text]
                spots = pc.if_else(pa.array(x.texts > 1), _lists(x.sizes, pa.array(place.astype(np.int32))), spots)
            yield pa.RecordBatch.from_arrays([x.batch.column(name), _lists(x.sizes, pa.array(got.astype(np.int64))), spots,
                                              _lists(np.bincount(x.owner[away], minlength=x.rows), cold)], names=[name, "ids", "spots", "cold"])

    kind = dict(tokens.dtypes)[doc]
    return tokens.mapInArrow(look_up, f"`{doc}` {kind}, ids array<long>, spots array<int>, cold array<struct<at:int,token:string>>")


def _put_in(rows: DataFrame, doc: str) -> DataFrame:
    """The rows (doc, ids, spots, found) with each found (at, id) at its place in ``ids``."""
    schema = rows.select(doc, "ids", "spots").schema
    name = doc

    def put(batches):
        for batch in batches:
            ids, found = batch.column("ids"), batch.column("found")
            n = pc.fill_null(pc.list_value_length(found), 0).to_numpy(zero_copy_only=False)
            sizes = pc.list_value_length(ids).to_numpy(zero_copy_only=False)
            flat, pairs = ids.flatten().to_numpy(zero_copy_only=False).copy(), found.flatten()
            first = np.repeat(np.cumsum(sizes) - sizes, n)
            flat[first + pairs.field("at").to_numpy(zero_copy_only=False)] = pairs.field("token_id").to_numpy(zero_copy_only=False)
            offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(name), pa.ListArray.from_arrays(offsets, pa.array(flat)), batch.column("spots")], names=[name, "ids", "spots"])

    return rows.mapInArrow(put, schema)


def encode(df: DataFrame, vocab: DataFrame, doc: str = "doc_id", text: str = "text",
           max_len: int | None = None, pad: bool = True) -> DataFrame:
    """FN-29 token ids per document in text order, OOV → 1; with ``max_len`` the first tokens
    are kept and the sequence is right-padded with 0 to that length.

    Token lists stay in their rows: the tokens with an id below ``HOT_IDS`` (frequent words among them) are broadcast and looked up a
    batch at a time; only occurrences of the others become rows, meet their ids by a shuffle and are put back. Texts that share an id are
    one document."""
    tokens = token_lists(df.where(F.col(doc).isNotNull()), doc, text)
    vocab = stored(vocab.select("token", "token_id"), "vocabulary")
    per_doc = _hot_ids(tokens, doc, vocab.where(F.col("token_id") < HOT_IDS))
    cold = vocab.where(F.col("token_id") >= HOT_IDS)
    if not cold.isEmpty():
        per_doc = stored(per_doc, "encoded")
        found = (per_doc.select(doc, F.inline("cold")).join(cold.hint("shuffle_merge"), "token").groupBy(doc)
                 .agg(F.collect_list(F.struct("at", "token_id")).alias("found")))
        per_doc = _put_in(per_doc.select(doc, "ids", "spots").join(found, doc, "left"), doc)
    in_order = F.transform(F.array_sort(F.arrays_zip("spots", "ids")), lambda x: x["ids"])
    per_doc = per_doc.select(doc, F.when(F.col("spots").isNull(), F.col("ids")).otherwise(in_order).alias("ids"))
    out = df.select(doc).join(per_doc, doc, "left").withColumn("ids", F.coalesce(F.col("ids"), F.array().cast("array<long>")))
    if max_len:
        cut = F.slice("ids", 1, max_len)
        if pad:
            cut = F.concat(cut, F.array_repeat(F.lit(PAD_ID).cast("long"), F.lit(max_len) - F.size(cut)))
        out = out.withColumn("ids", cut)
    return out


# ---------------------------------------------------------------- TF-IDF (ML-1, AGG-32)

def tfidf_terms(text: str = "text", ngram_max: int = 2) -> Column:
    """Unigrams … n-grams of accent-folded lowercase ``\\w+`` tokens."""
    toks = T.word_tokens(T.fold_accents(F.lower(F.col(text))))
    grams = [toks] + [T.ngrams(toks, n) for n in range(2, ngram_max + 1)]
    return F.concat(*grams) if len(grams) > 1 else toks


def _folded_tokens(text: Column) -> Column:
    """The unigrams of ``tfidf_terms``."""
    return T.word_tokens(T.fold_accents(F.lower(text)))


def _grams(x: _Slice, most: int):
    """For n = 1 … ``most``: the places where an n-gram starts, the number of each place's n-gram, and the n-grams."""
    code, names, start = x.code, x.words, np.arange(len(x.code))
    yield start, code, names
    for n in range(2, most + 1):
        # an n-gram is an (n-1)-gram and a word; both stand in the same text
        go = np.flatnonzero(start + n - 1 < len(x.code))
        go = go[x.text[start[go]] == x.text[start[go] + n - 1]]
        different, number = np.unique(code[go] * max(1, len(x.words)) + x.code[start[go] + n - 1], return_inverse=True)
        names = pc.binary_join_element_wise(names.take(pa.array(different // max(1, len(x.words)))), x.words.take(pa.array(different % max(1, len(x.words)))), " ")
        start, code = start[go], number
        yield start, code, names


def term_statistics(df: DataFrame, doc: str = "doc_id", text: str = "text", ngram_max: int = 2) -> DataFrame:
    """(term, df, cf): the documents that hold a term and its occurrences, summed over slices of Arrow batches."""
    def count(batches):
        for x in _slices(batches, fold=True):
            for start, code, names in _grams(x, ngram_max):
                cf = np.bincount(code, minlength=len(names))
                holds = np.bincount(np.unique(code * x.rows + x.owner[start]) // max(1, x.rows), minlength=len(names))
                yield pa.RecordBatch.from_arrays([names, pa.array(holds.astype(np.int64)), pa.array(cf.astype(np.int64))], names=["term", "df", "cf"])

    parts = token_lists(df, doc, text, _folded_tokens).mapInArrow(count, "term string, df long, cf long")
    return parts.groupBy("term").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf"))


def tfidf_fit(train: DataFrame, doc: str = "doc_id", text: str = "text", max_features: int = 10000,
              min_df: int = 2, ngram_max: int = 2) -> DataFrame:
    """Vocabulary (term, df, idf): terms in ≥ ``min_df`` training documents, the
    ``max_features`` most frequent over the corpus (ties by term), idf = ln((1+n)/(1+df)) + 1."""
    stats = term_statistics(train, doc, text, ngram_max)
    top = stats.where(F.col("df") >= min_df).orderBy(F.desc("cf"), F.asc("term")).limit(max_features)
    n = train.agg(F.count(F.lit(1)).alias("_n"))
    return with_scalars(top, n).select("term", "df", (F.log((1 + F.col("_n")) / (1 + F.col("df"))) + 1).alias("idf"))


class _Terms(NamedTuple):
    """The n-grams of a TF-IDF model: its words, and for n = 1 … the sorted (prefix, word) keys and the term of each, -1 for prefixes alone."""

    words: pa.Array
    levels: list[tuple[np.ndarray, np.ndarray]]


def _model_terms(terms: Sequence[str], most: int) -> _Terms:
    split = [t.split(" ") for t in terms]
    number = {w: i for i, w in enumerate(dict.fromkeys(w for t in split for w in t))}
    prefix, levels = {}, []
    for n in range(1, most + 1):
        key = {i: (number[t[0]] if n == 1 else prefix[i] * len(number) + number[t[n - 1]]) for i, t in enumerate(split) if len(t) >= n}
        keys = np.unique(np.array([*key.values()], dtype=np.int64))
        prefix = {i: int(np.searchsorted(keys, k)) for i, k in key.items()}
        term = np.full(len(keys), -1, dtype=np.int64)
        for i, at in prefix.items():
            if len(split[i]) == n:
                term[at] = i
        levels.append((keys, term))
    return _Terms(pa.array([*number], type=pa.string()), levels)


def _found(x: _Slice, model: _Terms) -> tuple[np.ndarray, np.ndarray]:
    """Row and term of each occurrence."""
    word = _places(x.words, model.words)[x.code]
    start, key, owners, terms = np.arange(len(word)), word, [], []
    for n, (keys, term) in enumerate(model.levels, 1):
        if n > 1:
            go = np.flatnonzero(start + n - 1 < len(word))
            after = start[go] + n - 1
            ok = (x.text[start[go]] == x.text[after]) & (word[after] >= 0)
            start, key = start[go[ok]], at[go[ok]] * len(model.words) + word[after[ok]]
        at = np.searchsorted(keys, key)
        hit = np.flatnonzero(keys[np.minimum(at, len(keys) - 1)] == key) if len(keys) else np.zeros(0, dtype=np.int64)
        start, at = start[hit], at[hit]
        whole = np.flatnonzero(term[at] >= 0)
        owners.append(x.owner[start[whole]])
        terms.append(term[at[whole]])
    return np.concatenate(owners), np.concatenate(terms)


def tfidf_transform(df: DataFrame, model: DataFrame, doc: str = "doc_id", text: str = "text",
                    ngram_max: int = 2, lists: bool = False) -> DataFrame:
    """(doc, term, weight): (1 + ln tf) · idf, L2-normalised per document. The model has at most
    ``max_features`` rows, so it is broadcast. With ``lists`` a row per document id (doc, terms, idx, weights), stored;
    ``idx`` is the model's column of that name, in ascending order, or the term's place in the model."""
    known = model.select("term", "idf", *[c for c in ("idx",) if c in model.columns]).toArrow()
    if "idx" in known.column_names:
        known = known.sort_by("idx")
    terms, idf = known.column("term").combine_chunks().cast(pa.string()), known.column("idf").to_numpy()
    idx = known.column("idx").to_numpy() if "idx" in known.column_names else np.arange(len(idf))
    shared = df.sparkSession.sparkContext.broadcast((*_model_terms(terms.to_pylist(), ngram_max), terms, idf, idx.astype(np.int32)))
    name = doc

    def weigh(batches):
        words, levels, terms, idf, idx = shared.value
        for x in _slices(batches, fold=True):
            row, term = _found(x, _Terms(words, levels))
            key, tf = np.unique(row * max(1, len(idf)) + term, return_counts=True)
            row, term = key // max(1, len(idf)), key % max(1, len(idf))
            w = (1 + np.log(tf)) * idf[term]
            w = w / np.sqrt(np.bincount(row, w * w, minlength=x.rows))[row]
            n = np.bincount(row, minlength=x.rows)
            yield pa.RecordBatch.from_arrays([x.batch.column(name), _lists(n, terms.take(pa.array(term))), _lists(n, pa.array(idx[term])), _lists(n, pa.array(w))],
                                             names=[name, "terms", "idx", "weights"])

    out = token_lists(df, doc, text, _folded_tokens).mapInArrow(weigh, f"`{doc}` {dict(df.dtypes)[doc]}, terms array<string>, idx array<int>, weights array<double>")
    return stored(out, "term-weights") if lists else out.select(doc, F.inline(F.arrays_zip("terms", "weights"))).toDF(doc, "term", "weight")


# ---------------------------------------------------------------- scaling (ML-2, ML-3, AGG-33)

def marker_features(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """ML-2 feature columns as doubles; missing or non-numeric → 0."""
    return df.select(*[c for c in df.columns if c not in cols],
                     *[F.coalesce(F.col(c).try_cast("double"), F.lit(0.0)).alias(c) for c in cols])


def standardise_fit(train: DataFrame, cols: Sequence[str]) -> DataFrame:
    """AGG-33 one row: mean and population std per column, from the training rows only."""
    return train.agg(*[e for c in cols for e in (F.avg(c).alias(f"{c}__mean"), F.stddev_pop(c).alias(f"{c}__std"))])


def standardise_apply(df: DataFrame, fit: DataFrame, cols: Sequence[str]) -> DataFrame:
    """ML-3 (x − mean) / std; zero variance leaves x − mean."""
    j = with_scalars(df, fit)
    out = [c for c in df.columns if c not in cols]
    for c in cols:
        std = F.col(f"{c}__std")
        out.append(((F.col(c) - F.col(f"{c}__mean")) / F.when(std == 0, F.lit(1.0)).otherwise(std)).alias(c))
    return j.select(*out)


# ---------------------------------------------------------------- augmented training set (ML-13)

def replace_labels(rows: DataFrame, labels: DataFrame, cols: Sequence[str], key: str = "id") -> DataFrame:
    """The rows with ``cols`` taken from ``labels`` alone (null where it has no row for the key). Of several
    label rows of a key the least counts, so no row is doubled; a null key meets no label."""
    one = labels.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct(*cols)).alias("_l"))
    return (rows.drop(*cols).join(one, key, "left")
            .select(*[c for c in rows.columns if c not in cols], *[F.col(f"_l.{c}").alias(c) for c in cols]))


def binarised(rows: DataFrame, tags: Sequence[str], annotator: str, annotators: Sequence[str], split: str = "train") -> DataFrame:
    """Extra annotated rows in the shape of training rows: ``<tag>_bin`` flags (FN-15), the constant annotator with
    its 0/1 columns (FN-16) and the split."""
    return rows.withColumns({**{f"{t}_bin": A.is_present(t).cast("int") for t in tags}, "annotator": F.lit(annotator),
                             **{a: F.lit(int(a == annotator)) for a in annotators}, "split": F.lit(split)})


def augmented_train(parts: Sequence[tuple[str, DataFrame]], key: str = "id", flag: str = "provenance") -> DataFrame:
    """ML-13: training sets of different columns in one, merged by ``key``.

    ``parts`` are (name, rows) in order of precedence: all rows of a key come from the first part that has it, under that
    part's name in ``flag``; rows of one part that share a key all stay, and so do rows without a key. Columns that a part
    lacks are null. A column must have one type in all parts. Keys are compared by a count per (key, part), joined by equality.
    """
    out, held = None, None
    for i, (name, rows) in enumerate(parts):
        tagged = rows.withColumns({flag: F.lit(name), "_part": F.lit(i)})
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
        keys = rows.select(F.col(key).alias("_key"), F.lit(i).alias("_part"))
        held = keys if held is None else held.unionByName(keys)
    # keys that several parts have, and the first of these parts
    first = (held.where(F.col("_key").isNotNull()).groupBy("_key").agg(F.min("_part").alias("_first"), F.max("_part").alias("_last"))
             .where("_first < _last").select("_key", "_first"))
    return (out.join(first, F.col(key) == F.col("_key"), "left").where("_first IS NULL OR _first = _part")
            .drop("_key", "_first", "_part"))


# ---------------------------------------------------------------- vectors (SRC-11, JN-7, AGG-34…37)

def vector_std(vectors: DataFrame, vector: str = "vector") -> DataFrame:
    """AGG-34 one row: population std of all vector components."""
    return vectors.select(F.explode(vector).alias("_x")).agg(F.stddev_pop("_x").alias("std"))


def _noise(token: Column, dim: int, seed: int, std: Column) -> Column:
    """Deterministic N(0, std²) components from a hash of (token, dimension, seed) (Box–Muller)."""
    def u(d, salt):
        h = F.xxhash64(token, d, F.lit(seed), F.lit(salt))
        return ((F.pmod(h, F.lit(1 << 30)).cast("double") + 0.5) / float(1 << 30))
    return F.transform(F.sequence(F.lit(0), F.lit(dim - 1)), lambda d: (
        F.sqrt(-2.0 * F.log(u(d, 1))) * F.cos(2 * 3.141592653589793 * u(d, 2)) * std).cast("float"))


def token_vectors(vocab: DataFrame, vectors: DataFrame, dim: int, seed: int = 581) -> DataFrame:
    """JN-7 (token_id, vector, found): PAD and OOV get zeros; vocabulary tokens missing from the
    vector table get deterministic noise with the vectors' global std; ``found`` flags hits."""
    std = vector_std(vectors)
    j = vocab.join(vectors.select("token", "vector"), "token", "left")
    j = with_scalars(j, std)
    zeros = F.array_repeat(F.lit(0.0).cast("float"), dim)
    vec = (F.when(F.col("token_id") <= OOV_ID, zeros)
           .when(F.col("vector").isNotNull(), F.col("vector"))
           .otherwise(_noise(F.col("token"), dim, seed, F.col("std"))))
    return j.select("token_id", "token", vec.alias("vector"), F.col("vector").isNotNull().alias("found"))


def vocab_coverage(vecs: DataFrame) -> DataFrame:
    """AGG-37 found / vocabulary size (PAD and OOV in the denominator), in percent."""
    return vecs.agg(F.count_if("found").alias("n_found"), F.count(F.lit(1)).alias("vocab_size")) \
        .withColumn("coverage_pct", 100.0 * F.col("n_found") / F.col("vocab_size"))


def _matrix(vectors: pa.ChunkedArray, dim: int) -> np.ndarray:
    """The vectors as rows of ``dim`` numbers; what a vector lacks counts 0."""
    one = vectors.combine_chunks()
    n = pc.fill_null(pc.list_value_length(one), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = pc.fill_null(one.flatten(), 0).to_numpy(zero_copy_only=False)
    if (n == dim).all():
        return flat.reshape(len(n), dim)
    out, place, owner = np.zeros((len(n), dim), dtype=flat.dtype), np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n), np.repeat(np.arange(len(n)), n)
    out[owner[place < dim], place[place < dim]] = flat[place < dim]
    return out


def doc_embedding(df: DataFrame, vocab: DataFrame, vecs: DataFrame, dim: int, doc: str = "doc_id",
                  text: str = "text", weights: DataFrame | None = None) -> DataFrame:
    """AGG-35 mean of token vectors over a document's tokens (OOV = zero vector), or AGG-36 the
    weighted mean Σ w·v / Σ w with w = the token's TF-IDF weight in the document (JN-8, default
    0.001 outside the TF-IDF vocabulary). Empty text → zero vector; Σ w = 0 → plain mean.

    ``weights`` are rows (doc, term, weight) or the lists of ``tfidf_transform``. Tokens are counted per document inside Arrow
    batches and weighed there. Tokens without a vector count as a zero vector. The vectors of the first ``HOT_TOKENS`` ids (ids go by
    first appearance, so frequent words are among them) are broadcast and summed in the batch; only the others become rows
    (doc, token, c) and meet their vectors by a shuffle. There each component is a sum of its own: a hash aggregate with a row
    per document, which no vector is sorted for, after the rows were dealt by document.
    """
    tokens = token_lists(df.where(F.col(doc).isNotNull()), doc, text)
    if weights is not None:
        if "weights" not in weights.columns:
            weights = weights.groupBy(doc).agg(F.collect_list(F.struct(F.col("term").alias("terms"), F.col("weight").cast("double").alias("weights"))).alias("_e"))
            weights = weights.select(doc, F.col("_e.terms").alias("terms"), F.col("_e.weights").alias("weights"))
        # tokens hold no blank, so n-gram terms (with blanks) can never match: drop them before they meet the tokens
        uni = F.filter(F.arrays_zip("terms", "weights"), lambda e: ~e["terms"].contains(" ") & e["weights"].isNotNull())
        weights = weights.where(F.col(doc).isNotNull()).select(doc, uni.alias("_e"))
        tokens = tokens.join(weights.select(doc, F.col("_e.terms").alias("terms"), F.col("_e.weights").alias("weights")), doc, "left")
    known = stored(vocab.select("token", "token_id").join(vecs.select("token_id", "vector"), "token_id"), "token-vectors")
    hot = known.where(F.col("token_id") < HOT_TOKENS).select("token", "vector").toArrow()
    words, vectors, times = hot.column("token").combine_chunks(), _matrix(hot.column("vector"), dim), None
    own = words.dictionary_encode()
    if len(own.dictionary) < len(words):
        # of a token that has several vectors each one counts, with the token's weight
        at, words = own.indices.to_numpy(), own.dictionary
        one, times = np.zeros((len(words), dim)), np.bincount(at)
        np.add.at(one, at, vectors)
        vectors = one
    shared = df.sparkSession.sparkContext.broadcast((words, vectors, times))
    del hot, words, vectors, times, own
    name, default, weighted = doc, DEFAULT_WEIGHT, weights is not None

    def sum_up(batches):
        words, vectors, times = shared.value
        for x in _slices(batches):
            row, word, tf = x.counted()
            c = tf.astype(np.float64)
            if weighted:
                terms = x.batch.column("terms")
                n = pc.fill_null(pc.list_value_length(terms), 0).to_numpy(zero_copy_only=False).astype(np.int64)
                code = _places(terms.flatten(), x.words)
                key = (np.repeat(np.arange(x.rows), n) * max(1, len(x.words)) + code)[code >= 0]
                key, number = np.unique(key, return_inverse=True)
                given = np.bincount(number, x.batch.column("weights").flatten().to_numpy(zero_copy_only=False)[code >= 0], minlength=len(key))
                mine, w = row * max(1, len(x.words)) + word, np.full(len(row), default)
                at = np.searchsorted(mine, key)
                ok = at < len(mine)
                ok[ok] = mine[at[ok]] == key[ok]
                w[at[ok]] = given[ok]
                c = c * w
                some = np.bincount(row, c, minlength=x.rows) > 0
                c = np.where(some[row], c, tf)
            at = _places(x.words, words)[word]
            total = np.bincount(row, c if times is None else c * np.append(times, 1)[at], minlength=x.rows)
            mine, away = np.flatnonzero(at >= 0), np.flatnonzero(at < 0)
            ends = np.searchsorted(row[mine], np.arange(x.rows + 1))
            at, weight = at[mine], c[mine]
            sums = np.zeros((x.rows, dim))
            for i, (a, b) in enumerate(zip(ends[:-1], ends[1:])):
                if a < b:
                    sums[i] = weight[a:b] @ vectors[at[a:b]]
            cold = pa.StructArray.from_arrays([x.words.take(pa.array(word[away])), pa.array(c[away])], names=["token", "c"])
            yield pa.RecordBatch.from_arrays([x.batch.column(name), pa.array(total), _lists(np.full(x.rows, dim), pa.array(sums.ravel())),
                                              _lists(np.bincount(row[away], minlength=x.rows), cold)], names=[name, "_total", "_sums", "_cold"])

    own = stored(tokens.mapInArrow(sum_up, f"`{doc}` {dict(df.dtypes)[doc]}, _total double, _sums array<double>, _cold array<struct<token:string,c:double>>"), "token-sums")
    cold = known.where(F.col("token_id") >= HOT_TOKENS).select("token", "vector")
    per_doc, added = own.select(doc, "_total", "_sums"), lambda i: F.get("_sums", F.lit(i))
    if not cold.isEmpty():
        # one size for the shuffle of a row: a vector and its factor
        met = own.select(doc, F.inline("_cold")).join(cold.hint("shuffle_merge"), "token").select(doc, "c", "vector")
        rest = _by_doc(met, doc).groupBy(doc).agg(*[F.sum(F.col("c") * F.get("vector", F.lit(i)).cast("double")).alias(f"_s{i}") for i in range(dim)])
        per_doc, added = per_doc.join(rest, doc, "left"), lambda i: F.get("_sums", F.lit(i)) + F.coalesce(F.col(f"_s{i}"), F.lit(0.0))
    mean = F.when(F.col("_total") > 0, F.array(*[added(i) / F.col("_total") for i in range(dim)]))
    zeros = F.array_repeat(F.lit(0.0), dim)
    return (df.select(doc).join(per_doc.select(doc, mean.alias("embedding")), doc, "left")
            .select(doc, F.coalesce("embedding", zeros).alias("embedding")))


def tag_distribution_vector(df: DataFrame, token_classes: DataFrame, doc: str = "doc_id", text: str = "text",
                            classes: Sequence[str] = POS_CLASSES) -> DataFrame:
    """AGG-38 per document the share of each class among all its tokens (zeros when empty).

    ``token_classes`` maps a token to its class (a tagger's output as a table). With a ``token_id`` the classes of the ids below
    ``HOT_TOKENS`` are broadcast, without one those of a table of that size at most; tokens are counted by class inside Arrow batches,
    and only tokens without a broadcast class become rows (doc, token, tf) and meet theirs by a shuffle."""
    if "token_id" in token_classes.columns:
        near = F.col("token_id") < HOT_TOKENS
    else:
        near = F.lit(token_classes.limit(HOT_TOKENS + 1).count() <= HOT_TOKENS)
    hot = token_classes.where(near).groupBy("token").agg(*[F.count_if(F.col("class") == c).alias(f"_{i}") for i, c in enumerate(classes)]).toArrow()
    shared = df.sparkSession.sparkContext.broadcast((hot.column("token").combine_chunks(), np.array([hot.column(f"_{i}").to_numpy() for i in range(len(classes))], dtype=np.int64)))
    name, n_classes = doc, len(classes)

    def count(batches):
        words, of = shared.value
        for x in _slices(batches):
            row, word, tf = x.counted()
            at = _places(x.words, words)[word]
            mine, away = np.flatnonzero(at >= 0), np.flatnonzero(at < 0)
            n = np.array([np.bincount(row[mine], tf[mine] * of[i][at[mine]], minlength=x.rows) for i in range(n_classes)], dtype=np.int64).reshape(n_classes, x.rows)
            cold = pa.StructArray.from_arrays([x.words.take(pa.array(word[away])), pa.array(tf[away].astype(np.int64))], names=["token", "tf"])
            yield pa.RecordBatch.from_arrays([x.batch.column(name), pa.array(x.sizes), _lists(np.full(x.rows, n_classes), pa.array(n.T.ravel())),
                                              _lists(np.bincount(row[away], minlength=x.rows), cold)], names=[name, "_total", "_n", "_cold"])

    own = token_lists(df.where(F.col(doc).isNotNull()), doc, text).mapInArrow(
        count, f"`{doc}` {dict(df.dtypes)[doc]}, _total long, _n array<long>, _cold array<struct<token:string,tf:long>>")
    cold = token_classes.where(~near).select("token", "class")
    counts = [F.get("_n", F.lit(i)) for i in range(len(classes))]
    if not cold.isEmpty():
        own = stored(own, "class-counts")
        met = own.select(doc, F.inline("_cold")).join(cold.hint("shuffle_merge"), "token")
        rest = met.groupBy(doc).agg(*[F.sum(F.when(F.col("class") == c, F.col("tf"))).alias(f"_r{i}") for i, c in enumerate(classes)])
        own = own.join(rest, doc, "left")
        counts = [n + F.coalesce(F.col(f"_r{i}"), F.lit(0)) for i, n in enumerate(counts)]
    shares = own.select(doc, *[F.when(F.col("_total") > 0, n / F.col("_total")).alias(c) for c, n in zip(classes, counts)])
    return df.select(doc).join(shares, doc, "left").select(doc, *[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in classes])
