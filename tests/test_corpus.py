"""Cleaning and corpus statistics on hand-made rows (FIXTURES F2) and a metamorphic check."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from markerlens.functions.lexicons import ENGLISH_STOPWORDS
from markerlens.operators import corpus as C
from markerlens.operators.ordering import contiguous_index, exclusive_prefix_sum

SCHEMA = "doc_id long, text string, label int"


def test_clean_rules(spark):
    rows = [(0, "ok text", 0), (1, "x" * 560, 1), (2, "x" * 561, 1), (3, "From REUTERS today", 0),
            (4, "ok text", 0), (5, "ok text", 1), (6, " \t\n ", 0), (7, "fine", None), (8, "fine", 2),
            (9, None, 1)]
    got = C.clean_indexed(spark.createDataFrame(rows, SCHEMA)).orderBy("id").collect()
    assert [(r["id"], r["doc_id"]) for r in got] == [(0, 0), (1, 1), (2, 5)]


def test_contiguous_index_ignores_partitioning(spark):
    df = spark.createDataFrame([(i * 7 % 101, f"t{i}") for i in range(101)], "k long, t string")
    a = {r["k"]: r["id"] for r in contiguous_index(df.repartition(1), "k").collect()}
    b = {r["k"]: r["id"] for r in contiguous_index(df.repartition(7), "k", partitions=5).collect()}
    assert a == b and sorted(a.values()) == list(range(101)) and a[0] == 0


def test_prefix_sum(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(50)], "k long, v long")
    got = {r["k"]: r["before"] for r in exclusive_prefix_sum(df, "k", "v", partitions=4).collect()}
    acc = 0
    for i in range(50):
        assert got[i] == acc
        acc += i % 3


def py_tokens(texts):
    return re.findall(r"[a-zA-Z]+", " ".join(texts).lower())


def test_top_words_and_bigrams_match_stream(spark):
    texts = ["The cat sat on the mat. Cat!", "", "mat cat dog", "dog dog cat mat", "The the"]
    df = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], SCHEMA)
    toks = [t for t in py_tokens(texts) if t not in set(ENGLISH_STOPWORDS)]
    want_words = Counter(toks).most_common(3)
    got_words = [(r["token"], r["n"]) for r in C.top_words(df, 3).collect()]
    assert got_words == want_words
    want_bi = Counter(" ".join(p) for p in zip(toks, toks[1:])).most_common(4)
    got_bi = [(r["bigram"], r["n"]) for r in C.top_bigrams(df, 4).collect()]
    assert got_bi == want_bi


def test_ttr(spark):
    texts = ["a b a", "c a", "d d d e"]
    df = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], SCHEMA)
    got = {r["num_words"]: r["types"] for r in C.type_token_ratio(df, (3, 5, 100)).collect()}
    toks = py_tokens(texts)
    assert got == {3: len(set(toks[:3])), 5: len(set(toks[:5])), len(toks): len(set(toks))}


def test_stats_and_describe(spark):
    texts = ["Hello world. Bye!", "one"]
    df = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], SCHEMA)
    s = C.stats(df).first()
    assert (s["articles"], s["tokens"], s["types"], s["sentences"]) == (2, 4, 4, 3)
    d = C.describe(spark.createDataFrame([(x,) for x in [1, 2, 3, 4, 10]], "x long"), "x").first()
    assert (d["p25"], d["p50"], d["p75"]) == (2.0, 3.0, 4.0)


def test_histogram_folds_max(spark):
    df = spark.createDataFrame([(x,) for x in [0, 50, 100]], "n_chars long")
    got = {r["bin"]: r["n"] for r in C.length_histogram(df, "n_chars", 100).collect()}
    assert got == {1: 1, 51: 1, 100: 1}


def test_first_occurrences_with_large_and_text_ids(spark):
    texts = ["beta alpha beta", "gamma alpha", "delta"]
    small = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for ids in ([i + (1 << 60) for i in range(3)], ["a", "b", "c"]):
        df = spark.createDataFrame(list(zip(ids, texts)), f"doc_id {'long' if isinstance(ids[0], int) else 'string'}, text string")
        for f in (lambda d: C.top_words(d, 10, stopwords=None), lambda d: C.type_token_ratio(d, sizes=(2, 4)),
                  lambda d: C.top_bigrams(d, 10, stopwords=None)):
            assert [tuple(r) for r in f(df).collect()] == [tuple(r) for r in f(small).collect()]
