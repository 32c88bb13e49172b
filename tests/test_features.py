"""Feature operators against brute-force Python on tiny fixtures (FIXTURES F10, F11)."""

import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from markerlens.operators import agreement as A
from markerlens.operators import consolidate as K
from markerlens.operators import features as X

DOCS = [(1, "The cat sat. The cat!"), (2, "A dog; the dog ran."), (3, ""), (4, "Café au lait, the café")]


def docs(spark):
    return spark.createDataFrame(DOCS, "doc_id long, text string")


def test_vocabulary_first_appearance(spark):
    vocab = {r["token"]: r["token_id"] for r in X.vocabulary(docs(spark)).collect()}
    order = []
    for _, t in DOCS:
        for tok in re.findall(r"\w+", t.lower()):
            if tok not in order:
                order.append(tok)
    assert vocab["<PAD>"] == 0 and vocab["<OOV>"] == 1
    assert [vocab[t] for t in order] == list(range(2, 2 + len(order)))


def test_encode_truncate_and_pad(spark):
    vocab = X.vocabulary(docs(spark).where("doc_id = 1"))
    enc = {r["doc_id"]: r["ids"] for r in X.encode(docs(spark), vocab, max_len=4).collect()}
    assert enc[1] == [2, 3, 4, 2]          # the cat sat the
    assert enc[2] == [1, 1, 2, 1]          # a dog the dog -> OOV except "the"
    assert enc[3] == [0, 0, 0, 0]          # empty text: all padding
    whole = {r["doc_id"]: r["ids"] for r in X.encode(docs(spark), vocab).collect()}
    assert len(whole[2]) == 5 and whole[3] == []


def test_tfidf_formula(spark):
    texts = {1: "a b a", 2: "a c", 3: "b b c"}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    model = X.tfidf_fit(df, max_features=3, min_df=2, ngram_max=1)
    idf = {r["term"]: r["idf"] for r in model.collect()}
    n = 3
    dfreq = {"a": 2, "b": 2, "c": 2}
    for t, d in dfreq.items():
        assert idf[t] == pytest.approx(math.log((1 + n) / (1 + d)) + 1)
    w = {(r["doc_id"], r["term"]): r["weight"] for r in X.tfidf_transform(df, model, ngram_max=1).collect()}
    raw = {t: (1 + math.log(c)) * idf[t] for t, c in Counter("a b a".split()).items()}
    norm = math.sqrt(sum(v * v for v in raw.values()))
    assert w[(1, "a")] == pytest.approx(raw["a"] / norm)


def test_standardise_zero_variance(spark):
    df = spark.createDataFrame([(1, 1.0, 5.0), (2, 3.0, 5.0)], "id long, x double, y double")
    fit = X.standardise_fit(df, ["x", "y"])
    out = {r["id"]: (r["x"], r["y"]) for r in X.standardise_apply(df, fit, ["x", "y"]).collect()}
    assert out[1] == (pytest.approx(-1.0), 0.0) and out[2] == (pytest.approx(1.0), 0.0)


def test_vectors_noise_and_embeddings(spark):
    vocab = X.vocabulary(docs(spark))
    vectors = spark.createDataFrame([("the", [1.0, 0.0]), ("cat", [0.0, 2.0])], "token string, vector array<float>")
    vecs = X.token_vectors(vocab, vectors, 2, seed=7)
    rows = {r["token"]: r for r in vecs.collect()}
    assert rows["<PAD>"]["vector"] == [0.0, 0.0] and rows["<OOV>"]["vector"] == [0.0, 0.0]
    assert rows["the"]["found"] and not rows["dog"]["found"]
    again = {r["token"]: r["vector"] for r in X.token_vectors(vocab, vectors, 2, seed=7).collect()}
    assert again["dog"] == rows["dog"]["vector"] and rows["dog"]["vector"] != [0.0, 0.0]
    emb = {r["doc_id"]: r["embedding"] for r in X.doc_embedding(docs(spark), vocab, vecs, 2).collect()}
    # doc 1: the cat sat the cat -> (2*[1,0] + 2*[0,2] + sat) / 5
    sat = rows["sat"]["vector"]
    assert emb[1][0] == pytest.approx((2 + sat[0]) / 5, rel=1e-5)
    assert emb[3] == [0.0, 0.0]
    weights = spark.createDataFrame([(1, "the", 0.5), (1, "cat", 0.25)], "doc_id long, term string, weight double")
    wemb = {r["doc_id"]: r["embedding"] for r in X.doc_embedding(docs(spark), vocab, vecs, 2, weights=weights).collect()}
    ws = 2 * 0.5 + 2 * 0.25 + 0.001
    assert wemb[1][1] == pytest.approx((2 * 0.25 * 2 + 0.001 * sat[1]) / ws, rel=1e-5)
    # weights that are all 0 give the plain mean
    none = spark.createDataFrame([(1, t, 0.0) for t in ("the", "cat", "sat")], "doc_id long, term string, weight double")
    zemb = {r["doc_id"]: r["embedding"] for r in X.doc_embedding(docs(spark), vocab, vecs, 2, weights=none).collect()}
    assert zemb[1] == pytest.approx(emb[1], rel=1e-9)


def test_tag_distribution_vector(spark):
    classes = spark.createDataFrame([("the", "DET"), ("cat", "NOUN")], "token string, class string")
    d = {r["doc_id"]: r for r in X.tag_distribution_vector(docs(spark), classes).collect()}
    assert d[1]["DET"] == pytest.approx(2 / 5) and d[1]["NOUN"] == pytest.approx(2 / 5)
    assert d[3]["X"] == 0.0


def test_repartitioning_does_not_change_agreement(spark):
    rows = [(f"r{(i * 7) % 4}", i // 4, f, c, i) for i in range(80)
            for f, c in (("f1", "ab"[(i * 3) % 2]), ("f2", "xyz"[(i * 5) % 3]))]
    df = spark.createDataFrame(rows, "annotator string, item_id long, feature string, category string, ord long")
    a = sorted((r["feature"], round(r["kappa"], 9)) for r in A.fleiss(df.repartition(1)).collect())
    b = sorted((r["feature"], round(r["kappa"], 9)) for r in A.fleiss(df.repartition(7, "ord")).collect())
    assert a == b
    ranking = spark.createDataFrame([("r0", 1), ("r1", 2)], "annotator string, rank int")
    v1 = sorted(tuple(r) for r in K.majority_vote(K.annotation_rows(df.repartition(1), ["f1", "f2"]), ranking).collect())
    v2 = sorted(tuple(r) for r in K.majority_vote(K.annotation_rows(df.repartition(5), ["f1", "f2"]), ranking).collect())
    assert v1 == v2


def test_augmented_train_merges_by_key_with_precedence(spark):
    base = spark.createDataFrame([("1", "a", 1), ("1", "a2", 0), (None, "n", 1)], "id string, text string, label int")
    extra = spark.createDataFrame([("1", "b", 5, "[x]", "o"), ("2", "c", 5, "[]", "o"), ("3", "d", 5, None, "o"), (None, "m", 5, "[y]", "o")],
                                  "id string, text string, label int, caps string, other string")
    found = spark.createDataFrame([("2", 0), ("2", 1), ("1", 1), (None, 1)], "id string, label int")
    flagged = X.replace_labels(X.binarised(extra, ["caps"], "q", ["p", "q"]), found, ["label"])
    assert {(r.id, r.label, r.caps_bin, r.annotator, r.p, r.q, r.split) for r in flagged.collect()} == {
        ("1", 1, 1, "q", 0, 1, "train"), ("2", 0, 0, "q", 0, 1, "train"), ("3", None, 0, "q", 0, 1, "train"), (None, None, 1, "q", 0, 1, "train")}
    made = spark.createDataFrame([("3", "e", 1), ("4", "f", 1), ("4", "f", 1)], "id string, text string, label int")
    got = X.augmented_train([("original", base), ("annotated", flagged), ("generated", made)])
    assert sorted(((r.id, r.text, r.provenance, r.caps) for r in got.collect()), key=repr) == sorted([
        ("1", "a", "original", None), ("1", "a2", "original", None), (None, "n", "original", None), ("2", "c", "annotated", "[]"),
        ("3", "d", "annotated", None), (None, "m", "annotated", "[y]"), ("4", "f", "generated", None), ("4", "f", "generated", None)], key=repr)
    assert X.augmented_train([("only", base.limit(0)), ("none", made.limit(0))]).count() == 0


def test_embeddings_are_hash_aggregates_and_tail_tokens_join_by_shuffle(spark, monkeypatch):
    vocab = X.vocabulary(docs(spark))
    vectors = spark.createDataFrame([("the", [1.0, 0.0]), ("cat", [0.0, 2.0])], "token string, vector array<float>")
    vecs = X.token_vectors(vocab, vectors, 2, seed=7)
    weights = spark.createDataFrame([(1, "the", 0.5), (1, "cat", 0.25)], "doc_id long, term string, weight double")
    want = {r["doc_id"]: r["embedding"] for r in X.doc_embedding(docs(spark), vocab, vecs, 2, weights=weights).collect()}
    monkeypatch.setattr(X, "HOT_TOKENS", 3)  # "the" alone is broadcast
    emb = X.doc_embedding(docs(spark), vocab, vecs, 2, weights=weights)
    got = {r["doc_id"]: r["embedding"] for r in emb.collect()}
    assert got.keys() == want.keys() and all(got[d] == pytest.approx(want[d], rel=1e-9) for d in want)
    plan = emb._jdf.queryExecution().toString()
    assert "ObjectHashAggregate" not in plan and "SortAggregate" not in plan


def test_first_occurrences_without_sorting_null_order_first(spark):
    df = spark.createDataFrame([(2, ["b", "a", "b"]), (None, ["x", "c", "b"]), (1, ["c", "a"])], "doc_id long, _toks array<string>")
    out = X._first_occurrences(df, "doc_id")
    assert {r["token"]: (r["_o"], r["_p"]) for r in out.collect()} == {"b": (None, 2), "a": (1, 1), "x": (None, 0), "c": (None, 1)}
    assert "SortAggregate" not in out._jdf.queryExecution().toString()


def test_encode_makes_rows_only_for_rare_tokens(spark, monkeypatch):
    """Frequent tokens are looked up inside the row (finding F25); the others come back to their places."""
    from markerlens.operators import features as X

    docs = spark.createDataFrame([(1, "a b zz a"), (2, ""), (3, None), (4, "c b"), (4, "d"), (None, "a")], "doc_id long, text string")
    vocab = spark.createDataFrame([("<PAD>", 0), ("<OOV>", 1), ("a", 2), ("b", 3), ("c", 4), ("d", 5)], "token string, token_id long")
    want = [(None, ()), (1, (2, 3, 1, 2)), (2, ()), (3, ()), (4, (4, 5, 3)), (4, (4, 5, 3))]
    for hot in (100, 4):
        monkeypatch.setattr(X, "HOT_IDS", hot)
        out = X.encode(docs, vocab)
        assert "Generate" not in out._jdf.queryExecution().executedPlan().toString() or hot == 4
        assert sorted(((r["doc_id"], tuple(r["ids"])) for r in out.collect()), key=lambda r: (r[0] or 0)) == want


ODD = ["Café au LAIT, naïve_1 ½ ² x2", "", None, "“Quoted” – end…", "İstanbul Iı ΣΑΣ", "e\u0301te cafe\u0301", "snow ☃ 漢字 ok", "a\x00b\tc\u2028d", "Ÿ ǅ ẞ ȿ Ⱥ ſ K", "_ __ 9"]


def test_words_made_in_a_batch_are_those_of_the_engine(spark):
    """Round 4, F1: texts in Latin letters are tokenised beside the counting, a slice at a time."""
    from markerlens.functions import text as T

    df = spark.createDataFrame([*enumerate(ODD), (3, "again the Same id"), (None, "no id")], "doc_id long, text string")
    for fold, tokens in ((False, T.word_tokens), (True, X._folded_tokens)):
        want = sorted(((r["doc_id"], w) for r in df.select("doc_id", tokens(F.col("text")).alias("w")).collect() for w in r["w"] or []), key=repr)
        got = [(x.batch.column("doc_id")[int(o)].as_py(), x.words[int(c)].as_py()) for batch in [X.token_lists(df, "doc_id", "text", tokens).toArrow().combine_chunks().to_batches()]
               for x in X._slices(batch, fold) for o, c in zip(x.owner, x.code)]
        assert sorted(got, key=repr) == want
    plain = {r["doc_id"]: r["plain"] is not None for r in X.token_lists(df, "doc_id", "text").collect()}
    assert plain[0] and plain[3] and not plain[4] and not plain[6]


def test_weights_as_lists_make_no_row_for_an_occurrence(spark):
    """Round 4, F1 and F6: the TF-IDF weights of a document stay in one row, in order of the vocabulary index."""
    from markerlens.operators import models as M

    texts = [(1, "b a b c"), (1, "a b"), (2, "C a"), (3, None), (4, "b c. A b"), (None, "a a")]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    model = X.tfidf_fit(df, min_df=1, ngram_max=3)
    stats = {r["term"]: r["df"] for r in model.collect()}
    assert stats["a"] == 4 and stats["a b"] == 2 and stats["b a b"] == 1 and stats["a b c"] == 1 and stats["c a"] == 2
    index = spark.createDataFrame([(t, i) for i, t in enumerate(sorted(stats, reverse=True))], "term string, idx long")
    rows = {(r["doc_id"], r["term"]): r["weight"] for r in X.tfidf_transform(df, model, ngram_max=3).collect()}
    lists = X.tfidf_transform(df, model.join(index, "term"), ngram_max=3, lists=True)
    assert "Generate" not in lists._jdf.queryExecution().executedPlan().toString()
    got = lists.collect()
    assert {(r["doc_id"], t): w for r in got for t, w in zip(r["terms"], r["weights"])} == pytest.approx(rows)
    assert all(r["idx"] == sorted(r["idx"]) for r in got) and len(got) == 5
    vectors = {r["doc_id"]: r["terms"].toArray().tolist() for r in M.term_block(df, lists, index).collect()}
    assert vectors == {r["doc_id"]: pytest.approx(r["terms"].toArray().tolist()) for r in M.term_block(df, X.tfidf_transform(df, model, ngram_max=3), index).collect()}


def test_classes_of_rare_tokens_join_by_shuffle(spark, monkeypatch):
    classes = spark.createDataFrame([("the", "DET", 2), ("cat", "NOUN", 3), ("cat", "VERB", 3), ("sat", "VERB", 4)], "token string, class string, token_id long")
    want = X.tag_distribution_vector(docs(spark), classes.drop("token_id")).collect()
    monkeypatch.setattr(X, "HOT_TOKENS", 3)
    for of in (classes, classes.drop("token_id")):
        assert sorted(X.tag_distribution_vector(docs(spark), of).collect()) == sorted(want)
    assert next(r for r in want if r["doc_id"] == 1)["VERB"] == pytest.approx(3 / 5)


def test_encode_counts_a_bounded_number_of_tokens_at_a_time(spark, monkeypatch):
    """Round 4, F3: a batch of 10,000 documents was looked up as a whole, against a million broadcast tokens."""
    assert X.HOT_IDS <= 200_000
    df = spark.createDataFrame([(i, " ".join(f"w{k % 7}" for k in range(i, i + 5)) + (" é ☃漢" if i % 2 else "")) for i in range(40)] + [(3, "w1 new")], "doc_id long, text string").coalesce(1)
    vocab = X.vocabulary(df.where("doc_id < 3"))
    want = sorted((r["doc_id"], r["ids"]) for r in X.encode(df, vocab).collect())
    for hot, most in ((200_000, 3), (4, 3), (4, 1_000)):
        monkeypatch.setattr(X, "HOT_IDS", hot)
        monkeypatch.setattr(X, "SLICE_TOKENS", most)
        assert sorted((r["doc_id"], r["ids"]) for r in X.encode(df, vocab).collect()) == want


def test_each_vector_of_a_token_counts(spark):
    vocab = spark.createDataFrame([("the", 2), ("cat", 3)], "token string, token_id long")
    vecs = spark.createDataFrame([(2, [1.0, 0.0]), (2, [3.0, 1.0]), (3, [0.0, 2.0])], "token_id long, vector array<float>")
    got = {r["doc_id"]: r["embedding"] for r in X.doc_embedding(docs(spark), vocab, vecs, 2).collect()}
    # doc 1: the cat sat the cat; "the" has two vectors, so it weighs four
    assert got[1] == pytest.approx([2 * 4 / 7, (2 * 1 + 2 * 2) / 7])
