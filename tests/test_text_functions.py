from pyspark.sql import functions as F

from markerlens.functions import text as T


def one(spark, expr, value, schema="s string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_clean_key_cases(spark):
    # lowercase, whitespace runs to one blank, stripped; empty stays empty
    cases = {"Hello World": "hello world", "  hello  ": "hello", "hello   world": "hello world",
             "hello\tworld\nagain": "hello world again", "": "", "a b c": "a b c"}
    for raw, want in cases.items():
        assert one(spark, T.clean_key("s"), raw) == want


def test_clean_key_idempotent(spark):
    for raw in ["  A\tB  C ", "x", "\n\n"]:
        once = one(spark, T.clean_key("s"), raw)
        assert one(spark, T.clean_key("s"), once) == once


def test_whitespace_token_count_blank_is_zero(spark):
    for raw, want in {"": 0, "   ": 0, "\t\n": 0, "a b  c": 3, " a ": 1}.items():
        assert one(spark, T.whitespace_token_count("s"), raw) == want


def test_tokens_and_stopwords(spark):
    assert one(spark, T.alpha_tokens("s"), "It's 2 GOOD-days") == ["it", "s", "good", "days"]
    assert one(spark, T.word_tokens("s"), "Café au_lait 42") == ["café", "au_lait", "42"]
    toks = T.remove_stopwords(T.alpha_tokens("s"), ["the", "of"])
    assert one(spark, toks, "The end of the road") == ["end", "road"]


def test_ngrams(spark):
    arr = "a array<string>"
    assert one(spark, T.ngrams("a", 2), ["x", "y", "z"], arr) == ["x y", "y z"]
    assert one(spark, T.ngrams("a", 3), ["x", "y", "z", "w"], arr) == ["x y z", "y z w"]
    assert one(spark, T.ngrams("a", 2), ["x"], arr) == []
    assert one(spark, T.ngrams("a", 2), [], arr) == []


def test_before_url_and_preview(spark):
    assert one(spark, T.before_url("s"), "Read this https://x.org now") == "Read this"
    assert one(spark, T.before_url("s"), "no link here ") == "no link here"
    assert one(spark, T.preview("s", 3), "abcdef") == "abc"


def test_elongation_and_placeholders(spark):
    assert one(spark, T.squeeze_elongation("s"), "sooooo goood") == "sooo goood"
    out = one(spark, T.social_placeholders("s"), "@bob see https://t.co/x #news :) 42")
    assert out == "MENTION see URL HASHTAG SMILEY NUMBER"


def test_fold_accents_and_sentences(spark):
    assert one(spark, T.fold_accents("s"), "éàçñü") == "eacnu"
    assert one(spark, T.fold_accents("s"), "čašću ńandú e\u0301t\u00e9 łódź") == "cascu nandu ete łodz"
    assert one(spark, T.sentence_count("s"), "One. Two! Three? ...") == 3
    assert one(spark, T.sentence_count("s"), "no end") == 1


def test_spans_key_sorted(spark):
    a = [("b", 1, 2), ("a", 5, 6)]
    b = [("a", 5, 6), ("b", 1, 2)]
    schema = "sp array<struct<text:string,start:int,end:int>>"
    assert one(spark, T.spans_key("sp"), a, schema) == one(spark, T.spans_key("sp"), b, schema)
