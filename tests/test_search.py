"""Search on the four-document fixture (FIXTURES F6) and the ingestion dedup cases (F8)."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from markerlens.operators import search as Q

DOC_SCHEMA = "ordinal long, text string, label string, tags array<string>"


def index(spark, annotated, ai, corpus):
    docs = Q.build_documents(spark.createDataFrame(annotated, DOC_SCHEMA), spark.createDataFrame(ai, DOC_SCHEMA),
                             spark.createDataFrame(corpus, DOC_SCHEMA))
    return docs, Q.build_postings(docs)


@pytest.fixture(scope="module")
def populated(spark):
    return index(spark,
                 [(0, "maybe this is true", "1", ["hedging"]), (1, "SHOUT at the top", "0", ["all_caps"])],
                 [(0, "possibly a rumour", "1", ["hedging"])],
                 [(0, "plain corpus document", "0", [])])


def ids(df):
    return [r["doc_id"] for r in df.collect()]


def test_keyword_and_facets(populated):
    docs, post = populated
    assert ids(Q.search(docs, post, ["maybe"])) == ["annot_0"]
    assert "corpus_0" not in ids(Q.search(docs, post, [], source="annotated"))
    tagged = ids(Q.search(docs, post, [], tags=["hedging"]))
    assert "annot_0" in tagged and "annot_1" not in tagged
    assert set(ids(Q.search(docs, post, [], label="0"))) == {"annot_1", "corpus_0"}
    assert len(ids(Q.search(docs, post, [], limit=1))) == 1


def test_ai_results_only_on_request(populated):
    docs, post = populated
    main = Q.two_panel(docs, post, ["possibly"], show_ai=False)
    assert ids(main) == []
    both = Q.two_panel(docs, post, ["possibly"], show_ai=True)
    assert [(r["panel"], r["doc_id"]) for r in both.collect()] == [("ai", "ai_0")]


def test_match_all_insertion_order(populated):
    docs, post = populated
    assert ids(Q.search(docs, post, [])) == ["annot_0", "annot_1", "corpus_0"]


def test_bm25_value(populated):
    docs, post = populated
    score = Q.search(docs, post, ["the"]).first()["score"]
    # 4 documents, avg length (4 + 4 + 3 + 3) / 4 = 3.5; "the" once in a 4-token document
    idf = math.log(4 / (1 + 1)) + 1
    want = idf * (1 * 2.2) / (1 + 1.2 * (0.25 + 0.75 * 4 / 3.5))
    assert score == pytest.approx(want)


def test_any_mode_and_phrase(populated):
    docs, post = populated
    assert set(ids(Q.search(docs, post, ["maybe", "shout"], mode="any"))) == {"annot_0", "annot_1"}
    assert ids(Q.search(docs, post, ["maybe", "shout"], mode="all")) == []
    assert ids(Q.phrase_search(docs, post, ["at", "the"])) == ["annot_1"]
    assert ids(Q.phrase_search(docs, post, ["the", "at"])) == []


def test_ingestion_dedup(spark):
    docs, _ = index(spark,
                    [(0, "Same text", "1", []), (1, "same   TEXT ", "0", [])],      # one document
                    [(0, "same text", "", []), (1, "Same text", "", [])],          # AI keeps its own, once
                    [(0, "same text", "0", []), (1, "other", "1", []), (2, "  ", "0", [])])
    got = sorted(ids(docs))
    assert got == ["ai_0", "annot_0", "corpus_1"]


def test_pairing_last_ai_wins(spark):
    main = spark.createDataFrame([("annot_0", "Hello ")], "doc_id string, text string")
    ai = spark.createDataFrame([("ai_1", "hello", 1), ("ai_2", "HELLO", 2)], "doc_id string, text string, ordinal long")
    assert Q.pair_with_ai(main, ai).first()["ai_doc_id"] == "ai_2"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    r = random.Random(3)
    text = lambda: " ".join(r.choices("the of cat Dog sat on mat".split(), [9, 6, 2, 2, 1, 1, 1], k=r.randint(1, 30)))
    rows = {s: [(i, text(), r.choice("01"), r.choice([[], ["hedging"]])) for i in range(40)] for s in ("annotated", "ai", "corpus")}
    frames = [spark.createDataFrame(rows[s], DOC_SCHEMA) for s in ("annotated", "ai", "corpus")]
    path = str(tmp_path_factory.mktemp("index") / "one")
    Q.write_index(*frames, path, buckets=5)
    return path, Q.build_documents(*frames).collect()


def phrases_by_hand(docs, phrase):
    out = {}
    for d in docs:
        w = d["text"].lower().split()
        n = sum(w[i:i + len(phrase)] == phrase for i in range(len(w)))
        if n:
            out[d["doc_id"]] = n
    return out


@pytest.mark.parametrize("phrase", [["the"], ["of", "the"], ["the", "the"], ["the", "of", "the"], ["cat", "bird"]])
def test_stored_phrases_against_brute_force(spark, corpus, phrase):
    path, docs = corpus
    got = {r["doc_id"]: r["tf"] for r in Q.phrase_counts(Q.open_index(spark, path), phrase).collect()}
    assert got == phrases_by_hand(docs, phrase)


@pytest.mark.parametrize("terms, mode", [(["the"], "all"), (["cat", "dog"], "all"), (["CAT", "sat", "bird"], "any"), (["bird"], "all")])
def test_stored_search_against_brute_force(spark, corpus, terms, mode):
    path, docs = corpus
    words = {d["doc_id"]: d["text"].lower().split() for d in docs}
    mean = sum(map(len, words.values())) / len(words)
    want = {}
    for d in docs:
        w, score, n = words[d["doc_id"]], 0.0, 0
        for t in {t.lower() for t in terms}:
            df, tf = sum(t in x for x in words.values()), w.count(t)
            n += tf > 0
            score += (math.log(len(words) / (df + 1)) + 1) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(w) / mean)) if tf else 0
        if d["source"] != "ai" and n and (mode == "any" or n == len(terms)):
            want[d["doc_id"]] = score
    got = Q.search_index(Q.open_index(spark, path), terms, mode=mode, limit=None).collect()
    assert {r["doc_id"]: r["score"] for r in got} == pytest.approx(want)
    assert [r["score"] for r in got] == sorted((r["score"] for r in got), reverse=True)


def test_stored_search_reads_no_text_and_only_its_folders(spark, corpus):
    index = Q.open_index(spark, corpus[0])
    for df in (Q.search_index(index, ["cat", "dog"]), Q.search_phrase(index, ["of", "the"]), Q.search_panels(index, ["cat"])):
        plan = df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        assert "text:string" not in plan and "regexp" not in plan
        assert re.search(r"PartitionFilters: \[.*bucket#\d+ (=|IN|INSET)", plan)
        assert "CartesianProduct" not in plan


def test_index_of_nothing(spark):
    none = spark.createDataFrame([], DOC_SCHEMA)
    index = Q.build_index(none, none, none)
    assert [df.count() for df in (index.documents, index.postings, Q.search_index(index, ["a"]), Q.search_index(index, []),
                                  Q.search_phrase(index, ["a", "b"]))] == [0] * 5


def test_index_is_written_without_a_sampling_pass(spark, tmp_path, monkeypatch):
    rows = [(i, f"the cat number {i} and the dog", "1", []) for i in range(40)]
    frames = [spark.createDataFrame(part, DOC_SCHEMA) for part in (rows[:1], rows[1:2], rows[2:])]

    def ranged(self, *_):
        raise AssertionError("ranges compute the postings twice")

    monkeypatch.setattr(type(frames[0]), "repartitionByRange", ranged)
    index = Q.write_index(*frames, str(tmp_path / "index"), buckets=2)
    assert {r["term"]: (r["df"], r["cf"]) for r in index.terms.where("df > 1").collect()} == {
        t: (40, 80 if t == "the" else 40) for t in ("the", "cat", "number", "and", "dog")}
    the = index.postings.where("term = 'the'")
    assert {(tuple(r["positions"]), r["tf"], r["doc_len"]) for r in the.collect()} == {((0, 5), 2, 7)}
    assert the.select(F.input_file_name()).distinct().count() > 1  # a word of every document is written by several tasks


def test_postings_make_no_row_per_occurrence(spark):
    """Token lists are grouped inside Arrow batches (findings F9 to F12, F19, F21); texts that share an id are one document."""
    from markerlens.operators import search as Q

    docs = spark.createDataFrame([("a", "b a b 1.5"), ("c", ""), ("d", "b"), ("d", "x b"), ("e", None)], "doc_id string, text string")
    posts = Q.build_postings(docs)
    assert "Generate" not in posts._jdf.queryExecution().executedPlan().toString()
    got = sorted((r["term"], r["doc_id"], r["tf"], tuple(r["positions"])) for r in posts.collect())
    assert got == [("1.5", "a", 1, (3,)), ("a", "a", 1, (1,)), ("b", "a", 2, (0, 2)), ("b", "d", 2, (0, 1)), ("x", "d", 1, (0,))]


def test_rule_tags_search_the_text_for_whole_words(spark):
    from markerlens.operators import search as Q

    texts = ["THE USA", "USAX maybe", "Mayor may. damned", "ful", "helpFUL!", "ſhall", None, "a_damn_b AB1"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    tagged = df.select("i", Q.rule_tags("text", ["may", "shall", "two words"], ["USA"], ["Damn"]).alias("tags"))
    assert "regexp_extract_all" not in tagged._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r["tags"]) for r in tagged.orderBy("i").collect()] == [
        ("all_caps",), ("all_caps",), ("hedging",), (), ("exclamation_marks", "adjectives"), (), (), ("all_caps", "unk")]
