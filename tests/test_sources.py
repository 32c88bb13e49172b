"""Readers and writers on small files written by the test (FIXTURES F1–F4, F11, F13, F15)."""

import json
import os

import pytest

from markerlens.sources import readers as R
from markerlens.sources import writers as W


def write(path, text):
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


def test_header_detection(spark, tmpdir_path):
    d = os.path.join(tmpdir_path, "csv")
    os.makedirs(d)
    write(f"{d}/a.csv", 'My title row,,\nid,text,label\n1,"hello, world",0\n2,"multi\nline",1\n')
    write(f"{d}/b.csv", 'label,text\n1,first\n0,second\n')
    got = sorted((r["text"], r["label"]) for r in R.read_csv_detect_header(spark, d).collect())
    assert got == [("first", "1"), ("hello, world", "0"), ("multi\nline", "1"), ("second", "0")]


def test_files_of_different_widths(spark, tmpdir_path):
    d = os.path.join(tmpdir_path, "widths")
    os.makedirs(d)
    write(f"{d}/a.csv", "One title cell\na,b,c,label,d,text\n1,2,3,0,5,\"six, \"\"6\"\"\n\nstill six\"\n\n1,2,3,1,5,short\n")
    write(f"{d}/b.csv", "text,label\nplain,1\nonly text\n\"\",0\n")
    write(f"{d}/c.csv", "no,header\nhere,at all\n")
    write(f"{d}/e.csv", "x\ny\ntext,label\nlate,1\n")
    write(f"{d}/f.csv", "")
    write(f"{d}/g.csv", "label,text\n" + "".join(f"{k % 2},\"row {k}\nof \"\"many\"\", with a comma\"\n" for k in range(3000)))
    got = R.read_csv_detect_header(spark, d).cache()
    by = {}
    for r in got.orderBy("source_row").collect():
        by.setdefault(os.path.basename(r["source_file"]), []).append((r["text"], r["label"]))
    many = by.pop("g.csv")
    assert by == {"a.csv": [('six, "6"\n\nstill six', "0"), ("short", "1")], "b.csv": [("plain", "1"), ("only text", None), (None, "0")]}
    assert many == [(f'row {k}\nof "many", with a comma', str(k % 2)) for k in range(3000)]
    told = {os.path.basename(r["source_file"]): (r["ok"], r["reason"]) for r in R.csv_files(spark, d).collect()}
    assert told["c.csv"] == told["e.csv"] == (False, "columns missing: text, label") and told["f.csv"] == (False, "no records")
    assert all(told[f"{k}.csv"] == (True, None) for k in "abg")


def test_manifest_and_corpus_csv(spark, tmpdir_path):
    m = write(os.path.join(tmpdir_path, "m.csv"), "filename,url\na, https://x/a.csv\nb,https://x/b.csv\n")
    assert [r["url"] for r in R.read_manifest(spark, m).collect()] == ["https://x/a.csv", "https://x/b.csv"]
    c = write(os.path.join(tmpdir_path, "c.csv"), '"",text,label\n"0","zero",0\n"","blank id",1\n')
    rows = sorted((r["id"], r["text"]) for r in R.read_corpus_csv(spark, c).collect())
    assert rows == [(0, "zero"), (1, "blank id")]


def test_span_export_flatten(spark, tmpdir_path):
    recs = [
        {"id": 1, "data": {"Unnamed: 0": 0, "id": 5, "text": "WOW great!!", "label": 1},
         "annotations": [{"result": [
             {"value": {"start": 0, "end": 3, "text": "WOW", "labels": ["all_caps"]}},
             {"value": {"start": 9, "end": 11, "text": "!!", "labels": ["exclamation_marks"]}},
             {"value": {"start": 4, "end": 9, "text": "great", "labels": ["nonsense"]}}]},
             {"result": [{"value": {"start": 4, "end": 9, "text": "great", "labels": ["adjectives"]}}]}]},
        {"id": 2, "data": {"ID": 9, "Text": "plain", "label": None}, "annotations": []},
    ]
    p = write(os.path.join(tmpdir_path, "x_annotations.json"), json.dumps(recs))
    rows = {r["ID"]: r for r in R.flatten_span_export(R.read_span_export(spark, p)).collect()}
    first = rows[5]  # Unnamed: 0 = 0 is falsy, so id wins
    assert [s["text"] for s in first["all_caps"]] == ["WOW"]
    assert [s["text"] for s in first["exclamation_marks"]] == ["!!"]
    assert first["adjectives"] == []  # only the first annotation counts
    assert rows[9]["Text"] == "plain" and rows[9]["all_caps"] == []


def test_annotators_and_consolidated(spark, tmpdir_path):
    d = os.path.join(tmpdir_path, "ann")
    os.makedirs(d)
    write(f"{d}/alice_annotations_cleaned.json", json.dumps([
        {"ID": 1, "Text": "A", "all_caps": [["WOW", 0, 3]], "exclamation_marks": [], "hedging": [],
         "adjectives": [], "unk": []}]))
    write(f"{d}/bob_annotations_cleaned.json", json.dumps([
        {"id": 1, "text": "A", "all_caps": [["WOW", "0", "3"]]}]))
    long = R.read_annotators(spark, f"{d}/*_annotations_cleaned.json")
    caps = {r["annotator"]: r["category"] for r in long.where("feature = 'all_caps'").collect()}
    assert caps["alice"] == caps["bob"]
    c = write(os.path.join(tmpdir_path, "cons.json"), json.dumps([
        {"ID": 3, "Text": "t", "label": "1", "Annotator": "x", "hedging": [["maybe", 0, 5]]}]))
    row = R.read_consolidated(spark, c).first()
    assert row["doc_label"] == "1" and row["hedging"][0]["start"] == 0 and row["hedging"][0]["text"] == "maybe"


def test_annotator_records_are_rows_and_the_first_stays(spark, tmpdir_path):
    d = os.path.join(tmpdir_path, "many")
    os.makedirs(f"{d}/cy_annotations_cleaned.json")
    recs = [{"ID": k // 2, "Text": f"t{k // 2}", "hedging": [[f"w{k}", k, k + 2]], "unk": None} for k in range(2000)]
    write(f"{d}/al_annotations_cleaned.json", json.dumps(recs))  # one line, one array
    write(f"{d}/bo_annotations_cleaned.json", json.dumps([
        {"Unnamed: 0": None, "id": None, "text": "no id", "hedging": []}, {"id": 7, "Text": "t", "hedging": [["a", 0, 1]]},
        {"id": 7, "Text": "other", "hedging": [["b", 0, 1]]}, {"id": 7, "Text": "t", "hedging": [["c", 0, 1]]}], indent=2))
    write(f"{d}/cy_annotations_cleaned.json/part-0.json", json.dumps(recs[0]) + "\n" + json.dumps({"id": None, "text": None}) + "\n")
    arrays = [f"{d}/al_annotations_cleaned.json", f"{d}/bo_annotations_cleaned.json"]
    long = R.read_annotators(spark, arrays).where("feature = 'hedging'").cache()
    al = {r["item_id"]: r["spans"] for r in long.where("annotator = 'al'").collect()}
    assert len(al) == 1000 and all(s[0]["text"] == f"w{2 * k}" and s[0]["start"] == 2 * k for k, s in al.items())
    whole, aside = R.without_id(long.where("annotator = 'bo'"))
    assert sorted((r["item_id"], r["text"], r["spans"][0]["text"]) for r in whole.collect()) == [(7, "other", "b"), (7, "t", "a")]
    assert [(r["text"], r["spans"]) for r in aside.collect()] == [("no id", [])]
    zero = R.read_annotators(spark, arrays[1], repair_ids=True)
    assert {r["item_id"] for r in zero.collect()} == {0, 7}
    cy = R.read_annotators(spark, f"{d}/cy_annotations_cleaned.json", lines=True).where("feature = 'hedging'")
    assert sorted((r["annotator"], r["item_id"] or -1, r["category"] is None) for r in cy.collect()) == [("cy", -1, False), ("cy", -1, True)]


def test_feed_vectors_lexicon(spark, tmpdir_path):
    x = write(os.path.join(tmpdir_path, "feed.xml"),
              "<rss><channel><item><title>Hello</title><link> https://n/1 </link></item>"
              "<item><title>Two</title><link>https://n/2</link></item></channel></rss>")
    assert sorted(r["url"] for r in R.read_feed_items(spark, x).collect()) == ["https://n/1", "https://n/2"]
    v = write(os.path.join(tmpdir_path, "v.vec"), "3 4\nthe 1 2 3 4\nbad 1 2\ncat 0.5 0 0 1\n")
    vec = {r["token"]: r["vector"] for r in R.read_word_vectors(spark, v, 4).collect()}
    assert set(vec) == {"the", "cat"} and vec["cat"][0] == pytest.approx(0.5)
    lx = write(os.path.join(tmpdir_path, "lex.txt"), "# Modal\nmay\nmight\n# Adverbs\nperhaps\n")
    got = [(r["category"], r["term"]) for r in R.read_lexicon(spark, lx).collect()]
    assert got == [("Modal", "may"), ("Modal", "might"), ("Adverbs", "perhaps")]


def test_writers(spark, tmpdir_path):
    df = spark.createDataFrame([(3, "c", "train"), (1, "a", "dev"), (2, "b, x", "train")], "k long, t string, split string")
    out = os.path.join(tmpdir_path, "idx")
    W.write_csv_indexed(df.select("k", "t"), out, "k")
    back = spark.read.option("header", True).option("escape", '"').csv(out)
    assert sorted((int(r["id"]), r["t"]) for r in back.collect()) == [(0, "a"), (1, "b, x"), (2, "c")]
    with pytest.raises(Exception):
        W.write_csv_indexed(df.select("k", "t"), out, "k")  # a finished build is not overwritten
    sp = os.path.join(tmpdir_path, "splits")
    W.write_splits(df, sp)
    assert spark.read.parquet(sp).where("split = 'train'").count() == 2
    assert W.safe_key("LogReg — opinion/v1") == "LogReg___opinion_v1"
