"""Incremental ingest: two file drops with one checkpoint equal one batch run."""

import os

import pytest
from pyspark.sql import functions as F

from markerlens.streaming import ingest


def drop(d, name, rows):
    with open(os.path.join(d, name), "w", encoding="utf-8") as f:
        f.write("text,label\n" + "".join(f'"{t}",{l}\n' for t, l in rows))


def test_two_drops_equal_one_run(spark, tmpdir_path):
    first = [("Alpha text", 0), ("alpha   TEXT", 1), ("Reuters says", 0), ("beta", 1)]
    second = [("ALPHA text", 0), ("gamma", 0), ("delta", 5)]
    inc_src, inc_out, inc_ck = (os.path.join(tmpdir_path, x) for x in ("src", "out", "ck"))
    os.makedirs(inc_src)
    drop(inc_src, "a.csv", first)
    ingest.run(spark, inc_src, inc_out, inc_ck)
    drop(inc_src, "b.csv", second)
    ingest.run(spark, inc_src, inc_out, inc_ck)
    one_src, one_out, one_ck = (os.path.join(tmpdir_path, x) for x in ("src1", "out1", "ck1"))
    os.makedirs(one_src)
    drop(one_src, "a.csv", first)
    drop(one_src, "b.csv", second)
    ingest.run(spark, one_src, one_out, one_ck)
    inc = sorted(r["clean_key"] for r in spark.read.parquet(inc_out).collect())
    one = sorted(r["clean_key"] for r in spark.read.parquet(one_out).collect())
    assert inc == one == ["alpha text", "beta", "gamma"]
    # a rerun with nothing new writes nothing
    ingest.run(spark, inc_src, inc_out, inc_ck)
    assert spark.read.parquet(inc_out).count() == 3


def test_dedup_across_micro_batches_in_one_run(spark, tmpdir_path):
    src, out, ck = (os.path.join(tmpdir_path, x) for x in ("s2", "o2", "c2"))
    os.makedirs(src)
    drop(src, "a.csv", [("Same words", 0), ("only a", 1)])
    drop(src, "b.csv", [("same   WORDS", 1), ("only b", 0)])
    batches = ingest.run(spark, src, out, ck, max_files_per_trigger=1)
    assert batches == 2
    keys = sorted(r["clean_key"] for r in spark.read.parquet(out).collect())
    assert keys == ["only a", "only b", "same words"]


def raw(d, name, text):
    with open(os.path.join(d, name), "w", encoding="utf-8", newline="") as f:
        f.write(text)


def test_headers_widths_and_failed_files(spark, tmpdir_path):
    src, out, ck = (os.path.join(tmpdir_path, x) for x in ("s3", "o3", "c3"))
    os.makedirs(src)
    raw(src, "a.csv", 'A title\nid,more,text,label\n1,x,"one, ""quoted""\nline",1\n')
    raw(src, "b.csv", "label,text\r\n0,two\r\n")
    raw(src, "c.csv", "id,body\n1,lost\n")
    raw(src, "d.csv", "")
    ingest.run(spark, src, out, ck)
    assert sorted((r["text"], r["label"]) for r in spark.read.parquet(out).collect()) == [('one, "quoted"\nline', 1), ("two", 0)]
    failed = {os.path.basename(r["source_file"]): r["reason"] for r in spark.read.parquet(f"{out}_failed").collect()}
    assert failed == {"c.csv": "columns missing: text, label"}  # the file source passes over empty files
    ingest.run(spark, src, out, ck)  # failed files are not read again
    assert spark.read.parquet(out).count() == 2


def test_output_without_progress_is_refused(spark, tmpdir_path):
    src, out, ck = (os.path.join(tmpdir_path, x) for x in ("s4", "o4", "c4"))
    os.makedirs(src)
    drop(src, "a.csv", [("one", 0)])
    ingest.run(spark, src, out, ck)
    with pytest.raises(FileExistsError, match="no interrupted progress"):
        ingest.run(spark, src, out, os.path.join(tmpdir_path, "another"))
    assert spark.read.parquet(out).count() == 1


def test_a_batch_reads_its_own_digest_partitions(spark, tmpdir_path):
    src, out, ck = (os.path.join(tmpdir_path, x) for x in ("s5", "o5", "c5"))
    os.makedirs(src)
    drop(src, "a.csv", [(f"text number {k}", 0) for k in range(300)])
    ingest.run(spark, src, out, ck)
    keys = spark.read.parquet(f"{out}_keys")
    prefixes = sorted(r[0] for r in keys.select("prefix").distinct().collect())
    assert len(prefixes) > 100
    seen = ingest.seen_digests(spark, f"{out}_keys", prefixes[:2], 99)
    assert {p for f in seen.inputFiles() for p in prefixes if f"prefix={p}/" in f} >= set(prefixes[:2])
    plan = seen._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "prefix" in plan.split("PartitionFilters")[1].split("]")[0]
    assert seen.count() == keys.where(F.col("prefix").isin(*prefixes[:2])).count()


def test_a_repeated_batch_changes_nothing(spark, tmpdir_path):
    src, out = (os.path.join(tmpdir_path, x) for x in ("s6", "o6"))
    os.makedirs(src)
    drop(src, "a.csv", [("one", 0), ("two", 1)])
    drop(src, "b.csv", [("TWO", 0), ("three", 1)])
    for name, batch in (("a.csv", 0), ("b.csv", 1), ("b.csv", 1), ("a.csv", 0)):
        ingest.write_batch(spark, [os.path.join(src, name)], batch, out, f"{out}_keys", f"{out}_failed")
        if batch:
            assert sorted(r["clean_key"] for r in spark.read.parquet(out).collect()) == ["one", "three", "two"]
