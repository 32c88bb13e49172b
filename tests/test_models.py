"""Split, folds, top fraction and a small model fit."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from markerlens.operators import models as M


def test_split_is_partition_with_exact_quotas(spark):
    rows = [(i, i % 2, (i // 2) % 3 == 0) for i in range(103)]
    df = spark.createDataFrame(rows, "doc_id long, a int, b boolean").withColumn("b", F.col("b").cast("int"))
    out = M.stratified_split(df, ["a", "b"]).collect()
    assert len(out) == 103 and all(r["split"] in ("train", "dev", "test") for r in out)
    per = Counter((r["a"], r["b"], r["split"]) for r in out)
    sizes = Counter((r["a"], r["b"]) for r in out)
    for s, n in sizes.items():
        for name, pct in M.SPLITS:
            assert abs(per[(s[0], s[1], name)] - n * pct / 100) < 1


def test_small_strata(spark):
    df = spark.createDataFrame([(1, 0), (2, 1), (3, 1), (4, 1), (5, 1), (6, 1)], "doc_id long, g int")
    got = Counter((r["g"], r["split"]) for r in M.stratified_split(df, ["g"]).collect())
    assert got[(0, "train")] == 1
    assert (got[(1, "train")], got[(1, "dev")], got[(1, "test")]) == (3, 1, 1)


def test_top_fraction_half_even(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(250)], "doc_id long, s double")
    top = M.top_fraction(df, [-F.col("s")], 0.05)
    assert top.where("top").count() == 12  # 12.5 rounds half to even


def test_fit_and_score(spark):
    from pyspark.ml.linalg import Vectors
    rows = [(i, i % 2, Vectors.dense([float(i % 2), 1.0]), 1.0) for i in range(40)]
    df = spark.createDataFrame(rows, ["doc_id", "label", "features", "weight"])
    train, n = M.fit_frame(df)
    model = M.logreg(1.0, n).fit(train)
    s = M.score(model, df, "t", "m", "label")
    assert s.where("pred = label").count() == 40


def test_variants_side_by_side_and_closed_form(spark):
    import math

    from pyspark.ml.functions import array_to_vector

    # the term stands in 30 of 40 documents of label 1 and in 10 of 40 of label 0
    rows = [(i, i % 2, int(i // 2 < (30 if i % 2 else 10))) for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, label int, has int")
    weights = docs.where("has = 1").select("doc_id", F.lit("t").alias("term"), F.lit(1.0).alias("weight"))
    weights = weights.unionByName(docs.select("doc_id", F.lit("outside").alias("term"), F.lit(9.0).alias("weight")))
    index = spark.createDataFrame([("t", 1), ("unused", 0)], "term string, idx long")
    block = M.term_block(docs, weights, index)
    got = {r["doc_id"]: r["terms"] for r in block.collect()}
    assert len(got) == 80 and all(got[i].toArray().tolist() == [0.0, float(has)] for i, _, has in rows)
    embedding = docs.select("doc_id", array_to_vector(F.array(F.lit(0.0), F.lit(0.0))).alias("embedding"))
    shares = docs.select("doc_id", F.lit(0.0).alias("NOUN"))
    variants = {"base": ["terms"], "transfer": ["terms", "embedding"], "cascaded": ["terms", "embedding", "NOUN"]}
    out = M.assembled([docs, block, embedding, shares], variants)
    train, n = M.fit_frame(M.balanced_weights(out, "label"))
    for k, name in enumerate(variants):
        model = M.logreg(1e6, n, "label", name).fit(train)
        assert model.numFeatures == [2, 4, 5][k]
        # the log odds without the term are -ln 3, and with it ln 3
        assert model.intercept == pytest.approx(-math.log(3), abs=0.02)
        assert model.coefficients.toArray().tolist() == pytest.approx([0, 2 * math.log(3)] + [0] * [0, 2, 3][k], abs=0.02)


def test_no_row_of_features_passes_through_python(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    weights = docs.select("doc_id", F.lit("a").alias("term"), F.lit(0.5).alias("weight"))
    out = M.assembled([docs, M.term_block(docs, weights, spark.createDataFrame([("a", 0)], "term string, idx long"))], {"base": ["terms"]})
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()
    assert out.first()["base"].toArray().tolist() == [0.5]
    assert M.term_block(docs.limit(0), weights, spark.createDataFrame([], "term string, idx long")).count() == 0


def test_fit_frame_bounds_rows_of_a_task_and_keeps_only_what_a_fit_reads(spark):
    df = spark.range(12_000).selectExpr("id", "'a long text' AS text", "1.0D AS weight", "CAST(id % 2 AS INT) AS label")
    frame, n = M.fit_frame(df, "weight", "label")
    assert n == 12_000 and frame.columns == ["weight", "label"]
    assert max(frame.rdd.glom().map(len).collect()) <= 5_000
    frame.unpersist()


def test_fits_run_side_by_side_and_keep_their_order():
    import threading

    meet = threading.Barrier(4, timeout=20)
    assert M.side_by_side([lambda i=i: (meet.wait(), i)[1] for i in range(4)]) == [0, 1, 2, 3]
    with pytest.raises(ZeroDivisionError):
        M.side_by_side([lambda: 1, lambda: 1 // 0])


def test_grid_search_runs_folds_together_and_agrees_with_cross_validator(spark, monkeypatch):
    import threading

    from pyspark.ml import Pipeline
    from pyspark.ml.linalg import Vectors
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder

    rows = [(Vectors.dense([float((i * 7919) % 13), float(i % 3 == 0)]), 1.0, int((i * 31) % 7 < 3 or i % 3 == 0), i % 3) for i in range(90)]
    df = spark.createDataFrame(rows, ["features", "weight", "label", "fold"])
    df = df.withColumn("label", F.col("label").cast("int")).withColumn("fold", F.col("fold").cast("int"))
    c_values, n = (0.001, 1.0), 90
    lr = M.logreg(c_values[0], n)
    grid = ParamGridBuilder().addGrid(lr.regParam, [1.0 / (c * n) for c in c_values]).build()
    want = CrossValidator(estimator=Pipeline(stages=[lr]), estimatorParamMaps=grid, evaluator=M.MacroF1Evaluator("label"),
                          numFolds=3, foldCol="fold").fit(df)
    # the first fits of two values and three folds wait for each other, which folds one after the other can't
    meet, plain = threading.Barrier(6, timeout=60), M.MacroF1Evaluator._evaluate
    monkeypatch.setattr(M.MacroF1Evaluator, "_evaluate", lambda self, data: (meet.wait(), plain(self, data))[1])
    got = M.grid_search(df, "label", c_values, 3, parallelism=6)
    assert got.avgMetrics == pytest.approx(want.avgMetrics)
    assert got.bestModel.stages[0].coefficients.toArray().tolist() == pytest.approx(want.bestModel.stages[0].coefficients.toArray().tolist(), rel=1e-6)
    with pytest.raises(ValueError):
        M.grid_search(df.withColumn("fold", F.lit(7)), "label", c_values, 3)


def test_assembling_runs_no_job(spark):
    """Vectors say how long they are (round 4, F1): of others a row of each variant was computed with all it stands on."""
    docs = spark.createDataFrame([(1, "a b"), (2, "")], "doc_id long, text string")
    index = spark.createDataFrame([("a", 0), ("b", 1)], "term string, idx long")
    block = M.term_block(docs, docs.where("doc_id = 1").select("doc_id", F.lit("b").alias("term"), F.lit(0.5).alias("weight")), index)
    spark.sparkContext.setJobGroup("assembling", "")
    out = M.assembled([docs, block], {"base": ["terms"], "other": ["terms", "doc_id"]})
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("assembling")
    spark.sparkContext.setJobGroup("after", "")
    assert {r["doc_id"]: r["other"].toArray().tolist() for r in out.collect()} == {1: [0.0, 0.5, 1.0], 2: [0.0, 0.0, 2.0]}


def _sparse_rows(spark, n=300, d=30):
    import random

    from pyspark.ml.linalg import Vectors

    r, rows = random.Random(3), []
    for i in range(n):
        x = [r.random() if r.random() < 0.2 else 0.0 for _ in range(d)]
        x[0], x[1] = 1.0, r.gauss(5, 3)
        v = Vectors.dense(x) if i % 7 == 0 else Vectors.sparse(d, {j: v for j, v in enumerate(x) if v})
        rows.append((v, 0.5 + r.random(), int(x[2] + x[3] - x[4] + 0.3 * r.gauss(0, 1) > 0.1), i % 3))
    return spark.createDataFrame(rows, ["features", "weight", "label", "fold"]).selectExpr("features", "weight", "CAST(label AS INT) AS label", "CAST(fold AS INT) AS fold")


def test_fits_that_run_together_are_those_of_the_estimator(spark, monkeypatch):
    df = _sparse_rows(spark).cache()
    lr = M.logreg(1.0, 300)
    specs = [(fold, 1.0 / (c * 300)) for fold in (None, 1) for c in (0.01, 1.0, 100.0)]
    want = [lr.copy({lr.regParam: reg}).fit(df if fold is None else df.where(F.col("fold") != fold)) for fold, reg in specs]
    for most in (M.ENTRIES_PER_FIT, 10):  # a task for each fit, and a job for each round of all fits
        monkeypatch.setattr(M, "ENTRIES_PER_FIT", most)
        for model, (coefficients, intercept) in zip(want, M.fit_together(df, "label", specs, lr)):
            assert coefficients.tolist() == pytest.approx(model.coefficients.toArray().tolist(), rel=1e-8, abs=1e-10)
            assert intercept == pytest.approx(model.intercept, rel=1e-8)
    assert M.fit_together(df.where("label = 1"), "label", specs, lr) is None  # the estimator has rules of its own for one label


def test_a_grid_search_runs_no_job_for_each_step(spark):
    """Round 4, F2: each step of each fit was a Spark job."""
    df = _sparse_rows(spark, 120)
    c_values = (0.01, 1.0)
    spark.sparkContext.setJobGroup("grid", "")
    M.fit_together(df, "label", [(i, 1.0 / (c * 120)) for c in c_values for i in range(3)], M.logreg(1.0, 120))
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("grid")
    spark.sparkContext.setJobGroup("after", "")
    assert len(jobs) <= 12
