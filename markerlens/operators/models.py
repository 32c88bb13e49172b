"""Sampling and models (pipeline D): ML-5 … ML-13, WIN-9, AGG-31, SNK-4/6.

The split is exact and deterministic without a global sort in one task: rows are ordered by a
seeded hash inside their stratum via the two-level contiguous index, and per-stratum quotas
(largest remainder over integer percentages) come from a table with one row per stratum and
split. Models are ``pyspark.ml`` estimators on assembled sparse vectors; grid search is a
cross-validation over stratified fold ids with a macro-F1 evaluator, folds and grid points side by side.
"""

from __future__ import annotations

import pickle
import sys
import uuid
from collections.abc import Callable, Sequence
from functools import reduce
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel, cloudpickle, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.common import _py2java
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.ml.tuning import CrossValidatorModel, ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from markerlens.operators.evaluate import class_metrics
from markerlens.operators.ordering import contiguous_index, with_scalars
from markerlens.session import shared_path

# The solver travels with the job: workers need not find this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Split names and percentages of the 60 / 20 / 20 split, and the default seeds.
SPLITS = (("train", 60), ("dev", 20), ("test", 20))
SPLIT_SEED = 344
MODEL_SEED = 581
C_GRID = (0.001, 0.01, 0.1, 1.0)


def hash_order(id_col: str, seed: int) -> Column:
    """Default seeded order key inside a stratum."""
    return F.xxhash64(F.col(id_col), F.lit(seed))


def stratum_quotas(strata_counts: DataFrame, keys: Sequence[str],
                   splits: Sequence[tuple[str, int]] = SPLITS) -> DataFrame:
    """Largest-remainder quotas per stratum: base = n·p div 100, the leftover rows go to the
    splits with the largest remainders (ties by split order). One row per (stratum, split)."""
    parts = F.array(*[F.struct(F.lit(name).alias("split"), F.lit(i).alias("split_order"), F.lit(p).alias("pct"))
                      for i, (name, p) in enumerate(splits)])
    q = strata_counts.select(*keys, "n", F.inline(parts))
    q = q.withColumn("base", F.expr("(n * pct) div 100")).withColumn("rem", F.expr("(n * pct) % 100"))
    # window over the (stratum, split) table: bounded by the number of strata × splits
    w_left = Window.partitionBy(*keys)
    w_rank = Window.partitionBy(*keys).orderBy(F.desc("rem"), "split_order")
    q = q.withColumn("_left", F.col("n") - F.sum("base").over(w_left)) \
         .withColumn("_rank", F.row_number().over(w_rank)) \
         .withColumn("quota", F.col("base") + F.when(F.col("_rank") <= F.col("_left"), 1).otherwise(0))
    w_cum = Window.partitionBy(*keys).orderBy("split_order").rowsBetween(Window.unboundedPreceding, 0)
    return q.withColumn("upper", F.sum("quota").over(w_cum)).select(*keys, "split", "split_order", "quota", "upper")


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on ``keys`` in which null equals null (a null label is a stratum like any other)."""
    other = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    on = [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys]
    return left.join(other, on, "inner").drop(*[f"__r_{k}" for k in keys])


def stratified_split(df: DataFrame, strata: Sequence[str], id_col: str = "doc_id",
                     splits: Sequence[tuple[str, int]] = SPLITS, seed: int = SPLIT_SEED,
                     order_key: Column | None = None) -> DataFrame:
    """ML-8 multilabel stratified split: stratum = the tuple of ``strata`` columns; inside a
    stratum rows are taken in seeded-hash order; each stratum meets its quotas exactly.
    Adds ``split``."""
    keys = list(strata)
    key = order_key if order_key is not None else hash_order(id_col, seed)
    base = df.withColumn("_ok", key)
    idx = contiguous_index(base.select(id_col, *keys, "_ok"), keys + ["_ok", id_col], "_gidx")
    counts = idx.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min("_gidx").alias("_start"))
    pos = null_safe_join(idx, counts.select(*keys, "_start"), keys) \
        .select(id_col, (F.col("_gidx") - F.col("_start")).alias("_pos"), *keys)
    quotas = stratum_quotas(counts.select(*keys, "n"), keys, splits)
    # quotas: strata × splits rows (strata are few: a product of binary label columns)
    assigned = null_safe_join(pos, quotas, keys).where(F.col("_pos") < F.col("upper")) \
        .groupBy(id_col).agg(F.min(F.struct("split_order", "split")).alias("_s"))
    return df.join(assigned.select(id_col, F.col("_s.split").alias("split")), id_col, "left")


def fold_ids(df: DataFrame, strata: Sequence[str], id_col: str = "doc_id", k: int = 5,
             seed: int = MODEL_SEED) -> DataFrame:
    """Stratified fold id 0..k−1 (the split operator with k equal parts, 100 at most)."""
    if not 1 <= k <= 100:
        raise ValueError("k must be between 1 and 100: parts are whole percents")
    base = 100 // k
    parts = [(str(i), base + (1 if i < 100 - base * k else 0)) for i in range(k)]
    out = stratified_split(df, strata, id_col, parts, seed)
    return out.withColumn("fold", F.col("split").cast("int")).drop("split")


def split_shares(df: DataFrame, split: str = "split", cols: Sequence[str] = ()) -> DataFrame:
    """ML-9 rows per split and the share of 1s of each 0/1 column."""
    return df.groupBy(split).agg(F.count(F.lit(1)).alias("n"),
                                 *[F.avg(F.col(c).cast("double")).alias(f"{c}_share") for c in cols])


def top_fraction(ranked: DataFrame, order: Sequence[Column | str], pct: float, id_col: str = "doc_id") -> DataFrame:
    """WIN-9 mark the first round-half-even(n·pct) rows in ascending ``order`` (value
    expressions; negate one for descending), ties by id, as ``top``."""
    o = ranked.select("*", *[(c if isinstance(c, Column) else F.col(c)).alias(f"_o{i}") for i, c in enumerate(order)])
    idx = contiguous_index(o, [f"_o{i}" for i in range(len(order))] + [id_col], "_idx")
    n = ranked.agg(F.count(F.lit(1)).alias("_n"))
    j = with_scalars(idx, n)
    return j.withColumn("top", F.col("_idx") < F.bround(F.col("_n") * pct, 0)) \
        .drop("_idx", "_n", *[f"_o{i}" for i in range(len(order))])


# ---------------------------------------------------------------- features → vectors

def term_block(docs: DataFrame, weights: DataFrame, vocab_index: DataFrame, doc: str = "doc_id") -> DataFrame:
    """(doc, terms): a sparse vector of the TF-IDF weights at their vocabulary index for each document of
    ``docs``, all zeros without a term. ``weights`` are rows (doc, term, weight) or the lists of ``tfidf_transform``,
    made with the ``idx`` of ``vocab_index``.

    The index table has at most ``max_features`` rows (broadcast). SQL has no constructor of sparse vectors, but
    Parquet holds them as (type, size, indices, values): the struct is written to the shared folder and read as
    vectors, so no row passes through Python.
    """
    spark = docs.sparkSession
    if "weights" in weights.columns:
        entries = weights.select(doc, F.struct("idx", F.col("weights").alias("w")).alias("_e"))
    else:
        entries = (weights.join(F.broadcast(vocab_index), "term").groupBy(doc)
                   .agg(F.array_sort(F.collect_list(F.struct(F.col("idx").cast("int").alias("idx"), F.col("weight").cast("double").alias("w")))).alias("_e")))
    j = with_scalars(docs.select(doc).distinct().join(entries, doc, "left"), vocab_index.agg(F.count(F.lit(1)).cast("int").alias("_n")))
    none = lambda kind: F.array().cast(f"array<{kind}>")
    vector = F.struct(F.lit(0).cast("byte").alias("type"), F.col("_n").alias("size"), F.coalesce("_e.idx", none("int")).alias("indices"),
                      F.coalesce("_e.w", none("double")).alias("values"))
    path = shared_path(spark, f"terms-{uuid.uuid4().hex}")
    out = j.select(doc, vector.alias("terms"))
    out.write.parquet(path)
    known = StructField("terms", VectorUDT(), metadata=vector_size(vocab_index.count()))
    return spark.read.schema(StructType([out.schema[doc], known])).parquet(path)


def vector_size(n: int) -> dict:
    """Metadata of a vector column of ``n`` entries; of one without, ``VectorAssembler`` computes a row to see its length."""
    return {"ml_attr": {"num_attrs": n}}


def assembled(blocks: Sequence[DataFrame], variants: dict[str, Sequence[str]], doc: str = "doc_id") -> DataFrame:
    """JN-12, ML-4 the blocks side by side by document, and for each variant a vector column of that name of the
    columns it lists (numbers and vectors, in this order). The first block gives the rows; each other one must have
    a row for every document of it."""
    out = reduce(lambda a, b: a.join(b, doc), blocks)
    for name, columns in variants.items():
        out = VectorAssembler(inputCols=list(columns), outputCol=name).transform(out)
    return out


def balanced_weights(df: DataFrame, label: str) -> DataFrame:
    """AGG-31 balanced class weights n / (2·n_c), as a ``weight`` column."""
    c = df.groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))
    n = df.agg(F.count(F.lit(1)).alias("_n"))
    w = with_scalars(c, n).select(label, (F.col("_n") / (2.0 * F.col("_nc"))).alias("weight"))
    return df.join(F.broadcast(w), label, "left")


ROWS_PER_FIT_PARTITION = 5_000


def fit_frame(df: DataFrame, *columns: str) -> tuple[DataFrame, int]:
    """Training rows for an iterative fit, with the ``columns`` it reads (all without any): every L-BFGS iteration is one
    job over them, so they are cached on ceil(n / 5k) partitions — one for a few hundred rows, many for millions. A row
    can hold thousands of terms, so this bounds what a task reads and holds."""
    df = df.select(*columns) if columns else df
    n = df.count()
    parts = max(1, -(-n // ROWS_PER_FIT_PARTITION))
    return df.repartition(parts).cache(), n


def logreg(c_value: float, n_rows: int, label: str = "label", features: str = "features") -> LogisticRegression:
    """ML-5 L2 logistic regression, inverse strength C: regParam = 1/(C·n), no internal
    standardisation, class-balanced row weights."""
    return LogisticRegression(featuresCol=features, labelCol=label, weightCol="weight",
                              regParam=1.0 / (c_value * n_rows), elasticNetParam=0.0,
                              standardization=False, maxIter=1000, family="binomial",
                              # stopping tolerance as in the reference's solver defaults (1e-4)
                              tol=1e-4)


class MacroF1Evaluator(Evaluator):
    """Macro F1 of ``prediction`` against the label, computed by a grouped aggregate."""

    def __init__(self, label: str = "label"):
        super().__init__()
        self.label = label

    def _evaluate(self, dataset: DataFrame) -> float:
        s = dataset.select(F.col(self.label).cast("int").alias("label"), F.col("prediction").cast("int").alias("pred"),
                           F.lit("t").alias("task"), F.lit("m").alias("model"))
        return float(class_metrics(s).first()["macro_f1"])

    def isLargerBetter(self) -> bool:
        return True


#: Fits that run at the same time, whatever their size.
PARALLEL_FITS = 4


def side_by_side(calls: Sequence[Callable], most: int = PARALLEL_FITS) -> list:
    """Results of ``calls`` in order, ``most`` running at a time: a fit is a row of small jobs, and the jobs of
    several fits fill the cores that one leaves idle."""
    with ThreadPool(max(1, min(most, len(calls)))) as pool:
        return [job.get() for job in [pool.apply_async(inheritable_thread_target(call)) for call in calls]]


#: Vector entries other than 0 (12 bytes each) that a task of a fit may hold.
ENTRIES_PER_FIT = 10_000_000


class _SearchFailed(Exception):
    """A line search that finds no step, or a history that gives no direction."""


def _strong_wolfe(value: float, slope: float, t: float):
    """Step length by the strong Wolfe conditions (Breeze's search: c1 1e-4, c2 0.9, cubic steps); yields lengths, gets (value, slope) at them."""
    if slope > 0:
        raise _SearchFailed
    low = (0.0, value, slope)

    def between(left, right):
        (lt, lv, ls), (rt, rv, rs) = (left, right) if left[0] <= right[0] else (right, left)
        d1 = ls + rs - 3 * (lv - rv) / (lt - rt)
        d2 = np.sqrt(d1 * d1 - ls * rs)
        at = rt - (rt - lt) * (rs + d2 - d1) / (rs - ls + 2 * d2)
        least, most = lt + 0.1 * (rt - lt), lt + 0.9 * (rt - lt)
        return least if at < least else most if at > most else at

    def zoom(low, high):
        for _ in range(10):
            at = between(low, high)
            c = (at, *(yield at))
            if c[1] > value + 1e-4 * at * slope or c[1] >= low[1]:
                high = c
            else:
                if abs(c[2]) <= 0.9 * abs(slope):
                    return at
                if c[2] * (high[0] - low[0]) >= 0:
                    high = low
                low = c
        raise _SearchFailed

    for i in range(10):
        c = (t, *(yield t))
        if not np.isfinite(c[1]):
            t /= 2
            continue
        if c[1] > value + 1e-4 * t * slope or (c[1] >= low[1] and i > 0):
            return (yield from zoom(low, c))
        if abs(c[2]) <= 0.9 * abs(slope):
            return t
        if c[2] >= 0:
            return (yield from zoom(c, low))
        low, t = c, t * 1.5
    raise _SearchFailed


def _lbfgs(x: np.ndarray, max_iter: int, tol: float, memory: int = 10):
    """L-BFGS as ``LogisticRegression`` runs it (Breeze): the same directions, steps and stopping rules. A generator: yields
    points, gets (value, gradient) at them and returns the last point, so that a round of many fits is one job."""
    value, grad = yield x
    first, values, history, iteration, failed = value, [np.inf], [], 0, False
    while not (iteration >= max_iter or np.linalg.norm(grad) <= max(tol * abs(value), 1e-8)
               or (len(values) >= 2 and abs(value - max(values)) <= tol * abs(first))):
        try:
            way, kept = grad.copy(), []
            for step, change in history:
                rho = step @ change
                part = step @ way / rho
                if np.isnan(part):
                    raise _SearchFailed
                kept.append((step, change, rho, part))
                way -= part * change
            if history:
                step, change = history[0]
                if step @ change < 0 or np.isnan(step @ change):
                    raise _SearchFailed
                way *= (step @ change) / (change @ change)
            for step, change, rho, part in reversed(kept):
                way += (part - change @ way / rho) * step
            way = -way
            search = _strong_wolfe(value, float(grad @ way), 1.0 if iteration else 1.0 / np.linalg.norm(way))
            reply, seen = None, (0.0, value, grad)
            try:
                while True:
                    t = search.send(reply)
                    seen = (t, *(yield x + t * way))
                    reply = (seen[1], float(seen[2] @ way))
            except StopIteration as end:
                t = end.value
            if t * np.linalg.norm(grad) < 1e-10:
                raise _SearchFailed
            new = x + t * way
            if seen[0] != t:
                seen = (t, *(yield new))
            history = [(new - x, seen[2] - grad), *history][:memory]
            x, value, grad = new, seen[1], seen[2]
            values, iteration, failed = [*values, value][-20:], iteration + 1, False
        except _SearchFailed:
            if failed:
                break
            failed, history = True, []
    return x


def fit_together(train: DataFrame, label: str, specs: Sequence[tuple[int | None, float]], lr: LogisticRegression, fold_col: str = "fold",
                 features: str = "features") -> list[tuple[np.ndarray, float]] | None:
    """(coefficients, intercept) of ``lr`` for each (fold left out, regParam) of ``specs``, without a Spark job for each step of each
    fit. Rows are kept in blocks of sparse entries. Up to ``ENTRIES_PER_FIT`` entries each fit is a task of its own; beyond, all fits
    take their steps together, and a round of them is one job over the blocks.

    The objective, the scaling by standard deviations and the solver are those of ``LogisticRegression``. None where that has rules
    of its own: labels other than 0 and 1, or one label alone in the rows of a fit."""
    sc = train.sparkSession.sparkContext

    def blocks(batches):
        for batch in batches:
            cells, w = batch.column("_x"), batch.column("_w").to_numpy(zero_copy_only=False)
            y, fold = batch.column("_y").to_numpy(zero_copy_only=False), batch.column("_f").to_numpy(zero_copy_only=False)
            values, places = pc.struct_field(cells, "values"), pc.struct_field(cells, "indices")
            dense = pc.is_null(places).to_numpy(zero_copy_only=False)
            n = pc.list_value_length(values).to_numpy(zero_copy_only=False).astype(np.int64)
            size = int(pc.struct_field(cells, "size")[0].as_py() or n[0]) if len(n) else 0
            own = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            own[~np.repeat(dense, n)] = places.flatten().to_numpy(zero_copy_only=False)
            flat = values.flatten().to_numpy(zero_copy_only=False)
            at = np.flatnonzero(np.diff(np.cumsum(n) // 200_000, prepend=-1))
            ends = np.concatenate([[0], np.cumsum(n)])
            for i, j in zip(at, np.append(at[1:], len(n))):
                part = (size, n[i:j], own[ends[i]:ends[j]].astype(np.int32), flat[ends[i]:ends[j]], w[i:j], y[i:j], fold[i:j])
                yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(part)], pa.binary())], names=["block"])

    rows = train.select(F.col(features).alias("_x"), F.col("weight").cast("double").alias("_w"), F.col(label).cast("double").alias("_y"),
                        F.col(fold_col).cast("double").alias("_f"))
    if rows.where("_x IS NULL OR _w IS NULL OR _w < 0 OR _y IS NULL OR _y NOT IN (0, 1)").take(1):
        return None
    n_rows = rows.count()
    dealt = rows.repartition(max(1, min(sc.defaultParallelism, -(-n_rows // 500))))
    kept = dealt.mapInArrow(blocks, "block binary").rdd.map(lambda r: bytes(r[0])).persist(StorageLevel.MEMORY_AND_DISK)
    folds = list(dict.fromkeys(f for f, _ in specs))

    def summed(of, *shared):
        """Sums over all blocks of the arrays that ``of`` gives for one, with ``shared`` sent to the workers."""
        sent = sc.broadcast(shared)

        def run(parts):
            total = None
            for part in parts:
                got = of(*pickle.loads(part), *sent.value)
                total = got if total is None else [f(a, b) for f, a, b in zip((np.add, np.add, np.minimum, np.maximum), total, got)]
            return [] if total is None else [total]

        try:
            parts = kept.mapPartitions(run).collect()
        finally:
            sent.destroy()
        return reduce(lambda x, y: [f(a, b) for f, a, b in zip((np.add, np.add, np.minimum, np.maximum), x, y)], parts)

    def moments(size, n, idx, val, w, y, fold, folds):
        owner, per = np.repeat(np.arange(len(n)), n), [w * (fold != (-1 if f is None else f)) for f in folds]
        sums = [np.concatenate([np.bincount(idx, v[owner] * val, size), [v.sum(), v @ v, v @ y]]) for v in per]
        held = [[np.bincount(idx, (v[owner] > 0) * (val != 0), size), np.full(size, (v > 0).sum())] for v in per]
        ends = [[np.full(size, np.inf), np.full(size, -np.inf)] for _ in per]
        for v, (least, most) in zip(per, ends):
            mine = v[owner] > 0
            np.minimum.at(least, idx[mine], val[mine])
            np.maximum.at(most, idx[mine], val[mine])
        return [np.array(sums), np.array(held), np.array([e[0] for e in ends]), np.array([e[1] for e in ends])]

    def spread(size, n, idx, val, w, y, fold, folds, means):
        owner, out = np.repeat(np.arange(len(n)), n), []
        for f, mean in zip(folds, means):
            v = w * (fold != (-1 if f is None else f))
            # every entry as if it were 0, put right where a value stands
            out.append(v.sum() * mean * mean + np.bincount(idx, v[owner] * ((val - mean[idx]) ** 2 - mean[idx] ** 2), size))
        return [np.array(out)]

    def losses(size, n, idx, val, w, y, fold, folds, at, points, offsets):
        starts, some, values, grads = np.cumsum(n) - n, n > 0, [], []
        for f, u, offset in zip(at, points, offsets):
            margin = np.full(len(n), offset)
            if some.any():
                margin[some] += np.add.reduceat(val * u[idx], starts[some])
            v = w * (fold != (-1 if folds[f] is None else folds[f]))
            values.append(v @ (np.logaddexp(0, margin) - y * margin))
            with np.errstate(over="ignore"):
                r = v * (1 / (1 + np.exp(-margin)) - y)
            grads.append(np.append(np.bincount(idx, val * np.repeat(r, n), size), r.sum()))
        return [np.array(values), np.array(grads)]

    try:
        sums, (held, least, most) = (got := summed(moments, folds))[0], got[1:]
        size = sums.shape[1] - 3
        weight, squares, ones = sums[:, size, None], sums[:, size + 1, None], sums[:, size + 2]
        if (ones <= 0).any() or (ones >= weight[:, 0]).any():
            return None
        means = sums[:, :size] / weight
        # entries that no row of a fit spells out are 0
        least, most = (np.where(held[:, 0] < held[:, 1], f(x, 0), x) for f, x in ((np.minimum, least), (np.maximum, most)))
        variance = np.maximum(summed(spread, folds, means)[0], 0) / (weight - squares / weight)
        std = np.where(least == most, 0.0, np.sqrt(variance))
        inverse = np.divide(1.0, std, out=np.zeros_like(std), where=std != 0)
        of = [folds.index(f) for f, _ in specs]
        start = [np.append(np.zeros(size), np.log(ones[k] / (weight[k, 0] - ones[k]))) for k in of]
        regs, limits = [r for _, r in specs], (lr.getMaxIter(), lr.getTol())

        def raw(i, x):
            """Factors of the entries as they are, and the intercept that goes with them."""
            u = x[:-1] * inverse[of[i]]
            return u, x[-1] - u @ means[of[i]]

        def objective(i, x, value, g):
            k = of[i]
            penalty = regs[i] * inverse[k] ** 2
            grad = np.append((g[:-1] - means[k] * g[-1]) * inverse[k], g[-1]) / weight[k, 0]
            grad[:-1] += penalty * x[:-1]
            return value / weight[k, 0] + 0.5 * float(penalty @ x[:-1] ** 2), grad

        def fit(i):
            search, parts = _lbfgs(start[i], *limits), [pickle.loads(p) for p in everything.value]
            parts = [(size, n, idx.astype(np.int64), *rest) for size, n, idx, *rest in parts]
            x = search.send(None)
            while True:
                u, offset = raw(i, x)
                got = [losses(*p, folds, [of[i]], [u], [offset]) for p in parts]
                try:
                    x = search.send(objective(i, x, sum(v[0] for v, _ in got), sum(g[0] for _, g in got)))
                except StopIteration as end:
                    return i, end.value

        if held[:, 0].sum(axis=1).max() <= ENTRIES_PER_FIT:
            # few rows: a fit is a task; weak penalties take the most steps, so they start first
            everything, order = sc.broadcast(kept.collect()), sorted(range(len(specs)), key=lambda i: regs[i])
            try:
                done = dict(sc.parallelize(order, len(order)).map(fit).collect())
            finally:
                everything.destroy()
        else:
            running, done = {i: _lbfgs(x, *limits) for i, x in enumerate(start)}, {}
            points = {i: g.send(None) for i, g in running.items()}
            while points:
                ids = [*points]
                at = [raw(i, points[i]) for i in ids]
                values, grads = summed(losses, folds, [of[i] for i in ids], [u for u, _ in at], [offset for _, offset in at])
                for i, value, g in zip(ids, values, grads):
                    try:
                        points[i] = running[i].send(objective(i, points[i], value, g))
                    except StopIteration as end:
                        done[i] = end.value
                        del points[i]
        out = []
        for i, k in enumerate(of):
            u = done[i][:-1] * inverse[k]
            out.append((u, float(done[i][-1] - u @ means[k])))
        return out
    finally:
        kept.unpersist()


def fitted_model(lr: LogisticRegression, coefficients: np.ndarray, intercept: float) -> LogisticRegressionModel:
    """A model of ``lr`` with these coefficients."""
    sc = SparkSession.active().sparkContext
    made = sc._jvm.org.apache.spark.ml.classification.LogisticRegressionModel(lr.uid, _py2java(sc, Vectors.dense(coefficients)), float(intercept))
    return lr._copyValues(LogisticRegressionModel(made))


def grid_search(train: DataFrame, label: str, c_values: Sequence[float] = C_GRID, folds: int = 5,
                fold_col: str = "fold", parallelism: int = PARALLEL_FITS):
    """ML-6 cross-validated C over stratified folds, scored by macro F1; refit on all rows.
    ``train`` carries features, weight, label and the fold column (0 to ``folds`` - 1). The fits of all folds and values, and those on
    all rows, run together (``fit_together``); scores run side by side, ``parallelism`` at a time at least, more while the
    partitions of all of them are no more than twice the cores. Returns the CrossValidatorModel (``avgMetrics`` aligned with ``c_values``)."""
    train, n = fit_frame(train, "features", "weight", label, fold_col)
    fold = F.col(fold_col)
    if train.where(fold.isNull() | (fold < 0) | (fold >= folds)).take(1):
        raise ValueError(f"{fold_col} must be between 0 and {folds - 1}")
    lr = logreg(c_values[0], n, label)
    estimator, evaluator = Pipeline(stages=[lr]), MacroF1Evaluator(label)
    grid = ParamGridBuilder().addGrid(lr.regParam, [1.0 / (c * n) for c in c_values]).build()
    parts = [(train.where(fold != i), train.where(fold == i)) for i in range(folds)]
    counts = {r[fold_col] for r in train.select(fold_col).distinct().collect()}
    for i in range(folds):
        if i not in counts or len(counts) == 1:
            raise ValueError(f"fold {i} or what is left of the rows without it is empty")
    specs = [(i, k) for i in (*range(folds), None) for k in range(len(grid))]
    got = fit_together(train, label, [(i, grid[k][lr.regParam]) for i, k in specs], lr, fold_col)

    def model(i, k):
        if got is None:
            return estimator.fit(train if i is None else parts[i][0], grid[k])
        own = lr.copy(grid[k])
        return PipelineModel([fitted_model(own, *got[specs.index((i, k))])])

    # weak penalties take the most iterations, so they start first
    order = sorted(((i, k) for i in range(folds) for k in range(len(grid))), key=lambda x: -c_values[x[1]])
    cores = train.sparkSession.sparkContext.defaultParallelism
    most = max(parallelism, 2 * cores // max(1, -(-n // ROWS_PER_FIT_PARTITION)))
    scores = dict(zip(order, side_by_side([lambda i=i, k=k: evaluator.evaluate(model(i, k).transform(parts[i][1])) for i, k in order], most)))
    means = np.array([[scores[i, k] for k in range(len(grid))] for i in range(folds)]).mean(axis=0).tolist()
    return CrossValidatorModel(model(None, int(np.argmax(means))), means)


def score(model, df: DataFrame, task: str, model_name: str, label: str, doc: str = "doc_id") -> DataFrame:
    """ML-7 scored-set rows (doc, task, model, label, prob, pred) from a fitted model."""
    p = model.transform(df)
    return p.select(doc, F.lit(task).alias("task"), F.lit(model_name).alias("model"),
                    F.col(label).cast("int").alias("label"),
                    vector_to_array("probability")[1].alias("prob"), F.col("prediction").cast("int").alias("pred"))
