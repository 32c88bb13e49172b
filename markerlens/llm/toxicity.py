"""Toxicity by a weighted lexicon.

Texts are folded (case, accents, look-alike letters, digits and signs that stand for letters, everything
else a space) and matched with an Aho-Corasick automaton. The lexicon is learnt: word beginnings and
whole words whose document counts in toxic and other training texts differ beyond chance, with their log
odds as weights. Phrases of two words in which a term stands in harmless texts are exceptions and
take their hit back. Total weight, alone and per word, goes through a logistic curve.

Learning takes at most SAMPLE_ROWS labelled rows (picked by a hash of doc_id) from the training rows;
held-out rows (crc32 of doc_id mod FOLDS is 0) are never learnt from. Scoring covers all rows.

Defined cases: null and empty texts have no hits and get the score of such texts; a null doc_id is
held out; without both labels in training all scores are 0; repeated rows score alike; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from markerlens.llm.common import drop_stored, is_held_out, stored

FOLDS = 5
SAMPLE_ROWS = 20_000
#: Lengths of word beginnings that may become terms; least toxic texts with a term; least G statistic; least log odds.
STEMS, LEAST_TEXTS, LEAST_G, LEAST_ODDS = range(4, 11), 10, 40.0, 2.0
EXCEPTION_TEXTS, EXCEPTION_SHARE = 5, 0.9
# Letters of other scripts that look like Latin ones, and digits and signs written for letters.
LOOK_ALIKES = dict(zip("аеорсухіѕјкмтвнгԁԛԝһαοερτυνικηωß", "aeopcyxisjkmtbhrdqwhaoeptuvikhws"))
SUBSTITUTES = dict(zip("0134579@$€", "oieastgase"))


def fold_table() -> dict[int, int | None]:
    """Code point to folded letter, space, or nothing (marks and invisible characters)."""
    table: dict[int, int | str | None] = {}
    for c in range(0x3000):
        ch = chr(c)
        kind = unicodedata.category(ch)
        low = LOOK_ALIKES.get(ch.lower(), SUBSTITUTES.get(ch))
        if low is None:
            base = unicodedata.normalize("NFKD", ch.lower())[:1]
            low = LOOK_ALIKES.get(base, base)
            if kind in ("Mn", "Cf", "Me"):
                low = None
            elif not (kind[0] == "L" or kind == "Nd"):
                low = " "
        table[c] = low
    for c in range(0xFF01, 0xFF5F):  # full-width forms of ASCII
        table[c] = table[c - 0xFEE0]
    return table


_FOLD: dict[int, int | None] = {}


def fold(text: str) -> str:
    """Folded words with one space around each."""
    if not _FOLD:
        _FOLD.update(fold_table())
    return f" {' '.join(text.translate(_FOLD).split())} "


def terms_of(folded: str) -> set[str]:
    """Candidate terms of a text: ' stem' for word beginnings, ' word ' for whole words."""
    out = set()
    for w in set(folded.split()):
        if len(w) >= 3:
            out.add(f" {w} ")
            out.update(f" {w[:n]}" for n in STEMS if n <= len(w))
    return out


@dataclass
class Lexicon:
    weights: dict[str, float]
    exceptions: set[str] = field(default_factory=set)
    curve: tuple[float, float, float] = (0.0, 0.0, 0.0)

    def __getstate__(self):
        return {"weights": self.weights, "exceptions": self.exceptions, "curve": self.curve}

    def automaton(self):
        if "_found" not in self.__dict__:
            import ahocorasick

            self._found = ahocorasick.Automaton()
            for t, w in self.weights.items():
                self._found.add_word(t, (len(t), w))
            if self.weights:
                self._found.make_automaton()
        return self._found

    def hits(self, folded: str) -> dict[int, float]:
        """Start of each hit word and the largest weight of the terms that match there."""
        best: dict[int, float] = {}
        if self.weights:
            for end, (n, w) in self.automaton().iter(folded):
                start = end - n + 1
                best[start] = max(best.get(start, 0.0), w)
        return best

    def phrases(self, folded: str, start: int) -> list[str]:
        """The word at ``start`` (a space) with its neighbours: two phrases of two words at most."""
        stop = folded.index(" ", start + 1)
        out = []
        if start > 0:
            out.append(folded[folded.rindex(" ", 0, start): stop])
        if stop + 1 < len(folded):
            out.append(folded[start: folded.index(" ", stop + 1)])
        return out

    def features(self, text: str) -> tuple[float, float, int]:
        folded = fold(text or "")
        hits = self.hits(folded)
        weight = sum(w for s, w in hits.items() if not (self.exceptions and self.exceptions.intersection(self.phrases(folded, s))))
        words = folded.count(" ") - 1
        return float(np.log1p(weight)), float(np.log1p(100 * weight / (words + 10))), len(hits)

    def score(self, x: float, y: float) -> float:
        a, b, c = self.curve
        return float(1 / (1 + np.exp(-np.clip(a + b * x + c * y, -50, 50))))


def log_odds(toxic, n_toxic, other, n_other):
    """Smoothed log odds and G statistic of document counts."""
    odds = np.log((toxic + 0.5) / (n_toxic + 1)) - np.log((other + 0.5) / (n_other + 1))
    share = (toxic + other) / (n_toxic + n_other)
    g = 0
    for seen, n in ((toxic, n_toxic), (other, n_other)):
        for have, expect in ((seen, n * share), (n - seen, n * (1 - share))):
            g = g + 2 * have * np.log(np.maximum(have, 1e-9) / np.maximum(expect, 1e-9))
    return odds, g


def curve_of(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """Ridge logistic regression by Newton steps."""
    design, w = np.column_stack([np.ones(len(x)), x]), np.zeros(x.shape[1] + 1)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        slope = design.T @ (p - y) + 0.1 * w
        w = w - np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design + 0.1 * np.eye(len(w)), slope)
    return tuple(w.tolist())


def learn(docs: DataFrame, labels: DataFrame) -> Lexicon:
    """The lexicon from a bounded sample of the labelled training rows."""
    marks = (labels.where(F.col("toxic").isNotNull() & ~is_held_out("doc_id", FOLDS))
             .groupBy(F.col("doc_id").cast("long").alias("l_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic")))
    share = min(1.0, SAMPLE_ROWS / max(marks.count(), 1))
    marks = marks.where(F.pmod(F.xxhash64("l_id", F.lit(3)), F.lit(1 << 20)) < int(share * (1 << 20)))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    sample = stored(rows.join(marks, F.col("doc_id") == F.col("l_id")).select("toxic", "text").repartition(12), "sample")
    totals = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    n1, n0 = totals.get(1, 0), totals.get(0, 0)
    if not n1 or not n0:
        return Lexicon({})

    def terms(batches):
        for batch in batches:
            for text in batch.column("text").to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(list(terms_of(fold(text))), pa.string())], names=["term"])

    toxic = {r["term"]: r["count"] for r in sample.where("toxic = 1").mapInArrow(terms, "term string").groupBy("term").count()
             .where(F.col("count") >= LEAST_TEXTS).collect()}
    wanted = docs.sparkSession.sparkContext.broadcast(set(toxic))

    def other_terms(batches):
        seen: dict[str, int] = {}
        for batch in batches:
            for text in batch.column("text").to_pylist():
                for t in terms_of(fold(text)) & wanted.value:
                    seen[t] = seen.get(t, 0) + 1
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["term", "c"])

    other = {r["term"]: r["c"] for r in sample.where("toxic = 0").mapInArrow(other_terms, "term string, c long")
             .groupBy("term").agg(F.sum("c").alias("c")).collect()}
    names = sorted(toxic, key=lambda t: (t.endswith(" "), len(t), t))
    odds, g = log_odds(np.array([toxic[t] for t in names]), n1, np.array([other.get(t, 0) for t in names]), n0)
    weights: dict[str, float] = {}
    for t, o, s in zip(names, odds.tolist(), g.tolist()):
        if o >= LEAST_ODDS and s >= LEAST_G:
            shorter = [weights[t[:k]] for k in range(len(t)) if t[:k] in weights]
            if not shorter or o > max(shorter) + 1.0:  # a longer term only where it says more
                weights[t] = o
    lexicon = Lexicon(weights)
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def phrases(batches):
        for batch in batches:
            for text in batch.column("text").to_pylist():
                folded = fold(text)
                found = {p for s in shared.value.hits(folded) for p in shared.value.phrases(folded, s)}
                yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.string())], names=["phrase"])

    counts = {k: sample.where(F.col("toxic") == k).mapInArrow(phrases, "phrase string").groupBy("phrase").count() for k in (0, 1)}
    harmless = (counts[0].where(F.col("count") >= EXCEPTION_TEXTS).withColumnRenamed("count", "n0")
                .join(counts[1].withColumnRenamed("count", "n1"), "phrase", "left"))
    share0 = (F.col("n0") / n0) / (F.col("n0") / n0 + F.coalesce("n1", F.lit(0)) / n1)
    lexicon.exceptions = {r["phrase"] for r in harmless.where(share0 >= EXCEPTION_SHARE).collect()}
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def features(batches):
        for batch in batches:
            f = np.array([shared.value.features(t)[:2] for t in batch.column("text").to_pylist()]).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(f[:, 0]), pa.array(f[:, 1])], names=["toxic", "x", "y"])

    table = sample.mapInArrow(features, "toxic int, x double, y double").toArrow()  # two numbers a sample row
    x = np.column_stack([table.column("x").to_numpy(), table.column("y").to_numpy()])
    lexicon.curve = curve_of(x, table.column("toxic").to_numpy().astype(float))
    drop_stored(sample)
    return lexicon


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted and n_hits of each row of ``docs`` (doc_id, text)."""
    lexicon = learn(docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches):
        for batch in batches:
            f = [shared.value.features(t) for t in batch.column("text").to_pylist()]
            scores = [shared.value.score(x, y) if shared.value.weights else 0.0 for x, y, _ in f]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(scores, pa.float64()),
                 pa.array([int(s >= 0.5) for s in scores], pa.int32()), pa.array([n for *_, n in f], pa.int64())],
                names=["doc_id", "held_out", "score", "predicted", "n_hits"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), is_held_out("doc_id", FOLDS).alias("held_out"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int, n_hits long")
