"""The training-data operators against brute force, on a small fixture with the awkward rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from markerlens.llm import (bwt_dedup, debruijn_dedup, decontaminate, jaccard_join, lattice_lm, packing, quality, queries,
                            token_counts, toxicity, warc_revisits)
from markerlens.llm.text_arrays import utf8

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
CLASH = ("start", "n", "spans", "anchor", "rid", "grp", "blk", "text_key", "score")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASH)


def words(text):
    return WORD.findall(text or "")


@pytest.fixture(scope="module")
def rows():
    r = random.Random(5)
    vocab = ["".join(r.choice("abcdefghijklmnoprstuvwé") for _ in range(r.randint(2, 8))) for _ in range(400)]
    text = lambda n: " ".join(r.choice(vocab) for _ in range(n))
    base, long = text(120), text(6000)
    near = base.split()
    near[60] = "other"
    made = [base, base, " ".join(near), base + " " + text(3), text(80) + " " + " ".join(base.split()[20:70]) + " " + text(20), long,
            text(30) + " " + long[:4000], None, "", "   \n\t ", "a", "tie tie tie", "tie tie tie", "x" * 5000,
            "It's <|endoftext|> á  日本 'S 12 ?!", text(9), text(50), text(50), base.upper(), "word " * 300]
    out = [(i, t, r.choice(["en", "de", None])) for i, t in enumerate(made)]
    out += [(None, "no id " + base, "en"), (None, None, None), (3, made[3], "en")]  # null ids and a repeated row
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(i, t, lang, None, len(t or ""), *["x"] * len(CLASH)) for i, t, lang in rows], SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def collected(df, columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def test_quality_base_counts(docs, rows):
    want = []
    for i, t, _ in rows:
        w = words(t)
        seen = Counter(tuple(w[k:k + 5]) for k in range(len(w) - 4))
        inside = {x for k in range(len(w) - 4) if seen[tuple(w[k:k + 5])] > 1 for x in range(k, k + 5)}
        lines = [x for x in (t or "").split("\n") if words(x)]
        want.append((i, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(inside),
                     len(w) < 10 or 100 * len(inside) > 20 * len(w)))
    got = quality.quality_rules(docs)
    assert collected(got, ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")) == sorted(want, key=repr)
    assert all(not r["kept"] for r in got.where("base_failed").collect())


def test_quality_model_sums_to_one():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 20, 3000))
    m = quality.Model({4: keys}, {4: np.random.default_rng(2).integers(1, 9, len(keys))})
    for order in (3, 2, 1):
        m.keys[order], m.counts[order] = np.unique(m.keys[order + 1] & ((1 << (5 * order)) - 1), return_counts=True)
    assert np.allclose(m.probabilities().reshape(-1, 32).sum(1), 1)


def prose(r, letters, n_texts, shortest=150, n_words=400):
    """Texts of invented words of the given letters, common words first."""
    vocab = ["".join(r.choice(letters) for _ in range(r.randint(2, 9))) for _ in range(n_words)]
    weights = [1 / (k + 1) for k in range(n_words)]
    return [" ".join(r.choices(vocab, weights, k=r.randint(shortest, 2 * shortest))) for _ in range(n_texts)]


CYRILLIC, GREEK = "абвгдежзийклмнопрстуфхцчшщыьэюя", "αβγδεζηθικλμνξοπρστυφχψω"


def grams_by_hand(text):
    padded = "   " + "".join(chr(x) for x in quality.symbols_of(*utf8(pa.array([text])))[0])
    return [padded[i:i + 4] for i in range(len(padded) - 3)]


@pytest.mark.parametrize("dense, cut", [(1 << 22, 1 << 20), (1 << 22, 3), (4, 5)])
def test_quality_grams_in_slices_and_sorted(monkeypatch, dense, cut):
    monkeypatch.setattr(quality, "DENSE", dense)
    monkeypatch.setattr(quality, "SLICE", cut)
    texts = ["", "ab", "The cat. The cat", None, "\u65e5\u672c\u8a9e the cat 12", "x", "\U0001f600abc"]
    block = quality.Grams(pa.array(texts))
    keys, counts = block.counted()
    context, last = block.parts(keys)
    got = {"".join(chr(int(c) >> s & 0x1FFFFF) for s in (42, 21, 0)) + chr(int(w)): int(n) for c, w, n in zip(context, last, counts)}
    assert got == Counter(g for t in texts for g in grams_by_hand(t or ""))
    values = np.arange(1.0, len(keys) + 1)
    of = dict(zip(got, values))  # in the order of the keys
    total, letters = block.sums(keys, values)
    assert np.allclose(total, [sum(of[g] for g in grams_by_hand(t or "")) for t in texts])
    assert letters.tolist() == [sum(g[3] not in ".#" for g in grams_by_hand(t or "")) for t in texts]
    empty = quality.Grams(pa.array([None, ""]))
    assert [len(x) for x in (*empty.counted(), *empty.sums(*empty.counted()))] == [0, 0, 2, 2]


def left_out_probabilities(grams):
    """Modified Kneser-Ney in plain Python: of each 4-gram, the probability without one occurrence."""
    counts = {4: grams}
    for k in (3, 2, 1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    p, q = {"": 1 / 2 ** 17}, {"": 1 / 2 ** 17}
    for k in (1, 2, 3, 4):
        c, heads = counts[k], {}
        n = [sum(x == i for x in c.values()) for i in range(5)]
        y = n[1] / (n[1] + 2 * n[2]) if n[1] + n[2] else 0.5
        d = [0] + [min(max(i - (i + 1) * y * n[i + 1] / n[i], 0.1), i - 0.1) if n[i] else 0.5 for i in (1, 2, 3)]
        for g, x in c.items():
            heads.setdefault(g[:-1], Counter())[g] = x

        def one(g, group, lower):
            total = sum(group.values())
            held = sum(d[min(x, 3)] for x in group.values())
            return max(group[g] - d[min(group[g], 3)], 0) / total + held / total * lower if total else lower

        np_, nq = {}, {}
        for g, x in c.items():
            group = heads[g[:-1]]
            np_[g] = one(g, group, p[g[1:]])
            nq[g] = one(g, Counter({**group, g: x - 1}), q[g[1:]] if x == 1 else p[g[1:]])
        p, q = np_, nq
    return q


def test_quality_verdict_against_plain_python(spark):
    r = random.Random(12)
    made = [("a", t) for t in prose(r, "abcdefg", 30, 12, 40)] + [("b", t) for t in prose(r, "defghijk", 12, 12, 40)]
    made += [("a", "".join(r.choice("abcdefg ") for _ in range(600))), (None, "Kurz, 12."), ("b", None), ("a", ""), ("a", "aa bb " * 30)]
    made += [made[0], made[0]]
    df = spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(made)], "doc_id long, text string, lang string")
    of = [grams_by_hand(t or "") for _, t in made]
    every = left_out_probabilities(Counter(g for x in of for g in x))
    bits = [0.0] * len(made)
    for lang in ("a", "b", None):
        mine = [i for i, (x, _) in enumerate(made) if x == lang]
        grams = Counter(g for i in mine for g in of[i])
        own, size = left_out_probabilities(grams), sum(grams.values())
        share = quality.OWN_WEIGHT * size / (size + quality.PRIOR_TEXT)
        for i in mine:
            letters = sum(g[3] not in ".#" for g in of[i])
            bits[i] = -sum(math.log2(share * own[g] + (1 - share) * every[g]) for g in of[i]) / max(letters, 1)
    quarter = lambda x: [sorted(x)[max(math.ceil(f * len(x)) - 1, 0)] for f in (0.25, 0.5, 0.75)]
    worded = [i for i in range(len(made)) if of[i]]
    bands = {lang: quarter([bits[i] for i in worded if made[i][0] == lang]) for lang in ("a", "b", None)}
    low, _, high = quarter([bits[i] - bands[made[i][0]][1] for i in worded])
    kept = {}
    for i in range(len(made)):
        q = bands[made[i][0]]
        docs_ = sum(made[k][0] == made[i][0] for k in worded)
        dev = (docs_ * (q[2] - q[0]) + quality.PRIOR_DOCS * (high - low)) / 1.349 / (docs_ + quality.PRIOR_DOCS)
        wide = quality.BAND_WIDTH * max(dev, quality.LEAST_DEVIATION)
        kept[i] = not of[i] or abs(bits[i] - q[1]) * len(of[i]) / (len(of[i]) + quality.PRIOR_SYMBOLS) <= wide
    got = {x["doc_id"]: x for x in quality.quality_rules(df).collect()}
    assert np.allclose([got[i]["perplexity"] for i in range(len(made))], np.exp2(bits), rtol=1e-9)
    assert {i for i, x in got.items() if x["kept"]} == {i for i, x in got.items() if kept[i] and not x["base_failed"]}
    assert not kept[42] and kept[0]


def test_quality_band_sees_random_letters_of_other_scripts(spark):
    r = random.Random(8)
    clean = prose(r, CYRILLIC, 120)
    junk = ["".join(c if c == " " else r.choice(CYRILLIC) for c in t) for t in clean[:4]]  # the same word lengths
    rows = [(i, t, "ru") for i, t in enumerate(clean + junk)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = {x["doc_id"] for x in quality.quality_rules(df).where("kept").collect()}
    assert not kept & set(range(120, 124)) and len(kept) >= 115
    assert {x["doc_id"] for x in quality.keep_clean(df).collect()} == kept


def test_quality_bands_of_small_languages(spark):
    r = random.Random(10)
    texts = {"en": prose(r, "abcdefghiklmnoprstuvwyz", 6000, 12), "ru": prose(r, CYRILLIC, 50, 150, 30), "el": prose(r, GREEK, 10)}
    spoilt = lambda lang, letters: [(lang, "".join(c if c == " " else r.choice(letters) for c in t)) for t in texts[lang][:3]]
    made = [(lang, t) for lang, ts in texts.items() for t in ts] + spoilt("ru", CYRILLIC) + spoilt("el", GREEK)
    df = spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(made)], "doc_id long, text string, lang string")
    clean = range(6000, 6060)  # 0.8 and 0.2 % of the rows
    kept = {x["doc_id"] for x in quality.quality_rules(df).where("kept").collect()}
    assert not kept & set(range(6060, 6066)) and len(kept & set(clean)) >= 58
    alone = {x["doc_id"] for x in quality.quality_rules(df.where("lang != 'el'")).where("kept").collect()}
    assert alone & set(range(6000, 6050)) == kept & set(range(6000, 6050))


def test_quality_orders_against_the_dense_model(spark):
    r = random.Random(9)
    text = " ".join(prose(r, "abcdefgh", 6, 40, 30))
    known = {c: k for k, c in enumerate(" abcdefgh")}
    s = [0, 0, 0] + [known[c] for c in text]
    c = Counter(tuple(s[i:i + 4]) for i in range(len(s) - 3))
    pack = lambda g: sum(x << (5 * k) for k, x in enumerate(reversed(g)))
    keys = sorted(c, key=pack)
    m = quality.Model({4: np.array([pack(g) for g in keys])}, {4: np.array([c[g] for g in keys])})
    for order in (3, 2, 1):
        m.keys[order], m.counts[order] = np.unique(m.keys[order + 1] & ((1 << (5 * order)) - 1), return_counts=True)
    dense = m.probabilities()
    point = {k: ord(ch) for ch, k in known.items()}
    table = [("x", point[a] << 42 | point[b] << 21 | point[d], point[w], n) for (a, b, d, w), n in c.items()]
    got = {(x["ctx"], x["w"]): x["p"] for x in quality.orders(spark.createDataFrame(table, "model string, ctx long, w int, c long")).collect()}
    for (a, b, d, w), _ in c.items():  # only the share below order 1 differs: 1/32 there, 1/2^17 here
        assert abs(got[point[a] << 42 | point[b] << 21 | point[d], point[w]] - dense[pack((a, b, d, w))]) < 2e-3


def reached(a, links):
    reach, todo = {a}, [a]
    while todo:
        for b in links[todo.pop()]:
            if b not in reach:
                reach.add(b)
                todo.append(b)
    return reach


def test_jaccard_join(docs, rows):
    groups = defaultdict(list)
    for k, (_, t, _) in enumerate(rows):
        groups[tuple(words(t))].append(k)
    keys = [w for w in groups if w]
    sets = [{w[k:k + 5] for k in range(len(w) - 4)} or {w} for w in keys]
    links = [[b for b in range(len(keys)) if a != b and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])] for a in range(len(keys))]
    want = []
    for a, w in enumerate(keys):
        reach = reached(a, links)
        least = lambda ks: min((rows[k][0] for k in ks if rows[k][0] is not None), default=None)
        for k in groups[w]:
            want.append((rows[k][0], least([k for b in reach for k in groups[keys[b]]]), len(groups[w]), len(links[a])))
    want += [(rows[k][0], rows[k][0], 1, 0) for k in groups[()]]
    assert collected(jaccard_join.jaccard_join(docs), ("doc_id", "class_id", "n_copies", "n_links")) == sorted(want, key=repr)
    kept = jaccard_join.keep_one(docs)
    assert kept.count() == len({frozenset(b for b in reached(a, links)) for a in range(len(keys))}) + len(groups[()])
    assert kept.columns == docs.columns


def test_jaccard_pruning_keeps_similar_pairs():
    least = jaccard_join.least_matches()
    assert all(a <= b for a, b in zip(least, least[1:])) and least[-1] < 0.8 * jaccard_join.HASHES


def removed(rows, k):
    seen = Counter(tuple(words(t)[i:i + k]) for _, t, _ in rows for i in range(len(words(t)) - k + 1))
    for i, t, _ in rows:
        w = words(t)
        gone = {x for s in range(len(w) - k + 1) if seen[tuple(w[s:s + k])] > 1 for x in range(s, s + k)}
        yield i, w, gone


def test_substring_dedup(docs, rows):
    want = [(i, len(w), len(g), hashlib.sha256(" ".join(x for n, x in enumerate(w) if n not in g).encode()).hexdigest())
            for i, w, g in removed(rows, 35)]
    assert collected(debruijn_dedup.substring_dedup(docs), ("doc_id", "n_words", "n_removed", "kept_sha256")) == sorted(want, key=repr)
    cut = debruijn_dedup.cut(docs)
    assert cut.columns == docs.columns
    assert sorted(len(words(r["text"])) for r in cut.collect()) == sorted(len(w) - len(g) for _, w, g in removed(rows, 35))


@pytest.mark.parametrize("chunk", [1 << 20, 600])
def test_byte_dedup(docs, rows, monkeypatch, chunk):
    monkeypatch.setattr(bwt_dedup, "CHUNK", chunk)
    data = [(i, (t or "").encode()) for i, t, _ in rows]
    seen = Counter(b[s:s + 200] for _, b in data for s in range(len(b) - 199))
    want = []
    for i, b in data:
        gone = np.zeros(len(b) + 1, int)
        for s in range(len(b) - 199):
            if seen[b[s:s + 200]] > 1:
                gone[s] += 1
                gone[s + 200] -= 1
        gone = np.cumsum(gone)[:-1] > 0
        runs = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        want.append((i, len(b), int(gone.sum()), runs, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    assert collected(bwt_dedup.byte_dedup(docs), ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")) == sorted(want, key=repr)


def test_interval_expansion():
    rng = np.random.default_rng(3)
    for _ in range(40):
        k = int(rng.integers(2, 9))
        texts = [bytes(rng.integers(97, 100, rng.integers(1, 60)).astype(np.uint8)) for _ in range(rng.integers(1, 12))]
        seen = Counter(t[i:i + k] for t in texts for i in range(len(t) - k + 1))
        want = [[i for i in range(len(t) - k + 1) if seen[t[i:i + k]] > 1] for t in texts]
        assert [x.tolist() for x in bwt_dedup.repeated_starts(texts, k)] == want


def test_token_counts(docs, rows):
    path = public_tokenizers.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    want = []
    for i, t, _ in rows:
        n = len(tok.encode(t or "", add_special_tokens=False).ids)
        want.append((i, len((t or "").encode()), n, n > 1024))
    assert collected(token_counts.token_counts(docs, path), ("doc_id", "n_bytes", "n_tokens", "over_limit")) == sorted(want, key=repr)


def test_transducer_on_random_text():
    path = public_tokenizers.path("byte_bpe_50k.json")
    machine, tok, r = token_counts.Transducer(path), Tokenizer.from_file(path), random.Random(2)
    letters = "aabcdest  \n\t'’s'll're 've.,;!?-123é ñ日本  　x🙂̀ÀßA\r"
    texts = ["".join(r.choice(letters) for _ in range(r.randint(0, 70))) for _ in range(3000)] + ["a" * 3000, " " * 700, "ab" * 900]
    buf, offsets = utf8(pa.array(texts, pa.large_string()))
    assert machine.counts(buf, offsets, token_counts.class_table()).tolist() == [len(e.ids) for e in tok.encode_batch(texts, add_special_tokens=False)]


def test_packing(docs, rows):
    path = public_tokenizers.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    want = []
    for i, t, _ in rows:
        ids = np.array(tok.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
        want += [(i, p, s, len(ids[s:s + 4096]), zlib.crc32(ids[s:s + 4096].tobytes())) for p, s in enumerate(range(0, len(ids), 4096))]
    got = packing.best_fit_packing(docs, path)
    assert collected(got, ("doc_id", "piece", "start", "length", "ids_crc32")) == sorted(want, key=repr)
    bins = defaultdict(list)
    for r in got.collect():
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 4096


def test_packing_plan_is_tight():
    r = random.Random(4)
    for _ in range(20):
        counts = Counter(r.randint(1, 100) for _ in range(2000))
        runs = packing.plan(counts, 100)
        fill = Counter()
        have = Counter()
        for length, rank, per, first, offset in runs.tolist():
            nexts = [x[1] for x in runs.tolist() if x[0] == length and x[1] > rank]
            n = (min(nexts) if nexts else counts[length]) - rank
            have[length] += n
            for k in range(n):
                fill[first + k // per] += length
        assert have == counts and max(fill.values()) <= 100
        assert len(fill) <= 1.06 * math.ceil(sum(a * b for a, b in counts.items()) / 100) + 1


def test_toxicity_on_held_out_rows(spark):
    d, lab = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    got = {r["doc_id"]: r for r in toxicity.toxicity(d, lab).collect()}
    held = [(got[r["doc_id"]], r["toxic"]) for r in lab.collect() if got[r["doc_id"]]["held_out"]]
    hit = sum(g["predicted"] == t for g, t in held)
    assert hit >= 0.97 * len(held) and all(0 <= g["score"] <= 1 for g, _ in held)


def test_toxicity_folding_and_exceptions():
    assert toxicity.fold("L0ser, 1diot! Ｓtupid café ѕсum x​y") == " loser idiot stupid cafe scum xy "
    lex = toxicity.Lexicon({" trash": 2.0}, {" trash can"}, (-1.0, 1.0, 1.0))
    assert lex.features("a trash can")[0] == 0 and lex.features("a trash heap")[0] > 0


def test_toxicity_awkward_rows(docs, spark, rows):
    lab = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(20)] + [(None, None, None)], "doc_id long, quality int, toxic int")
    assert toxicity.toxicity(docs, lab).count() == len(rows)
    assert {r["score"] for r in toxicity.toxicity(docs, lab.where("toxic = 5")).collect()} == {0.0}


def test_decontamination_recall(spark):
    d, b = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "benchmark"))
    fold = lambda t: " ".join(re.sub(r"[!-/:-@\[-`{-~]", " ", t.lower()).split())
    items = [(r["item_id"], f" {fold(r['text'])} ") for r in b.collect()]
    truth = {(r["doc_id"], i) for r in d.collect() for i, t in items if t in f" {fold(r['text'])} "}
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(d, b).collect()}
    assert len(truth & got) >= 0.9 * len(truth) and got <= truth


def test_decontamination_paraphrase_and_awkward_rows(spark, docs, rows):
    item = " ".join(words(rows[16][1])[5:40])
    changed = item.split()
    changed[4], changed[11] = "new", "words"
    bench = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, "too short")], "item_id long, text string")
    more = docs.select("doc_id", "text").union(spark.createDataFrame([(100, " ".join(changed))], "doc_id long, text string"))
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(more, bench).collect()} == {(16, 1), (100, 1)}
    kept = decontaminate.keep_uncontaminated(docs, bench)
    assert kept.columns == docs.columns and kept.count() == len(rows) - 1


def test_decontamination_without_a_sample(spark, docs, rows, monkeypatch):
    monkeypatch.setattr(decontaminate, "SAMPLE_WORDS", 0)  # as with few long texts, none of which the hash picks
    bench = spark.createDataFrame([(1, " ".join(words(rows[16][1])[5:40]))], "item_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(docs, bench).collect()} == {(16, 1)}
    assert decontaminate.keep_uncontaminated(docs, bench).count() == len(rows) - 1


def test_the_latent_space_is_fitted_on_every_passage(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "SAMPLE_WORDS", 0)  # with this a sample was empty
    texts = [" ".join(f"w{i}x{j}" for j in range(40)) for i in range(6)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, " ".join(f"b{j}" for j in range(20)))], "item_id long, text string")
    space = decontaminate.fit(decontaminate.text_rows(docs), bench)
    for t in texts:
        hashes, _ = decontaminate.folded_words(*utf8(pa.array([t])))
        assert np.abs(space.project[decontaminate.terms_of(hashes)]).max(axis=1).min() > 0


def test_decontamination_dense_blocks_are_the_passages_weights():
    """Blocks of any slice of a batch: the normalised TF-IDF rows, term by term, as brute force gives them."""
    r = np.random.default_rng(3)
    idf = r.uniform(1, 9, decontaminate.TERMS)
    terms = [r.integers(0, 60, n).astype(np.int32) for n in r.integers(1, 41, 3 * decontaminate.GRID_PASSAGES + 5)]
    batch = pa.RecordBatch.from_arrays([pa.array([t.tobytes() for t in terms], pa.binary())], names=["terms"])
    for part, own in ((batch, terms), (batch.slice(7, 90), terms[7: 97]), (batch.slice(0, 0), [])):
        got = []
        for names, a in decontaminate.grids([part], idf):
            full = np.zeros((len(a), 60))
            full[:, names] = a
            got.extend(full)
        want = [np.bincount(t, idf[t], 60) for t in own]
        lengths = [np.sqrt((idf[t] ** 2).sum()) for t in own]
        assert len(got) == len(want)
        for g, w, n in zip(got, want, lengths):
            np.testing.assert_allclose(g, w / n, rtol=1e-5, atol=1e-7)


def test_decontamination_of_items_without_a_vector():
    text = "one two three four five six seven eight nine ten eleven twelve"
    space = decontaminate.Space(np.ones(decontaminate.TERMS), np.zeros((decontaminate.TERMS, decontaminate.RANK), np.float32))
    found = decontaminate.Searcher(space, [decontaminate.item_of(7, text)]).search(*utf8(pa.array(["a b c", "so " + text + " so"])))
    assert found == [(1, 7, 12, 12, True)]


def test_decontamination_of_short_items(spark, docs, rows):
    bench = spark.createDataFrame([(1, " ".join(words(rows[17][1])[20:25])), (2, "words that stand nowhere"), (3, "?!")], "item_id long, text string")
    fold = lambda t: " " + " ".join(re.sub(r"[!-/:-@\[-`{-~]", " ", t or "").lower().split()) + " "
    item = fold(" ".join(words(rows[17][1])[20:25]))
    got = {(r["doc_id"], r["item_id"], r["common_words"], r["item_words"]) for r in decontaminate.leaks(docs, bench).collect()}
    assert got == {(i, 1, 5, 5) for i, t, _ in rows if item in fold(t)} and (17, 1, 5, 5) in got


def common(a, b):
    """Length of the longest common subsequence."""
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for k, y in enumerate(b):
            new.append(row[k] + 1 if x == y else max(row[k + 1], new[-1]))
        row = new
    return row[-1]


def test_decontamination_paraphrases_against_all_windows():
    """Without the cosine cut (no vectors), all windows with a common subsequence of 3/4 are found, also where rare words changed."""
    r = random.Random(12)
    frequent, rare = [f"w{k}" for k in range(40)], iter(f"rare{k}" for k in range(10_000))
    idf = np.full(decontaminate.TERMS, 9.0)
    hashes, _ = decontaminate.folded_words(*utf8(pa.array([" ".join(frequent)])))
    idf[decontaminate.terms_of(hashes)] = 1.0
    space = decontaminate.Space(idf, np.zeros((decontaminate.TERMS, decontaminate.RANK), np.float32))
    items, texts = [], []
    for _ in range(12):
        own = r.choices(frequent, k=18)
        places = sorted(r.sample(range(24), 6))
        fill = lambda: [next(rare) if k in places else own[k - sum(p < k for p in places)] for k in range(24)]
        items.append(fill())
        texts.append([next(rare) for _ in range(r.randint(5, 30))] + fill() + [next(rare) for _ in range(20)])
    width = 8 * -(-(24 + 7) // 8)
    want = {(d, i) for d, t in enumerate(texts) for i, it in enumerate(items)
            if max(common(it, t[s: s + width]) for s in range(0, len(t), 8)) >= 18}
    found = decontaminate.Searcher(space, [decontaminate.item_of(i, " ".join(it)) for i, it in enumerate(items)]).search(*utf8(pa.array([" ".join(t) for t in texts])))
    assert len(want) >= 12 and {(d, i) for d, i, c, *_ in found if c >= 18} == want


def test_lattice_scores(docs, rows):
    low = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    parsed = [(i, i is None or zlib.crc32(str(i).encode()) % 10 == 0, words(low(t))) for i, t, _ in rows]
    c = Counter(w for _, held, ws in parsed if not held for w in ws)
    ends = sum(not held for _, held, _ in parsed)
    n = sum(c.values()) + ends
    norm = n + 0.1 * (len(c) + 2)
    got = lattice_lm.lm_scores(docs, public_tokenizers.path("piece_bpe_32k.model"))
    want = [(i, held, len(ws) + 1, sum(c[w] > 0 for w in ws) + 1, n,
             round(sum(math.log10((c[w] + 0.1) / norm) for w in ws) + math.log10((ends + 0.1) / norm), 6)) for i, held, ws in parsed]
    have = got.withColumn("base_score", F.round("base_score", 6))
    assert collected(have, ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score")) == sorted(want, key=repr)
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in got.collect())


def test_lattice_sums_all_segmentations():
    p = lattice_lm.Pieces(public_tokenizers.path("piece_bpe_32k.model"))
    p.weigh(np.arange(len(p.spelled)) % 97 * 1.0, 1000)
    logs = dict(zip(p.keys.tolist(), p.logs.tolist()))

    def total(word):
        ways = [1.0] + [0.0] * len(word)
        for j in range(1, len(word) + 1):
            for i in range(j):
                key = int(lattice_lm.span_hashes(np.frombuffer(word[i:j], np.uint8), np.array([0]), np.array([j - i]))[0])
                ways[j] += ways[i] * 10 ** logs[key] if key in logs else 0
        return math.log10(ways[-1])

    some = ["hello", "naïve", "x", "antidisestablishment", "日本", "", "y" * 60]
    assert np.allclose(p.score(pa.array(some)), [total(b" " + w.encode()) for w in some])
    assert math.isclose(10 ** p.end + sum(10 ** x for x in p.logs), 1, rel_tol=1e-9)


def test_revisits(spark):
    h = {"ETag": '"a"', "Content-Type": "text/html", "Content-Length": "9"}
    recs = [(1, "http://WWW.x.com:80/a/?utm_source=f#top", 10, "response", '"a"', "d1", h), (2, "https://x.com/a", 20, "response", '"b"', "d2", h),
            (3, "http://x.com/a", 15, "revisit", 'W/"a"', None, {"Content-Length": "0", "X": "1"}), (4, "http://x.com/a", 10, "revisit", '"a"', None, None),
            (5, "http://x.com/a", 99, "revisit", '"a"', None, {}), (6, "http://x.com/a", 99, "revisit", None, "d2", {}),
            (7, None, 99, "revisit", '"a"', None, {}), (8, "http://x.com/a", None, "revisit", '"a"', None, {}), (9, "http://x.com/a", 99, "revisit", None, None, {})]
    df = spark.createDataFrame(recs, "record_id long, url string, ts long, kind string, etag string, last_modified string, headers map<string,string>")
    got = {r["record_id"]: r for r in warc_revisits.resolve_revisits(df.withColumn("canon", F.lit(1))).collect()}
    assert {k: (r["status"], r["response_id"]) for k, r in got.items()} == {
        3: ("resolved", 1), 4: ("no_earlier_response", None), 5: ("validator_mismatch", 2), 6: ("resolved", 2),
        7: ("no_earlier_response", None), 8: ("no_earlier_response", None), 9: ("validator_mismatch", 2)}
    assert got[3]["headers"] == {"etag": '"a"', "content-type": "text/html", "content-length": "9", "x": "1"}


def test_revisits_with_repeated_ids(spark):
    h = {"ETag": "x"}
    recs = [(1, "http://x.com/a", 10, "response", '"a"', None, h), (1, "http://x.com/b", 10, "response", '"b"', None, h),
            (1, "http://x.com/a", 20, "response", '"c"', None, h), (None, "http://x.com/n", 5, "response", '"n"', None, h),
            (7, "http://x.com/a", 15, "revisit", '"a"', None, {}), (7, "http://x.com/b", 15, "revisit", '"b"', None, {}),
            (8, "http://x.com/a", 30, "revisit", '"c"', None, {}), (9, "http://x.com/a", 15, "revisit", '"c"', None, {}),
            (None, "http://x.com/a", 15, "revisit", '"a"', None, {}), (10, "http://x.com/n", 9, "revisit", '"n"', None, {}),
            (11, "http://x.com/a", 15, "revisit", '"a"', None, {}), (11, "http://x.com/a", 15, "revisit", '"a"', None, {})]
    df = spark.createDataFrame(recs, "record_id long, url string, ts long, kind string, etag string, last_modified string, headers map<string,string>")
    assert collected(warc_revisits.resolve_revisits(df), ("record_id", "canon", "status")) == sorted([
        (7, "x.com/a", "resolved"), (7, "x.com/b", "resolved"), (8, "x.com/a", "resolved"), (9, "x.com/a", "validator_mismatch"),
        (None, "x.com/a", "resolved"), (10, "x.com/n", "resolved"), (11, "x.com/a", "resolved"), (11, "x.com/a", "resolved")], key=repr)


def test_short_benchmark_items_with_null_ids(spark):
    docs = spark.createDataFrame([(1, "so here the short item words stand"), (2, "nothing of it")], "doc_id long, text string")
    bench = spark.createDataFrame([(None, "the short item words"), (4, "the short item words"), (4, "the short item words")], "item_id long, text string")
    assert {r["doc_id"] for r in decontaminate.leaks(docs, bench).collect()} == {1}


def test_empty_tables(spark, none):
    path = public_tokenizers.path
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([], "item_id long, text string")
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    for df in (quality.quality_rules(none), jaccard_join.jaccard_join(none), debruijn_dedup.substring_dedup(none), bwt_dedup.byte_dedup(none),
               decontaminate.leaks(none, bench), packing.best_fit_packing(none, path("word_bpe_49k.json")), toxicity.toxicity(none, labels),
               token_counts.token_counts(none, path("byte_bpe_50k.json")), lattice_lm.lm_scores(none, path("piece_bpe_32k.model")),
               warc_revisits.resolved_pages(pages)):
        assert df.count() == 0


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = corpus_pipeline.STAGES
    names = [n for n, _ in stages]
    assert names == ["quality", "near_duplicates", "substrings", "decontamination", "packing"]
    sizes = [docs.count()]
    for _, stage in stages[:-1]:
        new = corpus_pipeline.stored(stage(spark, docs, SF))
        assert new.columns == docs.columns
        docs = new
        sizes.append(docs.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 0.5 * sizes[0]
    packed = stages[-1][1](spark, docs, SF)
    assert packed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()


def test_queries_are_registered():
    assert sorted(n.split("_")[0] for n in queries.QUERIES) == sorted([f"op{i}" for i in range(1, 14)] + ["pipeline"])


def test_quality_block_takes_a_bounded_multiple_of_its_text():
    import tracemalloc

    for words in ("some words of ", "des mots d'été "):
        texts = pa.array([words * 4000] * 80)
        tracemalloc.start()
        try:
            block = quality.Grams(texts)
            block.counted()
            quality.measured(block.buf, block.offsets)
            peak = tracemalloc.get_traced_memory()[1]
        finally:
            tracemalloc.stop()
        assert peak < 18 * len(block.buf)  # with whole columns of 64-bit places 36 times and more


def test_quality_slices_change_nothing(monkeypatch):
    texts = pa.array(["Añé 中文 x. 12\n\nAñé 中文 x. 12\n", None, "", "a", "a b c d e a b c d e 😀", "".join(chr(0x4E00 + i) for i in range(300))])
    for dense in (1 << 22, 50):
        monkeypatch.setattr(quality, "DENSE", dense)
        seen = []
        for size in (1 << 20, 5, 1):
            monkeypatch.setattr(quality, "SLICE", size)
            block = quality.Grams(texts)
            seen.append([block.symbols, block.bounds, block.names, block.pairs, block.rank, *block.counted(), *quality.measured(block.buf, block.offsets).values()])
        assert block.symbols[:4].tolist() == [ord(x) for x in "añé "] and block.bounds.tolist()[:5] == [0, 27, 27, 27, 28]
        for other in seen[1:]:
            assert all(np.array_equal(a, b) for a, b in zip(seen[0], other))
