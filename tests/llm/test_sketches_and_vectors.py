"""Bottom-k near duplicates, whitening and vector codes against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from markerlens.llm import bottomk_dedup, jd_whitening, orchard_codes
from markerlens.llm.text_arrays import utf8, word_hashes, word_spans

WORD = re.compile(r"[^\x20\x09-\x0D]+")
CLASH = ("rid", "value", "unit", "comp", "grp", "at", "sketch", "low", "blk", "component_id", "n")


def collected(df, columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def set_of(text):
    ws = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(ws[i:i + 3]) for i in range(len(ws) - 2)} or ({tuple(ws)} if ws else set())


def brute(rows):
    sets = [set_of(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least.setdefault(find(i), []).append(d)
    least = {k: min((x for x in v if x is not None), default=None) for k, v in least.items()}
    return [(d, len(s), least[find(i)], d == least[find(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets))]


def near_rows(r, n_groups, n_each, passage):
    vocab = ["".join(r.choice("abcdefghijklmnopé") for _ in range(r.randint(2, 8))) for _ in range(500)]
    text = lambda n: [r.choice(vocab) for _ in range(n)]
    shared = text(passage)
    out = []
    for g in range(n_groups):
        base = text(r.choice([1, 2, 4, 9, 30, 58, 66, 80, 400, 2000])) + (shared if g % 3 == 0 else [])
        for _ in range(n_each):
            t = list(base)
            for _ in range(r.choice([0, 0, 1, 2, len(t) // 40, len(t) // 25])):
                t[r.randrange(len(t))] = r.choice(vocab)
            out.append(" ".join(t if r.random() < 0.8 else t[: max(1, int(len(t) * r.uniform(0.84, 1)))]))
    return out


@pytest.mark.parametrize("block_rows", [512, 7])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, block_rows):
    monkeypatch.setattr(bottomk_dedup, "BLOCK_ROWS", block_rows)
    r = random.Random(3)
    texts = near_rows(r, 24, 6, 120)
    made = texts + [texts[0].upper(), "  \t" + texts[1], None, None, "", " \n", "tie", "tie", "Tie tie", "a b", "A  b", "a b c", "x" * 5000, "x" * 5000 + " y"]
    rows = [(i, t) for i, t in enumerate(made)]
    r.shuffle(rows)
    rows += [rows[5], (None, texts[3]), (None, "only one here"), (None, None)]
    df = spark.createDataFrame([(i, t, *["x"] * len(CLASH)) for i, t in rows], "doc_id long, text string, " + ", ".join(f"{c} string" for c in CLASH)).repartition(3)
    got = bottomk_dedup.near_duplicates(df)
    want = [(d, n, c, k or d is None and c is None) for d, n, c, k in brute(rows)]
    assert collected(got, ("doc_id", "n_shingles", "component_id", "kept")) == sorted(want, key=repr)


def test_near_duplicates_of_one_large_text_and_none(spark):
    r = random.Random(4)
    long = [f"w{r.randrange(10 ** 6)}" for _ in range(700_000)]  # some 5 MB, beyond every slice
    other = long[:100] + [f"v{k}" for k in range(30_000)] + long[30_100:]
    rows = [(1, " ".join(other)), (2, " ".join(long)), (3, " ".join(long[:550_000]))]
    got = bottomk_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert collected(got, ("doc_id", "component_id")) == [(1, 1), (2, 1), (3, 3)]
    assert bottomk_dedup.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_word_hashes_tell_thue_morse_words_apart():
    bits = [bin(i).count("1") % 2 for i in range(1 << 13)]
    words = [bytes(97 + (b ^ flip) for b in bits[:n]).decode() for n in (8, 16, 512, 1024, 8192) for flip in (0, 1)] + ["a", "b", "a" * 8, "a" * 9, "a\0"]
    buf, offsets = utf8(pa.array([" ".join(words * 2)]))
    starts, ends, _ = word_spans(buf, offsets)
    hashes = word_hashes(buf, starts, ends).tolist()
    assert len(set(hashes)) == len(words) and hashes[: len(words)] == hashes[len(words):]


def vector_rows(r, n, width, spread=0.2):
    out = [(i, [float(np.float32(r.gauss(0, spread * (1 + 3 / (k + 1))))) for k in range(width)], r.choice([0, 1, None])) for i in range(n)]
    out += [(n, None, 1), (n + 1, [None] * width, 1), (n + 2, [float("nan")] * width, 0), (n + 3, [float("inf")] + [0.0] * (width - 1), 0),
            (n + 4, [-0.0] * width, 2), out[3], (out[4][0], out[5][1], 1), (None, out[6][1], None), (n + 5, out[6][1], 2)]
    return out


def vector_frame(spark, rows):
    schema = "vec_id long, embedding array<float>, label int, x string, n string, code string, part string"
    return spark.createDataFrame([(*t, "x", "x", "x", "x") for t in rows], schema).repartition(3)


def sound(rows):
    return [t for t in rows if t[1] is not None and all(c is not None and np.isfinite(c) for c in t[1])]


@pytest.mark.parametrize("width, n", [(16, 300), (3, 60), (8, 2)])
def test_whitening_equals_a_dense_solver(spark, width, n):
    rows = vector_rows(random.Random(width), n, width) if n > 7 else [(1, [0.5] * width, 0), (2, [0.25] * width, 0), (3, [0.5] * width, 1)]
    kept = sound(rows)
    x = np.floor(np.array([t[1] for t in kept]) * 256).astype(np.int64)
    fit = np.unique(x, axis=0)
    m, s = len(fit), fit.sum(0)
    cov = np.cov(fit.T, bias=True)
    e, v = np.linalg.eigh(cov)
    e, v = e[::-1], v[:, ::-1]
    k = min(4, width, int((e > 1e-9 * e[0]).sum()))
    white = (x - s / m) @ v[:, :k] / np.sqrt(e[:k])
    got = jd_whitening.whiten(vector_frame(spark, rows)).collect()
    assert len(got) == k * len(kept) and {r["n"] for r in got} == {m} and max(r["identity_error"] for r in got) < 1e-9
    dev = Counter((t[0], int(((m * a - s) ** 2).sum())) for t, a in zip(kept, x))
    for c in range(1, k + 1):
        own = [r for r in got if r["component"] == c]
        assert Counter((r["vec_id"], r["deviation"]) for r in own) == dev
        assert np.allclose([r["explained"] for r in own], e[c - 1] / np.trace(cov), rtol=1e-9)
        have = sorted((repr(r["vec_id"]), r["deviation"], r["whitened"]) for r in own)
        want = sorted((repr(t[0]), int(((m * a - s) ** 2).sum()), w) for t, a, w in zip(kept, x, white[:, c - 1]))
        a, b = np.array([r[2] for r in have]), np.array([r[2] for r in want])
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-7


def test_jacobi_davidson_close_and_equal_eigenvalues():
    rng = np.random.default_rng(2)
    q, _ = np.linalg.qr(rng.standard_normal((60, 60)))
    for e in (np.r_[5, 5, 5 - 1e-6, 4.999, np.linspace(4, 0.1, 56)], np.r_[3.0, 1.0, np.zeros(58)], np.linspace(1, 0.9, 60)):
        a = (q * e) @ q.T
        calls = []
        values, vectors = jd_whitening.jacobi_davidson(lambda v: calls.append(1) or a @ v, 60)
        assert np.allclose(values, np.sort(e)[::-1][:4], atol=1e-12)
        assert np.abs(a @ vectors - vectors * values).max() < 1e-12 and np.abs(vectors.T @ vectors - np.eye(4)).max() < 1e-12


def test_vectors_that_have_no_result(spark):
    none = vector_frame(spark, [(1, None, 0), (2, [], 1), (3, [None] * 4, 1)])
    assert jd_whitening.whiten(none).count() == 0 and orchard_codes.compress(none).count() == 0
    assert jd_whitening.whiten(vector_frame(spark, [(1, [0.5, 0.25], 0), (2, [0.5, 0.25], 0)])).count() == 0
    with pytest.raises(ValueError):
        jd_whitening.whiten(vector_frame(spark, [(1, [0.5, 0.25], 0), (2, [0.5], 0)])).count()
    with pytest.raises(ValueError):
        orchard_codes.compress(vector_frame(spark, [(1, [0.5] * 6, 0)])).count()


def plain_codes(rows, width):
    kept = sound(rows)
    x = np.floor(np.array([t[1] for t in kept]) * 1024).astype(np.int64)
    order = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, x[i].tolist()))[:256]
    part = width // 4
    books = [x[order, p * part: (p + 1) * part] for p in range(4)]
    assign = lambda: [((x[:, None, p * part: (p + 1) * part] - b[None]) ** 2).sum(2) for p, b in enumerate(books)]
    for _ in range(4):
        near = [d.argmin(1) for d in assign()]
        books = [np.array([x[c == e, p * part: (p + 1) * part].sum(0) // (c == e).sum() if (c == e).any() else b[e] for e in range(len(b))])
                 for p, (b, c) in enumerate(zip(books, near))]
    dist = assign()
    code = np.stack([d.argmin(1) for d in dist], 1)
    error = sum(d.min(1) for d in dist)
    total = Counter()
    for t, e in zip(kept, error.tolist()):
        total[t[2]] += e
    name = hashlib.sha256(",".join(str(v) for b in books for v in b.reshape(-1)).encode()).hexdigest()
    return [(t[0], "".join(f"{v:02x}" for v in c), e, total[t[2]], name) for t, c, e in zip(kept, code.tolist(), error.tolist())]


@pytest.mark.parametrize("width, n, spread", [(16, 700, 0.2), (8, 900, 0.002), (4, 40, 0.2)])
def test_vector_codes_equal_brute_force(spark, width, n, spread):
    rows = vector_rows(random.Random(n), n, width, spread)
    got = orchard_codes.compress(vector_frame(spark, rows))
    assert collected(got, ("vec_id", "code", "error", "label_error", "codebooks_sha256")) == sorted(plain_codes(rows, width), key=repr)


def test_bottomk_equal_sets_have_equal_fingerprints_wherever_they_stand(spark):
    r = random.Random(41)
    other = [" ".join(f"w{r.randrange(5000)}" for _ in range(200)) for _ in range(20)]
    same = "the same text of nine words in every place"
    column = pa.array([t for x in other for t in (x, same)])
    values, bounds = bottomk_dedup.shingle_sets(*utf8(column))
    for prints in bottomk_dedup.fingerprints(values, bounds):
        assert len(set(prints[1::2].tolist())) == 1
        assert len(set(prints[::2].tolist())) == len(other)


def test_bottomk_the_leader_of_a_family_is_close_to_its_source(spark):
    """Copies with changes of their own share more with the source than with each other; the source is not the least id."""
    shared = [*range(1, 61)]
    sets = {0: shared[:40] + [*range(1000, 1024)], 1: shared[20:] + [*range(2000, 2024)], 2: shared + [9001, 9002, 9003, 9004], 3: shared[:50] + [*range(3000, 3014)]}
    reps = spark.createDataFrame([(k, len(v), v) for k, v in sets.items()], "rid long, n_shingles long, sketch array<long>")
    members = bottomk_dedup.different_lists(bottomk_dedup.inverted_lists(reps)).collect()
    full = Counter(m["value"] for m in members)
    assert full
    for value in full:
        own = {m["rid"] for m in members if m["value"] == value}
        lead = {m["lead"] for m in members if m["value"] == value}
        assert len(lead) == 1 and lead <= own
        if 2 in own:
            assert lead == {2}
