"""Operators 11 to 13 against brute force: whitening, periodic runs, benchmark decontamination."""

import hashlib
import math
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from hearth.llm import decontaminate, queries, runs, whitening

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def written(spark, tmp_path, **tables):
    for name, df in tables.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


# ---- 11


def whitened_by_hand(vectors, scale=64):
    x = np.array([[math.floor(float(c) * scale) for c in v] for v in vectors], float)
    v = np.cov(x.T, bias=True).reshape(x.shape[1], x.shape[1])
    e, u = np.linalg.eigh(v)
    order = np.argsort(-e)
    return x - x.mean(0), e[order], u[:, order], np.trace(v)


def test_whitening_query(spark, tmp_path):
    rng = np.random.default_rng(4)
    made = (rng.normal(size=(300, 6)) * [1, 3, 0.5, 0.2, 7, 2] + rng.normal(size=6)).tolist()
    odd = [(900, None), (901, []), (902, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (903, [float("nan")] * 6), (904, [float("inf")] * 6)]
    rows = [(i, v) for i, v in enumerate(made)] + odd + [(7, made[7]), (None, made[8])]
    sf = written(spark, tmp_path, embeddings=spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("n", F.lit("clash")).withColumn("component", F.lit(1)))
    got = queries.op11_embedding_whitening(spark, sf).collect()
    z, e, u, trace = whitened_by_hand([*made, made[7], made[8]])
    n = len(z)
    assert len(got) == n * 6 and {r["n"] for r in got} == {n}
    ints = np.array([[math.floor(c * 64) + 1000000 for c in v] for v in [*made, made[7], made[8]]], object)
    sums = ints.sum(0)
    for i, v in enumerate([*made, made[7], made[8]]):
        name = [*range(300), 7, None][i]
        own = [r for r in got if r["vec_id"] == name]
        assert {r["deviation"] for r in own} == {int(((ints[i] * n - sums) ** 2).sum())}
    for k in range(6):
        part = {r["vec_id"]: r for r in got if r["component"] == k + 1 and r["vec_id"] is not None}
        want = z @ u[:, k] / math.sqrt(e[k])
        have = np.array([part[i]["whitened"] for i in range(300)])
        assert min(np.abs(have - want[:300]).max(), np.abs(have + want[:300]).max()) < 1e-9
        assert abs(part[0]["explained"] - e[k] / trace) < 1e-12
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-9


def test_equal_and_zero_eigenvalues(spark):
    # +-1 along each of five axes of seven: five equal eigenvalues, two that are zero
    rows = [(2 * i + s, [float((1 - 2 * s) * (i == j)) for j in range(7)]) for i in range(5) for s in range(2)]
    model = whitening.fit(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))[7]
    basis = model.vectors
    assert np.abs(basis @ basis.T - np.eye(7)).max() < 1e-14
    assert np.allclose(model.roots[:5], math.sqrt(64 * 64 * 2 / 10)) and not model.roots[5:].any()
    assert model.explained == pytest.approx([0.2] * 5 + [0, 0]) and model.identity_error < 1e-12
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert got.where("component > 5 AND whitened IS NULL AND explained = 0").count() == got.where("component > 5").count() == 20
    one = whitening.whiten(spark.createDataFrame([(1, [2.0, 3.0])], "vec_id long, embedding array<double>")).collect()
    assert [(r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in one] == [(1, 0, None, None, None)] * 2


def test_close_roots_and_large_integers(spark):
    # roots whose difference no double shows, lengths apart, entries beyond 53 bits
    root = 1 << 90
    m = np.array([[root, 0, 0], [0, root + 1, 0], [0, 0, 1]], object)
    basis, roots, shift = whitening.components(spark, m, 3)
    assert [Fraction(r, 1 << shift) for r in roots] == [root + 1, root, 1]
    assert np.abs(basis).tolist() == [[0, 1, 0], [1, 0, 0], [0, 0, 1]]
    rows = [(i, [float(v), float(w)]) for i, (v, w) in enumerate([(2**50, 1), (-(2**49), 2), (3, 5e300), (1, 1)])] + [(10 + i, [float(i)]) for i in range(5)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    held = whitening.scatters(df, "embedding", 64)
    y = np.array([[min(math.floor(c * 64), 1 << 62) for c in v] for _, v in rows[:4]], object)
    assert held[2][0] == 4 and held[2][1] == y.sum(0).tolist() and (held[2][2] == y.T.dot(y)).all() and held[1][0] == 5
    got = {r["vec_id"]: r for r in whitening.whiten(df).where("component = 1").collect()}
    want = [int(((row * 4 - y.sum(0)) ** 2).sum()) for row in y]
    assert [got[i]["deviation"] is None and int(got[i]["deviation_exact"]) for i in range(4)] == want
    assert got[12]["whitened"] == 0 and got[10]["n"] == 5


def test_polynomial():
    rng = np.random.default_rng(2)
    a = rng.integers(-9, 10, (7, 7))
    m = (a @ a.T).astype(object)
    p = (1 << 31) - 1
    assert whitening.is_prime(p) and not whitening.is_prime(p - 2)
    c = whitening.polynomial_mod(m, p)
    assert len(c) == 8 and c[7] == 1 and (int(c[6]) + sum(m[i, i] for i in range(7))) % p == 0
    power, total = np.eye(7, dtype=object), np.zeros((7, 7), object)
    for v in c:  # every matrix is a root of its characteristic polynomial
        total = (total + int(v) * power) % p
        power = power.dot(m)
    assert not total.any()


def test_no_vectors(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert whitening.whiten(empty).columns == ["vec_id", "component", "n", "deviation", "deviation_exact", "whitened", "explained", "identity_error"]
    assert whitening.whiten(empty).isEmpty()


# ---- 12


def runs_by_hand(w):
    n, out = len(w), []
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(24, 3 * q):
                seg = w[i : i + length]
                if not any(all(seg[k] == seg[k + d] for k in range(length - d)) for d in range(1, q)):
                    out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda x: (x[0], x[2]))


def collapsed_by_hand(w, found):
    return " ".join(x for k, x in enumerate(w) if not any(s + q <= k < s + m for s, m, q in found))


def repetitive(rng, size=260):
    w = []
    for _ in range(rng.randint(0, 6)):
        base = [rng.choice(["a", "b", "É", "é", "😀", f"w{rng.randint(0, 50)}"]) for _ in range(rng.randint(1, 12))]
        w += base * rng.randint(1, 12)
        w = w[: rng.randint(0, len(w))] if rng.random() < 0.3 else w
        if rng.random() < 0.5 and w:
            w += w[-rng.randint(1, len(w)) :]
    return "".join(x + rng.choice([" ", "\n", " \t\r\x0b\x0c"]) for x in w[:size])


def test_periodic_runs_query(spark, tmp_path):
    rng = random.Random(9)
    texts = [None, "", " \n", "a " * 30, "A a " * 20, *(repetitive(rng) for _ in range(250)), *(" ".join(f"w{rng.randint(0, 9)}" for _ in range(rng.randint(1, 200))) for _ in range(250))]
    rows = [(i, t, None, "s", 1) for i, t in enumerate(texts)] + [(None, "b c " * 20, "en", None, None), (3, "a " * 30, None, None, 2)]
    sf = written(spark, tmp_path, documents=spark.createDataFrame(rows, DOCS).withColumn("runs", F.lit(1)).withColumn("h_", F.lit(1)))
    got = queries.op12_periodic_runs(spark, sf).collect()
    want, planted = [], 0
    for i, t, *_ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        h = zlib.crc32(str(i).encode()) if i is not None else 1
        if h % 10 == 0 and w:
            n, g = len(w), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [x if k < a else w[a + (k - a) % p] for k, x in enumerate(w)]
            planted += 1
        found = runs_by_hand(w)
        best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
        told = "".join(f"{s},{m},{q}\n" for s, m, q in found)
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        want.append((i, len(found), *best, 1000 * best[1] // best[2] if found else None, sha(told), sha(collapsed_by_hand(w, found))))
    assert planted > 30 and sum(x[1] > 0 for x in want) > 150
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, want))


def test_long_texts_and_chunks(spark):
    rng = random.Random(1)
    word = lambda: f"x{rng.randint(0, 10**6)}"
    line = [word() for _ in range(700)]
    texts = ["a " * 40000, " ".join(line * 60), " ".join([word() for _ in range(60000)] + ["p", "q", "r"] * 9 + ["s"]), "z" * 2_000_000, "a " * 23, "a " * 24]
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], DOCS)
    got = [(r["n_words"], [tuple(x) for x in r["runs"]], len(r["collapsed"].split())) for r in runs.find(df, ["doc_id"]).orderBy("doc_id").collect()]
    assert got == [(40000, [(0, 40000, 1)], 1), (42000, [(0, 42000, 700)], 700), (60028, [(60000, 27, 3)], 60004), (1, [], 1), (23, [], 23), (24, [(0, 24, 1)], 1)]
    assert runs.find(df.limit(0), ["doc_id", "lang"]).columns == ["doc_id", "lang", "n_words", "runs", "collapsed"] and runs.find(df.limit(0), ["doc_id"]).isEmpty()


# ---- 13


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def leaks_by_hand(text, items, length=10, coverage=1.0):
    t, hit, ids = words_of(text), set(), set()
    for name, item in items:
        w = words_of(item)
        size = decontaminate.window_of(len(w), length, coverage) if w else 0
        windows = {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if w else set()
        for k in range(len(t) - size + 1) if w else ():
            if tuple(t[k : k + size]) in windows:
                hit |= set(range(k, k + size))
                ids |= {str(name)} if name is not None else set()
    return len(t), hit, sorted(ids)


def planted(seed, few=6):
    rng = random.Random(seed)
    pool = [f"W{i}" if i % 3 else f"é{i}" for i in range(few)]
    items = [(k, rng.choice([", ", " ", "-\n"]).join(rng.choice(pool) for _ in range(rng.choice([0, 1, 2, 5, 9, 10, 11, 25])))) for k in range(12)]
    items += [(None, items[3][1]), (3, " ".join(pool * 3)), (77, None), (78, "..."), (5, items[5][1])]
    texts = [None, "", "!", pool[0]]
    for _ in range(200):
        t = [rng.choice([*pool, "other"]) for _ in range(rng.randint(0, 30))]
        own = (rng.choice(items)[1] or "").split(" ")
        a = rng.randint(0, len(own))
        t[rng.randint(0, len(t)) : 0] = own[a : a + rng.randint(0, 14)]
        texts.append(rng.choice([" ", ". ", "/"]).join(t).upper() if rng.random() < 0.2 else " ".join(t))
    return items, texts


def tables(spark, seed, few=6):
    items, texts = planted(seed, few)
    docs = spark.createDataFrame([(i, t, None, "s", 1) for i, t in enumerate(texts)] + [(None, texts[9], None, None, None), (9, texts[9], None, None, None)], DOCS)
    return items, docs.withColumn("spans", F.lit(1)).withColumn("items", F.lit(1)), spark.createDataFrame(items, "item_id long, text string").withColumn("n", F.lit(0))


@pytest.mark.parametrize("few", [6, 400])
def test_decontamination_query(spark, tmp_path, few):
    items, docs, bench = tables(spark, 3, few)
    got = queries.op13_benchmark_decontamination(spark, written(spark, tmp_path, documents=docs, benchmark=bench)).collect()
    want = []
    for r in docs.collect():
        n, hit, ids = leaks_by_hand(r["text"], items)
        want.append((r["doc_id"], n, len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, want))
    assert 20 < sum(x[5] for x in want) and (few == 6 or sum(x[5] for x in want) < 200)


@pytest.mark.parametrize("length,coverage", [(10, 1.0), (4, 0.5)])
def test_blocks_of_items(spark, monkeypatch, length, coverage):
    """A benchmark of many blocks gives what one block gives, and cutting leaves the other words."""
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 20)
    items, docs, bench = tables(spark, 5, 30)
    found = decontaminate.scan(docs, bench, keep=["doc_id", "text"], length=length, coverage=coverage)
    cut = {(r["doc_id"], r["was"]): r["text"] for r in decontaminate.cleaned(found.withColumn("was", F.col("text"))).collect()}
    rows = found.collect()
    assert len(rows) == docs.count()
    for r in rows:
        n, hit, ids = leaks_by_hand(r["text"], items, length, coverage)
        assert r["n_words"] == n and r["items"] == ids
        assert [k for s in r["spans"] for k in range(s["first"], s["last"])] == sorted(hit)
        assert all(a["last"] < b["first"] for a, b in zip(r["spans"], r["spans"][1:]))
        for s in r["spans"]:
            assert words_of(r["text"].encode()[s["start"] : s["end"]].decode()) == words_of(r["text"])[s["first"] : s["last"]]
        assert words_of(cut[r["doc_id"], r["text"]]) == [w for k, w in enumerate(words_of(r["text"])) if k not in hit]
    left = decontaminate.cleaned(found, most=0.3)
    assert 0 < left.count() < found.count()


def test_nothing_to_find(spark):
    _, docs, bench = tables(spark, 1)
    none = decontaminate.scan(docs, bench.limit(0), keep=["doc_id"])
    assert none.count() == docs.count() and none.where("size(spans) > 0 OR size(items) > 0").isEmpty()
    assert decontaminate.scan(docs.limit(0), bench, keep=["doc_id"]).isEmpty()
    item = " ".join(f"t{i}" for i in range(5000))
    long = spark.createDataFrame([(1, "x " * 300000 + item[:-1] + " y", None, None, None)], DOCS)
    (r,) = decontaminate.scan(long, spark.createDataFrame([(1, item)], "item_id long, text string"), keep=["doc_id"]).collect()
    assert [(s["first"], s["last"]) for s in r["spans"]] == [(300000, 304999)] and r["items"] == ["1"]
