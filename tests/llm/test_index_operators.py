"""Decontamination, spelling variants and whitening against brute force."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from loam.llm import decontamination as dc
from loam.llm import spelling, whitening

LOWER = {c: c + 32 for c in range(65, 91)}

# -- decontamination ------------------------------------------------------------------------------------------


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute_hits(texts, items, window=10, near=15):
    docs = [words(t) for t in texts]
    freq = Counter(w for d in docs for w in d)
    wins = {}
    for i, t in items:
        w = words(t)
        k = min(window, len(w))
        for s in range(len(w) - k + 1 if w else 0):
            wins.setdefault(tuple(w[s:s + k]), set()).add(i)
    out = []
    for d in docs:
        hit, found, close = set(), set(), set()
        where = {}
        for p, w in enumerate(d):
            where.setdefault(w, []).append(p)
        for g, ids in wins.items():
            for s in where.get(g[0], ()):
                if tuple(d[s:s + len(g)]) == g:
                    hit.update(range(s, s + len(g)))
                    found |= ids
            if all(freq[w] for w in g):
                rare = sorted(dict.fromkeys(g), key=lambda w: (freq[w], g.index(w)))[:3]
                if any(all(any(abs(q - p) <= near for q in where.get(w, ())) for w in rare[1:]) for p in where.get(rare[0], ())):
                    close |= ids
        out.append((len(d), len(hit), sorted(x for x in found if x is not None), len(close - {None})))
    return out


def check_hits(spark, docs, items, **kw):
    d = spark.createDataFrame(docs, "doc_id long, text string, block long, ord int, term string")
    b = spark.createDataFrame(items, "item_id long, text string, code int")
    got = dc.matches(d, b, **kw).collect()
    seen = sorted((r.doc is None, r.doc or 0, r.n_words, sum(
        1 for _ in {p for s in r.spans for p in range(s["begin"], s["end"])}), sorted(r["items"]), r.n_near) for r in got)
    brute = brute_hits([x[1] for x in docs], [x[:2] for x in items])
    assert seen == sorted((x[0] is None, x[0] or 0, *y) for x, y in zip(docs, brute))
    return got


@pytest.fixture(scope="module")
def leaks(texts):
    rng = random.Random(5)
    vocab = ["the", "of", "and"] * 3 + [f"word{i}" for i in range(60)] + ["naïve", "東京"]
    items = [(i, " ".join(rng.choices(vocab, k=n)), 0) for i, n in enumerate([12, 10, 30, 9, 3, 1, 0, 25, 11, 40])]
    items += [(20, items[0][1], 0), (21, items[1][1].upper() + "!", 0), (None, items[2][1], 0), (22, None, 0), (23, "the " * 12, 0),
              (2, items[2][1], 0)]
    docs = []
    for i in range(40):
        body = rng.choices(vocab, k=rng.randint(0, 60))
        it = words(items[i % 10][1])
        if i % 2:
            body[10:10] = it
        elif i % 4:
            shuffled = it[:]
            rng.shuffle(shuffled)
            body[5:5] = shuffled[:12]
        docs.append((i if i % 9 else None, "  ".join(body) + ("." if i % 3 else ""), 1, 2, "t"))
    docs += [(100 + i, t, 1, 2, "t") for i, t in enumerate(texts)] + docs[3:5]
    docs += [(500, "the " * 4000, 1, 2, "t"), (501, " ".join(words(items[0][1])[:6]), 1, 2, "t"), (502, " ".join(words(items[0][1])[6:]), 1, 2, "t")]
    return docs, items


def test_decontamination(spark, leaks):
    got = check_hits(spark, *leaks)
    assert sum(bool(r.spans) for r in got) > 10


def test_decontamination_blocks_and_chunks(spark, leaks, monkeypatch):
    monkeypatch.setattr(dc, "BLOCK_BYTES", 700)
    monkeypatch.setattr(dc, "CHUNK_BYTES", 300)
    check_hits(spark, *leaks)


def test_slices():
    size = np.random.default_rng(2).integers(0, 9, 200)
    got = list(dc.slices(size, 20))
    assert np.concatenate([np.arange(200)[s] for s in got]).tolist() == list(range(200)) and len(got) > 30
    assert all(size[s].sum() <= 20 or s.stop - s.start == 1 for s in got)


def test_decontamination_empty(spark, leaks):
    docs, items = leaks
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([x[:2] for x in docs], "doc_id long, text string")
    tests = spark.createDataFrame([x[:2] for x in items], "item_id long, text string")
    assert dc.matches(none, tests).count() == 0
    assert dc.matches(some, none.withColumnRenamed("doc_id", "item_id")).where("size(spans) > 0 or n_near > 0").count() == 0
    blank = spark.createDataFrame([(1, None), (2, " .. ")], "item_id long, text string")
    assert dc.matches(some, blank).where("size(spans) > 0").count() == 0
    kept = dc.clean(some, tests)
    assert kept.columns == some.columns
    brute = brute_hits([x[1] for x in docs], [x[:2] for x in items])
    bad = {x[0] for x, y in zip(docs, brute) if y[1] and x[0] is not None}
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(x[0]) for x in docs if x[0] not in bad)


def test_pack_round_trip():
    rng = np.random.default_rng(1)
    lists = [np.sort(rng.integers(0, 2 ** int(rng.integers(1, 34)), int(n))) for n in rng.integers(1, 40, 50)]
    flat = np.concatenate(lists)
    cuts = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
    gaps = np.diff(flat, prepend=0)
    gaps[cuts[:-1]] = flat[cuts[:-1]]
    places, back = dc.unpack(dc.pack(gaps, cuts).to_pylist())
    assert places.tolist() == flat.tolist() and back.tolist() == cuts.tolist()


def test_words(texts):
    coded, cuts = dc.words(pa.array(texts).slice(2))
    flat = coded.to_pylist()
    assert [flat[a:z] for a, z in zip(cuts[:-1], cuts[1:])] == [words(t) for t in texts[2:]]


# -- spelling -------------------------------------------------------------------------------------------------

def brute_counts(rows, every=199):
    n = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % every == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            if run:
                n[run] += 1
    return n


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_variants(n, least=6, count=5, ratio=5):
    ws = {w: c for w, c in n.items() if len(w) >= least and c >= count}
    near = {w: [v for v in ws if one_edit(w, v)] for w in ws}
    form = {}
    for w, c in ws.items():
        best = min(near[w], key=lambda v: (-ws[v], v), default=None)
        form[w] = best if best is not None and ws[best] >= ratio * c else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w
    return {(w, form[w], root(w), ws[w], len(near[w]), ws.get(form[w])) for w in ws}


@pytest.mark.parametrize("every", [199, 3])
def test_counts(spark, docs, real_docs, every):
    for df in (docs, real_docs):
        want = brute_counts([(r.doc_id, r.text) for r in df.collect()], every)
        assert {r.word: r.n for r in spelling.misspelt_counts(df, every=every).collect()} == want


def spell_words():
    rng = random.Random(2)
    n = Counter()
    for w in ["abcdefgh", "aaaaaa", "aaaaaaa", "établir", "ÿÿÿÿÿÿ", "mississippi", "bananaa"]:
        n[w] = 400
        for _ in range(60):
            v = list(w)
            for _ in range(rng.randint(1, 2)):
                k = rng.randrange(len(v))
                v[k:k + rng.randint(0, 1)] = rng.choice(["", "a", "b", "é", "z", "aa"])
            n["".join(v)] += rng.choice([1, 5, 5, 16, 80, 90])
    # a third of the words share a half
    for x in range(150):
        n["common" + chr(97 + x % 26) + chr(97 + x // 26) + "y" * (x % 3)] = 5 + x % 40 * (x % 3) * 9
    for w in ["tied" + c + "xx" for c in "abcé"]:
        n[w] = 50
    n["tiedxxx"] = 10
    n["short"] = 99
    return n


@pytest.mark.parametrize("hot", [4096, 30, 0])
def test_variants(spark, hot, monkeypatch):
    n = spell_words()
    monkeypatch.setattr(spelling.near_pairs, "__defaults__", ("word", hot))
    df = spark.createDataFrame([(w, c, "x", 3) for w, c in n.items()], "word string, n long, form string, size int")
    got = {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.variants(df).collect()}
    assert got == brute_variants(n)
    assert len({r[2] for r in got}) < len(got) and max(r[4] for r in got) > 5


def test_variants_chain(spark):
    n = {"a" * 6 + "b" * k: 5 * 5 ** k for k in range(9)}
    got = {(r.word, r.form, r.root, r.n, r.n_near, r.form_n)
           for r in spelling.variants(spark.createDataFrame(list(n.items()), "word string, n long")).collect()}
    assert got == brute_variants(Counter(n)) and {r[2] for r in got} == {"a" * 6 + "b" * 8}


def test_variants_empty(spark, no_docs):
    assert spelling.variants(spelling.misspelt_counts(no_docs)).count() == 0


def test_variants_real(spark, real_docs):
    counts = spelling.misspelt_counts(real_docs)
    got = {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.variants(counts).collect()}
    assert got == brute_variants(brute_counts([(r.doc_id, r.text) for r in real_docs.collect()]))


# -- whitening ------------------------------------------------------------------------------------------------

def check_whitening(spark, vectors, width, k=32, ids=None, tol=1e-8):
    ids = list(range(len(vectors))) if ids is None else ids
    df = spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 1, 2.0)
                                for i, v in zip(ids, vectors)], "vec_id long, embedding array<double>, n long, x double")
    got = whitening.whiten(df, k).collect()
    good = [(i, list(v) + [0.0] * (width - len(v))) for i, v in zip(ids, vectors)
            if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    x = np.floor(64 * np.array([v for _, v in good], dtype=float)).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(0)
    c = (n * x - s) / n
    e, q = np.linalg.eigh(c.T @ c / n)
    e, q = e[::-1], q[:, ::-1]
    rank = int((e > e[0] * 1e-12).sum())
    m = min(k, rank)
    assert len(got) == n * m
    dev = Counter((i, sum(int(v) ** 2 for v in r)) for (i, _), r in zip(good, (n * x - s).tolist()))
    assert Counter((r.vec_id, r.deviation) for r in got if r.component == 1) == dev
    assert {r.n for r in got} == {n} and {r.identity_error < 1e-8 for r in got} == {True}
    for r in got:
        assert abs(r.explained / (e[r.component - 1] / e.sum()) - 1) < 1e-8
    # signs apart, by component (rows in the order of their values: ids may repeat)
    for j in range(1, m + 1):
        z = sorted((str(i), v) for (i, _), v in zip(good, c @ q[:, j - 1] / np.sqrt(e[j - 1])))
        y = sorted((str(i), v) for (i, _), v in zip(good, -c @ q[:, j - 1] / np.sqrt(e[j - 1])))
        w = sorted((str(r.vec_id), r.whitened) for r in got if r.component == j)
        far = min(max(abs(a[1] - b[1]) for a, b in zip(w, v)) for v in (z, y))
        assert far < tol
    return got


def test_whitening(spark):
    rng = np.random.default_rng(4)
    base = rng.standard_normal((300, 48)) * np.linspace(3, 0.1, 48)
    check_whitening(spark, base.tolist(), 48)


def test_whitening_odd_rows(spark):
    rng = np.random.default_rng(6)
    v = rng.standard_normal((60, 5)).tolist()
    v += [None, [1.0, None, 2.0, 0.0, 0.0], [1.0, float("nan"), 0, 0, 0], [float("inf")] * 5, [], [1.0, 2.0], v[3], v[3]]
    check_whitening(spark, v, 5, ids=[i if i % 11 else None for i in range(len(v))])


def test_whitening_low_rank(spark):
    rng = np.random.default_rng(7)
    low = rng.integers(-3, 4, (40, 3)) @ rng.integers(-2, 3, (3, 30))
    check_whitening(spark, low.tolist(), 30)
    check_whitening(spark, rng.standard_normal((5, 20)).tolist(), 20)      # fewer vectors than dimensions


def test_whitening_nothing(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert whitening.whiten(none).count() == 0
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(4)], "vec_id long, embedding array<float>")
    assert whitening.whiten(same).count() == 0
    assert whitening.whiten(same.limit(1)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>")).count() == 0


def test_whitening_large_numbers(spark):
    v = [[1e15, 1.0], [-1e15, 2.0], [3e15, -4.0], [0.0, 1e3]]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    got = [r for r in whitening.whiten(df).collect() if r.component == 1]
    assert len(got) == 4 and all(r.deviation is None for r in got)


@pytest.mark.parametrize("tasks,most", [(40, 100), (3, 1 << 20)])
def test_partials_are_added_in_tasks(spark, tasks, most, monkeypatch):
    monkeypatch.setattr(whitening, "SENT_BYTES", most)
    rows = spark.range(200).repartition(tasks).selectExpr("cast(null as binary) as x").selectExpr("unhex('0100000000000000') as x")
    got = whitening.total(rows, 1, tasks, lambda x: x.sum(0).astype(float), 1)
    assert got.tolist() == [200.0]


def test_equal_singular_values():
    # every singular value twice: one Krylov space holds each once, restarts find the other
    d = np.repeat([5.0, 4.0, 3.0, 2.0, 1.0, 0.5], 2)
    x = np.linalg.qr(np.random.default_rng(1).standard_normal((50, 12)))[0] * d

    def product(w, left):
        p = x @ w
        return (x @ left).T @ p, x.T @ p, float(p @ p)
    s, v, steps = whitening.bidiagonalise(product, 12, 6, float((x * x).sum()))
    assert np.allclose(s, d[:6]) and np.allclose((x @ v).T @ (x @ v), np.diag(d[:6] ** 2), atol=1e-9)
    assert steps <= 12


def test_full_space_is_not_needed():
    x = np.random.default_rng(1).standard_normal((400, 100)) * 0.5 ** np.arange(100)

    def product(w, left):
        p = x @ w
        return (x @ left).T @ p, x.T @ p, float(p @ p)
    s, _, steps = whitening.bidiagonalise(product, 100, 4, float((x * x).sum()))
    assert np.allclose(s, np.linalg.svd(x)[1][:4], rtol=1e-12) and steps < 60
