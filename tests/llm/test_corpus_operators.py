"""Brute-force versions of the operators that compare, count or place rows."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from loam.llm import common, lm, mixing, packing, sharding, simhash, vectors, warc
from loam.llm.queries import tokenizer_path

WORD_BPE = "word_bpe_49k.json"


def roots(n, pairs):
    f = common.Forest(n)
    for a, b in pairs:
        f.join(a, b)
    return [f.root(i) for i in range(n)]


def least_ids(ids, groups):
    best = {}
    for i, g in zip(ids, groups):
        if i is not None and (best.get(g) is None or i < best[g]):
            best[g] = i
    return [best.get(g) for g in groups]


# -- components -----------------------------------------------------------------------------------------------

def test_components(spark):
    rng = np.random.default_rng(3)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 300, (170, 2))] + [(i, i + 1) for i in range(400, 460)]
    pairs += [(500, i) for i in range(501, 560)] + [(7, 7)]
    got = {r.node: r.root for r in common.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    want = roots(600, pairs)
    linked = {x for p in pairs if p[0] != p[1] for x in p}
    assert got == {x: want[x] for x in linked}
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


# -- simhash --------------------------------------------------------------------------------------------------

def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("which", ["docs", "real_docs", "sf01"])
def test_simhash(which, request, spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet") if which == "sf01" else request.getfixturevalue(which)
    src = df.select("doc_id", "text").collect()
    cache = {}
    fps = [cache.setdefault(r.text, None) or cache.__setitem__(r.text, fingerprint(r.text)) or cache[r.text] for r in src]
    pairs = [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 2]
    groups = roots(len(fps), pairs)
    want = Counter(zip([r.doc_id for r in src], [f"{x:016x}" for x in fps], least_ids([r.doc_id for r in src], groups)))
    g = simhash.simhash_groups(df).select("doc_id", simhash.hex16(F.col("fp")).alias("f"), "component_id")
    assert Counter(map(tuple, g.collect())) == want
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert kept.count() == len(set(groups))


def test_simhash_links_of_large_groups(spark, monkeypatch):
    monkeypatch.setattr(simhash, "TILE", 16)
    rng = np.random.default_rng(1)
    seeds = rng.integers(0, 1 << 63, 3)
    fps = list({int(s) ^ (1 << int(a)) ^ (1 << int(b)) for s in seeds for a, b in rng.integers(0, 63, (150, 2))})
    df = spark.createDataFrame([(x,) for x in fps], "fp long")
    edges = [(r.a, r.b) for r in simhash.links(df).collect()]
    at = {x: i for i, x in enumerate(fps)}
    assert all((a ^ b).bit_count() <= 2 for a, b in edges)
    want = roots(len(fps), [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 2])
    got = roots(len(fps), [(at[a], at[b]) for a, b in edges])
    assert len(set(zip(want, got))) == len(set(want)) == len(set(got))


def test_bit_counts():
    h = np.random.default_rng(0).integers(0, 1 << 63, 2000).astype(np.uint64) * np.uint64(2)
    starts = np.array([0, 1, 700])
    got = simhash.bit_counts(h, starts)
    for k, part in enumerate((h[:1], h[1:700], h[700:])):
        assert got[k].tolist() == [sum(int(x) >> b & 1 for x in part) for b in range(64)]


# -- mixing ---------------------------------------------------------------------------------------------------

def test_rake_holds_marginals():
    rng = np.random.default_rng(2)
    t = rng.random((5, 3, 4)) * 1000
    goals = [np.array(x) for x in ([.3, .2, .2, .2, .1], [.5, .3, .2], [.25] * 4)]
    out = mixing.rake(t, goals)
    for axis, g in enumerate(goals):
        assert np.allclose(out.sum(axis=tuple(i for i in range(3) if i != axis)) / out.sum(), g, atol=1e-6)
    p = mixing.probabilities(t, out, 0.6)
    assert p.max() <= 1 and math.isclose((p * t).sum(), 0.6 * t.sum(), rel_tol=1e-9)
    assert np.allclose(mixing.probabilities(t, out, 1.0), 1)


@pytest.mark.parametrize("which", ["docs", "real_docs"])
def test_mix(which, request):
    df = request.getfixturevalue(which)
    rows = mixing.mix(df, carry=("text", "lang", "source", "doc_id")).collect()
    assert len(rows) == df.count()
    cells = defaultdict(int)
    for r in rows:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
        assert r.tokens == n
        cells[r.source, r.lang, r.topic] += n
    names = [sorted({k[i] for k in cells}, key=str) for i in range(3)]
    table = np.zeros([len(x) for x in names])
    for k, n in cells.items():
        table[tuple(x.index(v) for x, v in zip(names, k))] = n
    goals = [table.sum(axis=tuple(i for i in range(3) if i != a)) ** 0.7 for a in range(3)]
    raked = mixing.rake(table, [g / g.sum() for g in goals])
    prob = mixing.probabilities(table, raked, 0.7)
    for r in rows:
        at = tuple(x.index(v) for x, v in zip(names, (r.source, r.lang, r.topic)))
        assert math.isclose(r.prob, prob[at] if table[at] else 0.7, rel_tol=1e-6)
        assert math.isclose(r.weight, raked[at] / table[at] if table[at] else 1.0, rel_tol=1e-6)
    kept = mixing.sample(df)
    assert kept.columns == df.columns and kept.count() == sum(r.kept for r in rows)


def test_mix_is_stable_and_near_its_share(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    a = mixing.mix(df).select("doc_id", "tokens", "kept").collect()
    b = mixing.mix(df.repartition(7)).select("doc_id", "tokens", "kept").collect()
    assert sorted(a) == sorted(b)
    assert abs(sum(r.tokens for r in a if r.kept) / sum(r.tokens for r in a) - 0.7) < 0.08


def test_mix_other_level(real_docs):
    rows = mixing.mix(real_docs, carry=("source",), levels=3).collect()
    assert len(rows) == real_docs.count()


# -- language model -------------------------------------------------------------------------------------------

@pytest.mark.parametrize("which", ["docs", "real_docs"])
def test_lm_base(which, request):
    df = request.getfixturevalue(which)
    src = df.select("doc_id", "text").collect()
    words = [(r.text or "").encode().lower().split() + [b""] for r in src]
    held = [r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 1 for r in src]
    c = Counter(w for ws, h in zip(words, held) if not h for w in ws)
    n, v = sum(c.values()), len(c)
    want = sorted((r.doc_id is None, r.doc_id or 0, h, len(ws), sum(c[w] > 0 for w in ws),
                   sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws)) for r, ws, h in zip(src, words, held))
    for hot in (lm.HOT, 50):  # with few hot words, most counts come by the join
        rows = lm.score(df, hot=hot).collect()
        got = sorted((r.doc_id is None, r.doc_id or 0, r.held_out, r.n_tokens, r.n_known, r.base_score) for r in rows)
        assert [x[:5] for x in got] == [x[:5] for x in want] and {r.train_tokens for r in rows} == {n}
        assert np.allclose([x[5] for x in got], [x[5] for x in want], rtol=1e-9)
        assert all(r.score < 0 for r in rows)


def test_lm_beats_base_on_held_out(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    r = lm.score(df).where("held_out").agg(F.sum("score"), F.sum("base_score"), F.sum("n_tokens")).first()
    assert r[0] - r[1] > 0.05 * r[2]  # at least 0.05 decimal digits a token


def by_id(df):
    return {r.doc_id: (r.score, r.base_score) for r in df.collect()}


def test_lm_does_not_depend_on_the_layout(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    one = by_id(lm.score(df.repartition(1), block_tokens=1 << 14))
    for parts in (16, 64):
        other = by_id(lm.score(df.repartition(parts, "n_chars"), block_tokens=1 << 14))
        assert other.keys() == one.keys()
        assert np.allclose([other[k] for k in one], list(one.values()), rtol=1e-5)


def test_lm_equals_one_process(spark, real_docs):
    """Blocks, order, steps and row-wise means rebuilt in plain loops; enough blocks for two steps of the tree."""
    size = 1 << 10
    text = {r.doc_id: (r.text or "").encode().lower().split() + [b""] for r in real_docs.collect()}
    train = {k for k in text if zlib.crc32(str(k).encode()) % 5 != 1}
    c = Counter(w for k in train for w in text[k])
    lex = lm.Lexicon(sorted(((w.decode(), n) for w, n in c.items()), key=lambda x: (-x[1], x[0])))
    mass = np.full(lm.LEAVES, 0.5)
    for w, n in c.items():
        mass[int(lex.leaves(lex.read([w]))[0])] += n + 0.5
    codes = {k: lex.read(w).astype(np.int32) for k, w in text.items()}
    blocks = -(-sum(c.values()) // (lm.ROUNDS * size))
    assert blocks > lm.FAN
    keys = spark.createDataFrame([(k, bytearray(codes[k].tobytes())) for k in train], "id long, codes binary").withColumn(
        "key", F.xxhash64("id", "codes"))
    dealt = keys.select("id", F.pmod(F.xxhash64("key", F.lit(3)), F.lit(lm.ROUNDS)).alias("turn"),
                        F.pmod(F.xxhash64("key", F.lit(5)), F.lit(blocks)).alias("block"),
                        F.xxhash64("key", F.lit(7)).alias("place")).collect()
    flat = lm.Model(mass).flat
    for turn in range(lm.ROUNDS):
        touch, total = 0.0, 0.0
        for block in range(blocks):
            docs = [codes[r.id] for r in sorted(dealt, key=lambda r: r.place) if (r.turn, r.block) == (turn, block)]
            if not docs:
                continue
            m = lm.Model(mass, flat)
            held = []
            for d in docs:
                held.append(d)
                if sum(map(len, held)) >= lm.BATCH:
                    lm.learn_block(m, lex, held)
                    held = []
            if held:
                lm.learn_block(m, lex, held)
            touch = touch + m.touch
            total = total + (m.flat - flat).reshape(len(m.touch), -1).astype(float) * m.touch[:, None]
        flat = (flat + (total / np.maximum(touch, 1)[:, None]).ravel()).astype(np.float32)
    m = lm.Model(mass, flat)
    got = by_id(lm.score(real_docs, block_tokens=size))
    for k, x in codes.items():
        leaves = lex.leaves(x.astype(np.int64))
        ctx = m.logp(lm.features(x.astype(np.int64), leaves, np.arange(len(x))), leaves) - np.log10(mass[leaves])
        logs = sum(math.log10(c[w] + 0.5) for w in text[k])
        assert math.isclose(got[k][0], ctx.sum() + logs, rel_tol=1e-5), k


def test_lm_splits_hot_rows(spark, real_docs):
    """One row repeated until it is most of the corpus: its copies are dealt one by one."""
    many = real_docs.unionByName(real_docs.where("doc_id = 0").crossJoin(spark.range(400)).drop("id"))
    rows = lm.score(many, block_tokens=1 << 10).collect()
    assert len(rows) == many.count() and all(np.isfinite(r.score) for r in rows)
    src = many.select(F.col("doc_id").alias("id"), F.col("text").alias("t"), F.lit(False).alias("held_out"))
    docs, blocks = lm.deal(lm.stored(lm.encode(src, lm.Lexicon([])), "codes"), 10 ** 6, 2, 1 << 10)
    largest = docs.groupBy("turn", "block").count().agg(F.max("count")).first()[0]
    assert blocks > 100 and largest < 40


def test_lm_probabilities_add_up():
    counts = {f"word{i}": 1 + 900 // (i + 1) for i in range(700)} | {"": 90}
    hot = sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:300]
    lex = lm.Lexicon(hot)
    mass = np.full(lm.LEAVES, 0.5)
    leaves = {w: int(lex.leaves(lex.read([w.encode()]))[0]) for w in counts}
    for w, c in counts.items():
        mass[leaves[w]] += c + 0.5
    m = lm.Model(mass)
    m.flat += np.random.default_rng(0).normal(0, 0.3, len(m.flat)).astype(np.float32)
    feats = np.repeat(np.arange(lm.TEMPLATES)[:, None], lm.LEAVES, axis=1)
    p = 10 ** m.logp(feats, np.arange(lm.LEAVES))
    total = sum(p[leaves[w]] * (c + 0.5) / mass[leaves[w]] for w, c in counts.items()) + sum(p * 0.5 / mass)
    assert math.isclose(total, 1, rel_tol=1e-5)


def test_lm_gradient():
    rng = np.random.default_rng(5)
    m = lm.Model(rng.random(lm.LEAVES) + 1)
    feats, leaves = rng.integers(0, lm.FEATURES, (lm.TEMPLATES, 400)), rng.integers(0, 4, 400)
    before = m.logp(feats, leaves).mean()
    for _ in range(5):
        m.learn(feats, leaves)
    assert m.logp(feats, leaves).mean() > before + 0.3


def test_lm_reads_the_third_word_back():
    # the middle words are noise; only the third word back tells which word comes
    assert lm.FEATURES >= 4096
    rng = np.random.default_rng(8)
    codes = rng.integers(0, 2, 20_000) * 2
    codes[3:][np.arange(3, len(codes)) % 4 == 3] = 0
    at = np.arange(3, len(codes), 4)
    codes[at] = codes[at - 3] + 1
    f = lm.features(codes, codes, np.arange(len(codes)))
    assert f.shape == (lm.TEMPLATES, len(codes)) and f.max() < lm.FEATURES
    m = lm.Model(np.bincount(codes, minlength=lm.LEAVES) + 1.0)
    for _ in range(20):
        m.learn(f[:, at], codes[at])
    assert m.logp(f[:, at], codes[at]).mean() > math.log10(0.9)


# -- packing --------------------------------------------------------------------------------------------------

def check_packing(rows, texts, t, capacity):
    by_doc, seqs = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.text].append(r)
        seqs[r.sequence_id].append((r.offset, r.length))
    for text, times in Counter(texts).items():
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 1]
        want = Counter({(k, at, len(ids[at:at + capacity]), zlib.crc32(np.array(ids[at:at + capacity], "<u4").tobytes())): times
                        for k, at in enumerate(range(0, len(ids), capacity))})
        assert Counter((r.piece, r.start, r.length, r.ids_crc32) for r in by_doc[text]) == want, text
    for s in seqs.values():
        at = 0
        for offset, n in sorted(s):
            assert offset == at
            at += n
        assert at <= capacity
    return len(seqs)


@pytest.mark.parametrize("which", ["docs", "real_docs"])
def test_packing(which, request):
    from tokenizers import Tokenizer
    df = request.getfixturevalue(which)
    path = tokenizer_path(WORD_BPE)
    t = Tokenizer.from_file(path)
    texts = [r.text for r in df.select("text").collect()]
    for capacity, per in ((4096, packing.ITEMS), (600, 20)):
        rows = packing.pack_documents(df, path, carry=("text",), capacity=capacity, per_partition=per).collect()
        n = check_packing(rows, texts, t, capacity)
        bound = packing.lower_bound(np.array([r.length for r in rows]), capacity)
        assert bound <= n <= bound + max(1, bound // 20)


def test_encode_matches_tokenizer(texts):
    from tokenizers import Tokenizer
    path = tokenizer_path(WORD_BPE)
    t = Tokenizer.from_file(path)
    odd = [*texts, "it's, we'll. don't.,x a., b .c, D.E. f,g. 5, 6. é, z.\xa0y, é ́a ﬁ, İx. ΑΣ, Σ. x y K, K.", "a,\nb.\n"]
    for text, ids in zip(odd, packing.encode(odd, path, 1)):
        assert np.frombuffer(ids, "<u4").tolist() == [*t.encode(text or "", add_special_tokens=False).ids, 1], text


def test_lower_bound_and_best_fit():
    assert packing.lower_bound(np.array([60, 60, 60]), 100) == 3
    assert packing.lower_bound(np.array([34] * 7), 100) == 4
    assert packing.lower_bound(np.array([], int), 100) == 0
    rng = np.random.default_rng(4)
    for _ in range(40):
        x = rng.integers(1, 100, rng.integers(1, 60))
        b, offset, fills = packing.best_fit(x, 100)
        assert packing.lower_bound(x, 100) <= len(fills) and fills.max() <= 100 and fills.sum() == x.sum()


# -- embeddings -----------------------------------------------------------------------------------------------

def brute_vectors(rows, t=0.95):
    width = max([len(v) for _, v in rows if v], default=1)
    x, ok = np.zeros((len(rows), width)), np.zeros(len(rows), bool)
    for i, (_, v) in enumerate(rows):
        if v and all(c is not None and math.isfinite(c) for c in v) and any(v):
            x[i, :len(v)], ok[i] = v, True
    n = np.linalg.norm(x, axis=1, keepdims=True)
    s = (x / np.where(n > 0, n, 1)) @ (x / np.where(n > 0, n, 1)).T
    link = (s >= t) & ok[:, None] & ok[None, :]
    np.fill_diagonal(link, False)
    g = roots(len(rows), np.argwhere(link).tolist())
    ids = [i for i, _ in rows]
    return sorted((str(i), int(k), str(c)) for i, k, c in zip(ids, link.sum(1), least_ids(ids, g)))


@pytest.mark.parametrize("tile", [vectors.TILE, 40])
def test_vectors(spark, tile):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    got = vectors.near_duplicates(df, tile=tile).collect()
    assert sorted((str(r.vec_id), r.n_links, str(r.component_id)) for r in got) == brute_vectors(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_vectors_edges(spark):
    rows = [(1, [1.0, 0.0, 0.0]), (2, [2.0, 0.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0, 0.0]), (6, [1.0, None, 0.0]),
            (7, [float("nan"), 1.0, 0.0]), (8, [float("inf"), 1.0, 0.0]), (9, [1.0]), (None, [0.0, 1.0, 0.0]),
            (10, [0.0, 1.0, 0.01]), (2, [2.0, 0.0, 0.0]), (11, [1e300, 1e300, 0.0]), (12, [1.0, 1.0]), (None, [0.0, 0.0, 1.0])]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, uid int, v string")
    got = vectors.near_duplicates(df).collect()
    with np.errstate(over="ignore", invalid="ignore"):
        want = brute_vectors([(i, [c / 1e300 for c in v] if v and v[0] == 1e300 else v) for i, v in rows])
    assert sorted((str(r.vec_id), r.n_links, str(r.component_id)) for r in got) == want
    for bad in (df.where("false"), df.where("vec_id = 3")):
        assert vectors.near_duplicates(bad).count() == bad.count()


@pytest.mark.parametrize("width", [1, 3, 7])
def test_vectors_along_one_direction(spark, width):
    one = np.random.default_rng(width).normal(size=width)
    rows = [(i, [float(x) for x in one * k * (1 + i / 7)]) for i, k in enumerate([1, -1] * 15)]
    got = vectors.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert all((r.n_links, r.component_id) == (14, r.vec_id % 2) for r in got) and len(got) == 30


# -- WARC -----------------------------------------------------------------------------------------------------

def test_warc_round_trip(spark, tmp_path):
    pages = [(1, "http://a/x y", "one"), (2, None, None), (3, "http://b", ""), (None, "http://c\r\nX: y", "one"),
             (0, "http://d", "one"), (4, "http://e", "é" * 50_000), (5, "http://f", "a\r\n\r\nb"), (None, None, "two"), (5, "http://f", "a\r\n\r\nb")]
    df = spark.createDataFrame([(*p, "z") for p in pages], "page_id long, url string, html string, sha string")
    folder = f"file://{tmp_path}/w"
    index = warc.write(df, folder)
    assert Counter((r.page_id, r.url) for r in index.collect()) == Counter(p[:2] for p in pages)
    got = Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to,
                   None if r.payload is None else bytes(r.payload)) for r in warc.read(index, folder).collect())
    first = {}
    for i, _, h in pages:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    want = Counter()
    for i, _, h in pages:
        p = (h or "").encode()
        resp = (h or "") not in first or i == first[h or ""]
        want[i, len(p), warc.digest(p), "response" if resp else "revisit", None if resp else first[h or ""], p if resp else None] += 1
    assert got == want
    few = warc.read(index.where("page_id = 4"), folder).collect()
    assert len(few) == 1 and bytes(few[0].payload) == ("é" * 50_000).encode()
    assert warc.read(warc.write(df.where("false"), folder), folder).count() == 0
    small = warc.write(df, folder, least_bytes=4)
    assert {r.record_type for r in small.where("payload_bytes < 4").collect()} == {"response"}


# -- sharding -------------------------------------------------------------------------------------------------

def test_cut_is_minimax():
    rng = np.random.default_rng(9)
    for _ in range(60):
        x = rng.integers(0, 20, rng.integers(1, 12)).tolist()
        k = int(rng.integers(1, 5))
        capacity, borders = sharding.cut(x, k)
        best = [[math.inf] * (k + 1) for _ in range(len(x) + 1)]
        best[0] = [0] * (k + 1)
        for i in range(1, len(x) + 1):
            for s in range(1, k + 1):
                best[i][s] = min(max(best[j][s - 1], sum(x[j:i])) for j in range(i))
        assert capacity == best[len(x)][k] and len(borders) == k - 1
        edges = [0, *borders, len(x)]
        assert max(sum(x[a:b]) for a, b in zip(edges, edges[1:])) <= capacity


@pytest.mark.parametrize("hot", [0, 3000, 8000, 16_383])
@pytest.mark.parametrize("times", [0.5, 0.05])
def test_cut_is_even_beside_a_hot_group(hot, times):
    sizes = np.random.default_rng(2).integers(900, 1100, sharding.BUCKETS).tolist()
    sizes[hot] += int(sum(sizes) * times)  # a third of all bytes, or a twentieth
    capacity, borders = sharding.cut(sizes, 40)
    edges = [0, *borders, len(sizes)]
    parts = [sum(sizes[a:b]) for a, b in zip(edges, edges[1:])]
    rest = sorted(parts)[:-1]
    assert capacity == sizes[hot] == max(parts) and rest[-1] < 1.05 * sum(rest) / 39 and rest[0] > 0.9 * sum(rest) / 39


def test_cut_leaves_no_shard_empty():
    rng = np.random.default_rng(6)
    for _ in range(300):
        x = (rng.integers(0, 30, rng.integers(1, 30)) * rng.choice([1, 1, 20], 1)).tolist()
        n = int(rng.integers(1, 12))
        capacity, borders = sharding.cut(x, n)
        edges = [0, *borders, len(x)]
        parts = [sum(x[a:b]) for a, b in zip(edges, edges[1:])]
        assert edges == sorted(edges) and len(parts) == n and max(parts) <= capacity
        assert sum(p > 0 for p in parts) == min(n, sum(v > 0 for v in x))


@pytest.mark.parametrize("which", ["docs", "real_docs"])
def test_shards(which, request):
    df = request.getfixturevalue(which)
    rows = sharding.place(df, n_shards=6, carry=("text", "doc_id")).collect()
    assert Counter(r.text for r in rows) == Counter(r.text for r in df.select("text").collect())
    home, slots, sizes, groups = {}, defaultdict(list), Counter(), Counter()
    for r in rows:
        raw = (r.text or "").encode()
        assert (r.size, r.text_crc32) == (len(raw) + 16, zlib.crc32(raw))
        assert home.setdefault(raw, r.shard) == r.shard and 0 <= r.shard < 6
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r.size
        groups[raw] += r.size
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(sizes.values()) <= sum(sizes.values()) / 6 + max(groups.values())


def test_shard_files(real_docs, tmp_path):
    sharding.write_shards(real_docs, f"file://{tmp_path}/s", n_shards=5)
    back = real_docs.sparkSession.read.parquet(f"file://{tmp_path}/s")
    assert back.drop("__shard").exceptAll(real_docs).count() == 0 and back.count() == real_docs.count()


# -- empty tables ---------------------------------------------------------------------------------------------

def test_empty(no_docs):
    path = tokenizer_path(WORD_BPE)
    assert simhash.simhash_groups(no_docs).count() == 0 and simhash.keep_one(no_docs).count() == 0
    assert mixing.mix(no_docs).count() == 0 and mixing.sample(no_docs).count() == 0
    assert lm.score(no_docs).count() == 0
    assert packing.pack_documents(no_docs, path).count() == 0
    assert sharding.place(no_docs).count() == 0
