"""Boosted parts grown together against one part at a time, by brute force."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler

from loam.plans import trees as tr


def brute(x, y, edges, trees, depth, rate, min_rows):
    """Predictions of one part's model on ``x``, and its training fit ``f``."""
    f = np.full(len(y), y.mean())

    def grow(rows, level):
        r = (y - f)[rows]
        best = None
        if level < depth:
            for k, e in enumerate(edges):
                for c in e:
                    left = x[rows, k] <= c
                    n = left.sum()
                    if n < min_rows or len(rows) - n < min_rows:
                        continue
                    gain = r[left].sum() ** 2 / n + r[~left].sum() ** 2 / (len(rows) - n) - r.sum() ** 2 / len(rows)
                    if best is None or gain > best[0] + 1e-10 * abs(best[0]):
                        best = (gain, k, c)
        if best is None or not best[0] > 1e-12 * max(1.0, r.sum() ** 2 / len(rows)):
            step[rows] = rate * r.mean()
            return
        left = x[rows, best[1]] <= best[2]
        grow(rows[left], level + 1)
        grow(rows[~left], level + 1)
    for _ in range(trees):
        step = np.zeros(len(y))
        grow(np.arange(len(y)), 0)
        f = f + step
    return f


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(2)
    x = np.c_[rng.standard_normal(200), rng.integers(0, 4, 200), rng.random(200), np.zeros(200)]
    y = np.where(x[:, 0] > 0, 2.0, -1.0) * (1 + x[:, 1]) + rng.standard_normal(200) * 0.1
    part = rng.integers(0, 3, 200) * 5 + 1
    part[:90] = 1
    return x, y, part


def frame(spark, x, y, part):
    df = spark.createDataFrame([(i, int(p), float(b), *map(float, a)) for i, (a, b, p) in enumerate(zip(x, y, part))],
                               "id int, part int, label double, " + ", ".join(f"x{k} double" for k in range(x.shape[1])))
    return VectorAssembler(inputCols=[f"x{k}" for k in range(x.shape[1])], outputCol="features", handleInvalid="keep").transform(df)


@pytest.mark.parametrize("min_rows,depth", [(1, 3), (8, 2)])
def test_equal_to_each_part_alone(spark, data, min_rows, depth):
    x, y, part = data
    df = frame(spark, x, y, part).repartition(5)
    model = tr.fit_parts(df, "part", trees=4, depth=depth, rate=0.5, min_rows=min_rows, bins=8)
    edges = tr.bin_edges(df.select(tr.vector_to_array("features").alias("x")), 4, bins=8)
    assert model.parts == [1, 6, 11] and len(edges[3]) == 0 and edges[1].tolist() == [0, 1, 2]
    got = model.scores(x)
    for i, p in enumerate(model.parts):
        m = part == p
        assert np.allclose(got[m, i], brute(x[m], y[m], edges, 4, depth, 0.5, min_rows))
    mean = {r.id: r.prediction for r in tr.predict(model, df, ["id"]).collect()}
    assert np.allclose([mean[i] for i in range(200)], got.mean(axis=1))
    t = model.table(spark)
    assert t.where("part = 6 and tree = 0 and node = 0").first().feature >= 0 and t.where("feature >= 0 and edge is null").count() == 0


def test_jobs_do_not_grow_with_parts(spark, data, monkeypatch):
    x, y, part = data
    calls = []
    real = tr._histograms
    monkeypatch.setattr(tr, "_histograms", lambda *a, **k: calls.append(1) or real(*a, **k))
    counts = []
    for parts in (np.ones(200, int), np.arange(200) % 20):
        calls.clear()
        tr.fit_parts(frame(spark, x, y, parts), "part", trees=2, depth=2)
        counts.append(len(calls))
    assert counts == [4, 4]


def test_odd_rows(spark, data):
    x, y, part = data
    x = x.copy()
    x[::7, 0] = np.nan
    df = frame(spark, x, y, part)
    odd = df.selectExpr("id", "cast(null as int) as part", "label", "x0", "x1", "x2", "x3", "features").limit(5)
    a = tr.fit_parts(df, "part", trees=2, depth=2)
    b = tr.fit_parts(df.unionByName(odd), "part", trees=2, depth=2)
    assert np.isfinite(a.scores(x)).all() and np.array_equal(a.feature, b.feature)
    same = tr.fit_parts(df.selectExpr("id", "part", "1.5 as label", "features"), "part", trees=2, depth=2)
    assert (same.feature == -1).all() and np.allclose(same.scores(x), 1.5)
    with pytest.raises(ValueError):
        tr.fit_parts(df.where("id < 0"), "part")
    nulls = tr.predict(a, df.selectExpr("id", "if(id % 2 = 0, features, null) as features"), ["id"]).collect()
    assert all((r.prediction is None) == (r.id % 2 == 1) for r in nulls) and len(nulls) == 200
