"""QR-tree regression against dense numpy, and the exact area under the curve."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler

from loam.operators import metrics as mt
from loam.plans import glm


def dense(x, y):
    a = np.c_[np.ones(len(x)), x]
    b = np.zeros(a.shape[1])
    for _ in range(60):
        mu = 1 / (1 + np.exp(-(a @ b)))
        w = mu * (1 - mu)
        b = b + np.linalg.solve(a.T @ (a * w[:, None]), a.T @ (y - mu))
    mu = 1 / (1 + np.exp(-(a @ b)))
    cov = np.linalg.inv(a.T @ (a * (mu * (1 - mu))[:, None]))
    return b, np.sqrt(np.diag(cov)), -2 * np.sum(y * np.log(mu) + (1 - y) * np.log(1 - mu))


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(5)
    x = rng.standard_normal((500, 3)) * [1, 100, 0.01] + [0, 1000, 0]
    y = (rng.random(500) < 1 / (1 + np.exp(-(x[:, 0] - (x[:, 1] - 1000) / 100)))).astype(float)
    return x, y


def frame(spark, x, y):
    df = spark.createDataFrame([(float(b), *map(float, a)) for a, b in zip(x, y)], ["label", *[f"x{k}" for k in range(x.shape[1])]])
    return VectorAssembler(inputCols=df.columns[1:], outputCol="features", handleInvalid="keep").transform(df)


@pytest.mark.parametrize("tasks,sent", [(1, 1 << 26), (9, 1 << 26), (9, 1)])
def test_matches_dense(spark, data, tasks, sent, monkeypatch):
    monkeypatch.setattr(glm, "SENT_BYTES", sent)
    x, y = data
    fit = glm.fit_binomial(frame(spark, x, y).repartition(tasks), ["a", "b", "c"])
    b, se, deviance = dense(x, y)
    assert np.allclose(fit.estimate, b, rtol=1e-6) and np.allclose(fit.std_error, se, rtol=1e-6)
    assert fit.converged and abs(fit.deviance / deviance - 1) < 1e-9 and fit.rank == 4 and fit.rows == 500
    share = y.mean()
    assert abs(fit.null_deviance - -2 * 500 * (share * np.log(share) + (1 - share) * np.log(1 - share))) < 1e-6
    assert abs(fit.aic - deviance - 8) < 1e-6


def test_redundant_terms(spark, data):
    x, y = data
    wide = np.c_[x[:, 0], x[:, 0], np.ones(500), x[:, 1], 2 * x[:, 0] - x[:, 1] / 7 + 3, np.zeros(500), x[:, 2]]
    fit = glm.fit_binomial(frame(spark, wide, y), [f"t{k}" for k in range(7)])
    b, se, _ = dense(x, y)
    assert [e is None for e in fit.estimate] == [False, False, True, True, False, True, True, False]
    assert np.allclose([e for e in fit.estimate if e is not None], b, rtol=1e-6)
    assert np.allclose([e for e in fit.std_error if e is not None], se, rtol=1e-6)
    table = {r.term: r for r in fit.table(spark).collect()}
    assert table["t1"].p_value is None and 0 <= table["t0"].p_value < 1e-6


def test_rows_that_cannot_be_used(spark, data):
    x, y = data
    odd_x = np.vstack([x, [[np.nan, 1, 1], [np.inf, 1, 1]]])
    fit = glm.fit_binomial(frame(spark, odd_x, np.append(y, [1, 0])), list("abc"))
    assert fit.rows == 500
    with pytest.raises(ValueError):
        glm.fit_binomial(frame(spark, x, y).where("label > 3"), list("abc"))
    with pytest.raises(ValueError):
        glm.fit_binomial(frame(spark, x, y), ["t"] * glm.MAX_COLUMNS)


def test_formula_with_a_factor_level_that_never_occurs(spark, data):
    x, y = data
    df = spark.createDataFrame([(float(b), float(a[0]), "uv"[i % 2]) for i, (a, b) in enumerate(zip(x, y))], "y double, a double, g string")
    full = df.unionByName(spark.createDataFrame([(1.0, 0.0, "w"), (0.0, 0.0, "w")], df.schema))
    fit = glm.fit_formula(df, "y ~ a + g", full=full)
    assert sum(e is None for e in fit.estimate) == 1 and all(s > 0 for s in fit.std_error if s is not None)


def brute_auc(rows):
    pos, neg = [s for s, y in rows if y == 1], [s for s, y in rows if y == 0]
    if not pos or not neg:
        return None
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def test_exact_auc(spark):
    rng = np.random.default_rng(8)
    rows = [(["a", None, "c"][i % 3], float(rng.integers(0, 4)) if i % 3 else float(rng.normal()), int(rng.integers(0, 2))) for i in range(400)]
    rows += [("one", 0.3, 1), ("one", 0.4, 1), ("a", None, 1), ("a", float("nan"), 0), ("z", 0.0, 1), ("z", -0.0, 0)]
    rows += [("inf", float("inf"), 1), ("inf", 1.0, 0), ("inf", float("-inf"), 1)]
    df = spark.createDataFrame(rows, "m string, s double, y int").unionByName(
        spark.createDataFrame([("a", 0.5, None)], "m string, s double, y int"))
    got = {r.m: r.auc for r in mt.exact_auc(df, "s", "y", ["m"]).collect()}
    for m in {r[0] for r in rows}:
        want = brute_auc([(s, y) for k, s, y in rows if k == m and s is not None and s == s])
        assert got[m] is None if want is None else abs(got[m] - want) < 1e-12
    whole = mt.exact_auc(df, "s", "y").first().auc
    assert abs(whole - brute_auc([(s, y) for _, s, y in rows if s is not None and s == s])) < 1e-12
    assert mt.exact_auc(df.where("m = 'none'"), "s", "y", ["m"]).count() == 0
