"""Findings of round 3: work that many passes share is done once, in tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

from conftest import SF001


def test_shared_rows_are_stored_once(spark, monkeypatch):
    """The training rows of E02 and both sets of M11 are joined once and read from files."""
    from loam import suite_models as sm
    fitted = []

    def fit(df, *a, **k):
        fitted.append(df)
        raise StopIteration
    monkeypatch.setattr(sm.md, "fit", fit)
    for query in (sm.q_e02, sm.q_m11):
        with pytest.raises(StopIteration):
            query(spark, SF001)
    for df in fitted:
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan and "parquet" in plan


def test_driver_gets_splits_not_histograms(spark, monkeypatch):
    from pyspark.ml.linalg import Vectors
    from loam.plans import trees as tr
    rng = np.random.default_rng(2)
    x = rng.random((300, 5))
    df = spark.createDataFrame([(int(i % 3), float(a[0] > 0.5), Vectors.dense(a)) for i, a in enumerate(x)], ["part", "label", "features"])
    got, real = [], tr._histograms
    monkeypatch.setattr(tr, "_histograms", lambda *a, **k: (got.append(real(*a, **k)), got[-1])[1])
    model = tr.fit_parts(df, "part", trees=2, depth=3)
    assert all(isinstance(t, pa.Table) and t.num_rows <= 3 * 2 ** 2 and t.nbytes < 2000 for t in got)
    assert (model.feature[:, 0, 0] == 0).all()


def test_rows_of_a_glm_are_decoded_once(spark, monkeypatch):
    """Every iteration reads dense blocks; numbers of a row fill one binary value of each block."""
    from pyspark.ml.linalg import Vectors
    from loam.plans import glm
    seen, real = [], glm._pass
    monkeypatch.setattr(glm, "_pass", lambda rows, *a: (seen.append(rows), real(rows, *a))[1])
    df = spark.createDataFrame([(float(i % 3 == 0), Vectors.dense([float(i % 7)])) for i in range(50)], ["label", "features"])
    fit = glm.fit_binomial(df.coalesce(1), ["x"])
    assert fit.rows == 50 and len(seen) > 2
    assert [f.dataType.typeName() for f in seen[0].schema] == ["binary", "binary"] and seen[0].count() == 1


def test_counting_tasks_grow_with_the_input(spark, tmp_path, monkeypatch):
    from loam.functions import text as tx
    path = str(tmp_path / "docs")
    spark.range(400).selectExpr("id", "repeat(cast(id * 7919 as string), 20) as text").write.parquet(path)
    df = spark.read.parquet(path)
    want = {tuple(r) for r in tx.word_counts(df, "id", "text").collect()}
    monkeypatch.setattr(tx, "COUNT_BYTES", 200)
    for counts in (tx.word_counts(df, "id", "text"), tx.ngram_term_counts(df, "id", "text")):
        assert counts.rdd.getNumPartitions() > 20
    assert {tuple(r) for r in tx.word_counts(df, "id", "text").collect()} == want


def test_light_rows_step_in_groups(spark):
    """no step of single rows where rows weigh little against the penalty; the dual
    rises with every pass and the line is the closed form."""
    from loam.plans import dual
    rng = np.random.default_rng(5)
    x = rng.integers(1, 51, 12000) / 50
    df = spark.createDataFrame([(float(3 * v + 1 + e), [True, bool(i % 3)], [[1]], [[float(v)]]) for i, (v, e) in enumerate(zip(x, rng.standard_normal(12000)))],
                               "y double, uses array<boolean>, idx array<array<long>>, val array<array<double>>")
    blocks, count, used = dual.blocks_of(df)
    block = dual.Block(blocks.toArrow().to_pylist()[0])

    def single(*_):
        raise AssertionError("a step of one row")
    for loss, use in (("squared", 0), ("squared", 1), ("log", 1)):
        values, conjugate, (_, many) = dual.LOSSES[loss]
        if loss == "log":
            block.y = np.sign(block.y - 2.5)
        a, v, last = np.zeros(12000), np.zeros(2), 0.0
        for r in range(4):
            s = dual.Setting(0.01, 0.1, use)
            v = v + block.ascend(a, v, s, used[use], count, 1, np.random.default_rng(r), (single, many))
            now = conjugate(a, block.y)[block.uses[:, use]].mean() - 0.05 * (dual.shrink(v, 0.1) ** 2).sum()
            assert now >= last - 1e-12
            last = now
        assert (a[~block.uses[:, use]] == 0).all()
    fit = dual.ascend(df, [dual.Setting(0.0, 0.1)], "squared", tol=1e-11, passes=2)
    m = np.c_[np.ones(12000), x]
    w = {r.feature: r.weight for r in fit.weights.collect()}
    y = np.array([r.y for r in df.collect()])
    assert fit.reached == [True] and fit.rounds <= 20
    assert np.allclose([w[dual.INTERCEPT], w[1]], np.linalg.solve(m.T @ m / 12000 + 0.1 * np.eye(2), m.T @ y / 12000), atol=1e-6)
    z, q = rng.standard_normal(500) * 20, rng.random(500) * 5
    y = np.sign(rng.standard_normal(500))
    a = y * rng.random(500)
    assert np.allclose(dual._log_steps(a, y, z, q), [dual._log_step(*k) for k in zip(a, y, z, q)], rtol=1e-9, atol=1e-12)


@pytest.mark.parametrize("intercept", [True, False])
def test_rows_of_a_block_are_packed_together(intercept):
    """features of all rows at once, the values those of each row alone."""
    from loam.plans import dual
    idx = [[[5, 3, 5], [7]], [None, [2, 2]], [[], []], [[9, 1], [1]], [[4, 4], [6]]]
    val = [[[1.0, 0.5, 0.1], [2.0]], None, [[], []], [[0.0, 2.0], [3.0]], [[1.0, -1.0], [0.25]]]
    kinds = (pa.list_(pa.list_(pa.int64())), pa.list_(pa.list_(pa.float64())))
    for k in range(2):
        ptr, f, x = dual._view_of(pa.array(idx, kinds[0]), pa.array(val, kinds[1]), k, intercept)
        for i, (a, b) in enumerate(zip(idx, val)):
            sums = {}
            for j, g in enumerate(a[k] or ()):
                sums[g] = sums.get(g, 0.0) + (b[k][j] if b is not None else 1.0)
            want = [(g, v) for g, v in sorted(sums.items()) if v] + [(dual.INTERCEPT, 1.0)] * intercept
            assert [*zip(f[ptr[i]:ptr[i + 1]].tolist(), x[ptr[i]:ptr[i + 1]].tolist())] == want
    with pytest.raises(ValueError):
        dual._view_of(pa.array([[[1, 2]]], kinds[0]), pa.array([[[1.0]]], kinds[1]), 0, intercept)
