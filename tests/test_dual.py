"""Dual coordinate ascent against dense solves, and its text learner."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from loam.plans import dual
from loam.plans import models as md
from loam.plans import textlinear as tl
from loam.plans.dual import INTERCEPT, Setting

N, D = 240, 6


@pytest.fixture(scope="module")
def planted():
    rng = np.random.default_rng(3)
    x = rng.standard_normal((N, D))
    x[rng.random((N, D)) < 0.3] = 0
    z = x @ np.array([1.5, -2, 0, 0, 0.7, 1.0]) + 0.4
    return x, {"log": (rng.random(N) < 1 / (1 + np.exp(-z))).astype(float), "squared": z + rng.standard_normal(N) * 0.3}


def frame(spark, x, y):
    rows = [(float(b), [True, bool(i % 2)], [list(range(D))], [[float(v) for v in a]], "c") for i, (a, b) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "y double, uses array<boolean>, idx array<array<long>>, val array<array<double>>, block string")


def dense(x, y, s, loss):
    """Accelerated proximal gradient on the whole matrix."""
    a = np.c_[x, np.ones(len(x))]
    w = z = np.zeros(a.shape[1])
    rate = 1 / (np.linalg.norm(a, 2) ** 2 / len(a) * (0.25 if loss == "log" else 1) + s.l2)
    t = 1.0
    sign = 2 * y - 1
    for _ in range(8000):
        g = -(a * (sign / (1 + np.exp(sign * (a @ z))))[:, None]).mean(0) if loss == "log" else a.T @ (a @ z - y) / len(a)
        new = dual.shrink(z - rate * (g + s.l2 * z), s.l1 * rate)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        w, z, t = new, new + (t - 1) / t_new * (new - w), t_new
    return w


def weights(fit, settings):
    w = np.zeros((settings, D + 1))
    for r in fit.weights.collect():
        w[r.setting, D if r.feature == INTERCEPT else r.feature] = r.weight
    return w


def compare(fit, settings, x, y, loss):
    w = weights(fit, len(settings))
    for i, s in enumerate(settings):
        m = np.arange(N) % 2 == 1 if s.use else np.ones(N, bool)
        assert np.abs(w[i] - dense(x[m], y[m], s, loss)).max() < 1e-4
    h = fit.history.collect()
    assert all(r.gap > -1e-9 and abs(r.primal - r.dual - r.gap) < 1e-12 for r in h)
    assert fit.reached == [True] * len(settings) and {r.setting for r in h} == set(range(len(settings)))


@pytest.mark.parametrize("loss", ["log", "squared"])
def test_one_block(spark, planted, loss):
    x, ys = planted
    settings = [Setting(0.0, 1e-2), Setting(0.08, 1e-2), Setting(0.005, 0.1, use=1)]
    fit = dual.ascend(frame(spark, x, ys[loss]), settings, loss, tol=1e-9)
    compare(fit, settings, x, ys[loss], loss)
    assert (weights(fit, 3)[1] == 0).any()


@pytest.mark.parametrize("sent_bytes", [dual.SENT_BYTES, 0])
def test_blocks_share(spark, planted, sent_bytes):
    """Several blocks; shared values sent, or joined from a table."""
    x, ys = planted
    settings = [Setting(0.0, 0.3), Setting(0.05, 0.2, use=1)]
    fit = dual.ascend(frame(spark, x, ys["log"]), settings, "log", tol=1e-8, block_values=700, sent_bytes=sent_bytes)
    compare(fit, settings, x, ys["log"], "log")
    assert fit.rounds > 2


def test_layout_and_grid_do_not_matter(spark, planted):
    x, ys = planted
    df = frame(spark, x, ys["log"])
    settings = [Setting(0.01, 1e-2), Setting(0.0, 0.3)]
    a = dual.ascend(df, settings, tol=1e-6)
    b = dual.ascend(df.repartition(7, F.rand(5)), settings, tol=1e-6)
    assert np.array_equal(weights(a, 2), weights(b, 2))
    alone = [dual.ascend(df, [s], tol=1e-6).rounds for s in settings]
    assert a.rounds == max(alone)          # passes over the rows: those of the slowest setting


def test_rows_that_cannot_be_used(spark, planted):
    x, ys = planted
    df = frame(spark, x, ys["log"])
    odd = spark.createDataFrame([(None, [True, True], [[1]], [[2.0]], ""), (1.0, [True, True], None, None, ""), (1.0, None, [[1]], [[1.0]], "")],
                                df.schema)
    a, b = (dual.ascend(d, [Setting(0.0, 0.1)], tol=1e-6) for d in (df, df.unionByName(odd)))
    assert np.array_equal(weights(a, 1), weights(b, 1))
    # a repeated feature adds up, a null val counts mentions
    d = spark.createDataFrame([(float(i % 2), [True], [[5, 5] if i % 2 else [6]], None) for i in range(40)],
                              "y double, uses array<boolean>, idx array<array<long>>, val array<array<double>>")
    e = spark.createDataFrame([(float(i % 2), [True], [[5] if i % 2 else [6]], [[2.0] if i % 2 else [1.0]]) for i in range(40)], d.schema)
    f, g = ({r.feature: r.weight for r in dual.ascend(k, [Setting(0.0, 0.1)], tol=1e-6).weights.collect()} for k in (d, e))
    assert f == g
    with pytest.raises(ValueError):
        dual.ascend(df, [Setting(0.1, 0.0)])
    with pytest.raises(ValueError):
        dual.ascend(df.where("y > 7"), [Setting(0.0, 0.1)])
    with pytest.raises(ValueError):
        dual.ascend(df.withColumn("uses", F.array(F.lit(False))), [Setting(0.0, 0.1)])


@pytest.mark.parametrize("wide", [True, False])
def test_heavy_rows_reach_the_gap(spark, wide):
    """Counts that weigh much against the penalty: Newton steps on either side of the matrix, settings in several tasks."""
    rng = np.random.default_rng(8)
    n, d = (60, 150) if wide else (300, 25)
    x = rng.poisson(rng.gamma(0.3, 60, d), (n, d)).astype(float)
    y = (rng.random(n) < 0.4).astype(float)
    rows = [(float(b), [True, bool(i % 3)], [np.flatnonzero(a).tolist()], [a[a > 0].tolist()]) for i, (a, b) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "y double, uses array<boolean>, idx array<array<long>>, val array<array<double>>")
    settings = [Setting(0.0, 1e-3), Setting(1e-3, 1e-3, use=1), Setting(1e-4, 1e-2)]
    fit = dual.ascend(df, settings, tol=1e-5, max_rounds=3)
    assert fit.reached == [True] * 3
    w = np.zeros((3, d + 1))
    for r in fit.weights.collect():
        w[r.setting, d if r.feature == INTERCEPT else r.feature] = r.weight
    last = {r.setting: r for r in fit.history.orderBy("round").collect()}
    for i, s in enumerate(settings):
        m = np.arange(n) % 3 > 0 if s.use else np.ones(n, bool)
        z = np.c_[x, np.ones(n)][m] @ w[i] * (2 * y[m] - 1)
        primal = np.logaddexp(0, -z).mean() + s.l2 / 2 * w[i] @ w[i] + s.l1 * np.abs(w[i]).sum()
        assert abs(primal - last[i].primal) < 1e-9 and -1e-9 < last[i].gap <= 1e-5 * primal


def test_heavy_rows_of_several_blocks(spark, monkeypatch):
    """The rows of all blocks step together by Newton's method on a matrix summed in runs."""
    monkeypatch.setattr(dual, "TOGETHER_ROWS", 8)
    rng = np.random.default_rng(12)
    n, d = 150, 40
    x = rng.poisson(rng.gamma(0.3, 60, d), (n, d)).astype(float)
    y = (rng.random(n) < 0.4).astype(float)
    rows = [(float(b), [True, bool(i % 3)], [np.flatnonzero(a).tolist()], [a[a > 0].tolist()]) for i, (a, b) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "y double, uses array<boolean>, idx array<array<long>>, val array<array<double>>")
    settings = [Setting(0.0, 1e-3), Setting(1e-3, 1e-3, use=1)]
    fit = dual.ascend(df, settings, tol=1e-4, max_rounds=3, block_values=1500)
    assert fit.reached == [True] * 2
    w = np.zeros((2, d + 1))
    for r in fit.weights.collect():
        w[r.setting, d if r.feature == INTERCEPT else r.feature] = r.weight
    last = {r.setting: r for r in fit.history.orderBy("round").collect()}
    for i, s in enumerate(settings):
        m = np.arange(n) % 3 > 0 if s.use else np.ones(n, bool)
        z = np.c_[x, np.ones(n)][m] @ w[i] * (2 * y[m] - 1)
        primal = np.logaddexp(0, -z).mean() + s.l2 / 2 * w[i] @ w[i] + s.l1 * np.abs(w[i]).sum()
        assert abs(primal - last[i].primal) < 1e-9 and -1e-9 < last[i].gap <= 1e-4 * primal


def test_good_duals_stay():
    """A block that is asked again after its gap is closed changes nothing."""
    rng = np.random.default_rng(4)
    n, d = 80, 30
    x = rng.poisson(20, (n, d)).astype(float)
    block = dual.Block({"block": 0, "n": n, "y": np.where(rng.random(n) < 0.5, 1.0, -1.0).tobytes(), "uses": np.ones(n, np.uint8).tobytes(),
                        "feats": list(range(d)), "ptr": [(np.arange(n + 1) * d).tobytes()],
                        "loc": [np.tile(np.arange(d, dtype=np.int32), n).tobytes()], "val": [x.tobytes()]})
    a, s = np.zeros(n), Setting(1e-3, 1e-3)
    v = block.ascend(a, np.zeros(d), s, n, 1, 8, rng, dual.LOSSES["log"], 1e-4)
    was = a.copy()
    assert v.any() and not block.ascend(a, v, s, n, 1, 8, rng, dual.LOSSES["log"], 1e-4).any() and np.array_equal(a, was)


def test_stage_is_a_spark_model(spark, planted, tmp_path):
    x, ys = planted
    cols = [f"x{k}" for k in range(D)]
    df = spark.createDataFrame([(*map(float, a), float(b)) for a, b in zip(x, ys["log"])], ", ".join(f"{c} double" for c in [*cols, "label"]))
    model = md.fit(df, None, "fastlinear_class", {"l1_weight": 0.01, "l2_weight": 0.05, "tol": 1e-8},
                   pre_stages=[VectorAssembler(inputCols=cols, outputCol="features")])
    want = dense(x, ys["log"], Setting(0.01, 0.05), "log")
    got = [*model.stages[-1].coefficients, model.stages[-1].intercept]
    assert np.abs(np.array(got) - want).max() < 1e-4
    model.write().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m")).transform(df).select("probability", "prediction").collect()
    p = 1 / (1 + np.exp(-(x @ want[:-1] + want[-1])))
    assert np.abs(np.array([r.probability[1] for r in again]) - p).max() < 1e-4
    assert md.coefficient_table(spark, model, terms=cols).count() == D + 1
    reg = Pipeline(stages=[VectorAssembler(inputCols=cols, outputCol="features"), dual.FastLinear(kind="regression", l2=0.1, tol=1e-9)])
    assert reg.fit(df).stages[-1].reached == [True]


def test_text_learner(spark):
    texts = ["zzq zzq qqz", "abc abd abe", None, "", "a", "Zzq! 12"]
    rows = [(i, texts[i % 6], float(i % 6 in (0, 5)), i % 7 != 0) for i in range(90)]
    rows += [(900, "only heldout words", 1.0, False)]
    df = spark.createDataFrame(rows, "id int, text string, label double, use boolean")
    settings = [Setting(0.0, 1e-2, 0, 0), Setting(1e-3, 1e-2, 0, 1)]
    fit = tl.fit_text(df, "text", "label", settings, [F.col("use")], (2, 3), tol=1e-4)
    sent = {r.id: r.margins for r in tl.score_text(df, "text", fit, settings, ["id"], (2, 3)).collect()}
    joined = {r.id: r.margins for r in tl.score_text(df, "text", fit, settings, ["id"], (2, 3), key=["id"], sent_bytes=0).collect()}
    assert sent.keys() == joined.keys() and len(sent) == 91
    for k, v in sent.items():
        assert (v is None) == (joined[k] is None) == (rows[min(k, 90)][1] is None if k < 900 else False)
        assert v is None or np.allclose(v, joined[k])
    base = {r.setting: r.weight for r in fit.weights.where(F.col("feature") == INTERCEPT).collect()}
    assert np.allclose(sent[3], [base.get(0, 0.0), base.get(1, 0.0)])       # an empty text has the intercept alone
    assert all(sent[i][0] > sent[j][0] for i in (0, 5) for j in (1, 7))
    terms = tl.dictionary(df, "text", (2, 3))
    assert tl.colliding_terms(terms) == 0
    named = terms.join(fit.weights, "feature")
    assert named.where("term like '%hel%' or term = 'eld'").count() == 0 and named.where("term = 'zzq'").count() == 1


def test_sweep_saves_and_resumes(spark, tmp_path):
    df = spark.createDataFrame([(i, ("good fine " if i % 2 else "bad poor ") * (1 + i % 3), float(i % 2)) for i in range(120)],
                               "id int, text string, label double")
    grid = [{"training_fraction": f, "kfold": 1, "feat_ngram": n, "l1_weight": 0.0, "l2_weight": l2}
            for f in (0.4, 1.0) for n in (1, 2) for l2 in (1e-2, 1.0)]
    path = str(tmp_path / "res")
    half = tl.run_linear_grid(spark, df, "id", "text", grid[:3], results_path=path)
    assert half.count() == 3
    full = tl.run_linear_grid(spark, df, "id", "text", grid, results_path=path).collect()
    assert len(full) == 8 and len({r.run_id for r in full}) == 8
    assert len({r.train_time for r in full}) == 2                            # the first three were not run again
    again = tl.run_linear_grid(spark, df, "id", "text", grid, results_path=path).collect()
    assert sorted(again) == sorted(full)
    assert all(0.9 < r.test <= 1 and 0.9 < r.training <= 1 for r in full)
    direct = tl.run_linear_grid(spark, df, "id", "text", grid)
    assert {r.run_id: (r.tss, round(r.test, 6)) for r in direct.collect()} == {r.run_id: (r.tss, round(r.test, 6)) for r in full}
