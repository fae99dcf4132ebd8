"""Forecasting pieces: reconciliation against a dense solve, smoothing and AR
against plain numpy, legal grid, clamping."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from loam.plans.forecast import methods, reconcile
from loam.plans.forecast import search as fs
from loam.plans.forecast.panel import ForecastParams, aggregate_nodes, membership


def _panel(spark):
    rows = []
    rng = np.random.default_rng(0)
    for a in ("a1", "a2", "a3"):
        for b in ("b1", "b2"):
            for m in range(1, 13):
                rows.append((a, b, f"2020-{m:02d}-01", float(rng.integers(1, 50))))
    df = spark.createDataFrame(rows, "A string, B string, Date string, Quantity double")
    return df.withColumn("Date", F.to_date("Date"))


def test_combine_matches_dense_solve(spark):
    panel = _panel(spark)
    keys = ["A", "B"]
    memb = membership(panel, keys)
    nodes = sorted({r["node"] for r in memb.select("node").distinct().collect()})
    bottoms = sorted({r["bottom"] for r in memb.select("bottom").distinct().collect()})
    S = np.zeros((len(nodes), len(bottoms)))
    for r in memb.collect():
        S[nodes.index(r["node"]), bottoms.index(r["bottom"])] = 1.0
    rng = np.random.default_rng(1)
    yhat = rng.normal(10, 3, size=len(nodes))
    var = rng.uniform(0.5, 2.0, size=len(nodes))
    fc = spark.createDataFrame([(0, n, float(y), float(v)) for n, y, v in zip(nodes, yhat, var)],
                               "run int, node string, fcast double, resid_var double")
    big, rows = 64 << 20, reconcile.TASK_ENTRIES
    # broadcast 0: upper rows joined in parts; entries 0: conjugate gradient over the long tables
    cases = (("ols", np.ones(len(nodes)), big, rows), ("nseries", 1 / S.sum(axis=1), big, rows),
             ("wls", 1 / var, big, rows), ("wls", 1 / var, 0, rows), ("wls", 1 / var, big, 0), ("wls", 1 / var, 0, 0))
    for scheme, w, bcast, entries in cases:
        W = np.diag(w)
        expect = np.linalg.solve(S.T @ W @ S, S.T @ W @ yhat)
        wts = reconcile.node_weights(memb, fc, ["run"], scheme)
        got = {r["bottom"]: r["fcast"] for r in
               reconcile.combine(fc, memb, ["run"], wts, tol=1e-12, broadcast_bytes=bcast,
                                                               task_entries=entries).collect()}
        assert np.allclose([got[b] for b in bottoms], expect, atol=1e-8), (scheme, bcast, entries)


def test_solve_entries_sparse_equals_dense(monkeypatch):
    rng = np.random.default_rng(5)
    m = 60
    i, j = np.triu_indices(m)
    keep = (i == j) | (rng.random(len(i)) < 0.1)
    i, j = i[keep], j[keep]
    g = np.where(i == j, 20.0, rng.uniform(0, 1, len(i)))
    e = rng.normal(size=m)
    dense = reconcile._solve_entries(i, j, g, e)
    monkeypatch.setattr(reconcile, "DENSE_NODES", 0)
    assert np.allclose(reconcile._solve_entries(i, j, g, e), dense, atol=1e-9)
    assert not reconcile._solve_entries(i, j, g, np.zeros(m)).any()


def test_reconciled_parents_equal_children_sums(spark):
    panel = _panel(spark)
    keys = ["A", "B"]
    memb = membership(panel, keys)
    b = panel.where(F.col("Date") == F.to_date(F.lit("2020-12-01"))) \
             .select(F.lit(0).alias("run"), F.concat_ws("/", F.concat(F.lit("A="), "A"), F.concat(F.lit("B="), "B"))
                     .alias("bottom"), F.col("Quantity").alias("fcast"))
    nodes = {r["node"]: r["fcast"] for r in reconcile.bottom_up(b, memb, ["run"]).collect()}
    assert abs(nodes["total"] - sum(nodes[f"A={a}"] for a in ("a1", "a2", "a3"))) < 1e-9
    assert abs(nodes["total"] - sum(nodes[f"B={x}"] for x in ("b1", "b2"))) < 1e-9


def test_ses_and_ar1_match_numpy(spark):
    y = [3.0, 5.0, 4.0, 6.0, 7.0, 6.5, 8.0, 9.0]
    arr = spark.createDataFrame([(0, "2020-08-01", y)], "k int, last_date string, y array<double>")
    l = y[0]
    for x in y[1:]:
        l = 0.3 * x + 0.7 * l
    got = methods.ses_fixed(arr, ["k"], 1, 0.3).first()["fcast"]
    assert abs(got - l) < 1e-12
    X = np.column_stack([np.ones(len(y) - 1), y[:-1]])
    c, a = np.linalg.lstsq(X, np.array(y[1:]), rcond=None)[0]
    got = methods.ar_fixed(arr, ["k"], 1, 1).first()["fcast"]
    assert abs(got - (c + a * y[-1])) < 1e-9


def test_ets_and_arima_give_horizon_rows(spark):
    y = [float(10 + i + (i % 3)) for i in range(30)]
    arr = spark.createDataFrame([(0, "2022-06-01", y)], "k int, last_date string, y array<double>")
    for fn in (methods.ets, methods.arima):
        rows = fn(arr, ["k"], 3).collect()
        assert [r["step"] for r in sorted(rows, key=lambda r: r["step"])] == [1, 2, 3]
        assert all(np.isfinite(r["fcast"]) for r in rows)


def test_legal_grid_has_eight_settings(spark):
    g = fs.legal_grid(spark).collect()
    assert len(g) == 8
    assert all(r["COMBHTS_WEIGHTS"] == "ols" for r in g if r["GTSMETHOD"] == "bu")


def test_future_forecasts_nonnegative(spark):
    df = _panel(spark).withColumn("Quantity", F.col("Quantity") - 40)     # many negatives
    p = ForecastParams(keys=("A", "B"), horizon=2, gts_method="bu", ts_method="arima")
    fc = fs.future_forecast(df, p)
    assert fc.where(F.col("fcast") < 0).count() == 0
    assert fc.count() == 6 * 2


def test_aggregate_nodes_levels(spark):
    panel = _panel(spark)
    n = aggregate_nodes(panel, ["A", "B"], "Date", "Quantity")
    assert n.select("node").distinct().count() == 1 + 3 + 2 + 6


def test_seasonal_smoothing(spark):
    """A clean season is found by the search and continued; fixed weights equal plain Python."""
    rng = np.random.default_rng(3)
    season = np.array([5, 3, 0, -2, -4, -6, -4, -1, 0, 2, 3, 4.0]) * 4
    y = [float(50 + season[i % 12] + rng.normal(0, 0.5)) for i in range(60)]
    arr = spark.createDataFrame([(0, "2022-12-01", y), (1, "2022-12-01", y[:15]), (2, "2022-12-01", y[:1])],
                                "k int, last_date string, y array<double>")
    got = {(r["k"], r["step"]): r for r in methods.ets(arr, ["k"], 14).collect()}
    assert len(got) == 3 * 14
    assert got[0, 1]["ets_model"] in ("ANA", "AAA")
    for h in range(1, 15):
        assert abs(got[0, h]["fcast"] - (50 + season[(h - 1) % 12])) < 3
    assert got[1, 1]["ets_model"] in ("ANN", "AAN") and got[2, 1]["fcast"] == y[0]
    lvl = float(np.mean(y[:12]))
    s = [v - lvl for v in y[:12]]
    for x in y[12:]:
        s0 = s.pop(0)
        lvl = 0.3 * (x - s0) + 0.7 * lvl
        s.append(0.2 * (x - lvl) + 0.8 * s0)
    fixed = {(r["k"], r["step"]): r["fcast"] for r in methods.seasonal_fixed(arr, ["k"], 13, 0.3, 0.2).collect()}
    assert all(abs(fixed[0, h] - (lvl + s[(h - 1) % 12])) < 1e-9 for h in range(1, 14))
    assert fixed[2, 1] is None


def test_constant_keys_stay_in_outputs(spark):
    df = _panel(spark).withColumn("C", F.lit("only"))
    p = ForecastParams(keys=("A", "C", "B"), horizon=1, gts_method="bu")
    fc = fs.future_forecast(df, p, ts_override="naive")
    assert fc.columns == ["bottom", "A", "C", "B", "Date", "step", "fcast"]
    assert {r["C"] for r in fc.collect()} == {"only"} and fc.count() == 6
    cv = fs.crossval(df, p, nfolds=1, ts_override="naive")
    assert {r["C"] for r in cv.collect()} == {"only"}


def test_split_upper_nodes_reach_every_series(spark, monkeypatch):
    """Upper nodes in several parts, not broadcast, give the broadcast form's sums."""
    monkeypatch.setattr(reconcile._Structure, "PART", 2)
    memb = membership(_panel(spark), ["A", "B"])
    u = memb.select("node").distinct().withColumn("run", F.lit(0)).withColumn(
        "u", F.pmod(F.xxhash64("node"), F.lit(100)).cast("double"))
    sums = []
    for limit in (64 << 20, 0):
        s = reconcile._Structure(memb, 1, limit)
        assert s.bcast == (limit > 0)
        sums.append({r["bottom"]: r["u"] for r in s.St(s.flag(u), ["run"], "u").collect()})
    assert s.up_nodes.agg(F.max("_parts")).first()[0] == 3
    assert len(sums[0]) == 6 and sums[0] == sums[1]
