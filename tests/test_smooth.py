"""Fitted weights against the grid, random points and a numpy optimiser."""

from __future__ import annotations

import numpy as np
import pytest

from loam.plans.forecast import smooth


def _arrays(spark, series):
    return spark.createDataFrame([(k, "2024-12-01", [None if v is None else float(v) for v in y]) for k, y in enumerate(series)],
                                 "k int, last_date string, y array<double>")


def _run(y, model, x, m=12, warm=0):
    """States and squared error in plain Python; ``warm`` months after the first do not count."""
    y = np.asarray(y, float)
    a, b, g, phi = x
    if model.endswith("A"):
        lev = y[:m].mean()
        tr = (y[m:2 * m].mean() - lev) / m if model.startswith("AA") else 0.0
        s, rest, warm = list(y[:m] - lev), y[m:], 0
    else:
        lev, tr, s, rest = y[0], (y[1] - y[0] if model.startswith("AA") and len(y) > 1 else 0.0), [], y[1:]
    sse = 0.0
    for t, v in enumerate(rest):
        s0 = s.pop(0) if s else 0.0
        base = lev + phi * tr
        new = a * (v - s0) + (1 - a) * base
        if t >= warm:
            sse += (v - base - s0) ** 2
        if model.endswith("A"):
            s.append(g * (v - new) + (1 - g) * s0)
        lev, tr = new, b * (new - lev) + (1 - b) * phi * tr
    return sse, lev, tr, s


def _numpy_best(y, model, rng, m, warm):
    """Random starts, then shrinking random steps around the best of them."""
    lo, hi, free = np.array(smooth.LOWER), np.array(smooth.UPPER), smooth.free_weights(model)

    def clip(z):
        x = np.array([0.0, 0.0, 0.0, 1.0])
        x[free] = np.clip(z, lo[free], hi[free])
        return x
    points = [clip(rng.uniform(lo[free], hi[free])) for _ in range(150)]
    best = min(((_run(y, model, x, m, warm)[0], tuple(x)) for x in points))
    for scale in 0.2 * 0.8 ** np.arange(30):
        for _ in range(12):
            x = clip(np.array(best[1])[free] + rng.normal(0, scale, len(free)))
            best = min(best, (_run(y, model, x, m, warm)[0], tuple(x)))
    return best[0]


def _series(rng):
    t = np.arange(60)
    season = np.tile([5, 3, 0, -2, -4, -6, -4, -1, 0, 2, 3, 4.0], 5)
    walk = np.cumsum(rng.normal(0, 1, 60))
    trend = np.cumsum(0.5 + np.cumsum(rng.normal(0, 0.1, 60)) + rng.normal(0, 0.5, 60))
    return [50 + walk + rng.normal(0, 1, 60), 20 + trend, 100 + 3 * season + walk, 30 + 0.8 * t + 2 * season + rng.normal(0, 2, 60),
            40 + 20 * (1 - 0.9 ** t) + rng.normal(0, 0.5, 60)]


@pytest.mark.parametrize("model", list(smooth.ETS_PARAMS))
def test_error_below_grid_and_near_numpy_optimiser(spark, model):
    """Never above the grid's error; within 0.1 % of the optimiser's."""
    rng = np.random.default_rng(11)
    series = _series(rng)
    seasonal = model.endswith("A")
    grid = [g for g in (smooth.ETS_SEASONAL_GRID if seasonal else smooth.ETS_GRID) if g[0] == model.replace("d", "")]
    arr = _arrays(spark, series)
    args = {"grid": [] if seasonal else grid, "seasonal_grid": grid if seasonal else [], "frequency": 12 if seasonal else 1}
    if seasonal:
        args["grid"] = [("ANN", 0.5, 0.0, 0.0)]
    got, coarse = ({(r["k"], r["model"]): r for r in _per_family(smooth, arr, s, **args)} for s in (True, False))
    for k, y in enumerate(series):
        r = got[k, model]
        x = tuple(r["x"])
        assert r["sse"] <= coarse[k, model]["sse"]
        assert np.isclose(r["sse"], _run(y, model, x)[0], rtol=1e-9)
        for i in smooth.free_weights(model):
            assert smooth.LOWER[i] <= x[i] <= smooth.UPPER[i] or r["sse"] == coarse[k, model]["sse"]
        assert r["sse"] <= 1.001 * _numpy_best(y, model, rng, 12, 0), (k, x)


def _per_family(mod, arr, search, grid, seasonal_grid, frequency):
    from pyspark.sql import functions as F
    plain, seasons = mod._families(grid, seasonal_grid)
    m = max(frequency, 2)
    fams = F.array(*[mod._struct(k, p, m) for k, p in {**plain, **seasons}.items()])
    fit = F.transform(fams, lambda f: F.struct(f["model"].alias("model"), mod._fit_family(F.col("y"), f, m, F.lit(0), search).alias("b")))
    return arr.select("k", F.explode(fit).alias("e")).select("k", "e.model", "e.b.sse", "e.b.x").collect()


def test_forecasts_follow_the_fitted_weights(spark):
    rng = np.random.default_rng(5)
    series = _series(rng)
    got = {(r["k"], r["step"]): r for r in smooth.ets(_arrays(spark, series), ["k"], 14).collect()}
    assert len(got) == 14 * len(series)
    for k, y in enumerate(series):
        r = got[k, 1]
        sse, lev, tr, s = _run(y, r["ets_model"], (r["alpha"], r["beta"], r["gamma"], r["phi"]), 12, 11)
        assert np.isclose(sse, r["sse"], rtol=1e-9) and np.isclose(r["resid_var"], sse / 48, rtol=1e-9)
        for h in range(1, 15):
            want = lev + tr * sum(r["phi"] ** i for i in range(1, h + 1)) + (s[(h - 1) % 12] if s else 0.0)
            assert np.isclose(got[k, h]["fcast"], want, rtol=1e-9)
    assert got[2, 1]["ets_model"].endswith("A") and got[3, 1]["ets_model"].startswith("AA")


def test_odd_series(spark):
    series = [[7.0] * 40, [3.0], [1.0, 2.0], [1.0, None, 5.0] * 10, [0.0] * 30, []]
    got = {(r["k"], r["step"]): r["fcast"] for r in smooth.ets(_arrays(spark, series), ["k"], 2).collect()}
    assert len(got) == 2 * len(series)
    assert got[0, 2] == 7 and got[1, 2] == 3 and got[4, 1] == 0
    assert got[2, 1] is not None and got[3, 1] is None and got[5, 1] is None
