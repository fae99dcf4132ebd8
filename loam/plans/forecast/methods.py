"""Per-series forecasters (T03, T04, T05) without a per-series Python solver.

A series is one row: its history as an array ordered by month.  The array
length is bounded by the calendar (one value per month), not by the data
volume, so ``collect_list`` per series is safe; the number of series is
spread over all tasks.

* naive: last value (fully SQL-checkable baseline);
* ``ets``: additive exponential smoothing with fitted weights (``smooth.py``);
* ``arima``: ARMA orders on 0, 1 or 2 differences (``arma.py``);
* ``ar_fixed``: AR(1)/AR(2) by conditional least squares from moment sums.

All return ``(keys..., step, fcast)`` plus the in-sample one-step residual
variance ``resid_var`` (used by WLS reconciliation).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loam.plans.forecast.arma import arima
from loam.plans.forecast.smooth import ets


def series_arrays(long: DataFrame, keys: Sequence[str], date_col: str, value_col: str) -> DataFrame:
    """One row per series: ``y`` = values ordered by date, ``last_date``."""
    keys = list(keys)
    g = long.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(F.col(date_col).alias("d"),
                                                                     F.col(value_col).cast("double").alias("v"))))
                                .alias("_s"), F.max(date_col).alias("last_date"))
    return g.select(*keys, "last_date", F.transform("_s", lambda s: s["v"]).alias("y"))


def _steps(h: int) -> Column:
    return F.explode(F.sequence(F.lit(1), F.lit(h))).alias("step")


def naive(arrays: DataFrame, keys: Sequence[str], h: int) -> DataFrame:
    """Last observed value for every step; residual variance of the
    one-step naive errors."""
    y = F.col("y")
    d = F.zip_with(F.slice(y, 2, F.greatest(F.size(y) - 1, F.lit(0))),
                   F.slice(y, 1, F.greatest(F.size(y) - 1, F.lit(0))), lambda a, b: a - b)
    var = F.aggregate(d, F.lit(0.0), lambda acc, e: acc + e * e) / F.greatest(F.size(d), F.lit(1))
    return arrays.select(*keys, "last_date", _steps(h), F.element_at(y, -1).alias("fcast"),
                         var.alias("resid_var"))


def ses_fixed(arrays: DataFrame, keys: Sequence[str], h: int, alpha: float) -> DataFrame:
    """T03 with a fixed smoothing weight (level only): l1 = y1,
    l_t = alpha y_t + (1 - alpha) l_{t-1}; forecast = last level."""
    y = F.col("y")
    lvl = F.aggregate(F.slice(y, 2, F.greatest(F.size(y) - 1, F.lit(0))), F.element_at(y, 1),
                      lambda l, x: F.lit(alpha) * x + F.lit(1 - alpha) * l)
    return arrays.select(*keys, "last_date", _steps(h), lvl.alias("fcast"))


def _tail(y: Column, start, drop) -> Column:
    """``y`` from position ``start`` (1-based), ``size - drop`` values, or none."""
    return F.slice(y, start, F.greatest(F.size(y) - drop, F.lit(0)))


def _season_step(alpha, beta, gamma, m: int):
    """One month of additive smoothing; ``s`` holds the last ``m`` seasonal
    states, the oldest (this month's) first."""
    def step(acc, x):
        base = acc["l"] + acc["b"]
        s0 = F.element_at(acc["s"], 1)
        lvl = alpha * (x - s0) + (1 - alpha) * base
        err = x - base - s0
        return F.struct(lvl.alias("l"), (beta * (lvl - acc["l"]) + (1 - beta) * acc["b"]).alias("b"),
                        F.concat(F.slice(acc["s"], 2, m - 1), F.array(gamma * (x - lvl) + (1 - gamma) * s0)).alias("s"),
                        (acc["sse"] + err * err).alias("sse"))
    return step


def _mean(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda acc, v: acc + v) / F.size(a)


def _season_start(y: Column, m: int, trend: Column) -> Column:
    """Start of the seasonal fold: the first period's mean, its deviations, and
    the mean monthly change to the second period where there is a trend."""
    first = F.slice(y, 1, m)
    l0 = _mean(first)
    slope = F.when(trend, (_mean(F.slice(y, m + 1, m)) - l0) / m).otherwise(F.lit(0.0))
    return F.struct(l0.alias("l"), slope.alias("b"), F.transform(first, lambda v: v - l0).alias("s"), F.lit(0.0).alias("sse"))


def seasonal_fixed(arrays: DataFrame, keys: Sequence[str], h: int, alpha: float, gamma: float,
                   frequency: int = 12) -> DataFrame:
    """T03 with fixed weights, level and additive season: the first period sets
    level (its mean) and season; later months smooth both.  Series shorter than
    one period have no forecast (null)."""
    m = frequency
    y = F.col("y")
    state = F.aggregate(_tail(y, m + 1, m), _season_start(y, m, F.lit(False)),
                        _season_step(F.lit(alpha), F.lit(0.0), F.lit(gamma), m))
    fitted = arrays.select(*keys, "last_date", F.when(F.size(y) >= m, state).alias("_f"))
    return fitted.select(*keys, "last_date", _steps(h), "_f").select(
        *keys, "last_date", "step",
        (F.col("_f.l") + F.get(F.col("_f.s"), (F.col("step") - 1) % m)).alias("fcast"))


def _ar_moments(z: Column, p: int) -> Column:
    """Sums over the lagged pairs/triples of array ``z`` for an AR(p) fit with
    intercept (one fold over the array)."""
    m = F.size(z) - p
    cnt = F.greatest(m, F.lit(0))
    cols = [F.slice(z, p + 1, cnt), F.slice(z, p, cnt)] + ([F.slice(z, 1, cnt)] if p == 2 else [])
    zero = F.lit(0.0)
    names = ["sy", "s1", "s2", "s11", "s12", "s22", "s1y", "s2y", "syy"]

    def add(acc, r):
        y, x1 = r["0"], r["1"]
        x2 = r["2"] if p == 2 else zero
        inc = {"sy": y, "s1": x1, "s2": x2, "s11": x1 * x1, "s12": x1 * x2, "s22": x2 * x2,
               "s1y": x1 * y, "s2y": x2 * y, "syy": y * y}
        return F.struct(*[(acc[k] + inc[k]).alias(k) for k in names])
    mom = F.aggregate(F.arrays_zip(*cols), F.struct(*[zero.alias(k) for k in names]), add)
    return F.struct(mom.alias("s"), m.alias("m"))


def _ar_solve(mom: str, p: int) -> Column:
    """CLS coefficients from the materialised moments column ``mom``:
    struct(c, a1, a2, sse, m, ok)."""
    g = lambda k: F.col(f"{mom}.s.{k}")
    m = F.col(f"{mom}.m")
    mm = m.cast("double")
    c11 = g("s11") - g("s1") * g("s1") / mm
    c1y = g("s1y") - g("s1") * g("sy") / mm
    cyy = g("syy") - g("sy") * g("sy") / mm
    if p == 1:
        ok = (m >= 3) & (F.abs(c11) > 1e-12)
        a1 = F.when(ok, c1y / c11).otherwise(F.lit(0.0))
        a2 = F.lit(0.0)
        sse = cyy - a1 * c1y
    else:
        c22 = g("s22") - g("s2") * g("s2") / mm
        c12 = g("s12") - g("s1") * g("s2") / mm
        c2y = g("s2y") - g("s2") * g("sy") / mm
        det = c11 * c22 - c12 * c12
        ok = (m >= 4) & (F.abs(det) > 1e-12)
        a1 = F.when(ok, (c1y * c22 - c2y * c12) / det).otherwise(F.lit(0.0))
        a2 = F.when(ok, (c2y * c11 - c1y * c12) / det).otherwise(F.lit(0.0))
        sse = cyy - a1 * c1y - a2 * c2y
    c = (g("sy") - a1 * g("s1") - a2 * g("s2")) / mm
    return F.struct(c.alias("c"), a1.alias("a1"), a2.alias("a2"), F.greatest(sse, F.lit(0.0)).alias("sse"),
                    m.alias("m"), ok.alias("ok"))


def _diff(y: Column) -> Column:
    n = F.greatest(F.size(y) - 1, F.lit(0))
    return F.zip_with(F.slice(y, 2, n), F.slice(y, 1, n), lambda a, b: a - b)


def _ar_candidate(arrays: DataFrame, keys: list[str], d: int, p: int) -> DataFrame:
    """One (d, p) candidate per series: moments first (materialised), then
    the solve -- the fold over the array runs once per series."""
    y = F.col("y")
    z = y if d == 0 else _diff(y)
    return (arrays.select(*keys, "last_date", "y", _ar_moments(z, p).alias("_mom"))
                  .select(*keys, "last_date", "y", F.lit(d).alias("d"), F.lit(p).alias("p"),
                          _ar_solve("_mom", p).alias("fit")))


def _ar_forecast_cols(h: int) -> list[Column]:
    yy = F.col("y")
    last, prev = F.element_at(yy, -1), F.element_at(yy, -2)
    d1 = F.col("d") == 1
    z_last = F.when(d1, last - prev).otherwise(last)
    z_prev = F.when(d1, prev - F.element_at(yy, -3)).otherwise(prev)
    c, a1, a2 = F.col("fit.c"), F.col("fit.a1"), F.col("fit.a2")
    zs, lv, out = [z_prev, z_last], last, []
    for _ in range(h):
        znew = c + a1 * zs[-1] + a2 * zs[-2]
        lv = F.when(d1, lv + znew).otherwise(znew)
        out.append(lv)
        zs.append(znew)
    return out


def forecast(arrays: DataFrame, keys: Sequence[str], h: int, method: str, frequency: int = 12) -> DataFrame:
    """Dispatch by method name: ``naive``, ``ets``, ``arima``."""
    if method == "naive":
        return naive(arrays, keys, h)
    if method == "ets":
        # the parameter search fits every node at every origin: weights from the coarse grid
        return ets(arrays, keys, h, frequency=frequency, search=False)
    if method == "arima":
        return arima(arrays, keys, h)
    raise ValueError(f"unknown forecasting method {method!r}")


def ar_fixed(arrays: DataFrame, keys: Sequence[str], h: int, p: int = 1) -> DataFrame:
    """T04 with a fixed order on levels: AR(p) by conditional least squares,
    forecast recursively ``h`` steps (for checks against ``regr_slope``)."""
    keys = list(keys)
    fit = _ar_candidate(arrays, keys, 0, p).where(F.col("fit.ok"))
    return (fit.select(*keys, "last_date", F.posexplode(F.array(*_ar_forecast_cols(h))).alias("_i", "fcast"))
               .select(*keys, "last_date", (F.col("_i") + 1).alias("step"), "fcast"))
