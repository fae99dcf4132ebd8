"""ARIMA(p, d, q) per series, inside the row of the series.

* ``d`` is the fewest differences (0, 1, 2) after which the KPSS statistic for a
  constant level stays under its 5 % value; its long-run variance uses Bartlett
  weights over ``trunc(4 (n / 100)^(1/4))`` lags.
* Coefficients come from two regressions (Hannan-Rissanen).  The first is a
  long autoregression whose residuals stand for the shocks; the second regresses
  the value on its own lags and the lagged shocks.  The moment matrix of the
  second is summed once, with all lags; every order (p, q) is a choice of its
  columns, so all orders are compared over the same months and the search does
  not read the history again.
* The order has the least corrected AIC of those that are stationary,
  invertible and determined.  With d < 2 a constant is fitted.
* Forecasts run the filter over the whole history with the chosen coefficients.

The series is centred (d < 2) and scaled first, so the moments are of order one
whatever the unit.  Nothing here is seasonal.

Defined results: a series too short for any order, or holding a null, gets its
last value, an empty one null (``ar_p``, ``ar_d``, ``ma_q`` null); a constant
series gets its constant.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loam.functions.folds import cumulate, diff, dot, doubles, let, mean, moments, solve, stable, tail, total

# 5 % value of the KPSS statistic for a constant level (fixed value)
KPSS_5 = 0.463
MAX_P, MAX_Q = 3, 3
MAX_LONG = 12


def kpss(z: Column) -> Column:
    """KPSS statistic for a constant level; 0 for a constant series."""
    def of(e):
        n = F.size(e).cast("double")
        lags = F.floor(4 * F.pow(n / 100, F.lit(0.25))).cast("int")
        lagged = lambda j: dot(tail(e, j), F.slice(e, F.lit(1), F.greatest(F.size(e) - j, F.lit(0))))
        own = dot(e, e)
        long_run = own + 2 * total(F.transform(F.sequence(F.lit(1), F.greatest(lags, F.lit(1))),
                                               lambda j: (1 - j / (lags + 1.0)) * lagged(j)))
        return let(long_run, lambda v: F.when(v > 1e-12 * F.greatest(own, F.lit(1e-300)), let(
            cumulate(e, F.lit(0.0)), lambda s: dot(s, s)) / (n * v)).otherwise(F.lit(0.0)))
    return F.when(F.size(z) > 1, let(mean(z), lambda c: let(F.transform(z, lambda v: v - c), of))).otherwise(F.lit(0.0))


def differences(y: Column) -> Column:
    """How often to difference: 0, 1 or 2."""
    return let(diff(y), lambda d1: F.when(kpss(y) <= KPSS_5, F.lit(0)).when(kpss(d1) <= KPSS_5, F.lit(1)).otherwise(F.lit(2)))


def _shocks(z: Column, long: Column) -> Column:
    """Residuals of an autoregression of order ``long`` (its own size in every
    row), zero before they begin; null where it is not determined."""
    n = F.size(z)
    rows = F.transform(F.sequence(long + 1, F.greatest(n, long + 1)), lambda t: F.concat(
        F.array(F.lit(1.0)), F.reverse(F.slice(z, t - long, long)), F.array(F.element_at(z, t))))

    def residuals(r):
        width = long + 2
        zero = F.array_repeat(F.array_repeat(F.lit(0.0), width), width)
        gram = F.aggregate(r, zero, lambda g, x: F.zip_with(g, x, lambda line, v: F.zip_with(line, x, lambda s, w: s + v * w)))
        beta = let(gram, lambda g: solve(g, F.sequence(F.lit(0), long), long + 1))
        return let(beta, lambda b: F.concat(F.array_repeat(F.lit(0.0), long), F.transform(
            r, lambda x: F.element_at(x, -1) - dot(b, F.slice(x, F.lit(1), long + 1)))))
    return F.when(n > long, let(rows, residuals))


def _candidates(orders, d: Column, max_p: int) -> Column:
    """One struct per order: p, q and the columns of the moment matrix it uses."""
    lit = lambda xs: F.array(*[F.lit(i) for i in xs]) if xs else F.array().cast("array<int>")
    return F.array(*[F.struct(F.lit(p).alias("p"), F.lit(q).alias("q"), F.concat(
        F.when(d < 2, lit([0])).otherwise(lit([])), lit([*range(1, p + 1), *range(max_p + 1, max_p + q + 1)])).alias("cols"))
        for p, q in orders])


def _fit(z: Column, d: Column, orders, long: Column) -> Column:
    """Best order over one centred, scaled series: struct(bad, aicc, p, q, c, phi, theta)."""
    max_p, max_q = max(p for p, _ in orders), max(q for _, q in orders)
    width = max_p + max_q + 2

    def second(e):
        first = F.greatest(long + max_q, F.lit(max_p)) + 1
        back = lambda a, t, k: F.reverse(F.slice(a, t - k, F.lit(k)))
        rows = F.when(F.size(z) >= first, F.transform(F.sequence(first, F.greatest(F.size(z), first)), lambda t: F.concat(
            F.array(F.lit(1.0)), back(z, t, max_p), back(e, t, max_q), F.array(F.element_at(z, t)))))
        return let(rows, lambda r: let(moments(r, width), lambda g: let(F.size(r).cast("double"), lambda m: choose(g, m))))

    def choose(g, m):
        y = F.lit(width - 1)

        def judged(cand):
            def with_beta(b):
                cross = F.transform(cand["cols"], lambda i: F.get(F.get(g, i), y))
                sse = F.greatest(F.get(F.get(g, y), y) - dot(b, cross), F.lit(0.0))
                const = F.when(d < 2, F.lit(1)).otherwise(F.lit(0))
                phi = F.slice(b, const + 1, cand["p"])
                theta = F.slice(b, const + 1 + cand["p"], cand["q"])
                k = F.size(cand["cols"]) + 1.0
                room = m - k - 1
                aicc = F.when(room > 0, m * F.log(F.greatest(sse / m, F.lit(1e-12))) + 2 * k + 2 * k * (k + 1) / room)
                good = F.coalesce(stable(phi) & stable(F.transform(theta, lambda v: -v)) & (aicc < float("inf")), F.lit(False))
                return F.struct((~good).alias("bad"), aicc.alias("aicc"), cand["p"].alias("p"), cand["q"].alias("q"),
                                F.when(d < 2, F.get(b, F.lit(0))).otherwise(F.lit(0.0)).alias("c"), phi.alias("phi"),
                                theta.alias("theta"))
            return let(solve(g, cand["cols"], y), with_beta)
        return F.array_min(F.transform(_candidates(orders, d, max_p), judged))
    return let(_shocks(z, long), second)


def _filter(z: Column, fit: Column) -> Column:
    """One-step errors of the chosen coefficients over ``z``: the last values and
    shocks (newest first) and the sum of squares; shocks before the start are zero."""
    p, q = fit["p"], fit["q"]

    def step(s, x):
        err = x - (fit["c"] + dot(fit["phi"], s["zl"]) + dot(fit["theta"], s["el"]))
        return let(err, lambda e: F.struct(F.slice(F.concat(F.array(x), s["zl"]), F.lit(1), p).alias("zl"),
                                           F.slice(F.concat(F.array(e), s["el"]), F.lit(1), q).alias("el"),
                                           (s["sse"] + e * e).alias("sse")))
    start = F.struct(F.reverse(F.slice(z, F.lit(1), p)).alias("zl"), F.array_repeat(F.lit(0.0), q).alias("el"),
                     F.lit(0.0).alias("sse"))
    return F.aggregate(tail(z, p), start, step)


def _ahead(fit: Column, state: Column, h: int) -> Column:
    def step(s, _):
        f = fit["c"] + dot(fit["phi"], s["zl"]) + dot(fit["theta"], s["el"])
        return let(f, lambda v: F.struct(F.slice(F.concat(F.array(v), s["zl"]), F.lit(1), fit["p"]).alias("zl"),
                                         F.slice(F.concat(F.array(F.lit(0.0)), s["el"]), F.lit(1), fit["q"]).alias("el"),
                                         F.concat(s["out"], F.array(v)).alias("out")))
    return F.aggregate(F.sequence(F.lit(1), F.lit(h)),
                       F.struct(state["zl"].alias("zl"), state["el"].alias("el"), doubles().alias("out")), step)["out"]


def _fitted(arrays: DataFrame, h: int, orders, d: Column, long: int | None = None) -> DataFrame:
    """``arrays`` with a struct ``_f``: ``ok``, ``d``, ``p``, ``q``, ``c`` (intercept),
    ``phi``, ``theta``, ``resid_var`` and ``path``, the ``h`` forecasts; in the unit
    of the differenced series, the path in that of the series.  ``long`` is the
    order of the first regression, by default the square root of the length
    between max p and 12.  One projection a step: the analyzer resolves one level
    of nested lambdas a pass and allows 100."""
    max_p = max(p for p, _ in orders)
    y = F.col("y")
    last = F.try_element_at(y, F.lit(-1))

    def scaled(z, dd):
        centre = F.when(dd < 2, mean(z)).otherwise(F.lit(0.0))
        return let(centre, lambda c: let(F.transform(z, lambda v: v - c), lambda w: let(
            F.sqrt(dot(w, w) / F.greatest(F.size(w), F.lit(1))), lambda s: let(
                F.when(s > 1e-9 * F.abs(c), s).otherwise(F.lit(1.0)), lambda u: F.struct(
                    F.transform(w, lambda v: v / u).alias("w"), c.alias("c"), u.alias("u"))))))

    def order(w):
        return (F.lit(int(long)) if long is not None else
                F.greatest(F.lit(max(max_p, 1)), F.least(F.lit(MAX_LONG), F.floor(F.sqrt(F.size(w)))).cast("int")))

    def path(out, dd, c, u):
        return let(F.transform(out, lambda v: c + u * v), lambda z: F.when(dd == 0, z).when(
            dd == 1, cumulate(z, last)).otherwise(
                cumulate(cumulate(z, F.try_element_at(diff(y), F.lit(-1))), last)))

    def result(d_, z, fit, state, out):
        return F.struct(F.coalesce(~fit["bad"], F.lit(False)).alias("ok"), d_.alias("d"), fit["p"].alias("p"), fit["q"].alias("q"),
                        (z["c"] * (1 - total(fit["phi"])) + z["u"] * fit["c"]).alias("c"), fit["phi"].alias("phi"),
                        fit["theta"].alias("theta"),
                        (state["sse"] * z["u"] * z["u"] / F.greatest(F.size(z["w"]) - fit["p"], F.lit(1))).alias("resid_var"),
                        path(out, d_, z["c"], z["u"]).alias("path"))

    usable = (F.size(y) > 2) & ~F.exists(y, lambda v: v.isNull())
    steps = arrays.withColumn("_d", F.when(usable, d))
    steps = steps.withColumn("_z", F.when(usable, let(F.col("_d"), lambda dd: let(
        F.when(dd == 0, y).when(dd == 1, diff(y)).otherwise(diff(diff(y))), lambda z: scaled(z, dd)))))
    steps = steps.withColumn("_fit", let(F.col("_z.w"), lambda w: let(F.col("_d"), lambda dd: let(
        order(w), lambda lo: _fit(w, dd, orders, lo)))))
    steps = steps.withColumn("_state", let(F.col("_fit"), lambda fit: let(F.col("_z.w"), lambda w: _filter(w, fit))))
    steps = steps.withColumn("_out", let(F.col("_fit"), lambda fit: let(F.col("_state"), lambda st: _ahead(fit, st, h))))
    return steps.select(*arrays.columns, result(*[F.col(c) for c in ("_d", "_z", "_fit", "_state", "_out")]).alias("_f"))


def arma_fixed(arrays: DataFrame, keys: Sequence[str], h: int, p: int, q: int, d: int = 0, long: int | None = None) -> DataFrame:
    """T04 with a fixed order: ``(keys, last_date, step, fcast, c, phi, theta, ok)``.
    Every series keeps its ``h`` rows; where the coefficients are not determined,
    stationary and invertible ``ok`` is false, they and the forecasts null."""
    keys = list(keys)
    fit = _fitted(arrays.select(*keys, "last_date", "y"), h, [(p, q)], F.lit(d), long)
    ok = F.coalesce(F.col("_f.ok"), F.lit(False))
    path = F.when(ok, F.col("_f.path")).otherwise(F.array_repeat(F.lit(None).cast("double"), h))
    return (fit.select(*keys, "last_date", "_f", ok.alias("ok"), F.posexplode(path).alias("_i", "fcast"))
               .select(*keys, "last_date", (F.col("_i") + 1).alias("step"), "fcast",
                       *[F.when(F.col("ok"), F.col(f"_f.{k}")).alias(k) for k in ("c", "phi", "theta")], "ok"))


def arima(arrays: DataFrame, keys: Sequence[str], h: int, max_p: int = MAX_P, max_q: int = MAX_Q) -> DataFrame:
    """Differences by unit-root test, order by corrected AIC; a series where
    no order can be fitted gets the naive forecast."""
    keys = list(keys)
    orders = [(p, q) for p in range(max_p + 1) for q in range(max_q + 1)]
    fit = _fitted(arrays.select(*keys, "last_date", "y"), h, orders, differences(F.col("y")))
    ok = F.coalesce(F.col("_f.ok"), F.lit(False))
    flat = F.array_repeat(F.try_element_at("y", F.lit(-1)), h)
    out = fit.select(*keys, "last_date", "y", "_f", F.posexplode(F.when(ok, F.col("_f.path")).otherwise(flat)).alias("_i", "fcast"))
    naive_var = let(diff(F.col("y")), lambda e: dot(e, e) / F.greatest(F.size(e), F.lit(1)))
    return out.select(*keys, "last_date", (F.col("_i") + 1).alias("step"), "fcast",
                      F.when(ok, F.col("_f.resid_var")).otherwise(naive_var).alias("resid_var"),
                      F.when(ok, F.col("_f.d")).alias("ar_d"), F.when(ok, F.col("_f.p")).alias("ar_p"),
                      F.when(ok, F.col("_f.q")).alias("ma_q"))
