"""Additive exponential smoothing with fitted weights, inside the row.

A family has no trend, a trend or a damped trend, with or without a season of
``frequency`` months: ANN, AAN, AAdN, ANA, AAA, AAdA.  One month is, in error form,

    err = y - (l + phi b) - s;  l = l + phi b + alpha err
    b = phi b + alpha beta err;  s = s + gamma (1 - alpha) err

Weights of a family start at the best point of a coarse grid by the sum of squared
one-step errors.  Then every weight in turn is searched in a bracket around its
value, within its bounds, by golden sections, and after all of them the line along
which the cycle moved; brackets halve after a cycle that gains little.  A point is only taken where it is better, so the error is never above the grid's.
The family has the least AIC; all are compared over the same months: with a season
in play, errors count after the first period.  Starting states are not fitted: the
first value and change, or the first period's mean, its deviations and the mean
change to the second period.

Defined results: a family with a season needs two periods; one value is forecast by
itself; a series holding a null has null forecasts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loam.functions.folds import doubles, let, mean, tail, total

# starting points (model, alpha, beta, gamma) and the phi of their damped forms
COARSE_GRID = ([("ANN", a / 10, 0.0, 0.0) for a in range(1, 10)]
               + [("AAN", a, b, 0.0) for a in (0.1, 0.3, 0.5, 0.7, 0.9) for b in (0.05, 0.2)])
COARSE_SEASONAL_GRID = ([("ANA", a, 0.0, g) for a in (0.1, 0.3, 0.5, 0.7) for g in (0.05, 0.2, 0.5)]
                        + [("AAA", a, 0.05, g) for a in (0.1, 0.3, 0.5) for g in (0.05, 0.2)])
ETS_GRID = COARSE_GRID + [("AAN", a, b, 0.0) for a in (0.1, 0.3, 0.5, 0.7, 0.9) for b in (0.5, 0.9)]
ETS_SEASONAL_GRID = (COARSE_SEASONAL_GRID + [("ANA", 0.9, 0.0, g) for g in (0.05, 0.2, 0.5)]
                     + [("ANA", a, 0.0, 0.9) for a in (0.1, 0.3, 0.5, 0.7, 0.9)]
                     + [("AAA", a, b, g) for a in (0.1, 0.5, 0.9) for b in (0.3, 0.9) for g in (0.05, 0.5)])
DAMPED_START = 0.9
# smoothing weights and initial states; a seasonal form adds its ``frequency`` slots
ETS_PARAMS = {"ANN": 2, "AAN": 4, "AAdN": 5, "ANA": 3, "AAA": 5, "AAdA": 6}
# alpha, beta, gamma, phi
LOWER, UPPER = (1e-4, 1e-4, 1e-4, 0.8), (0.9999, 0.9999, 0.9999, 0.98)
# cycles over the weights, points a bracket, its first half width, and the relative gain of a cycle below which it halves
ROUNDS, SECTIONS, BRACKET, GAIN = 14, 6, 0.3, 1e-3
_GOLD = (5 ** 0.5 - 1) / 2


def free_weights(model: str) -> list[int]:
    """Positions of the weights a family fits."""
    return [0] + [1] * model.startswith("AA") + [2] * model.endswith("A") + [3] * ("d" in model)


def _families(grid, seasonal_grid) -> tuple[dict, dict]:
    """Starting points per family, damped forms beside their plain ones."""
    out = []
    for g in (grid, seasonal_grid):
        fam: dict[str, list] = {}
        for mod, a, b, c in g:
            fam.setdefault(mod, []).append((a, b, c, 1.0))
            if mod.startswith("AA"):
                fam.setdefault(mod.replace("AA", "AAd"), []).append((a, b, c, DAMPED_START))
        out.append(fam)
    return out[0], out[1]


def _struct(model: str, points, m: int) -> Column:
    return F.struct(F.lit(model).alias("model"), F.lit(model.startswith("AA")).alias("trend"),
                    F.lit(model.endswith("A")).alias("season"),
                    F.lit(float(ETS_PARAMS[model] + (m if model.endswith("A") else 0))).alias("k"),
                    F.array(*[F.lit(i) for i in free_weights(model)]).alias("free"),
                    F.array(*[F.array(*[F.lit(float(v)) for v in p]) for p in points]).alias("points"))


def _start(y: Column, fam: Column, m: int, warm: Column) -> Column:
    """State before the fold; ``skip`` months do not count as errors."""
    first = F.slice(y, 1, m)
    n = F.size(y)
    plain = F.struct(F.try_element_at(y, F.lit(1)).alias("l"),
                     F.when(fam["trend"] & (n >= 2), F.try_element_at(y, F.lit(2)) - F.try_element_at(y, F.lit(1))).otherwise(0.0).alias("b"),
                     doubles().alias("s"), warm.alias("skip"), F.lit(0.0).alias("sse"))
    seasonal = let(mean(first), lambda l0: F.struct(
        l0.alias("l"), F.when(fam["trend"], (mean(F.slice(y, m + 1, m)) - l0) / m).otherwise(0.0).alias("b"),
        F.transform(first, lambda v: v - l0).alias("s"), F.lit(0).alias("skip"), F.lit(0.0).alias("sse")))
    return F.when(fam["season"], seasonal).otherwise(plain)


def _run(values: Column, start: Column, x: Column, m: int) -> Column:
    """The fold over the months with weights ``x`` = [alpha, beta, gamma, phi]."""
    def weights(w):
        def step(s, v):
            base = s["l"] + w["phi"] * s["b"]
            s0 = F.coalesce(F.get(s["s"], F.lit(0)), F.lit(0.0))
            return let(base, lambda at: let(s0, lambda old: let(v - at - old, lambda e: F.struct(
                (at + w["a"] * e).alias("l"), (w["phi"] * s["b"] + w["ab"] * e).alias("b"),
                F.when(F.size(s["s"]) > 0, F.concat(F.slice(s["s"], 2, m - 1), F.array(old + w["g"] * e))).otherwise(s["s"]).alias("s"),
                (s["skip"] - 1).alias("skip"), (s["sse"] + F.when(s["skip"] > 0, 0.0).otherwise(e * e)).alias("sse")))))
        return F.aggregate(values, start, step)
    a, b, g = (F.get(x, F.lit(i)) for i in range(3))
    return let(F.struct(a.alias("a"), (a * b).alias("ab"), (g * (1 - a)).alias("g"), F.get(x, F.lit(3)).alias("phi")), weights)


def _line(f, at: Column, way: Column, lo0: Column, hi0: Column) -> Column:
    """``at`` = struct(sse, x) after a golden-section search of x + t ``way`` for t from
    ``lo0`` to ``hi0``; weights that move stay within their bounds."""
    bound = lambda vs, i: F.get(F.array(*[F.lit(v) for v in vs]), i)

    def put(t):
        return F.transform(at["x"], lambda v, i: let(F.get(way, i), lambda d: F.when(d == 0, v).otherwise(
            F.least(F.greatest(v + t * d, bound(LOWER, i)), bound(UPPER, i)))))

    def begin(lo, hi):
        inner = F.transform(F.array(hi - _GOLD * (hi - lo), lo + _GOLD * (hi - lo)), lambda t: F.struct(f(put(t)).alias("f"), t.alias("t")))
        return let(inner, lambda p: F.struct(lo.alias("lo"), hi.alias("hi"), F.get(p, F.lit(0)).alias("p"), F.get(p, F.lit(1)).alias("q")))

    def cut(s, _):
        left = s["p"]["f"] <= s["q"]["f"]
        lo, hi = F.when(left, s["lo"]).otherwise(s["p"]["t"]), F.when(left, s["q"]["t"]).otherwise(s["hi"])
        new = F.when(left, hi - _GOLD * (hi - lo)).otherwise(lo + _GOLD * (hi - lo))
        return let(new, lambda t: let(F.struct(f(put(t)).alias("f"), t.alias("t")), lambda p: F.struct(
            lo.alias("lo"), hi.alias("hi"), F.when(left, p).otherwise(s["q"]).alias("p"), F.when(left, s["p"]).otherwise(p).alias("q"))))

    end = F.aggregate(F.sequence(F.lit(1), F.lit(SECTIONS - 2)), begin(lo0, hi0), cut)
    return let(end, lambda e: let(F.least(e["p"], e["q"]), lambda best: F.when(
        best["f"] < at["sse"], F.struct(best["f"].alias("sse"), put(best["t"]).alias("x"))).otherwise(at)))


def _fit_family(y: Column, fam: Column, m: int, warm: Column, search: bool) -> Column:
    """struct(sse, x) of one family."""
    values = F.when(fam["season"], tail(y, m)).otherwise(tail(y, 1))

    def over(vals, start):
        f = lambda x: _run(vals, start, x, m)["sse"]
        grid = F.array_min(F.transform(fam["points"], lambda x: F.struct(f(x).alias("sse"), x.alias("x"))))
        if not search:
            return grid

        axes = F.transform(fam["free"], lambda j: F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: F.when(i == j, 1.0).otherwise(0.0)))

        def cycle(s, _):
            end = F.aggregate(axes, s["at"], lambda at, way: _line(f, at, way, -s["half"], s["half"]))
            # then on along what the cycle changed, against valleys that no axis follows
            ahead = lambda e: _line(f, e, F.zip_with(e["x"], s["at"]["x"], lambda n, o: n - o), F.lit(-1.0), F.lit(8.0))
            return let(let(end, ahead), lambda e: F.struct(e.alias("at"), F.when(
                e["sse"] < (1 - GAIN) * s["at"]["sse"], s["half"]).otherwise(s["half"] / 2).alias("half")))
        return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), F.struct(grid.alias("at"), F.lit(BRACKET).alias("half")), cycle)["at"]
    return let(values, lambda vals: let(_start(y, fam, m, warm), lambda start: over(vals, start)))


def _forecast(state: Column, phi: Column, step: Column, m: int) -> Column:
    swing = F.when(F.size(state["s"]) > 0, F.get(state["s"], (step - 1) % m)).otherwise(F.lit(0.0))
    return state["l"] + state["b"] * total(F.transform(F.sequence(F.lit(1), step), lambda i: F.pow(phi, i))) + swing


def ets(arrays: DataFrame, keys: Sequence[str], h: int, grid=None, seasonal_grid=None,
        frequency: int = 12, search: bool = True) -> DataFrame:
    """Smoothing with the best family and fitted weights per series:
    ``(keys, last_date, step, fcast, resid_var, ets_model, alpha, beta, gamma, phi, sse)``.

    Seasonal families join where a series has two periods of ``frequency`` months
    (``frequency`` 1: none).  ``search=False`` keeps the best
    point of a grid, by default the coarse one, at a few per cent of the folds."""
    keys = list(keys)
    grid = (ETS_GRID if search else COARSE_GRID) if grid is None else grid
    seasonal_grid = (ETS_SEASONAL_GRID if search else COARSE_SEASONAL_GRID) if seasonal_grid is None else seasonal_grid
    m = frequency
    y, n = F.col("y"), F.size("y")
    plain, seasons = _families(grid, seasonal_grid)
    seasonal = (n >= 2 * m) if m > 1 and seasons else F.lit(False)
    base = arrays.withColumn("_warm", F.when(seasonal, F.lit(m - 1)).otherwise(F.lit(0))).withColumn(
        "_m", F.greatest(n - 1 - F.col("_warm"), F.lit(1)))
    fams = F.array(*[_struct(k, p, m) for k, p in plain.items()])
    if m > 1 and seasons:
        fams = F.when(F.col("_warm") > 0, F.concat(fams, F.array(*[_struct(k, p, m) for k, p in seasons.items()]))).otherwise(fams)

    def judged(fam):
        return let(_fit_family(y, fam, m, F.col("_warm"), search), lambda b: F.struct(
            (F.col("_m") * F.log(F.greatest(b["sse"] / F.col("_m"), F.lit(1e-12))) + 2 * fam["k"]).alias("aic"), fam["k"].alias("k"),
            b["sse"].alias("sse"), b["x"].alias("x"), fam["model"].alias("model"), fam["trend"].alias("trend"), fam["season"].alias("season")))
    best = base.withColumn("_b", F.array_min(F.transform(fams, judged)))
    best = best.withColumn("_f", let(F.col("_b"), lambda b: let(F.when(b["season"], tail(y, m)).otherwise(tail(y, 1)),
                                                              lambda v: _run(v, _start(y, b, m, F.col("_warm")), b["x"], m))))
    out = best.select(*keys, "last_date", F.explode(F.sequence(F.lit(1), F.lit(h))).alias("step"), "_b", "_f", "_m")
    x = lambda i: F.get(F.col("_b.x"), F.lit(i))
    return out.select(*keys, "last_date", "step", _forecast(F.col("_f"), x(3), F.col("step"), m).alias("fcast"),
                      (F.col("_b.sse") / F.col("_m")).alias("resid_var"), F.col("_b.model").alias("ets_model"),
                      *[x(i).alias(c) for i, c in enumerate(("alpha", "beta", "gamma", "phi"))], F.col("_b.sse").alias("sse"))


def smooth_fixed(arrays: DataFrame, keys: Sequence[str], h: int, model: str, alpha: float, beta: float = 0.0, gamma: float = 0.0,
                 phi: float = 1.0, frequency: int = 12) -> DataFrame:
    """T03 with a fixed family and weights: ``(keys, last_date, step, fcast, sse)``, errors counted from the second value."""
    point = (alpha, beta, gamma, phi)
    fam = _struct(model, [point], frequency)
    state = _run(tail(F.col("y"), frequency if model.endswith("A") else 1), _start(F.col("y"), fam, frequency, F.lit(0)),
                 F.array(*[F.lit(float(v)) for v in point]), frequency)
    return (arrays.withColumn("_f", state).select(*keys, "last_date", F.explode(F.sequence(F.lit(1), F.lit(h))).alias("step"), "_f")
                  .select(*keys, "last_date", "step", _forecast(F.col("_f"), F.lit(float(phi)), F.col("step"), frequency).alias("fcast"),
                          F.col("_f.sse").alias("sse")))
