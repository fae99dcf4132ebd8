"""Checks for grouped time-series forecasting.

The naive (last value) forecaster makes rolling-origin evaluation, parameter
search and reconciliation fully SQL-checkable: naive node forecasts are
already coherent, so bottom-up and every optimal-combination weighting must
return them unchanged.  Smoothing with a fixed weight and AR(1) are checked
against a recursive CTE and ``regr_slope``, ARMA(1,1) against its two regressions
and the filter in SQL; the searched ETS / ARIMA fits are rows-only checks backed
by pytest.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from loam.plans.forecast import arma, methods, smooth
from loam.plans.forecast import search as fs
from loam.plans.forecast.panel import ForecastParams, aggregate_nodes, bottom_panel, membership
from loam.plans.forecast.reconcile import bottom_up, combine, node_weights
from loam.session import materialize
from loam.sources.views import view, with_ctes
from loam.suite import query, r6, s6
from loam.suite_relational import DEMAND_KEYS, _MONTHLY

PARAMS = ForecastParams()
K = DEMAND_KEYS
_BOTTOM = "concat_ws('/', " + ", ".join(f"'{k}=' || {k}" for k in K) + ")"
_BOTTOM_K = "concat_ws('/', " + ", ".join(f"'{k}=' || k.{k}" for k in K) + ")"
_NODE = ("CASE WHEN concat_ws('/', " + ", ".join(f"CASE WHEN GROUPING({k}) = 0 THEN '{k}=' || {k} END" for k in K)
         + ") = '' THEN 'total' ELSE concat_ws('/', "
         + ", ".join(f"CASE WHEN GROUPING({k}) = 0 THEN '{k}=' || {k} END" for k in K) + ") END")
_PANEL = _MONTHLY + """,
k AS (SELECT DISTINCT CustomerName, ProductCategory, Destination FROM m),
cal AS (SELECT CAST(unnest(generate_series((SELECT min(Date) FROM m), (SELECT max(Date) FROM m), INTERVAL 1 MONTH)) AS DATE) AS Date),
p AS (SELECT k.CustomerName, k.ProductCategory, k.Destination, cal.Date, coalesce(m.Quantity, 0.0) AS Quantity,
      """ + _BOTTOM_K + """ AS bottom
      FROM k CROSS JOIN cal LEFT JOIN m ON k.CustomerName = m.CustomerName AND k.ProductCategory = m.ProductCategory
        AND k.Destination = m.Destination AND cal.Date = m.Date),
nodes AS (SELECT """ + _NODE + """ AS node, CAST(3 - GROUPING(CustomerName) - GROUPING(ProductCategory)
             - GROUPING(Destination) AS INT) AS level, Date, sum(Quantity) AS Quantity FROM p
          GROUP BY GROUPING SETS ((Date), (Date, CustomerName), (Date, ProductCategory), (Date, Destination),
                                  (Date, CustomerName, ProductCategory, Destination)))"""


def _demand(spark, sf):
    return view(spark, sf, "demand").dropna(how="any")


def _nodes(spark, sf):
    panel, keys = bottom_panel(_demand(spark, sf), PARAMS)
    return panel, keys, aggregate_nodes(panel, keys, "Date", "Quantity")


def _sql(select: str, extra: str = "") -> str:
    return with_ctes(["demand"], "demand_c AS (SELECT * FROM demand WHERE CustomerName IS NOT NULL AND "
                     "ProductCategory IS NOT NULL AND Destination IS NOT NULL AND Date IS NOT NULL AND "
                     "Quantity IS NOT NULL),\n" + _PANEL.replace("FROM demand GROUP BY ALL", "FROM demand_c GROUP BY ALL")
                     + ("," + extra if extra else ""), select)


@query("T02_grouped_series_nodes", _sql(f"SELECT node, level, Date, {s6('Quantity')} AS Quantity FROM nodes"))
def q_t02(spark, sf):
    _, _, nodes = _nodes(spark, sf)
    return r6(nodes.select("node", "level", "Date", "Quantity"), "Quantity")


_ODD = {"CustomerName": "CASE WHEN CustomerName < 'C' THEN NULL WHEN CustomerName < 'G' THEN 'x/ProductCategory=1%' ELSE CustomerName END",
        "ProductCategory": "CASE WHEN length(ProductCategory) % 2 = 0 THEN NULL ELSE ProductCategory || '=/' END"}


def _odd_part(k: str) -> str:
    return f"'{k}=' || coalesce(replace(replace(replace({k}, '%', '%25'), '/', '%2F'), '=', '%3D'), '%N')"


def _odd_node(keys, level: int) -> str:
    node = " || '/' || ".join(_odd_part(k) for k in keys) or "'total'"
    return f"SELECT {node} AS node, {level} AS level, sum(Quantity) AS q FROM o GROUP BY 1"


@query("T02_T06_null_keys_and_separators", with_ctes(["demand"], "o AS (SELECT " + ", ".join(
    f"{_ODD.get(k, k)} AS {k}" for k in K) + ", Quantity FROM demand WHERE Date IS NOT NULL AND Quantity IS NOT NULL),\nn AS ("
    + "\nUNION ALL ".join([_odd_node([], 0), *[_odd_node([k], 1) for k in K], _odd_node(K, 3)]) + ")",
    f"SELECT node, level, {s6('q')} AS summed, {s6('q')} AS from_bottom FROM n"))
def q_t02_odd(spark, sf):
    """Nodes over null keys and values with ``/``, ``=`` and ``%``: their sums, and
    the same from the bottom series by the membership table."""
    d = view(spark, sf, "demand").where("Date IS NOT NULL AND Quantity IS NOT NULL").selectExpr(
        *[f"{_ODD.get(k, k)} AS {k}" for k in K], "Date", "Quantity")
    panel, keys = bottom_panel(d, PARAMS)
    nodes = aggregate_nodes(panel, keys, "Date", "Quantity").groupBy("node", "level").agg(F.sum("Quantity").alias("summed"))
    bottom = nodes.where(F.col("level") == len(keys)).select(F.lit(0).alias("run"), F.col("node").alias("bottom"), F.col("summed").alias("fcast"))
    up = bottom_up(bottom, membership(panel, keys), ["run"]).select("node", F.col("fcast").alias("from_bottom"))
    return r6(nodes.join(up, "node").select("node", "level", "summed", "from_bottom"), "summed", "from_bottom")


@query("T03_smoothing_fixed_weight", _sql(
    f"SELECT node, {s6('l')} AS fcast FROM r WHERE t = (SELECT max(t) FROM s WHERE s.node = r.node)", """
s AS (SELECT node, CAST(row_number() OVER (PARTITION BY node ORDER BY Date) AS INT) AS t, Quantity AS y FROM nodes),
r(node, t, l) AS (SELECT node, t, y FROM s WHERE t = 1
   UNION ALL SELECT s.node, s.t, 0.5e0 * s.y + 0.5e0 * r.l FROM r JOIN s ON s.node = r.node AND s.t = r.t + 1)"""
).replace("WITH ", "WITH RECURSIVE ", 1))
def q_t03(spark, sf):
    _, _, nodes = _nodes(spark, sf)
    arr = methods.series_arrays(nodes, ["node"], "Date", "Quantity")
    return r6(methods.ses_fixed(arr, ["node"], 1, 0.5).select("node", "fcast"), "fcast")


@query("T03_seasonal_fixed_weights", _sql(
    f"SELECT node, step, {s6('l + s[step]')} AS fcast FROM r, (SELECT unnest(range(1, 4)) AS step) "
    "WHERE t = (SELECT max(t) FROM o WHERE o.node = r.node)", """
o AS (SELECT node, CAST(row_number() OVER (PARTITION BY node ORDER BY Date) AS INT) AS t, Quantity AS y FROM nodes),
f AS (SELECT node, avg(y) AS l0, list(y ORDER BY t) AS ys FROM o WHERE t <= 12 GROUP BY node),
r(node, t, l, s) AS (SELECT node, 12, l0, list_transform(ys, lambda v: v - l0) FROM f
   UNION ALL SELECT o.node, o.t, 0.3e0 * (o.y - r.s[1]) + 0.7e0 * r.l,
     list_append(r.s[2:], 0.2e0 * (o.y - (0.3e0 * (o.y - r.s[1]) + 0.7e0 * r.l)) + 0.8e0 * r.s[1])
   FROM r JOIN o ON o.node = r.node AND o.t = r.t + 1)"""
).replace("WITH ", "WITH RECURSIVE ", 1))
def q_t03c(spark, sf):
    _, _, nodes = _nodes(spark, sf)
    arr = methods.series_arrays(nodes, ["node"], "Date", "Quantity")
    return r6(methods.seasonal_fixed(arr, ["node"], 3, 0.3, 0.2, PARAMS.frequency).select("node", "step", "fcast"), "fcast")


@query("T03_damped_fixed_weights", _sql(
    f"SELECT node, step, {s6('l + b * w')} AS fcast, {s6('sqrt(sse)')} AS root_sse FROM r, (SELECT step, sum(pow(0.9e0, i)) AS w "
    "FROM (SELECT unnest(range(1, 4)) AS step), (SELECT unnest(range(1, 4)) AS i) WHERE i <= step GROUP BY step) "
    "WHERE t = (SELECT max(t) FROM s WHERE s.node = r.node)", """
s AS (SELECT node, CAST(row_number() OVER (PARTITION BY node ORDER BY Date) AS INT) AS t, Quantity AS y FROM nodes),
r(node, t, l, b, sse) AS (SELECT s.node, 1, s.y, n.y - s.y, 0e0 FROM s JOIN s n ON n.node = s.node AND n.t = 2 WHERE s.t = 1
   UNION ALL SELECT s.node, s.t, 0.4e0 * s.y + 0.6e0 * (r.l + 0.9e0 * r.b),
     0.3e0 * (0.4e0 * s.y + 0.6e0 * (r.l + 0.9e0 * r.b) - r.l) + 0.7e0 * 0.9e0 * r.b, r.sse + pow(s.y - r.l - 0.9e0 * r.b, 2)
   FROM r JOIN s ON s.node = r.node AND s.t = r.t + 1)"""
).replace("WITH ", "WITH RECURSIVE ", 1))
def q_t03d(spark, sf):
    """Damped trend with fixed weights: three months and the root of the squared error, of the fold that the search runs."""
    _, _, nodes = _nodes(spark, sf)
    arr = methods.series_arrays(nodes, ["node"], "Date", "Quantity")
    return r6(smooth.smooth_fixed(arr, ["node"], 3, "AAdN", 0.4, 0.3, phi=0.9).select("node", "step", "fcast", F.sqrt("sse").alias("root_sse")),
              "fcast", "root_sse")


@query("T03_ets_searched_per_node")
def q_t03b(spark, sf):
    _, _, nodes = _nodes(spark, sf)
    arr = methods.series_arrays(nodes, ["node"], "Date", "Quantity")
    return methods.ets(arr, ["node"], PARAMS.horizon)


@query("T04_ar1_least_squares", _sql(
    "SELECT node, round(c + a * y_last, 2) + 0.0 AS fcast FROM f JOIN lst USING (node)", """
l AS (SELECT node, Date, Quantity AS y, lag(Quantity) OVER (PARTITION BY node ORDER BY Date) AS ylag FROM nodes),
f AS (SELECT node, regr_slope(y, ylag) AS a, regr_intercept(y, ylag) AS c FROM l WHERE ylag IS NOT NULL GROUP BY node),
lst AS (SELECT node, Quantity AS y_last FROM nodes WHERE Date = (SELECT max(Date) FROM nodes))"""))
def q_t04(spark, sf):
    _, _, nodes = _nodes(spark, sf)
    arr = methods.series_arrays(nodes, ["node"], "Date", "Quantity")
    fc = methods.ar_fixed(arr, ["node"], 1, p=1)
    # two decimals: the fit uses centred moment sums, the oracle regr_slope
    return fc.select("node", F.round("fcast", 2).alias("fcast"))


@query("T04_arma_fixed_order", _sql(
    """SELECT node, step, ok, CASE WHEN ok THEN round(phi, 6) + 0.0 END AS phi, CASE WHEN ok THEN round(theta, 6) + 0.0 END AS theta, CASE WHEN ok THEN round(CASE step
         WHEN 1 THEN f1 WHEN 2 THEN c + phi * f1 ELSE c + phi * (c + phi * f1) END, 2) + 0.0 END AS fcast
       FROM (SELECT r.node, ok, c, phi, theta, c + phi * s.y + theta * r.e AS f1 FROM r JOIN s ON s.node = r.node AND s.t = r.t
             JOIN b ON b.node = r.node WHERE r.t = (SELECT max(t) FROM s)), (SELECT unnest(range(1, 4)) AS step)""", """
s AS (SELECT node, CAST(row_number() OVER (PARTITION BY node ORDER BY Date) AS INT) AS t, Quantity AS y FROM nodes),
l AS (SELECT node, t, y, lag(y) OVER (PARTITION BY node ORDER BY t) AS x FROM s),
f AS (SELECT node, regr_slope(y, x) AS a1, regr_intercept(y, x) AS a0 FROM l WHERE x IS NOT NULL GROUP BY node),
e AS (SELECT node, t, y, x, lag(y - a0 - a1 * x) OVER (PARTITION BY node ORDER BY t) AS e FROM l JOIN f USING (node) WHERE x IS NOT NULL),
g AS (SELECT node, avg(y) AS my, avg(x) AS mx, avg(e) AS me, var_pop(x) AS xx, var_pop(e) AS ee, covar_pop(x, e) AS xe,
        covar_pop(x, y) AS xy, covar_pop(e, y) AS ey FROM e WHERE e IS NOT NULL GROUP BY node),
h AS (SELECT *, (xy * ee - ey * xe) / (xx * ee - xe * xe) AS phi, (ey * xx - xy * xe) / (xx * ee - xe * xe) AS theta FROM g),
b AS (SELECT node, phi, theta, my - phi * mx - theta * me AS c, abs(phi) < 0.999 AND abs(theta) < 0.999 AS ok FROM h),
r(node, t, e) AS (SELECT node, 1, 0e0 FROM b
   UNION ALL SELECT l.node, l.t, l.y - b.c - b.phi * l.x - b.theta * r.e
   FROM r JOIN l ON l.node = r.node AND l.t = r.t + 1 JOIN b ON b.node = r.node)"""
).replace("WITH ", "WITH RECURSIVE ", 1))
def q_t04c(spark, sf):
    """ARMA(1,1) of every node, first regression of order 1: coefficients and three
    months, no forecast where the coefficients are not stationary and invertible."""
    _, _, nodes = _nodes(spark, sf)
    arr = methods.series_arrays(nodes, ["node"], "Date", "Quantity")
    fc = arma.arma_fixed(arr, ["node"], 3, 1, 1, long=1)
    # two decimals for the forecasts, as above
    return r6(fc.select("node", "step", "ok", F.get("phi", F.lit(0)).alias("phi"), F.get("theta", F.lit(0)).alias("theta"),
                        F.round("fcast", 2).alias("fcast")), "phi", "theta")


@query("T04_unit_root_statistic", _sql(
    f"""SELECT node, {s6('ss / n / v')} AS kpss, ss / n / v <= 0.463 AS level FROM (
          SELECT node, n, sum(s * s) AS ss, any_value(own + 2 * coalesce(w, 0)) AS v
          FROM c LEFT JOIN q USING (node) JOIN (SELECT node, sum(e * e) AS own FROM o GROUP BY node) USING (node) GROUP BY node, n)""", """
o AS (SELECT node, row_number() OVER (PARTITION BY node ORDER BY Date) AS t, Quantity - avg(Quantity) OVER (PARTITION BY node) AS e,
        count(*) OVER (PARTITION BY node) AS n FROM nodes),
c AS (SELECT node, n, sum(e) OVER (PARTITION BY node ORDER BY t) AS s FROM o),
q AS (SELECT a.node, sum((1 - (a.t - b.t) / (floor(4 * pow(a.n / 100, 0.25)) + 1)) * a.e * b.e) AS w FROM o a JOIN o b
        ON a.node = b.node AND a.t - b.t BETWEEN 1 AND floor(4 * pow(a.n / 100, 0.25)) GROUP BY a.node)"""))
def q_t04d(spark, sf):
    """KPSS statistic of every node and whether it passes for a constant level."""
    _, _, nodes = _nodes(spark, sf)
    arr = methods.series_arrays(nodes, ["node"], "Date", "Quantity").select("node", arma.kpss(F.col("y")).alias("kpss"))
    return r6(arr.select("node", "kpss", (F.col("kpss") <= arma.KPSS_5).alias("level")), "kpss")


@query("T04_arima_order_search")
def q_t04b(spark, sf):
    _, _, nodes = _nodes(spark, sf)
    arr = methods.series_arrays(nodes, ["node"], "Date", "Quantity")
    return methods.arima(arr, ["node"], PARAMS.horizon)


@query("T05_univariate_series_forecast")
def q_t05(spark, sf):
    """All demand grouped to one series (every key holds one value): arima, clamped at 0."""
    d = _demand(spark, sf).withColumns({k: F.lit("all") for k in K})
    return fs.future_forecast(d, PARAMS)


@query("T06_bottom_up_sums", _sql(
    f"SELECT n.node, {s6('sum(b.Quantity)')} AS fcast FROM lastb b JOIN memb n ON b.bottom = n.bottom GROUP BY n.node", """
lastb AS (SELECT bottom, CustomerName, ProductCategory, Destination, Quantity FROM p WHERE Date = (SELECT max(Date) FROM p)),
memb AS (SELECT bottom, 'total' AS node FROM lastb
   UNION ALL SELECT bottom, 'CustomerName=' || CustomerName FROM lastb
   UNION ALL SELECT bottom, 'ProductCategory=' || ProductCategory FROM lastb
   UNION ALL SELECT bottom, 'Destination=' || Destination FROM lastb
   UNION ALL SELECT bottom, bottom FROM lastb)"""))
def q_t06(spark, sf):
    panel, keys, nodes = _nodes(spark, sf)
    arr = methods.series_arrays(nodes.where(F.col("level") == len(keys)).withColumn("run", F.lit(0)),
                                ["run", "node"], "Date", "Quantity")
    b = methods.naive(arr, ["run", "node"], 1).withColumnRenamed("node", "bottom")
    return r6(bottom_up(b, membership(panel, keys), ["run"]).select("node", "fcast"), "fcast")


_SCHEMES = ("ols", "wls", "nseries")


@query("T07_T08_optimal_combination_clamped")
def q_t07(spark, sf):
    p = PARAMS.with_(horizon=1)
    settings = [(i, "comb", w, p.ts_method) for i, w in enumerate(_SCHEMES)]
    fc = fs.future_forecasts(_demand(spark, sf), p, settings)
    return fc.withColumn("weights", F.get(F.array(*[F.lit(w) for w in _SCHEMES]), "grid_id")).drop("grid_id")


@query("T07_normal_equations", _sql(
    "SELECT w.weights, k.bottom, 0.0e0 AS residual FROM (SELECT DISTINCT bottom FROM p) k, "
    "(VALUES ('ols'), ('wls'), ('nseries')) w(weights)"))
def q_t07b(spark, sf):
    """Smoothed node forecasts, which do not add up, combined; the residual S'W(yhat - S b) per series is
    measured from the result, against the size of its terms."""
    panel, keys, nodes = _nodes(spark, sf)
    memb = materialize(membership(panel, keys))
    fc = materialize(methods.ets(methods.series_arrays(nodes, ["node"], "Date", "Quantity"), ["node"], 1, search=False))
    fc = fc.select("node", "fcast", "resid_var", F.explode(F.array(*[F.lit(w) for w in _SCHEMES])).alias("weights"))
    wts = None
    for w in _SCHEMES:
        one = node_weights(memb, fc.where(F.col("weights") == w), ["weights"], w)
        wts = one if wts is None else wts.unionByName(one)
    b = combine(fc, memb, ["weights"], wts, inputs_stored=True)
    sums = bottom_up(b, memb, ["weights"]).withColumnRenamed("fcast", "s")
    terms = memb.select("bottom", "node").join(
        fc.join(sums, on=["weights", "node"]).join(wts, on=["weights", "node"]), on="node")
    gap, size = F.col("w") * (F.col("fcast") - F.col("s")), F.col("w") * F.abs("fcast")
    return r6(terms.groupBy("weights", "bottom").agg((F.sum(gap) / F.sum(size)).alias("residual")), "residual")


@query("T09_forecast_table_wide", _sql(
    "SELECT bottom, CustomerName, ProductCategory, Destination, " + ", ".join(
        f"{s6('greatest(Quantity, 0.0)')} AS fcast{i}" for i in (1, 2, 3))
    + " FROM p WHERE Date = (SELECT max(Date) FROM p)"))
def q_t09(spark, sf):
    fc = fs.future_forecast(_demand(spark, sf), PARAMS.with_(gts_method="bu"), ts_override="naive")
    return r6(fs.forecast_table(fc, ["bottom", *K], horizon=PARAMS.horizon), "fcast1", "fcast2", "fcast3")


_CV_NAIVE = """o AS (SELECT CAST((SELECT max(Date) FROM p) - INTERVAL (k) MONTH AS DATE) AS origin FROM range(0, 3) r(k)),
cv AS (SELECT o.origin, a.bottom, a.CustomerName, a.ProductCategory, a.Destination, a.Quantity AS actual1,
       greatest(f.Quantity, 0.0) AS fcast1 FROM o JOIN p a ON a.Date = o.origin
       JOIN p f ON f.bottom = a.bottom AND f.Date = CAST(o.origin - INTERVAL 1 MONTH AS DATE))"""


@query("T10_rolling_origin_naive_rmse", _sql(
    f"SELECT 0 AS grid_id, origin, bottom, CustomerName, ProductCategory, Destination, {s6('actual1')} AS actual1, "
    f"{s6('fcast1')} AS fcast1, {s6('abs(actual1 - fcast1)')} AS RMSE FROM cv", _CV_NAIVE))
def q_t10(spark, sf):
    cv = fs.crossval(_demand(spark, sf), PARAMS.with_(gts_method="bu"), ts_override="naive")
    return r6(cv.select("grid_id", "origin", "bottom", *K, "actual1", "fcast1", "RMSE"), "actual1", "fcast1", "RMSE")


_GRID_ROWS = "(0, 'comb', 'ols'), (1, 'bu', 'ols'), (2, 'comb', 'ols'), (4, 'comb', 'wls'), (6, 'comb', 'nseries'), " \
             "(7, 'bu', 'ols'), (8, 'comb', 'ols'), (10, 'comb', 'wls'), (12, 'comb', 'nseries')"


@query("T12_parameter_search_scores", _sql(
    f"SELECT g.grid_id, g.GTSMETHOD, g.COMBHTS_WEIGHTS, {s6('sc.score')} AS score FROM "
    f"(SELECT avg(m) AS score FROM (SELECT origin, avg(abs(actual1 - fcast1)) AS m FROM cv GROUP BY origin)) sc, "
    f"(VALUES {_GRID_ROWS}) g(grid_id, GTSMETHOD, COMBHTS_WEIGHTS)", _CV_NAIVE))
def q_t12(spark, sf):
    scores, _ = fs.search(_demand(spark, sf), PARAMS, ts_override="naive")
    return r6(scores.select("grid_id", "GTSMETHOD", "COMBHTS_WEIGHTS", "score"), "score")


@query("T11_T13_optimise_settings")
def q_t13(spark, sf):
    scores, best = fs.search(_demand(spark, sf), PARAMS)
    return scores.join(best.select("grid_id", F.lit(True).alias("chosen")), on="grid_id", how="left") \
                 .fillna(False, subset=["chosen"])


@query("T01_T14_future_forecast_chosen_setting")
def q_t14(spark, sf):
    d = _demand(spark, sf)
    _, best = fs.search(d, PARAMS)
    row = best.first()                       # one row: the chosen setting
    p = PARAMS.with_(gts_method=row["GTSMETHOD"], comb_weights=row["COMBHTS_WEIGHTS"], ts_method=row["TSMETHOD"])
    return fs.future_forecast(d, p)
