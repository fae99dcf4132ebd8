"""Rolling-origin evaluation, parameter search and future forecasts
(T05, T09-T14).

Every parameter setting is a key column (``grid_id``) in one plan instead of
a task per setting: base forecasts are computed once per forecasting method
for all (origin, node) series, reconciliation solves all (setting, origin,
step) systems together, and the scores are two grouped means.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loam.operators.relational import arg_min, expand_grid, full_join_fill, mean_of_means
from loam.session import materialize
from loam.plans.forecast import methods, reconcile
from loam.plans.forecast.panel import (ForecastParams, aggregate_nodes, bottom_keys, bottom_node, bottom_panel,
                                       expanding_windows, membership)

GRID_LEVELS = {"GTSMETHOD": ["bu", "comb"], "COMBHTS_WEIGHTS": ["ols", "wls", "nseries"],
               "TSMETHOD": ["ets", "arima"]}


def legal_grid(spark: SparkSession, levels=GRID_LEVELS) -> DataFrame:
    """All combinations (first factor fastest), weights forced to the
    first level where the method is not ``comb``, duplicates removed keeping
    the first row."""
    g = expand_grid(spark, levels)
    first = levels["COMBHTS_WEIGHTS"][0]
    g = g.withColumn("COMBHTS_WEIGHTS", F.when(F.col("GTSMETHOD") == "comb", F.col("COMBHTS_WEIGHTS"))
                     .otherwise(F.lit(first)))
    keep = g.groupBy("GTSMETHOD", "COMBHTS_WEIGHTS", "TSMETHOD").agg(F.min("grid_id").alias("grid_id"))
    return keep.select("grid_id", "GTSMETHOD", "COMBHTS_WEIGHTS", "TSMETHOD")


def settings_rows(grid: DataFrame) -> list[tuple]:
    """The (small, bounded) grid as driver-side tuples to lay out the plan."""
    return [(r["grid_id"], r["GTSMETHOD"], r["COMBHTS_WEIGHTS"], r["TSMETHOD"])
            for r in grid.orderBy("grid_id").collect()]


def _reconciled_bottoms(fc: DataFrame, memb: DataFrame, settings: Sequence[tuple], level_bottom: int,
                        keys_sys: Sequence[str], tol: float) -> DataFrame:
    """Bottom forecasts per setting, clamped at 0."""
    parts = []
    bu = [s for s in settings if s[1] == "bu"]
    comb = [s for s in settings if s[1] == "comb"]
    for gid, _, _, ts in bu:
        b = fc.where((F.col("ts_method") == ts) & (F.col("level") == level_bottom))
        parts.append(b.select(F.lit(gid).alias("grid_id"), *keys_sys, F.col("node").alias("bottom"), "fcast"))
    if comb:
        node_fc, wts = None, None
        for gid, _, wname, ts in comb:
            nf = fc.where(F.col("ts_method") == ts).withColumn("grid_id", F.lit(gid))
            w = reconcile.node_weights(memb, nf, ["grid_id", *keys_sys], wname)
            node_fc = nf if node_fc is None else node_fc.unionByName(nf)
            wts = w if wts is None else wts.unionByName(w)
        x0 = node_fc.where(F.col("level") == level_bottom).select(
            "grid_id", *keys_sys, F.col("node").alias("bottom"), "fcast")
        # memb and fc are stored by the callers; node_fc / wts are projections of them
        parts.append(reconcile.combine(node_fc, memb, ["grid_id", *keys_sys], wts, tol=tol, x0=x0,
                                       inputs_stored=True))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("fcast", F.greatest(F.col("fcast"), F.lit(0.0)))


def base_node_forecasts(nodes_long: DataFrame, series_keys: Sequence[str], date_col: str, value_col: str,
                        h: int, ts_methods: Sequence[str], frequency: int = 12) -> DataFrame:
    """Base forecasts of every node series for each method, one plan."""
    arrays = methods.series_arrays(nodes_long, series_keys, date_col, value_col)
    out = None
    for ts in sorted(set(ts_methods)):
        f = methods.forecast(arrays, series_keys, h, ts, frequency).select(
            *series_keys, "last_date", "step", "fcast", "resid_var", F.lit(ts).alias("ts_method"))
        out = f if out is None else out.unionByName(f)
    return out


def crossval(df: DataFrame, params: ForecastParams, grid: DataFrame | None = None, nfolds: int = 3,
             ts_override: str | None = None, tol: float = 1e-8) -> DataFrame:
    """For each of the last ``nfolds`` months as origin, forecast one
    month ahead from the history before it (for every setting of ``grid``;
    default: the single setting of ``params`` as grid_id 0), compare with the
    actuals (full join, missing -> 0) and give the RMSE per bottom series.

    Columns: grid_id, origin, bottom, keys..., actual1, fcast1, RMSE."""
    spark = df.sparkSession
    if grid is None:
        grid = spark.createDataFrame([(0, params.gts_method, params.comb_weights, params.ts_method)],
                                     "grid_id int, GTSMETHOD string, COMBHTS_WEIGHTS string, TSMETHOD string")
    settings = settings_rows(grid)
    if ts_override:
        settings = [(g, m, w, ts_override) for g, m, w, _ in settings]
    panel, keys = bottom_panel(df, params)
    d, v = params.date_col, params.value_col
    # the panel, the summing structure and the base forecasts feed several
    # jobs (each setting, the solver, the actuals): store each once
    panel = materialize(panel)
    memb = materialize(membership(panel, keys))
    nodes = aggregate_nodes(panel, keys, d, v)
    windows = expanding_windows(nodes, d, nfolds)
    fc = base_node_forecasts(windows, ["origin", "node"], d, v, 1, [s[3] for s in settings], params.frequency)
    fc = materialize(fc.join(nodes.select("node", "level").distinct(), on="node"))
    bottoms = _reconciled_bottoms(fc, memb, settings, len(keys), ["origin", "step"], tol)
    fcast = bottoms.where(F.col("step") == 1).select("grid_id", "origin", "bottom", F.col("fcast").alias("fcast1"))
    # actuals at each origin month (dense panel: a series without sales that
    # month has 0), attached to every setting through the small (grid_id,
    # origin) table, then a full join with the forecasts (missing -> 0)
    runs = fcast.select("grid_id", "origin").distinct()
    actual = (panel.select(bottom_node(keys).alias("bottom"), F.col(d).alias("origin"), F.col(v).alias("actual1"))
                   .join(runs, on="origin"))
    merged = full_join_fill(actual, fcast, ["grid_id", "origin", "bottom"], 0.0)
    out = merged.withColumn("RMSE", F.sqrt((F.col("actual1") - F.col("fcast1")) ** 2))
    keys_df = bottom_keys(panel, params, keys)
    return out.join(keys_df, on="bottom", how="left")


def setting_scores(cv: DataFrame) -> DataFrame:
    """Mean RMSE per (setting, origin), then mean over origins."""
    return mean_of_means(cv, ["grid_id", "origin"], ["grid_id"], "RMSE", name="score")


def best_setting(scores: DataFrame, grid: DataFrame) -> DataFrame:
    """The setting with the lowest score; ties go to the lowest
    grid_id (the base setting is id 0, so it is only replaced by a strictly
    better one)."""
    return arg_min(scores.join(grid, on="grid_id"), [], "score", "grid_id")


def search(df: DataFrame, params: ForecastParams, nfolds: int = 3, ts_override: str | None = None,
           tol: float = 1e-8) -> tuple[DataFrame, DataFrame]:
    """T12 + T13: score the base setting (grid_id 0) and every legal grid
    setting in one plan; return (scores with settings, best row)."""
    spark = df.sparkSession
    base = spark.createDataFrame([(0, params.gts_method, params.comb_weights, params.ts_method)],
                                 "grid_id int, GTSMETHOD string, COMBHTS_WEIGHTS string, TSMETHOD string")
    grid = base.unionByName(legal_grid(spark))
    cv = crossval(df, params, grid, nfolds, ts_override, tol)
    scores = setting_scores(cv).join(grid, on="grid_id")
    return scores, best_setting(scores.select("grid_id", "score"), grid)


def future_forecasts(df: DataFrame, params: ForecastParams, settings: Sequence[tuple], tol: float = 1e-8,
                     single: str = "arima") -> DataFrame:
    """T14 for several settings (grid_id, GTSMETHOD, COMBHTS_WEIGHTS, TSMETHOD)
    in one plan: panel and base forecasts are computed once, all settings are
    reconciled together.  A single series (T05: no key has two values) is
    forecast by ``single`` and needs no combination.

    Columns: grid_id, bottom, keys..., Date, step, fcast."""
    panel, keys = bottom_panel(df, params)
    d, v = params.date_col, params.value_col
    if not keys:
        settings = [(g, "bu", w, single) for g, _, w, _ in settings]
    panel = materialize(panel)
    memb = materialize(membership(panel, keys))
    nodes = aggregate_nodes(panel, keys, d, v).withColumn("run", F.lit(0))
    fc = base_node_forecasts(nodes, ["run", "node"], d, v, params.horizon, [s[3] for s in settings], params.frequency)
    fc = materialize(fc.join(nodes.select("node", "level").distinct(), on="node"))
    b = _reconciled_bottoms(fc, memb, settings, len(keys), ["run", "step"], tol)
    out = b.join(bottom_keys(panel, params, keys), on="bottom", how="left")
    return out.select("grid_id", "bottom", *[k for k in params.keys if k in out.columns],
                      F.add_months(panel.select(F.max(d)).scalar(), F.col("step")).alias(d), "step", "fcast")


def future_forecast(df: DataFrame, params: ForecastParams, ts_override: str | None = None,
                    tol: float = 1e-8) -> DataFrame:
    """T14 (and T05 for a single series): ``params.horizon`` months after the
    last month, with the given setting; bottom forecasts clamped at 0.

    Columns: bottom, keys..., Date, step, fcast."""
    one = (0, params.gts_method, params.comb_weights, ts_override or params.ts_method)
    return future_forecasts(df, params, [one], tol, ts_override or "arima").drop("grid_id")


def forecast_table(fc: DataFrame, keys: Sequence[str], prefix: str = "fcast", horizon: int = 3) -> DataFrame:
    """Keys + one column per forecast month (export layout)."""
    wide = fc.withColumn("_col", F.concat(F.lit(prefix), F.col("step").cast("string")))
    cols = [f"{prefix}{i}" for i in range(1, horizon + 1)]
    return wide.groupBy(*keys).pivot("_col", cols).agg(F.first("fcast"))
