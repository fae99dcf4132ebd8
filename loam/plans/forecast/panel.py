"""Grouped monthly series as long tables.

A grouped time series is kept **long**: ``(keys..., Date, Quantity)`` for the
bottom series and ``(node, Date, Quantity)`` for all aggregation nodes, where a
node is one grouping set of the key columns (total, each single key, bottom).
Nothing is pivoted to one column per series, so the number of series is only
bounded by the cluster.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loam.operators.relational import calendar_panel, constant_columns, monthly_sum


@dataclass(frozen=True)
class ForecastParams:
    """Forecasting settings with the workflow's defaults."""
    horizon: int = 3
    gts_method: str = "comb"          # "bu" bottom-up, "comb" optimal combination
    ts_method: str = "ets"            # "ets" exponential smoothing, "arima" AR(p) on d differences
    comb_weights: str = "ols"         # "ols", "wls", "nseries" (only read for comb)
    frequency: int = 12
    keys: tuple = ("CustomerName", "ProductCategory", "Destination")
    date_col: str = "Date"
    value_col: str = "Quantity"
    extra: dict = field(default_factory=dict)

    def with_(self, **kw) -> "ForecastParams":
        return replace(self, **kw)


def bottom_panel(df: DataFrame, params: ForecastParams, drop_constant: bool = True) -> tuple[DataFrame, list[str]]:
    """Monthly sums per key vector on a dense calendar (every series x
    every month from the first to the last month, gaps = 0).

    Key columns with one value are dropped from the grouping (they add no
    node) but stay in the panel, so that outputs carry them; returns the panel
    and the key columns that group."""
    from loam.session import materialize
    keys = list(params.keys)
    # the monthly sums (keys x months, far smaller than the rows) are stored
    # once; the constant-key test and the panel both read them, so the fact
    # rows are scanned a single time
    m = materialize(monthly_sum(df, params.date_col, keys, params.value_col))
    kept, fixed = keys, {}
    if drop_constant:
        const = set(constant_columns(m.select(*keys)))
        kept = [k for k in keys if k not in const]
        if const:
            fixed = {k: F.lit(m.select(F.first(k)).first()[0]).cast(m.schema[k].dataType) for k in sorted(const)}
            m = m.groupBy(params.date_col, *kept).agg(F.sum(params.value_col).alias(params.value_col))
    return calendar_panel(m, kept, params.date_col, params.value_col).withColumns(fixed), kept


def bottom_keys(panel: DataFrame, params: ForecastParams, keys: list[str]) -> DataFrame:
    """One row per bottom series: its node name and every key column, those
    with one value included."""
    every = [k for k in params.keys if k in panel.columns]
    return panel.select(bottom_node(keys).alias("bottom"), *every).distinct()


def node_sets(keys: list[str]) -> list[list[str]]:
    """Total, each single key, bottom level (grouped structure)."""
    if not keys:
        return [[]]
    sets = [[]] + [[k] for k in keys]
    if len(keys) > 1:
        sets.append(list(keys))
    return sets


def node_part(key: str) -> Column:
    """``key=value`` as a part of a node name: ``%``, ``/`` and ``=`` in names and
    values read ``%25``, ``%2F`` and ``%3D``, a null reads ``%N``, so that no two
    nodes have one name."""
    plain = F.col(key).cast("string")
    name = key
    for sign, code in (("%", "%25"), ("/", "%2F"), ("=", "%3D")):
        plain, name = F.replace(plain, F.lit(sign), F.lit(code)), name.replace(sign, code)
    return F.concat(F.lit(f"{name}="), F.coalesce(plain, F.lit("%N")))


def node_id(keys: list[str]) -> Column:
    """Readable node name: ``total`` or ``k1=v1/k2=v2`` over the non-rolled-up keys
    (to be used right after a grouping-sets aggregation)."""
    parts = [F.when(F.grouping(k) == 0, node_part(k)) for k in keys]
    if not parts:
        return F.lit("total")
    joined = F.concat_ws("/", *parts)
    return F.when(joined == "", F.lit("total")).otherwise(joined)


def node_level(keys: list[str]) -> Column:
    """Number of keys a node is grouped by (0 = total)."""
    if not keys:
        return F.lit(0)
    return reduce(lambda a, b: a + b, [1 - F.grouping(k) for k in keys]).cast("int")


def aggregate_nodes(panel: DataFrame, keys: list[str], date_col: str, value_col: str) -> DataFrame:
    """All node series in one pass: ``(node, level, keys..., Date, value)``."""
    sets = node_sets(keys)
    return (panel.groupingSets([[date_col] + s for s in sets], date_col, *keys)
                 .agg(F.sum(value_col).alias(value_col), node_id(keys).alias("node"),
                      node_level(keys).alias("level")))


def bottom_node(keys: list[str]) -> Column:
    """The node name of a bottom series row (same text as :func:`node_id`)."""
    if not keys:
        return F.lit("total")
    return F.concat_ws("/", *[node_part(k) for k in keys])


def membership(panel: DataFrame, keys: list[str]) -> DataFrame:
    """The summing structure S as a long table: one row per (bottom series,
    node containing it).  Its size is (#bottom series x #node sets)."""
    bottoms = panel.select(*keys).distinct().withColumn("bottom", bottom_node(keys))
    sets = node_sets(keys)
    arr = F.array(*[
        (F.concat_ws("/", *[node_part(k) for k in s]) if s else F.lit("total"))
        for s in sets])
    return bottoms.select("bottom", *keys, F.explode(F.array_distinct(arr)).alias("node"))


def expanding_windows(df: DataFrame, date_col: str, nfolds: int, horizon: int = 1) -> DataFrame:
    """Rolling-origin training windows.  The origins are the last
    ``nfolds`` months (minus ``horizon - 1``); each row is emitted once per
    origin it precedes (``date < origin``), as column ``origin``.  The origins
    come from a scalar subquery and rows fan out with ``explode`` -- no join."""
    mx = df.select(F.max(date_col)).scalar()
    origins = F.array(*[F.add_months(mx, -(k + horizon - 1)) for k in range(nfolds)])
    return (df.select(F.explode(origins).alias("origin"), "*")
              .where(F.col(date_col) < F.col("origin")))
