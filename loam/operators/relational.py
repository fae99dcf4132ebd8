"""Relational operators: projections (P*), joins (J*), aggregations (A*),
sorts (O*) and reshaping (R*).  Each is a function DataFrame(s) -> DataFrame
with column names as parameters.

Scale notes
-----------
* Aggregations are written as plain ``groupBy().agg()`` so Spark does the
  partial (map-side) aggregation before the shuffle.
* Joins are equi-joins on listed keys; AQE picks broadcast vs. sort-merge from
  measured sizes.  A ``broadcast`` hint is only put on sides whose row count is
  fixed by construction (level lists, grids, one-row bound tables).
* Group-wise "keep the best rows" operators join back to a pre-aggregated
  table instead of using a window, so a hot key never lands in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loam.functions.scalar import bin_factor, hour_of_hhmm


def _names(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


# --------------------------------------------------------------------------
# P: projections and predicates
# --------------------------------------------------------------------------

def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename columns ``{old: new}``."""
    return df.withColumnsRenamed(dict(mapping))


def select_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keep the listed columns (pruned down to the scan by Catalyst)."""
    return df.select(*cols)


def floor_to_hour(df: DataFrame, col: str) -> DataFrame:
    """``col = floor(col / 100)`` on an ``hhmm`` column (bigint)."""
    return df.withColumn(col, hour_of_hhmm(col))


def data_step(df: DataFrame, keep: Sequence[str], computed: Mapping[str, Column] | None = None,
              row_selection: Column | None = None) -> DataFrame:
    """Keep listed columns, add computed ones, optional row filter
    applied first (so it is pushed to the scan)."""
    if row_selection is not None:
        df = df.where(row_selection)
    cols = [F.col(c) for c in keep] + [e.alias(n) for n, e in (computed or {}).items()]
    return df.select(*cols)


def parse_date_drop_missing(df: DataFrame, date_col: str, fmt: str | None = None) -> DataFrame:
    """Parse the date column, then drop rows with any missing value."""
    d = F.to_date(F.col(date_col), fmt) if fmt else F.to_date(F.col(date_col))
    return df.withColumn(date_col, d).dropna(how="any")


def drop_columns(df: DataFrame, *cols: str) -> DataFrame:
    """P09."""
    return df.drop(*cols)


def rename_positional(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """P10: positional renaming."""
    return df.toDF(*names)


def constant_columns(df: DataFrame, cols: Sequence[str] | None = None) -> list[str]:
    """Columns holding a single value (nulls count as a value, like R's
    ``n_distinct``).  One pass of min/max/count -- no distinct aggregation."""
    cols = list(cols or df.columns)
    aggs = []
    for c in cols:
        aggs += [F.min(c).alias(f"mn_{c}"), F.max(c).alias(f"mx_{c}"), F.count(c).alias(f"n_{c}")]
    row = df.agg(F.count(F.lit(1)).alias("_all"), *aggs).first()
    out = []
    for c in cols:
        n, total = row[f"n_{c}"], row["_all"]
        if n == 0 or (n == total and row[f"mn_{c}"] == row[f"mx_{c}"]):
            out.append(c)
    return out


def drop_constant_columns(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Drop the columns among ``cols`` that hold one value only."""
    return df.drop(*constant_columns(df, cols))


def fill_missing(df: DataFrame, value=0, cols: Sequence[str] | None = None) -> DataFrame:
    """Missing -> ``value``."""
    return df.fillna(value, subset=list(cols) if cols else None)


def clamp_negatives(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Negative values -> 0."""
    return df.withColumns({c: F.when(F.col(c) < 0, F.lit(0.0)).otherwise(F.col(c)) for c in cols})


def complete_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Rows with no null in ``cols`` (``complete.cases``)."""
    cols = list(cols or df.columns)
    return df.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols]))


def date_range(df: DataFrame, col: str, first, last) -> DataFrame:
    """``first <= col <= last`` (pushed to the scan)."""
    return df.where(F.col(col).between(first, last))


# --------------------------------------------------------------------------
# J: joins
# --------------------------------------------------------------------------

def shared_columns(left: DataFrame, right: DataFrame) -> list[str]:
    return [c for c in left.columns if c in set(right.columns)]


def natural_left_join(left: DataFrame, right: DataFrame, on: Sequence[str] | None = None) -> DataFrame:
    """Left join on all shared column names (listed explicitly).

    Null keys never match (SQL equality).  Pre-aggregate ``right`` to one row
    per key first (as the weather summary is) so the join cannot fan out.
    """
    keys = list(on) if on is not None else shared_columns(left, right)
    return left.join(right, on=keys, how="left")


def anti_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``left`` with no key match in ``right``.

    Written as ``left_anti`` directly: Catalyst does not turn an outer join
    plus ``IS NULL`` filter into an anti join.
    """
    return left.join(right.select(*keys), on=list(keys), how="left_anti")


def full_join_fill(left: DataFrame, right: DataFrame, keys: Sequence[str], fill=0.0) -> DataFrame:
    """Full outer join on ``keys``; missing measures -> ``fill``."""
    out = left.join(right, on=list(keys), how="full")
    measures = [c for c in out.columns if c not in set(keys)]
    return out.fillna(fill, subset=measures)


def calendar_panel(df: DataFrame, keys: Sequence[str], date_col: str, value_col: str,
                   step: str = "1 month", fill=0.0) -> DataFrame:
    """Every key combination seen x every period between the overall
    first and last date; gaps filled with ``fill``.

    The bounds are scalar subqueries (one plan, nothing on the driver); the
    calendar is generated per key with ``explode(sequence())`` -- no cross join.
    """
    keys = list(keys)
    lo = df.select(F.min(date_col)).scalar()
    hi = df.select(F.max(date_col)).scalar()
    grid = (df.select(*keys).distinct()
              .select(*keys, F.explode(F.sequence(lo, hi, F.expr(f"INTERVAL {step}"))).alias(date_col)))
    same = [F.col(f"g.{c}").eqNullSafe(F.col(f"d.{c}")) for c in keys + [date_col]]
    rest = [F.col(f"d.{c}") for c in df.columns if c not in {*keys, date_col}]
    out = grid.alias("g").join(df.alias("d"), on=same, how="left").select(
        *[F.col(f"g.{c}") for c in keys + [date_col]], *rest)
    return out.withColumn(value_col, F.coalesce(F.col(value_col), F.lit(fill)))


def expand_grid(spark, levels: Mapping[str, Sequence], id_col: str = "grid_id") -> DataFrame:
    """Cartesian product of small parameter lists, first factor varying
    fastest, numbered from 1 -- built from one ``sequence`` (no join)."""
    names = list(levels)
    sizes = [len(levels[n]) for n in names]
    total = reduce(lambda a, b: a * b, sizes, 1)
    i = F.col("_i")
    cols, stride = [], 1
    for n, k in zip(names, sizes):
        arr = F.array(*[F.lit(v) for v in levels[n]])
        cols.append(F.element_at(arr, (F.floor(i / stride) % k + 1).cast("int")).alias(n))
        stride *= k
    return (spark.range(1).select(F.explode(F.sequence(F.lit(0), F.lit(total - 1))).alias("_i"))
                 .select((i + 1).cast("int").alias(id_col), *cols))


def level_grid(df: DataFrame, cols: Sequence[str], id_col: str = "grid_id", max_levels: int = 1000) -> DataFrame:
    """J06 over the levels of factor columns: every combination of their sorted
    distinct non-null values (first column fastest), laid out by
    :func:`expand_grid`.  The level lists are parameters of a search, so they
    are short: a column of more than ``max_levels`` values is an error."""
    levels = {}
    for c in cols:
        vals = [r[0] for r in df.select(c).where(F.col(c).isNotNull()).distinct().limit(max_levels + 1).collect()]
        if len(vals) > max_levels:
            raise ValueError(f"{c!r} has more than {max_levels} levels: not a parameter list")
        levels[c] = sorted(vals)
    if not all(levels.values()):
        return df.select(F.lit(0).alias(id_col), *cols).where(F.lit(False))
    return expand_grid(df.sparkSession, levels, id_col)


def broadcast_fixed(small: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast hint for a side that is small by nature (level lists,
    grids, lexicons), after counting it: more than ``max_rows`` rows get no
    hint and are left to the planner's measured sizes."""
    if small.limit(max_rows + 1).count() > max_rows:
        return small
    return F.broadcast(small)


# --------------------------------------------------------------------------
# A: aggregations
# --------------------------------------------------------------------------

def group_means(df: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """One row per key, mean of each measure (nulls skipped)."""
    return df.groupBy(*keys).agg(*[F.avg(m).alias(m) for m in measures])


def row_count(df: DataFrame, name: str = "n") -> DataFrame:
    """A02."""
    return df.agg(F.count(F.lit(1)).alias(name))


def count_by(df: DataFrame, keys: Sequence[str], name: str = "n", ordered: bool = False) -> DataFrame:
    """Rows per key (null is a group); optionally ordered by the keys."""
    out = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    return out.orderBy(*keys) if ordered else out


def monthly_sum(df: DataFrame, date_col: str, keys: Sequence[str], measure: str,
                name: str | None = None) -> DataFrame:
    """Sum of ``measure`` per month start and key vector."""
    return (df.groupBy(F.trunc(F.col(date_col), "MM").alias(date_col), *keys)
              .agg(F.sum(measure).alias(name or measure)))


def summary_stats(df: DataFrame, measure: str, by: str | None = None, low: int | None = None,
                  high: int | None = None, level_col: str = "level") -> DataFrame:
    """Mean, sd, min, max, valid N, missing N of ``measure`` overall and
    per ``F(by, low, high)`` level (rows outside the range leave the per-level
    part).  ``level`` is ``'all'`` for the overall row."""
    m = F.col(measure)
    stats = [F.avg(m).alias("mean"), F.stddev_samp(m).alias("sd"), F.min(m).alias("min"),
             F.max(m).alias("max"), F.count(m).alias("valid_n"),
             (F.count(F.lit(1)) - F.count(m)).alias("missing_n")]
    if by is None:
        return df.agg(*stats).select(F.lit("all").alias(level_col), "*")
    b = bin_factor(by, low, high).alias("_bin")
    g = df.select(b, m).groupingSets([[], ["_bin"]], "_bin").agg(*stats, F.grouping("_bin").alias("_g"))
    return (g.where((F.col("_g") == 1) | F.col("_bin").isNotNull())
             .select(F.when(F.col("_g") == 1, F.lit("all")).otherwise(F.col("_bin").cast("string"))
                      .alias(level_col), "mean", "sd", "min", "max", "valid_n", "missing_n"))


def cube_cells(df: DataFrame, measure: str, f1: tuple, f2: tuple, include_empty: bool = True) -> DataFrame:
    """Mean of ``measure`` and row count per cell of two binned factors
    ``(col, low, high)``; with ``include_empty`` every cell of the grid appears
    (mean null, count 0).  The grid is generated, not joined from data."""
    (c1, lo1, hi1), (c2, lo2, hi2) = f1, f2
    agg = (df.select(bin_factor(c1, lo1, hi1).alias(c1), bin_factor(c2, lo2, hi2).alias(c2), measure)
             .where(F.col(c1).isNotNull() & F.col(c2).isNotNull())
             .groupBy(c1, c2).agg(F.avg(measure).alias(measure), F.count(F.lit(1)).alias("Counts")))
    if not include_empty:
        return agg
    spark = df.sparkSession
    grid = (spark.range(1).select(F.explode(F.sequence(F.lit(lo1), F.lit(hi1))).alias(c1))
                 .select(c1, F.explode(F.sequence(F.lit(lo2), F.lit(hi2))).alias(c2)))
    return (agg.join(broadcast_fixed(grid, 1_000_000), on=[c1, c2], how="right")
            .withColumn("Counts", F.coalesce(F.col("Counts"), F.lit(0))))


def histogram(df: DataFrame, x: str, n_bins: int, by: str | None = None,
              lo=None, hi=None) -> DataFrame:
    """Counts per equal-width bin of ``x`` (1..n_bins), optionally per
    panel column ``by``.  Bounds default to the data's min/max (scalar
    subqueries); values on the top edge go to the last bin, values outside the
    bounds to bin 0 / n_bins + 1.  Columns: [by], bin, bin_low, bin_high, n."""
    lo_c = df.select(F.min(x).cast("double")).scalar() if lo is None else F.lit(float(lo))
    hi_c = df.select(F.max(x).cast("double")).scalar() if hi is None else F.lit(float(hi))
    v = F.col(x).cast("double")
    raw = F.floor((v - lo_c) * n_bins / (hi_c - lo_c)) + 1
    b = F.when(v == hi_c, F.lit(n_bins)).when(v > hi_c, F.lit(n_bins + 1)) \
         .when(v < lo_c, F.lit(0)).otherwise(raw).cast("int")
    keys = ([by] if by else []) + ["bin"]
    width = (hi_c - lo_c) / n_bins
    return (df.where(v.isNotNull()).select(*([by] if by else []), b.alias("bin"))
              .groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
              .withColumn("bin_low", lo_c + (F.col("bin") - 1) * width)
              .withColumn("bin_high", lo_c + F.col("bin") * width))


def crosstab_long(df: DataFrame, a: str, b: str, name: str = "n") -> DataFrame:
    """Counts per (a, b) cell, long layout."""
    return df.groupBy(a, b).agg(F.count(F.lit(1)).alias(name))


def _levels(df: DataFrame, col: str, values: Sequence | None) -> tuple[DataFrame, list]:
    """The levels that become columns: from the data if ``values`` is None
    (Spark refuses more than ``spark.sql.pivotMaxValues``), else as listed; a
    value outside the list fails the query instead of vanishing."""
    if values is None:
        most = int(df.sparkSession.conf.get("spark.sql.pivotMaxValues"))
        found = [r[0] for r in df.select(col).where(F.col(col).isNotNull()).distinct().limit(most + 1).collect()]
        if len(found) > most:
            raise ValueError(f"{col} has more than {most} levels")
        return df, sorted(found)
    bad = F.concat(F.lit(f"{col} has a value outside the listed levels: "), F.col(col).cast("string"))
    listed = F.when(F.col(col).isNull() | F.col(col).isin(list(values)), F.col(col)).otherwise(F.raise_error(bad))
    return df.withColumn(col, listed), list(values)


def crosstab_wide(df: DataFrame, rows: str, cols: str, values: Sequence | None = None) -> DataFrame:
    """A09 wide layout; ``values`` lists the column levels (no extra pass),
    None takes them from the data."""
    df, values = _levels(df, cols, values)
    return df.groupBy(rows).pivot(cols, values).count().fillna(0)


def crosstab_predicates(df: DataFrame, by: str, predicates: Mapping[str, Column]) -> DataFrame:
    """A10: per level of ``by``, how many rows satisfy each predicate -- all
    predicates in one scan."""
    return df.groupBy(by).agg(*[F.count_if(p).alias(n) for n, p in predicates.items()])


def distinct_counts(df: DataFrame, cols: Sequence[str] | None = None, exact: bool = True,
                    rsd: float = 0.01) -> DataFrame:
    """Distinct values per column, long layout (column, n_distinct).
    ``exact=False`` uses HyperLogLog sketches (bounded memory per column)."""
    cols = list(cols or df.columns)
    f = (lambda c: F.count_distinct(F.col(c))) if exact else \
        (lambda c: F.approx_count_distinct(F.col(c), rsd))
    row = df.agg(*[f(c).alias(f"_{i}") for i, c in enumerate(cols)])
    stack = ", ".join(f"'{c}', `_{i}`" for i, c in enumerate(cols))
    return row.selectExpr(f"stack({len(cols)}, {stack}) AS (column, n_distinct)")


def mean_of_means(df: DataFrame, inner: Sequence[str], outer: Sequence[str], measure: str,
                  name: str = "score") -> DataFrame:
    """Mean of ``measure`` per ``inner`` keys, then the mean of those means
    per ``outer`` keys (``outer`` must be a subset of ``inner``)."""
    per = df.groupBy(*inner).agg(F.avg(measure).alias("_m"))
    return per.groupBy(*outer).agg(F.avg("_m").alias(name))


def arg_min(df: DataFrame, by: Sequence[str], score: str, tiebreak: str) -> DataFrame:
    """The row with the smallest ``score`` per group; ties go to the
    smallest ``tiebreak`` (``which.min`` keeps the first).  ``min_by`` is a
    mergeable aggregate, so hot groups are pre-aggregated map-side."""
    by = _names(by)
    others = [c for c in df.columns if c not in by]
    best = F.min_by(F.struct(*[F.col(c) for c in others]),
                    F.struct(F.col(score), F.col(tiebreak))).alias("_best")
    return (df.where(F.col(score).isNotNull()).groupBy(*by).agg(best)
              .select(*by, *[F.col(f"_best.{c}").alias(c) for c in others]))


def arg_max_all(df: DataFrame, by: Sequence[str], score: str) -> DataFrame:
    """All rows reaching the group maximum of ``score`` (ties kept).
    Joins back to the pre-aggregated maxima on (group, score) -- no window."""
    by = _names(by)
    mx = df.groupBy(*by).agg(F.max(score).alias(score))
    return df.join(mx, on=by + [score], how="left_semi")


def grouping_set_sums(df: DataFrame, time_col: str, keys: Sequence[str], measure: str,
                      sets: Sequence[Sequence[str]] | None = None, name: str | None = None) -> DataFrame:
    """Sums at the total, each single key and the bottom level (or the
    given ``sets``) per time step, in one pass (``GROUPING SETS``).

    Adds ``gid``: bit i set when key i is rolled up (first key = highest bit)."""
    keys = list(keys)
    if sets is None:
        sets = [[]] + [[k] for k in keys] + [keys]
    gs = [[time_col] + list(s) for s in sets]
    n = len(keys)
    gid = reduce(lambda a, b: a + b,
                 [F.grouping(k) * (1 << (n - 1 - i)) for i, k in enumerate(keys)]).cast("int")
    return df.groupingSets(gs, time_col, *keys).agg(F.sum(measure).alias(name or measure), gid.alias("gid"))


def distinct_rows(df: DataFrame, cols: Sequence[str], keep_lowest: str | None = None) -> DataFrame:
    """One row per distinct ``cols``; with ``keep_lowest`` the row with
    the smallest id is kept (all of its columns)."""
    if keep_lowest is None:
        return df.select(*cols).distinct()
    return arg_min(df, cols, keep_lowest, keep_lowest)


# --------------------------------------------------------------------------
# O: sorts and top-n
# --------------------------------------------------------------------------

def sort(df: DataFrame, *cols, descending: bool = False) -> DataFrame:
    """O01."""
    return df.orderBy(*[F.col(c).desc() if descending else F.col(c) for c in cols])


def top_n(df: DataFrame, n: int, order: Sequence) -> DataFrame:
    """First n rows in a total order (TakeOrderedAndProject: each task
    keeps only n rows)."""
    return df.orderBy(*order).limit(n)


def category_extremes(df: DataFrame, category_col: str, category: str, score_col: str,
                      tail_fraction: float = 0.01, upper: bool = True, exact: bool = True) -> DataFrame:
    """Rows of one category in the upper (or lower) tail of
    ``log10(score)``, sorted by score descending.

    The threshold is the (1 - tail) (or tail) quantile -- exact by a
    distributed sort, or a sketch -- used as a scalar subquery."""
    from loam.operators.ranking import quantile_value
    from loam.functions.scalar import log10_or_null
    sub = (df.where(F.col(category_col) == category)
             .withColumn("log10" + score_col, log10_or_null(score_col)))
    p = 1.0 - tail_fraction if upper else tail_fraction
    t = quantile_value(sub, "log10" + score_col, p, exact=exact)
    lc = F.col("log10" + score_col)
    return sub.where(lc > t if upper else lc < t).orderBy(F.col(score_col).desc())


# --------------------------------------------------------------------------
# R: set and reshape operators
# --------------------------------------------------------------------------

def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Union all, matched by column name; missing columns -> null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def wide_to_long(df: DataFrame, ids: Sequence[str], values: Sequence[str], var_name: str,
                 value_name: str) -> DataFrame:
    """``gather``."""
    return df.unpivot(list(ids), list(values), var_name, value_name)


def long_to_wide(df: DataFrame, ids: Sequence[str], pivot_col: str, values: Sequence | None,
                 measure: str, fill=0.0) -> DataFrame:
    """``spread`` with fill; ``values`` fixes the output columns (no
    extra distinct pass, bounded width), None takes them from the data."""
    df, values = _levels(df, pivot_col, values)
    out = df.groupBy(*ids).pivot(pivot_col, values).agg(F.sum(measure))
    return out.fillna(fill, subset=[str(v) for v in values])


def unite(df: DataFrame, cols: Sequence[str], name: str, sep: str = "_", keep: bool = True) -> DataFrame:
    """Join key columns into one display name (keys kept by default,
    since values may contain ``sep``)."""
    out = df.withColumn(name, F.concat_ws(sep, *[F.col(c).cast("string") for c in cols]))
    return out if keep else out.drop(*cols)


def separate(df: DataFrame, col: str, into: Sequence[str], sep: str = "_") -> DataFrame:
    """Split a united name back into columns at the literal ``sep`` (exact
    only if no value contains it)."""
    parts = F.split(F.col(col), "\\Q" + sep.replace("\\E", "\\E\\\\E\\Q") + "\\E", -1)
    return df.withColumns({n: parts.getItem(i) for i, n in enumerate(into)})


def transpose(df: DataFrame, id_col: str, value_cols: Sequence[str], new_ids: Sequence | None,
              var_name: str = "column") -> DataFrame:
    """Rows <-> columns for a small table: unpivot then pivot on the
    old row ids (``new_ids`` lists them, None takes them from the data)."""
    df, new_ids = _levels(df, id_col, new_ids)
    long = df.unpivot([id_col], list(value_cols), var_name, "_v")
    return long.groupBy(var_name).pivot(id_col, list(new_ids)).agg(F.first("_v"))


def column_difference(cols: Sequence[str], drop: Sequence[str]) -> list[str]:
    """``setdiff`` on column names, order kept."""
    d = set(drop)
    return [c for c in cols if c not in d]
