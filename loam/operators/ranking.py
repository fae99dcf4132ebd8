"""Exact ranks without single-task windows.

``row_number().over(Window.partitionBy(g).orderBy(x))`` puts each group into
one task; with one group holding a third of all rows that task holds a third
of the data.  The operators here get the same exact numbers from a
range-partitioned sort instead:

1. ``orderBy(group, order)``: range exchange + local sort, spread over all
   partitions however skewed the groups are; the sorted rows are **written
   once**, each with the number of its sort partition and its place in it, so
   every later step reads the same partitioning (a second evaluation of the
   sort would sample other bounds);
2. per (partition, group): row count and first place -- a table with at most
   ``#partitions + #groups`` rows;
3. a window over that small table gives, for each (partition, group), how many
   rows of the group sit in earlier partitions;
4. rank = rows before + position inside the partition.

Quantiles count each distinct value first and rank the values, so tied values
are one row, never one task.

Used by exact quantiles (A11, O03), exact training fractions (H09, W04) and
equal-size row sets (H05).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loam.session import materialize


def _names(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def group_row_number(df: DataFrame, order_cols: Sequence, group_cols: Sequence[str] = (),
                     name: str = "rn", size_name: str | None = None) -> DataFrame:
    """Add ``name`` = exact 0-based position of each row inside its group when
    sorted by ``order_cols`` (ascending; pass Columns for other orders).

    Give ``order_cols`` a unique tie-breaker if tied rows must get stable
    numbers.  ``size_name`` adds the group's row count.
    """
    group_cols = _names(group_cols)
    order = [F.col(c) if isinstance(c, str) else c for c in order_cols]
    keys = [F.col(g).asc_nulls_first() for g in group_cols] + order
    s = materialize(df.orderBy(*keys)
                      .withColumn("_pid", F.spark_partition_id())
                      .withColumn("_mid", F.monotonically_increasing_id()), "sorted")
    stats = s.groupBy("_pid", *group_cols).agg(F.count(F.lit(1)).alias("_n"),
                                               F.min("_mid").alias("_first"))
    w_before = Window.partitionBy(*group_cols).orderBy("_pid").rowsBetween(
        Window.unboundedPreceding, -1)
    stats = stats.withColumn("_before", F.coalesce(F.sum("_n").over(w_before), F.lit(0)))
    if size_name:
        stats = stats.withColumn(size_name, F.sum("_n").over(Window.partitionBy(*group_cols)))
    # Without group columns the offsets table has at most one row per
    # partition (a proven bound), so it is broadcast and the sorted rows stay
    # where they are; with groups its size follows the group count and AQE
    # decides from the measured size.
    st = (F.broadcast(stats) if not group_cols else stats).alias("st")
    cond = [F.col("s._pid") == F.col("st._pid")]
    cond += [F.col(f"s.{g}").eqNullSafe(F.col(f"st.{g}")) for g in group_cols]
    keep = [F.col(f"s.{c}") for c in df.columns]
    extra = [(F.col("st._before") + F.col("s._mid") - F.col("st._first")).alias(name)]
    if size_name:
        extra.append(F.col(f"st.{size_name}"))
    return s.alias("s").join(st, on=cond, how="inner").select(*keep, *extra)


def _value_ranks(counts: DataFrame, group_cols: Sequence[str]) -> DataFrame:
    """Distinct values (groups, _v, _n) with ``_rn``, the rank of a value's
    first row in its group, and ``_size``, the group's rows."""
    keys = [F.col(g).asc_nulls_first() for g in group_cols] + [F.col("_v")]
    s = materialize(counts.orderBy(*keys).withColumn("_pid", F.spark_partition_id())
                          .withColumn("_mid", F.monotonically_increasing_id()), "values")
    parts = s.groupBy("_pid", *group_cols).agg(F.sum("_n").alias("_rows"))
    upto = Window.partitionBy(*group_cols).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumns({"_before": F.coalesce(F.sum("_rows").over(upto), F.lit(0)),
                               "_size": F.sum("_rows").over(Window.partitionBy(*group_cols))})
    inside = Window.partitionBy("_pid", *group_cols).orderBy("_mid").rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumn("_in", F.coalesce(F.sum("_n").over(inside), F.lit(0))).alias("s")
    cond = [F.col("s._pid") == F.col("p._pid")]
    cond += [F.col(f"s.{g}").eqNullSafe(F.col(f"p.{g}")) for g in group_cols]
    return s.join(parts.alias("p"), on=cond).select(
        *[F.col(f"s.{g}") for g in group_cols], "s._v", "s._n", (F.col("_before") + F.col("_in")).alias("_rn"), "_size")


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float],
                    group_cols: Sequence[str] = (), prob_name: str = "prob",
                    value_name: str = "value") -> DataFrame:
    """Exact quantiles with linear interpolation (type 7; equals
    ``percentile`` / DuckDB ``quantile_cont``), one row per (group, prob).

    Nulls are skipped.  Values are counted first, so ties of any number are
    one row; a distinct value stands for the ranks from the count of smaller
    values on.  Only the <= 2 values per requested probability leave the sort.
    """
    group_cols = _names(group_cols)
    probs = [float(p) for p in probs]
    x = df.select(*group_cols, F.col(col).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    ranked = _value_ranks(x.groupBy(*group_cols, "_v").agg(F.count(F.lit(1)).alias("_n")), group_cols)
    parr = F.array(*[F.lit(p) for p in probs])
    h = lambda p: (F.col("_size") - 1).cast("double") * p
    at = lambda r: (r >= F.col("_rn")) & (r < F.col("_rn") + F.col("_n"))
    needed = ranked.where(F.exists(parr, lambda p: at(F.floor(h(p))) | at(F.ceil(h(p)))))
    hit = (needed
           .select(*group_cols, "_v", "_rn", "_n", "_size", F.explode(parr).alias(prob_name))
           .withColumn("_h", h(F.col(prob_name)))
           .where(at(F.floor("_h")) | at(F.ceil("_h"))))
    agg = hit.groupBy(*group_cols, prob_name).agg(
        F.max(F.when(at(F.floor("_h")), F.col("_v"))).alias("_lo"),
        F.max(F.when(at(F.ceil("_h")), F.col("_v"))).alias("_hi"),
        F.first("_h").alias("_h"))
    frac = F.col("_h") - F.floor("_h")
    return agg.select(*group_cols, prob_name,
                      (F.col("_lo") + frac * (F.col("_hi") - F.col("_lo"))).alias(value_name))


def approx_quantiles(df: DataFrame, col: str, probs: Sequence[float],
                     group_cols: Sequence[str] = (), accuracy: int = 10000,
                     prob_name: str = "prob", value_name: str = "value") -> DataFrame:
    """A11, sketch form: ``percentile_approx`` (mergeable, bounded memory)."""
    group_cols = _names(group_cols)
    probs = [float(p) for p in probs]
    agg = df.groupBy(*group_cols).agg(
        F.percentile_approx(F.col(col).cast("double"), probs, accuracy).alias("_q"))
    return agg.select(*group_cols, F.posexplode("_q").alias("_i", value_name)).select(
        *group_cols, F.element_at(F.array(*[F.lit(p) for p in probs]), F.col("_i") + 1).alias(prob_name),
        value_name)


def sketch_rank_error(k: int) -> float:
    """The rank error (a share of the rows) that a KLL sketch of size ``k`` keeps
    with 99 % confidence, merged or not; sketches of fewer than ``k`` values are exact."""
    return 2.296 / k ** 0.9021


def quantile_sketches(df: DataFrame, col: str, by: Sequence[str], k: int = 4096, name: str = "sketch") -> DataFrame:
    """A11, stored form: one mergeable KLL sketch a group (binary, a few times
    ``k`` numbers whatever the rows).  Write it as a table: later questions about
    any union of groups read the sketches, not the rows.  Nulls are not counted."""
    x = F.col(col).cast("double")
    return df.where(x.isNotNull()).groupBy(*_names(by)).agg(F.kll_sketch_agg_double(x, k).alias(name))


def sketch_quantiles(sketches: DataFrame, probs: Sequence[float], by: Sequence[str] = (), k: int = 4096, name: str = "sketch",
                     prob_name: str = "prob", value_name: str = "value") -> DataFrame:
    """Quantiles of the union of all sketches with equal ``by`` (of all, without):
    rows (by.., n, prob, value), each value within :func:`sketch_rank_error`."""
    by = _names(by)
    merged = sketches.groupBy(*by).agg(F.kll_merge_agg_double(name, k).alias("_s")).where(F.col("_s").isNotNull())
    ranks = F.array(*[F.lit(float(p)) for p in probs])
    return (merged.select(*by, F.kll_sketch_get_n_double("_s").alias("n"), ranks.alias("_p"),
                          F.kll_sketch_get_quantile_double("_s", ranks).alias("_v"))
                  .select(*by, "n", F.explode(F.arrays_zip("_p", "_v")).alias("_z"))
                  .select(*by, "n", F.col("_z._p").alias(prob_name), F.col("_z._v").alias(value_name)))


def quantile_value(df: DataFrame, col: str, prob: float, exact: bool = True) -> Column:
    """One quantile as a scalar-subquery Column (lazy; no driver round trip)."""
    q = (exact_quantiles(df, col, [prob]) if exact else approx_quantiles(df, col, [prob]))
    return q.select("value").scalar()


def equal_sets(df: DataFrame, n_sets: int, order_cols: Sequence, name: str = "set_id") -> DataFrame:
    """``n_sets`` row sets whose sizes differ by at most one (like
    ``ntile``), numbered 1..n, without a single-task window."""
    r = group_row_number(df, order_cols, (), name="_rn", size_name="_size")
    base = F.floor(F.col("_size") / n_sets)
    rem = F.col("_size") - base * n_sets          # the first `rem` sets get one extra row
    big = rem * (base + 1)
    sid = F.when(F.col("_rn") < big, F.floor(F.col("_rn") / (base + 1))) \
           .otherwise(rem + F.floor((F.col("_rn") - big) / base))
    return r.withColumn(name, (sid + 1).cast("int")).drop("_rn", "_size")
