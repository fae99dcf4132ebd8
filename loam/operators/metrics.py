"""Evaluation metrics as aggregations.

ROC and AUC go through score buckets: one partial-aggregated pass reduces the
scored rows to at most ``n_buckets`` rows per model, and only those few rows
meet a window.  No global sort of the scored rows is ever needed (an
unpartitioned window over all rows would run in one task).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _names(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def bucket_of(score, n_buckets: int = 1000) -> Column:
    """Right-closed buckets on [0, 1] with the lowest edge included:
    score in ((k)/n, (k+1)/n] -> k, score 0 -> 0."""
    s = F.col(score) if isinstance(score, str) else score
    return F.greatest(F.ceil(s * n_buckets) - 1, F.lit(0)).cast("int")


def score_buckets(df: DataFrame, score: str, label: str, by: Sequence[str] = (),
                  n_buckets: int = 1000) -> DataFrame:
    """Positives and totals per score bucket (scores outside [0, 1]
    have no bucket and are left out)."""
    by = _names(by)
    s = F.col(score)
    return (df.where(s.between(0, 1) & F.col(label).isNotNull())
              .groupBy(*by, bucket_of(score, n_buckets).alias("bucket"))
              .agg(F.sum(F.col(label).cast("long")).alias("positives"),
                   F.count(F.lit(1)).alias("total")))


def roc_points(buckets: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Cumulative true- and false-positive rates, highest bucket
    first, one row per bucket (<= n_buckets rows per model)."""
    by = _names(by)
    w = Window.partitionBy(*by).orderBy(F.col("bucket").desc()).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*by)
    neg = F.col("total") - F.col("positives")
    # one class only -> the rate of the missing class is undefined (null)
    return (buckets.withColumn("tpr", F.try_divide(F.sum("positives").over(w), F.sum("positives").over(whole)))
                   .withColumn("fpr", F.try_divide(F.sum(neg).over(w), F.sum(neg).over(whole))))


def auc_from_roc(roc: DataFrame, by: Sequence[str] = (), anchor: bool = True) -> DataFrame:
    """Trapezoid area under the ROC points.

    ``anchor=True`` starts the curve at (0, 0); ``anchor=False`` gives the
    literal first-difference formula that leaves out the first segment."""
    by = _names(by)
    w = Window.partitionBy(*by).orderBy(F.col("bucket").desc())
    prev_f = F.lag("fpr", 1).over(w)
    prev_t = F.lag("tpr", 1).over(w)
    if anchor:
        prev_f, prev_t = F.coalesce(prev_f, F.lit(0.0)), F.coalesce(prev_t, F.lit(0.0))
    d = roc.withColumn("dfpr", F.col("fpr") - prev_f).withColumn("dtpr", F.col("tpr") - prev_t)
    return d.groupBy(*by).agg(
        (F.sum(F.col("tpr") * F.coalesce(F.col("dfpr"), F.lit(0.0)))
         - F.sum(F.col("dtpr") * F.col("dfpr")) / 2).alias("auc"))


def bucketed_auc(df: DataFrame, score: str, label: str, by: Sequence[str] = (),
                 n_buckets: int = 1000, anchor: bool = True) -> DataFrame:
    """A13 -> W01 -> W02 in one plan."""
    return auc_from_roc(roc_points(score_buckets(df, score, label, by, n_buckets), by), by, anchor)


def scores_long(df: DataFrame, score_cols: Sequence[str], label: str, keep: Sequence[str] = (),
                model_col: str = "model", score_col: str = "score") -> DataFrame:
    """Several score columns as one long (model, score) table."""
    return df.unpivot([*keep, label], list(score_cols), model_col, score_col)


def roc_curve(df: DataFrame, score_cols: Sequence[str], label: str, n_buckets: int = 1000) -> DataFrame:
    """ROC points for one or many score columns (long layout)."""
    long = scores_long(df, score_cols, label)
    return roc_points(score_buckets(long, "score", label, ["model"], n_buckets), ["model"])


def residuals(df: DataFrame, prediction: str, label: str, name: str = "residual") -> DataFrame:
    """``prediction - label``."""
    return df.withColumn(name, F.col(prediction) - F.col(label))


def rmse(df: DataFrame, prediction: str, label: str, by: Sequence[str] = (), name: str = "rmse") -> DataFrame:
    """sqrt(SSE / n) over rows where the residual is known."""
    by = _names(by)
    r = F.col(prediction) - F.col(label)
    return df.groupBy(*by).agg(F.sqrt(F.sum(r * r) / F.count(r)).alias(name),
                               F.count(r).alias("n"))


def training_set_size(df: DataFrame, flag_col: str = "in_training_set") -> DataFrame:
    """Exact count of training rows."""
    return df.agg(F.count_if(F.col(flag_col)).alias("tss"))


def metric_for(kind: str):
    """Regression -> RMSE, classification -> AUC."""
    if kind == "regression":
        return lambda df, pred, label, by=(): rmse(df, pred, label, by).select(*_names(by), F.col("rmse").alias("metric"))
    if kind == "classification":
        return lambda df, pred, label, by=(): bucketed_auc(df, pred, label, by).select(*_names(by), F.col("auc").alias("metric"))
    raise ValueError(f"unknown task kind: {kind}")


def counted_scores(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows (by.., score, positives, total) of the distinct known scores; -0.0
    counts as 0.0, rows without a label or with a score that is no number are left out."""
    s = F.col(score).cast("double")
    return (df.where(s.isNotNull() & ~F.isnan(s) & F.col(label).isNotNull())
              .groupBy(*_names(by), F.when(s == 0, 0.0).otherwise(s).alias("score"))
              .agg(F.sum(F.col(label).cast("long")).alias("positives"), F.count(F.lit(1)).alias("total")))


def exact_auc(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """The exact area under the ROC curve of every model, ties counted half:
    the share of (positive, negative) pairs that the score puts in order.

    Scores are counted first, so ties cost one row however many there are.  The
    counted rows are sorted by range once and written; a row's negatives below it
    are those earlier in its part plus the sum of the parts before, so a model
    with a third of all scores is spread over all tasks, and no window holds one.
    The pair count is a decimal: exact up to 1e19 rows a class.  Null for a model
    of one class."""
    from loam.session import materialize
    by = _names(by)
    n = F.col("total") - F.col("positives")
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = counted_scores(df, score, label, by).repartitionByRange(parts, *by, "score")
    rows = materialize(keyed.sortWithinPartitions(*by, "score").withColumn("part", F.spark_partition_id()), "auc")
    group = [F.col(c) for c in by] or [F.lit(0)]
    inside = Window.partitionBy(*group, "part").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    # one row a model and part: the sums of the parts before it
    sums = rows.groupBy(*by, "part").agg(F.sum(n).alias("negatives"))
    before = Window.partitionBy(*group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.withColumn("before", F.coalesce(F.sum("negatives").over(before), F.lit(0))).drop("negatives")
    on = F.col("s.part") == F.col("o.part")
    for c in by:
        on = on & F.col(f"s.{c}").eqNullSafe(F.col(f"o.{c}"))
    # parts times models rows: as many as the sort has tasks, and one more for each model
    joined = rows.alias("s").join(offsets.alias("o"), on).select(
        *[F.col(f"s.{c}").alias(c) for c in by], F.col("s.part").alias("part"), "score", "positives", "total", "before")
    low = F.coalesce(F.sum(n).over(inside), F.lit(0)) + F.col("before")
    pairs = joined.withColumn("low", low).select(*by, "positives", n.alias("negatives"), (
        F.col("positives").cast("decimal(19,0)") * (2 * F.col("low") + n).cast("decimal(19,0)")).alias("twice"))
    got = pairs.groupBy(*by).agg(F.sum("twice").alias("twice"), F.sum("positives").alias("p"), F.sum("negatives").alias("n"))
    size = F.col("p").cast("double") * F.col("n").cast("double")
    return got.select(*by, F.try_divide(F.col("twice").cast("double"), 2 * size).alias("auc"))
