"""Checks for evaluation metrics on a score column."""

from __future__ import annotations

from pyspark.sql import functions as F

from loam.operators import metrics as mt
from loam.operators import sampling as smp
from loam.sources.views import view, with_ctes
from loam.suite import query, r6, s6

_LONG = """long AS (SELECT event_id, is_real AS label, 'p' AS model, Probability AS score FROM scored
   UNION ALL SELECT event_id, is_real, 'q', (event_id % 997) / 997e0 FROM scored)"""
_BUCKETS = """b AS (SELECT model, CAST(greatest(ceil(score * 1000) - 1, 0) AS INT) AS bucket,
      CAST(sum(label) AS BIGINT) AS positives, count(*) AS total FROM long
      WHERE score BETWEEN 0 AND 1 AND label IS NOT NULL GROUP BY 1, 2)"""
_ROC = """r AS (SELECT model, bucket, positives, total,
      sum(positives) OVER w / sum(positives) OVER (PARTITION BY model) AS tpr,
      sum(total - positives) OVER w / sum(total - positives) OVER (PARTITION BY model) AS fpr
      FROM b WINDOW w AS (PARTITION BY model ORDER BY bucket DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""


def _long(spark, sf):
    s = view(spark, sf, "scored").withColumn("q", (F.col("event_id") % 997) / F.lit(997.0))
    return mt.scores_long(s.withColumnRenamed("Probability", "p"), ["p", "q"], "is_real", keep=["event_id"])


@query("A13_score_bucket_counts", with_ctes(["scored"], _LONG + ",\n" + _BUCKETS, "SELECT * FROM b"))
def q_a13(spark, sf):
    return mt.score_buckets(_long(spark, sf), "score", "is_real", ["model"])


@query("W01_E05_roc_points", with_ctes(["scored"], _LONG + ",\n" + _BUCKETS + ",\n" + _ROC,
       f"SELECT model, bucket, positives, total, {s6('tpr')} AS tpr, {s6('fpr')} AS fpr FROM r"))
def q_w01(spark, sf):
    b = mt.score_buckets(_long(spark, sf), "score", "is_real", ["model"])
    return r6(mt.roc_points(b, ["model"]), "tpr", "fpr")


_AUC = ("SELECT model, " + s6("sum(tpr * (fpr - coalesce(pf, 0))) - sum((tpr - coalesce(pt, 0)) * "
        "(fpr - coalesce(pf, 0))) / 2") + " AS auc FROM (SELECT *, lag(fpr) OVER v AS pf, lag(tpr) OVER v AS pt "
        "FROM r WINDOW v AS (PARTITION BY model ORDER BY bucket DESC)) GROUP BY model")


@query("W02_E06_E07_bucketed_auc", with_ctes(["scored"], _LONG + ",\n" + _BUCKETS + ",\n" + _ROC, _AUC))
def q_w02(spark, sf):
    return r6(mt.bucketed_auc(_long(spark, sf), "score", "is_real", ["model"]), "auc")


_TIED = """e AS (SELECT event_id % 5 AS run, Probability AS score, is_real AS label FROM scored
   UNION ALL SELECT 5, CASE WHEN event_id % 10 = 0 THEN Probability ELSE 0.5e0 END, is_real FROM scored
   UNION ALL SELECT NULL, floor(Probability * 3), is_real FROM scored),
c AS (SELECT run, score, sum(label) AS p, sum(1 - label) AS n FROM e WHERE score IS NOT NULL AND label IS NOT NULL GROUP BY run, score),
u AS (SELECT run, p, n, coalesce(sum(n) OVER (PARTITION BY run ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS low FROM c)"""


@query("E06_exact_auc", with_ctes(["scored"], _TIED, "SELECT CAST(run AS BIGINT) AS run, "
       + s6("sum(p * (2 * low + n)) / (2e0 * sum(p) * sum(n))") + " AS auc FROM u GROUP BY run"))
def q_e06_exact(spark, sf):
    """The exact area of seven models, one with 90 % and one with nearly all scores tied."""
    s = view(spark, sf, "scored")
    p, label = F.col("Probability"), F.col("is_real").alias("label")
    runs = (s.select((F.col("event_id") % 5).alias("run"), p.alias("score"), label)
             .unionByName(s.select(F.lit(5).cast("long").alias("run"), F.when(F.col("event_id") % 10 == 0, p).otherwise(0.5).alias("score"), label))
             .unionByName(s.select(F.lit(None).cast("long").alias("run"), F.floor(p * 3).cast("double").alias("score"), label)))
    return r6(mt.exact_auc(runs, "score", "label", ["run"]), "auc")


@query("W02_literal_first_difference_auc", with_ctes(["scored"], _LONG + ",\n" + _BUCKETS + ",\n" + _ROC,
       "SELECT model, " + s6("sum(tpr * coalesce(fpr - pf, 0)) - sum((tpr - pt) * (fpr - pf)) / 2")
       + " AS auc FROM (SELECT *, lag(fpr) OVER v AS pf, lag(tpr) OVER v AS pt FROM r "
       "WINDOW v AS (PARTITION BY model ORDER BY bucket DESC)) GROUP BY model"))
def q_w02b(spark, sf):
    return r6(mt.bucketed_auc(_long(spark, sf), "score", "is_real", ["model"], anchor=False), "auc")


@query("E04_residual_column", with_ctes(["scored"], "",
       "SELECT event_id, category, Probability - is_real AS residual FROM scored"))
def q_e04(spark, sf):
    s = view(spark, sf, "scored")
    return mt.residuals(s, "Probability", "is_real").select("event_id", "category", "residual")


@query("A14_E08_rmse", with_ctes(["scored"], "",
       f"SELECT category, {s6('sqrt(sum((Probability - is_real) * (Probability - is_real)) / count(Probability - is_real))')} "
       "AS rmse, count(Probability - is_real) AS n FROM scored GROUP BY category"))
def q_a14(spark, sf):
    return r6(mt.rmse(view(spark, sf, "scored"), "Probability", "is_real", ["category"]), "rmse")


@query("E10_training_set_size", with_ctes(["scored"], "",
       f"SELECT CAST(count_if(({smp.hash_sql('event_id', 5)} % 3 + 1) <> 1 AND "
       f"{smp.hash_sql('event_id', '5:train')} < {int(0.25 * 2 ** 32)}) AS BIGINT) AS tss FROM scored"))
def q_e10(spark, sf):
    t = smp.tag_rows(view(spark, sf, "scored"), "event_id", 3, 1, 0.25, 5)
    return mt.training_set_size(t)


def _auc_reducer(pdf):
    """Running true/false-positive shares from the top bucket down, then the
    trapezoid area anchored at (0, 0) -- state carried through the rows."""
    import pandas as pd
    g = pdf.sort_values("bucket", ascending=False)
    tp, fp = g["positives"].astype(float), (g["total"] - g["positives"]).astype(float)
    tpr, fpr = tp.cumsum() / tp.sum(), fp.cumsum() / fp.sum()
    dfpr = fpr.diff().fillna(fpr.iloc[0])
    dtpr = tpr.diff().fillna(tpr.iloc[0])
    auc = float((tpr * dfpr).sum() - (dtpr * dfpr).sum() / 2)
    return pd.DataFrame({"model": [g["model"].iloc[0]], "auc": [round(auc, 6) + 0.0]})


@query("U03_grouped_state_function", with_ctes(["scored"], _LONG + ",\n" + _BUCKETS + ",\n" + _ROC, _AUC))
def q_u03(spark, sf):
    from loam.operators.batch import grouped_state
    b = mt.score_buckets(_long(spark, sf), "score", "is_real", ["model"])   # <= 1000 rows per model
    return grouped_state(b, ["model"], _auc_reducer, "model string, auc double")
