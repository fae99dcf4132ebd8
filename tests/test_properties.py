"""Property checks."""

from __future__ import annotations

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loam.operators import metrics as mt
from loam.operators import sampling as smp
from loam.operators.ranking import equal_sets, exact_quantiles, group_row_number


def test_folds_partition_rows_and_fractions_nest(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    tagged = [smp.tag_rows(df, "k", 4, 2, p, 11) for p in (0.1, 0.5, 1.0)]
    folds = tagged[0].groupBy("kfold").count().collect()
    assert sum(r["count"] for r in folds) == 5000 and len(folds) == 4
    sets = [set(r["k"] for r in t.where("in_training_set").select("k").collect()) for t in tagged]
    assert sets[0] <= sets[1] <= sets[2]
    test = set(r["k"] for r in tagged[2].where("in_test_set").select("k").collect())
    assert not (test & sets[2]) and len(test | sets[2]) == 5000


def test_exact_training_rows_count(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    t = smp.tag_rows_exact(df, "k", 3, 1, 0.25, 5)
    cand = t.where(~F.col("in_test_set")).count()
    assert t.where("in_training_set").count() == int(np.floor(cand * 0.25))


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(0, 1, allow_nan=False), min_size=10, max_size=60),
       st.lists(st.integers(0, 1), min_size=60, max_size=60))
def test_auc_of_score_and_complement_sum_to_one(spark, scores, labels):
    rows = [(s, labels[i]) for i, s in enumerate(scores)]
    if len({y for _, y in rows}) < 2:
        return
    df = spark.createDataFrame(rows, "s double, y int")
    a = mt.bucketed_auc(df, "s", "y").first()["auc"]
    b = mt.bucketed_auc(df.withColumn("s", 1 - F.col("s")), "s", "y").first()["auc"]
    # buckets are right-closed, so 1 - s can share a bucket boundary differently; tolerance
    assert abs(a + b - 1) < 0.05


def test_group_row_number_matches_window(spark):
    from pyspark.sql import Window
    df = spark.range(3000).select((F.col("id") % 7).alias("g"), (F.col("id") * 7919 % 1000).alias("v"), "id")
    ours = group_row_number(df, ["v", "id"], ["g"], name="rn")
    ref = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("v", "id")) - 1)
    assert ours.exceptAll(ref.select(*ours.columns)).count() == 0


def test_exact_quantiles_match_numpy(spark):
    vals = np.random.default_rng(3).normal(size=777)
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = {r["prob"]: r["value"] for r in exact_quantiles(df, "x", probs).collect()}
    for p in probs:
        assert abs(got[p] - np.quantile(vals, p)) < 1e-12


def test_equal_sets_like_ntile(spark):
    df = spark.range(10).withColumnRenamed("id", "k")
    sizes = sorted(r["count"] for r in equal_sets(df, 4, ["k"]).groupBy("set_id").count().collect())
    assert sizes == [2, 2, 3, 3]


def test_anti_join_equals_except_all_on_keys(spark):
    from loam.operators.relational import anti_join
    a = spark.range(100).withColumnRenamed("id", "k")
    b = spark.range(0, 100, 3).withColumnRenamed("id", "k")
    assert sorted(r[0] for r in anti_join(a, b, ["k"]).collect()) == sorted(
        r[0] for r in a.exceptAll(b).collect())


def test_sketch_quantiles_within_rank_error(spark):
    from loam.operators.ranking import approx_quantiles
    vals = np.sort(np.random.default_rng(5).normal(size=5000))
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    probs = [0.05, 0.25, 0.5, 0.75, 0.95]
    got = {r["prob"]: r["value"] for r in approx_quantiles(df, "x", probs, accuracy=1000).collect()}
    for p in probs:
        rank = np.searchsorted(vals, got[p]) / len(vals)
        assert abs(rank - p) <= 2.0 / 1000 + 1.0 / len(vals)
