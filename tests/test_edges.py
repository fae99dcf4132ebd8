"""Hand-made edge frames (FIXTURES.md section 3)."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from loam.functions.scalar import bin_factor, hour_of_hhmm
from loam.operators import metrics as mt
from loam.operators import relational as rel
from loam.operators import sampling as smp


def test_null_keys_never_match(spark):
    left = spark.createDataFrame([(1, "a"), (None, "b")], "k int, v string")
    right = spark.createDataFrame([(1, 10.0), (None, 20.0)], "k int, w double")
    out = {r["v"]: r["w"] for r in rel.natural_left_join(left, right).collect()}
    assert out == {"a": 10.0, "b": None}
    anti = rel.anti_join(left, right, ["k"]).collect()
    assert [r["v"] for r in anti] == ["b"]


def test_dirty_hhmm_text_becomes_null(spark):
    df = spark.createDataFrame([("1234",), ("null",), ("",), ("abc",), (None,)], "t string")
    got = [r[0] for r in df.select(hour_of_hhmm("t")).collect()]
    assert got == [12, None, None, None, None]


def test_summary_all_null_group_and_single_row(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None), (3.0, 5.0), (9.0, 1.0)], "p double, x double")
    rows = {r["level"]: r for r in rel.summary_stats(df, "x", "p", 1, 6).collect()}
    assert rows["1"]["valid_n"] == 0 and rows["1"]["missing_n"] == 1 and rows["1"]["mean"] is None
    assert rows["3"]["sd"] is None and rows["3"]["mean"] == 5.0          # one row: sd undefined
    assert "9" not in rows                                                # outside F(p, 1, 6)
    assert rows["all"]["valid_n"] == 2 and rows["all"]["missing_n"] == 2


def test_histogram_top_edge_and_outside(spark):
    df = spark.createDataFrame([(0.0,), (0.5,), (1.0,), (-1.0,), (2.0,)], "x double")
    got = {r["bin"]: r["n"] for r in rel.histogram(df, "x", 4, lo=0.0, hi=1.0).collect()}
    assert got == {1: 1, 3: 1, 4: 1, 0: 1, 5: 1}


def test_score_bucket_edges(spark):
    df = spark.createDataFrame([(0.0, 1), (0.001, 1), (0.0011, 0), (1.0, 1), (1.5, 0)], "s double, y int")
    got = {r["bucket"]: (r["positives"], r["total"]) for r in mt.score_buckets(df, "s", "y").collect()}
    assert got == {0: (2, 2), 1: (0, 1), 999: (1, 1)}                   # 1.5 has no bucket


def test_bin_factor_bounds(spark):
    df = spark.createDataFrame([(0.5,), (1.0,), (6.9,), (7.0,)], "x double")
    assert [r[0] for r in df.select(bin_factor("x", 1, 6)).collect()] == [None, 1, 6, None]


def test_arg_min_ties_first_and_arg_max_keeps_ties(spark):
    df = spark.createDataFrame([("g", 2, 1.0), ("g", 1, 1.0), ("g", 3, 2.0), ("h", 4, 5.0)],
                               "g string, id int, s double")
    best = {r["g"]: r["id"] for r in rel.arg_min(df, ["g"], "s", "id").collect()}
    assert best == {"g": 1, "h": 4}
    ties = sorted(r["id"] for r in rel.arg_max_all(df.withColumn("s", F.lit(1.0)), ["g"], "s").collect())
    assert ties == [1, 2, 3, 4]


def test_unite_keeps_keys_when_value_has_separator(spark):
    df = spark.createDataFrame([("a_b", "c")], "k1 string, k2 string")
    out = rel.unite(df, ["k1", "k2"], "ug").first()
    assert out["ug"] == "a_b_c" and out["k1"] == "a_b"


def test_calendar_fills_missing_months(spark):
    rows = [("x", "2020-01-01", 1.0), ("x", "2020-02-01", 2.0), ("y", "2020-01-01", 3.0),
            ("x", "2020-04-01", 4.0)]                                    # March missing everywhere
    df = spark.createDataFrame(rows, "k string, d string, q double").withColumn("d", F.to_date("d"))
    out = rel.calendar_panel(df, ["k"], "d", "q")
    got = {(r["k"], str(r["d"])): r["q"] for r in out.collect()}
    assert len(got) == 8
    assert got[("x", "2020-03-01")] == 0.0 and got[("y", "2020-04-01")] == 0.0


def test_folds_layout_independent(spark):
    df = spark.range(2000).withColumnRenamed("id", "k")
    ref = None
    for n in (1, 2, 8):
        got = sorted((r["k"], r["kfold"], r["in_training_set"])
                     for r in smp.tag_rows(df.repartition(n), "k", 3, 1, 0.4, 7).collect())
        ref = ref or got
        assert got == ref


def test_auc_one_class_and_ties(spark):
    one = spark.createDataFrame([(0.2, 1), (0.7, 1)], "s double, y int")
    r = mt.bucketed_auc(one, "s", "y").first()
    assert r["auc"] is None or math.isnan(r["auc"])                      # no negatives: undefined
    tied = spark.createDataFrame([(0.5, 1), (0.5, 0)], "s double, y int")
    assert abs(mt.bucketed_auc(tied, "s", "y").first()["auc"] - 0.5) < 1e-12
