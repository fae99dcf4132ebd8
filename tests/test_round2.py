"""Faults found in review: ranks with payload, tied values, level handling, rows kept when scoring."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from loam.operators import relational as rel
from loam.operators import sampling as smp
from loam.operators.ranking import equal_sets, exact_quantiles, group_row_number
from loam.plans import models as md
from loam.plans import scoring as sc
from loam.session import checkpoint_dir


def test_ranks_with_payload_columns(spark):
    df = spark.range(400_000).select("id", (F.col("id") * 7919 % 100_003).alias("v"), (F.col("id") % 3).alias("g"),
                                     F.repeat(F.lit("x"), 20).alias("payload"), F.rand(3).alias("noise"))
    r = group_row_number(df, ["v", "id"], ["g"], name="rn", size_name="n")
    got = r.groupBy("g").agg(F.count("*").alias("rows"), F.countDistinct("rn").alias("ranks"), F.max("rn").alias("top"),
                             F.max("n").alias("n")).collect()
    assert all(x["rows"] == x["ranks"] == x["top"] + 1 == x["n"] for x in got) and sum(x["rows"] for x in got) == 400_000
    want = df.select("id", (F.row_number().over(Window.partitionBy("g").orderBy("v", "id")) - 1).alias("w"))
    assert r.join(want, "id").where("rn <> w").count() == 0
    t = smp.tag_rows_exact(df, "id", 3, 1, 0.25, 5)
    cand = t.where("not in_test_set").count()
    assert t.count() == 400_000 and t.where("in_training_set").count() == int(cand * 0.25)
    sizes = [x["count"] for x in equal_sets(df, 4, ["id"]).groupBy("set_id").count().collect()]
    assert sizes == [100_000] * 4


def test_quantiles_of_tied_values_hold_no_large_task(spark):
    df = spark.range(100_000).select(F.when(F.col("id") % 10 > 0, F.lit(5.0)).otherwise(F.col("id") / 1000).alias("x"))
    x = np.array([r[0] for r in df.collect()])
    probs = [0.0, 0.01, 0.05, 0.3, 0.5, 0.93, 0.99, 1.0]
    q = exact_quantiles(df, "x", probs)
    assert {r["prob"]: pytest.approx(r["value"]) for r in q.collect()} == dict(zip(probs, np.quantile(x, probs)))
    values = df.groupBy("x").count().count()
    written = [f for f in q.inputFiles()]
    assert spark.read.parquet(*written).count() == values  # what is sorted are values, not rows


def test_calendar_keeps_null_keys(spark):
    df = spark.createDataFrame([(None, "2020-01-01", 5.0), ("a", "2020-02-01", 1.0)], "k string, d string, q double")
    out = rel.calendar_panel(df.withColumn("d", F.col("d").cast("date")), ["k"], "d", "q")
    assert {(r.k, r.d.month, r.q) for r in out.collect()} == {(None, 1, 5.0), (None, 2, 0.0), ("a", 1, 0.0), ("a", 2, 1.0)}


def test_unlisted_level_fails(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (1, "b", 2.0)], "i int, c string, v double")
    assert set(rel.long_to_wide(df, ["i"], "c", None, "v").columns) == {"i", "a", "b"}
    with pytest.raises(Exception, match="outside the listed levels"):
        rel.long_to_wide(df, ["i"], "c", ["a"], "v").collect()


def test_scoring_keeps_every_row(spark):
    rows = [(float(i % 2 or i % 5 == 0), "ab"[i % 2 if i % 7 else 0], float(i)) for i in range(200)]
    df = spark.createDataFrame(rows, "y double, f string, x double")
    model = md.fit_logit(df, "y ~ f + x")
    new = spark.createDataFrame([(0.0, "a", 1.0), (1.0, "unseen", 2.0), (1.0, None, 3.0), (0.0, "b", None)], df.schema)
    got = {(r.f, r.x): r.Score for r in sc.score(model, new, ["f", "x"]).collect()}
    assert len(got) == 4 and [k for k, v in got.items() if v is not None] == [("a", 1.0)]
    with pytest.raises(ValueError, match="columns"):
        md.fit_logit(df, "y ~ f + x", max_features=1)


def test_ensemble_with_string_factors_is_the_mean_of_its_models(spark):
    rows = [(float(i % 3 == 0), "abcdefgh"[i % (3 + i % 6)], float(i % 11), i % 4 + 1) for i in range(400)]
    df = spark.createDataFrame(rows, "y double, f string, x double, part int")
    df = df.where("part <> 2 or f <> 'a'")  # one part lacks a level
    models = md.fit_parts_ensemble(df, "part", 4, "y ~ f + x", "btrees_reg", {"maxIter": 3})
    got = [r.p for r in md.ensemble_predict(models, df, "p", keep=["x"]).collect()]
    each = [[r.prediction for r in m.transform(df).select("prediction").collect()] for m in models]
    assert np.allclose(got, np.mean(each, axis=0))


def test_no_local_scratch_on_a_cluster():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session())


def test_whole_tables_leave_no_row_out(spark):
    from conftest import SF01
    from loam.sources.views import view
    from loam.suite import QUERIES
    run = lambda name: QUERIES[name](spark, SF01)
    demand, scored = view(spark, SF01, "demand"), view(spark, SF01, "scored")
    p13 = run("P13_drop_constant_columns_whole")
    assert "Unit" not in p13.columns and p13.count() == demand.count()
    assert run("R01_union_by_name_whole").count() == 2 * scored.count()
    total = run("J04_full_join_fill_zero_whole").selectExpr("sum(actual1)", "sum(fcast1)").first()
    want = demand.selectExpr("sum(Quantity)").first()[0]
    assert abs(total[0] - want) < 1e-3 and abs(total[1] - want) < 1e-3
