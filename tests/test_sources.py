"""File sources and sinks (S01-S04, S07, S08, S14, S15) on files written from
the driver's tables."""

from __future__ import annotations

import os

from conftest import SF001
from pyspark.sql import functions as F

from loam.session import read_table
from loam.sources import files as fl
from loam.sources import tables as tb


def test_csv_text_and_typed(spark, tmp_path):
    ev = read_table(spark, SF001, "events").select("event_id", "user_id", "value", "event_type")
    path = str(tmp_path / "ev_csv")
    ev.withColumn("value", F.when(F.col("event_id") % 10 == 0, F.lit("null"))
                  .when(F.col("event_id") % 10 == 1, F.lit("abc")).otherwise(F.col("value").cast("string"))) \
      .write.option("header", True).csv(path)
    text = fl.read_csv_text(spark, path)
    assert all(t == "string" for _, t in text.dtypes)
    assert text.where(F.col("value").isNull()).count() == ev.where(F.col("event_id") % 10 == 0).count()
    typed = fl.read_csv_typed(spark, path, {"event_id": "bigint", "user_id": "bigint", "value": "double",
                                            "event_type": "string"})
    assert typed.where(F.col("value").isNull()).count() == ev.where(F.col("event_id") % 10 <= 1).count()
    ints = fl.read_csv_int_matrix(spark, path, ["event_id", "user_id", "value", "event_type"])
    assert ints.count() == ev.count()


def test_write_stage_and_resume(spark, tmp_path):
    ev = read_table(spark, SF001, "events")
    p = str(tmp_path / "t")
    fl.write_table(ev, p, n_files=3)
    assert len([f for f in os.listdir(p) if f.endswith(".parquet")]) == 3
    fl.stage_if_missing(ev.limit(1), p)                     # exists: left untouched
    assert spark.read.parquet(p).count() == ev.count()
    grid = spark.createDataFrame([("a",), ("b",), ("c",)], "run_id string")
    done = spark.createDataFrame([("b",)], "run_id string")
    assert sorted(r[0] for r in fl.pending_runs(grid, done).collect()) == ["a", "c"]
    assert fl.read_results(spark, str(tmp_path / "nothing")) is None


def test_text_directory(spark, tmp_path):
    docs = read_table(spark, SF001, "documents").select("doc_id", "text").limit(6).collect()
    for i, r in enumerate(docs):
        d = tmp_path / ("train" if i % 2 else "unsup") / "pos"
        d.mkdir(parents=True, exist_ok=True)
        (d / f"{r['doc_id']}_{7 if i % 3 else 2}.txt").write_text(r["text"])
    out = fl.read_text_files(spark, str(tmp_path))
    rows = out.collect()
    assert len(rows) == 3 and all("unsup" not in r["fname"] for r in rows)
    assert all(len(r["review"]) > 0 for r in rows)
    assert {r["sentiment"] for r in rows} <= {True, False}


def test_inspect_and_levels(spark):
    t = read_table(spark, SF001, "orders")
    info = {r["name"]: r for r in tb.inspect(t).collect()}
    assert info["o_totalprice"]["low"] <= info["o_totalprice"]["high"]
    assert info["o_orderstatus"]["low"] is None
    lv = tb.level_record(t, ["o_orderstatus", "o_orderpriority"]).collect()
    assert {tuple(r) for r in lv} == {("o_orderstatus", r[0]) for r in t.select("o_orderstatus").collect()} | {
        ("o_orderpriority", r[0]) for r in t.select("o_orderpriority").collect()}
