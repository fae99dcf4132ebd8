"""Node names and separators that hold signs with a meaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from loam.operators.relational import separate, unite
from loam.plans.forecast.panel import aggregate_nodes, bottom_node, membership

ROWS = [(None, "v", 1.0), ("v", None, 2.0), ("total", "a/B=v", 4.0), ("a", "v", 8.0), ("", "%N", 16.0), ("%N", "", 32.0), (None, None, 64.0)]


def test_node_names_tell_nodes_apart(spark):
    df = spark.createDataFrame(ROWS, "A string, B string, value double").withColumn("Date", F.lit("2024-01-01").cast("date"))
    nodes = aggregate_nodes(df, ["A", "B"], "Date", "value").collect()
    assert len({r.node for r in nodes}) == len(nodes) == 1 + 6 + 5 + 7
    by = {(r.level, r.node): r.value for r in nodes}
    assert by[(0, "total")] == 127 and by[(1, "A=%N")] == 65 and by[(1, "B=v")] == 9 and by[(1, "A=%25N")] == 32 and by[(1, "A=")] == 16
    memb = membership(df, ["A", "B"])
    up = (df.withColumn("bottom", bottom_node(["A", "B"])).join(memb.select("bottom", "node"), "bottom")
            .groupBy("node").agg(F.sum("value").alias("value")).collect())
    assert {r.node: r.value for r in up} == {r.node: r.value for r in nodes}


def test_separator_is_literal(spark):
    df = spark.createDataFrame([("a", "b"), ("", "c")], "x string, y string")
    for sep in (".", "|", "^", "$", "\\", "\\E", "[", "*", " ", "a+"):
        rows = separate(unite(df, ["x", "y"], "u", sep, keep=False), "u", ["x", "y"], sep).collect()
        assert {(r.x, r.y) for r in rows} == {("a", "b"), ("", "c")}, sep
