"""Stored quantile sketches."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from loam.operators import ranking as rk


def test_unions_keep_the_rank_error(spark, tmp_path):
    rng = random.Random(1)
    rows = [("abc"[i % 3], i % 7, rng.choice([rng.gauss(0, 1), 0.5])) for i in range(30_000)] + [("a", 1, None), ("z", 0, 4.0), ("n", 0, None)]
    df = spark.createDataFrame(rows, "g string, day int, v double")
    k = 256
    rk.quantile_sketches(df, "v", ["g", "day"], k).write.parquet(str(tmp_path / "s"))
    stored = spark.read.parquet(str(tmp_path / "s"))
    probs, error = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0], rk.sketch_rank_error(k)
    for where, keep in (("g = 'a'", lambda g, d: g == "a"), ("day in (1, 5)", lambda g, d: d in (1, 5)), ("true", lambda g, d: True)):
        values = sorted(v for g, d, v in rows if v is not None and keep(g, d))
        for r in rk.sketch_quantiles(stored.where(where), probs, k=k).collect():
            n = len(values)
            assert r.n == n
            assert sum(v < r.value for v in values) <= (r.prob + error) * n + 1 and sum(v <= r.value for v in values) >= (r.prob - error) * n - 1
    by = rk.sketch_quantiles(stored, [0.5], ["g"], k=k).collect()
    assert {r.g for r in by} == {"a", "b", "c", "z"} and {r.value for r in by if r.g == "z"} == {4.0}
    assert rk.sketch_quantiles(stored.where(F.lit(False)), [0.5], ["g"], k=k).count() == 0
