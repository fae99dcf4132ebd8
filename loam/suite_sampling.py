"""Checks for sampling, folds, splits and time windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from loam.operators import sampling as smp
from loam.operators.ranking import group_row_number
from loam.sources.views import view, with_ctes, with_views
from loam.suite import query, r6, s6
from loam.suite_relational import HOLDOUT_KEYS, _MONTHLY, _monthly

_H = smp.hash_sql


@query("H01_repeatable_percent_sample", with_views(
    f"SELECT * FROM trips WHERE {_H(HOLDOUT_KEYS, 98052)} % 10000 < 500", "trips"))
def q_h01(spark, sf):
    return smp.repeatable_sample(view(spark, sf, "trips"), HOLDOUT_KEYS, 5, 98052)


@query("H02_seeded_kfold_and_fraction", with_views(
    f"SELECT doc_id, category, CAST({_H('doc_id', 42)} % 3 + 1 AS INT) AS kfold, "
    f"({_H('doc_id', 42)} % 3 + 1) = 1 AS in_test_set, "
    f"({_H('doc_id', 42)} % 3 + 1) <> 1 AND {_H('doc_id', '42:train')} < {int(0.5 * 2 ** 32)} AS in_training_set "
    "FROM names", "names"))
def q_h02(spark, sf):
    n = view(spark, sf, "names").select("doc_id", "category")
    return smp.tag_rows(n, "doc_id", 3, 1, 0.5, 42)


@query("H03_time_based_split", with_views(
    "SELECT *, CASE WHEN make_date(Year, Month, DayOfMonth) < DATE '2024-01-22' THEN 'train' ELSE 'test' END AS split "
    "FROM flights WHERE make_date(Year, Month, DayOfMonth) < DATE '2024-01-22' OR "
    "(make_date(Year, Month, DayOfMonth) >= DATE '2024-01-22' AND make_date(Year, Month, DayOfMonth) < DATE '2024-02-01')",
    "flights"))
def q_h03(spark, sf):
    from loam.plans.flights import time_split
    train, test = time_split(view(spark, sf, "flights"), (2024, 1, 22), (2024, 1, 22), (2024, 2, 1))
    return train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))


@query("H05_equal_size_row_sets", with_views(
    "SELECT doc_id, CAST(ntile(4) OVER (ORDER BY doc_id) AS INT) AS set_id FROM reviews", "reviews"))
def q_h05(spark, sf):
    return smp.row_sets(view(spark, sf, "reviews").select("doc_id"), 4, ["doc_id"])


@query("H06_disjoint_ensemble_parts", with_views(
    f"SELECT CAST({_H('event_id', 2017)} % 16 + 1 AS INT) AS part, count(*) AS n, "
    "CAST(sum(ArrDel15) AS BIGINT) AS delayed FROM flights GROUP BY 1", "flights"))
def q_h06(spark, sf):
    f = smp.disjoint_parts(view(spark, sf, "flights"), "event_id", 16, 2017)
    return f.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.sum("ArrDel15").alias("delayed"))


@query("H07_geometric_training_fractions", with_ctes(["names"], """
c AS (SELECT CAST(count(*) AS DOUBLE) * (1 - 1 / 3e0) AS max_tss FROM names)""",
    f"SELECT CAST(i AS INT) AS i, {s6('exp(ln(50e0 / max_tss) + (0e0 - ln(50e0 / max_tss)) * i / 7e0)')} AS fraction, "
    f"{s6('max_tss')} AS max_tss FROM c, range(0, 8) r(i)"))
def q_h07(spark, sf):
    n = view(spark, sf, "names")
    mx = n.agg((F.count(F.lit(1)).cast("double") * (1 - 1 / 3)).alias("max_tss"))
    out = mx.select("max_tss", F.posexplode(smp.training_fractions_col(50.0, F.col("max_tss"), 8))
                    .alias("i", "fraction"))
    return r6(out.select(F.col("i").cast("int").alias("i"), "fraction", "max_tss"), "fraction", "max_tss")


@query("H08_seeded_shuffle", with_views(
    "SELECT doc_id, row_number() OVER (ORDER BY md5(concat(CAST(doc_id AS VARCHAR), ':1')), doc_id) - 1 AS position "
    "FROM names", "names"))
def q_h08(spark, sf):
    n = view(spark, sf, "names").select("doc_id")
    key = F.md5(F.concat(F.col("doc_id").cast("string"), F.lit(":1")))
    return group_row_number(n, [key, F.col("doc_id")], [], name="position")


@query("H09_exact_training_rows", with_ctes(["names"], f"""
t AS (SELECT doc_id, CAST({_H('doc_id', 42)} % 3 + 1 AS INT) AS kfold, {_H('doc_id', '42:train')} AS u FROM names),
r AS (SELECT *, kfold = 1 AS in_test_set, row_number() OVER (PARTITION BY kfold = 1 ORDER BY u, doc_id) - 1 AS rn,
      count(*) OVER (PARTITION BY kfold = 1) AS cand FROM t)""",
    "SELECT doc_id, kfold, in_test_set, NOT in_test_set AND rn < floor(cand * 0.5e0) AS in_training_set FROM r"))
def q_h09(spark, sf):
    n = view(spark, sf, "names").select("doc_id")
    return smp.tag_rows_exact(n, "doc_id", 3, 1, 0.5, 42)


@query("W03_expanding_window_origins", with_ctes(["demand"], _MONTHLY + """,
tot AS (SELECT Date, sum(Quantity) AS Quantity FROM m GROUP BY Date),
o AS (SELECT CAST((SELECT max(Date) FROM tot) - INTERVAL (k) MONTH AS DATE) AS origin FROM range(0, 3) r(k))""",
    f"SELECT o.origin, tot.Date, {s6('tot.Quantity')} AS Quantity FROM tot JOIN o ON tot.Date < o.origin"))
def q_w03(spark, sf):
    from loam.plans.forecast.panel import expanding_windows
    tot = _monthly(spark, sf).groupBy("Date").agg(F.sum("Quantity").alias("Quantity"))
    return r6(expanding_windows(tot, "Date", 3), "Quantity")


@query("W04_row_tagger", with_ctes(["reviews"], "",
    f"SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS row_num, CAST({_H('doc_id', 9)} % 5 + 1 AS INT) AS kfold, "
    f"({_H('doc_id', 9)} % 5 + 1) = 2 AS in_test_set, "
    f"({_H('doc_id', 9)} % 5 + 1) <> 2 AND {_H('doc_id', '9:train')} < {int(0.3 * 2 ** 32)} AS in_training_set "
    "FROM reviews"))
def q_w04(spark, sf):
    r = view(spark, sf, "reviews").select("doc_id")
    r = group_row_number(r, ["doc_id"], [], name="row_num")
    return smp.tag_rows(r, "doc_id", 5, 2, 0.3, 9)
