"""Checks for sources, projections, joins, aggregations, sorts and reshaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from loam.plans import flights as fw
from loam.sources.views import view, views, with_ctes, with_views
from loam.suite import ORACLE, QUERIES, query, r6, s6

MEASURES = fw.WEATHER_MEASURES
_W_SUMMARY = """ws AS (SELECT AdjustedYear AS Year, AdjustedMonth AS Month, AdjustedDay AS DayOfMonth,
       AdjustedHour AS CRSDepTime, AirportID AS OriginAirportID,
       avg(Visibility) AS Visibility, avg(DryBulbCelsius) AS DryBulbCelsius,
       avg(DewPointCelsius) AS DewPointCelsius, avg(RelativeHumidity) AS RelativeHumidity,
       avg(WindSpeed) AS WindSpeed, avg(Altimeter) AS Altimeter
  FROM weather GROUP BY 1, 2, 3, 4, 5)"""
_FL = """fl AS (SELECT ArrDel15, Year, Month, DayOfMonth, DayOfWeek, Carrier, OriginAirportID,
       DestAirportID, CAST(floor(CRSDepTime / 100) AS BIGINT) AS CRSDepTime, CRSArrTime FROM flights)"""
_FW = (_W_SUMMARY + ",\n" + _FL + """,
fw AS (SELECT fl.*, """ + ", ".join(f"o.{m} AS {m}Origin" for m in MEASURES) + ", "
       + ", ".join(f"d.{m} AS {m}Dest" for m in MEASURES) + """
  FROM fl LEFT JOIN ws o ON fl.Year = o.Year AND fl.Month = o.Month AND fl.DayOfMonth = o.DayOfMonth
        AND fl.CRSDepTime = o.CRSDepTime AND fl.OriginAirportID = o.OriginAirportID
      LEFT JOIN ws d ON fl.Year = d.Year AND fl.Month = d.Month AND fl.DayOfMonth = d.DayOfMonth
        AND fl.CRSDepTime = d.CRSDepTime AND fl.DestAirportID = d.OriginAirportID)""")
FW_COLS = fw.FLIGHT_COLUMNS + [m + s for s in ("Origin", "Dest") for m in MEASURES]


def flights_weather(spark, sf):
    flights, weather = views(spark, sf, "flights", "weather")
    return fw.join_flights_weather(flights, weather)


def _fw_sql(select: str) -> str:
    return with_views("", "flights", "weather").rstrip() + ",\n" + _FW + "\n" + select


# ---------------------------------------------------------------- slice
@query("J02_flights_origin_dest_weather", _fw_sql(
    "SELECT " + ", ".join(fw.FLIGHT_COLUMNS) + ", "
    + ", ".join(s6(c) + f" AS {c}" for c in FW_COLS[10:]) + " FROM fw"))
def q_j02(spark, sf):
    return r6(flights_weather(spark, sf), *FW_COLS[10:])


@query("J01_flights_origin_weather", with_views("", "flights", "weather").rstrip() + ",\n"
       + _W_SUMMARY + ",\n" + _FL + "\nSELECT fl.*, "
       + ", ".join(s6(f"o.{m}") + f" AS {m}" for m in MEASURES)
       + """ FROM fl LEFT JOIN ws o ON fl.Year = o.Year AND fl.Month = o.Month
       AND fl.DayOfMonth = o.DayOfMonth AND fl.CRSDepTime = o.CRSDepTime
       AND fl.OriginAirportID = o.OriginAirportID""")
def q_j01(spark, sf):
    flights, weather = views(spark, sf, "flights", "weather")
    from loam.operators.relational import natural_left_join
    out = natural_left_join(fw.prepare_flights(flights), fw.weather_summary(weather))
    return r6(out, *MEASURES)


@query("A01_weather_hourly_means", with_views("", "weather").rstrip() + ",\n" + _W_SUMMARY
       + "\nSELECT Year, Month, DayOfMonth, CRSDepTime, OriginAirportID, "
       + ", ".join(s6(m) + f" AS {m}" for m in MEASURES) + " FROM ws")
def q_a01(spark, sf):
    return r6(fw.weather_summary(view(spark, sf, "weather")), *MEASURES)


@query("S10_register_cached_table", _fw_sql(
    "SELECT Year, Month, count(*) AS n, CAST(sum(ArrDel15) AS BIGINT) AS delayed FROM fw GROUP BY Year, Month"))
def q_s10(spark, sf):
    fwdf = fw.register(flights_weather(spark, sf), "flightsweather")
    return spark.sql("SELECT Year, Month, count(*) AS n, sum(ArrDel15) AS delayed "
                     "FROM flightsweather GROUP BY Year, Month")


@query("A02_row_count", _fw_sql("SELECT count(*) AS n FROM fw"))
def q_a02(spark, sf):
    from loam.operators.relational import row_count
    return row_count(flights_weather(spark, sf))


@query("A03_count_per_value", _fw_sql("SELECT ArrDel15, count(*) AS n FROM fw GROUP BY ArrDel15"))
def q_a03(spark, sf):
    from loam.operators.relational import count_by
    return count_by(flights_weather(spark, sf), ["ArrDel15"])


@query("A04_count_per_year_month_ordered",
       _fw_sql("SELECT Year, Month, count(*) AS n FROM fw GROUP BY Year, Month ORDER BY Year, Month"))
def q_a04(spark, sf):
    from loam.operators.relational import count_by
    return count_by(flights_weather(spark, sf), ["Year", "Month"], ordered=True)


# ---------------------------------------------------------------- sources
from loam.functions.geo import dlit, haversine_miles, haversine_sql, calculate_distance  # noqa: E402
from loam.functions import scalar as fx  # noqa: E402
from loam.operators import relational as rel  # noqa: E402
from loam.sources import tables as tb  # noqa: E402

PAYMENT_LEVELS = ["CSH", "CRD", "DIS", "NOC", "UNK"]
DEMAND_KEYS = ["CustomerName", "ProductCategory", "Destination"]

TRIP_QUERY = """SELECT tipped, tip_amount, fare_amount, passenger_count, trip_time_in_secs, trip_distance,
       pickup_datetime, dropoff_datetime,
       CAST(pickup_longitude AS DOUBLE) AS pickup_longitude,
       CAST(pickup_latitude AS DOUBLE) AS pickup_latitude,
       CAST(dropoff_longitude AS DOUBLE) AS dropoff_longitude,
       CAST(dropoff_latitude AS DOUBLE) AS dropoff_latitude,
       CAST(pickup_longitude AS DOUBLE) * 100 AS pickup_longitude2,
       CAST(pickup_latitude AS DOUBLE) * 100 AS pickup_latitude2,
       CAST(dropoff_longitude AS DOUBLE) * 100 AS dropoff_longitude2,
       CAST(dropoff_latitude AS DOUBLE) * 100 AS dropoff_latitude2,
       payment_type FROM {trips}"""


@query("S05_sql_query_source", with_views(TRIP_QUERY.replace("{trips}", "trips"), "trips"))
def q_s05(spark, sf):
    return tb.sql_source(spark, TRIP_QUERY, trips=view(spark, sf, "trips"))


@query("S06_F11_typed_table_source", with_views(
    "SELECT o_orderkey, CAST(passenger_count AS DOUBLE) AS passenger_count, "
    "CAST(trip_distance AS DOUBLE) AS trip_distance, "
    "CAST(trip_time_in_secs AS DOUBLE) AS trip_time_in_secs, tipped FROM trips", "trips"))
def q_s06(spark, sf):
    t = view(spark, sf, "trips").select("o_orderkey", "passenger_count", "trip_distance",
                                        "trip_time_in_secs", "tipped")
    return tb.typed_columns(t, {"passenger_count": "double", "trip_distance": "double",
                                "trip_time_in_secs": "double"})


_S16_COLS = [("passenger_count", "int", True), ("trip_distance", "double", True),
             ("fare_amount", "double", True), ("tip_amount", "double", True),
             ("medallion", "bigint", True), ("payment_type", "string", False)]


@query("S16_source_inspection", with_views(" UNION ALL ".join(
    f"SELECT '{c}' AS name, '{t}' AS type, "
    + (f"CAST(min({c}) AS DOUBLE) AS low, CAST(max({c}) AS DOUBLE) AS high, " if num
       else "CAST(NULL AS DOUBLE) AS low, CAST(NULL AS DOUBLE) AS high, ")
    + f"count({c}) AS valid_n, count(*) - count({c}) AS missing_n FROM trips"
    for c, t, num in _S16_COLS), "trips"))
def q_s16(spark, sf):
    return tb.inspect(view(spark, sf, "trips"), [c for c, _, _ in _S16_COLS])


@query("S17_factor_level_record", with_views(" UNION ALL ".join(
    f"SELECT DISTINCT '{c}' AS column, {c} AS level FROM demand WHERE {c} IS NOT NULL" for c in DEMAND_KEYS), "demand"))
def q_s17(spark, sf):
    return tb.level_record(view(spark, sf, "demand"), DEMAND_KEYS)


# ---------------------------------------------------------------- projections
@query("P01_rename_columns", with_views(
    "SELECT AdjustedYear AS Year, AdjustedMonth AS Month, AdjustedDay AS DayOfMonth, "
    "AdjustedHour AS CRSDepTime, AirportID AS OriginAirportID, Visibility, DryBulbCelsius, "
    "DewPointCelsius, RelativeHumidity, WindSpeed, Altimeter FROM weather", "weather"))
def q_p01(spark, sf):
    return rel.rename(view(spark, sf, "weather"), fw.WEATHER_RENAME)


@query("P02_select_columns", with_views("SELECT " + ", ".join(fw.FLIGHT_COLUMNS) + " FROM flights",
                                        "flights"))
def q_p02(spark, sf):
    return rel.select_columns(view(spark, sf, "flights"), fw.FLIGHT_COLUMNS)


@query("P03_F01_floor_to_hour", with_views(
    "SELECT event_id, CAST(floor(CRSDepTime / 100) AS BIGINT) AS CRSDepTime, CRSArrTime FROM flights",
    "flights"))
def q_p03(spark, sf):
    return rel.floor_to_hour(view(spark, sf, "flights").select("event_id", "CRSDepTime", "CRSArrTime"),
                             "CRSDepTime")


@query("P04_filter_conjunction", with_views(
    "SELECT * FROM flights WHERE Year < 2025 AND DayOfMonth <= 7 AND Carrier = 'C1'", "flights"))
def q_p04(spark, sf):
    f = view(spark, sf, "flights")
    return f.where((F.col("Year") < 2025) & (F.col("DayOfMonth") <= 7) & (F.col("Carrier") == "C1"))


@query("P05_cast_and_scale", with_views(
    "SELECT o_orderkey, hack_license, passenger_count, CAST(pickup_longitude AS DOUBLE) * 100 AS pickup_longitude2, "
    "CAST(pickup_latitude AS DOUBLE) * 100 AS pickup_latitude2 FROM trips", "trips"))
def q_p05(spark, sf):
    t = view(spark, sf, "trips")
    return t.select("o_orderkey", "hack_license", "passenger_count",
                    fx.cast_scale("pickup_longitude", 100).alias("pickup_longitude2"),
                    fx.cast_scale("pickup_latitude", 100).alias("pickup_latitude2"))


_KEEP = ["tipped", "fare_amount", "passenger_count", "trip_time_in_secs", "trip_distance",
         "pickup_datetime", "dropoff_datetime", "pickup_longitude", "pickup_latitude",
         "dropoff_longitude", "dropoff_latitude"]
_HAV = haversine_sql("pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude")


@query("P06_data_step_keep_and_compute", with_views(
    "SELECT " + ", ".join(_KEEP) + f", {_HAV} AS direct_distance FROM trips", "trips"))
def q_p06(spark, sf):
    return rel.data_step(view(spark, sf, "trips"), _KEEP, {"direct_distance": haversine_miles(
        "pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude")})


@query("P07_row_selection_in_step", with_views(
    "SELECT " + ", ".join(_KEEP) + f", {_HAV} AS direct_distance FROM trips WHERE tipped = 1 AND passenger_count <= 6",
    "trips"))
def q_p07(spark, sf):
    return rel.data_step(view(spark, sf, "trips"), _KEEP, {"direct_distance": haversine_miles(
        "pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude")},
        row_selection=(F.col("tipped") == 1) & (F.col("passenger_count") <= 6))


@query("P08_parse_date_drop_missing", with_views(
    "SELECT CustomerName, ProductCategory, Destination, CAST(CAST(Date AS VARCHAR) AS DATE) AS Date, Quantity "
    "FROM demand WHERE CustomerName IS NOT NULL AND ProductCategory IS NOT NULL AND Destination IS NOT NULL "
    "AND Date IS NOT NULL AND Quantity IS NOT NULL", "demand"))
def q_p08(spark, sf):
    d = view(spark, sf, "demand").withColumn("Date", F.col("Date").cast("string"))
    return rel.parse_date_drop_missing(d, "Date", "yyyy-MM-dd")


@query("P09_drop_column", with_views("SELECT * EXCLUDE (ArrDel15) FROM flights", "flights"))
def q_p09(spark, sf):
    return rel.drop_columns(view(spark, sf, "flights"), "ArrDel15")


@query("P11_factor_fixed_levels", with_views(
    "SELECT o_orderkey, hack_license, passenger_count, payment_type AS payment_raw, "
    "CASE WHEN payment_type IN ('CSH','CRD','DIS','NOC','UNK') THEN payment_type END AS payment_type, "
    "CAST(CASE payment_type WHEN 'CSH' THEN 0 WHEN 'CRD' THEN 1 WHEN 'DIS' THEN 2 WHEN 'NOC' THEN 3 "
    "WHEN 'UNK' THEN 4 END AS INT) AS payment_index FROM trips", "trips"))
def q_p11(spark, sf):
    t = view(spark, sf, "trips")
    return t.select("o_orderkey", "hack_license", "passenger_count",
                    F.col("payment_type").alias("payment_raw"),
                    fx.factor_value("payment_type", PAYMENT_LEVELS).alias("payment_type"),
                    fx.factor_index("payment_type", PAYMENT_LEVELS).alias("payment_index"))


@query("P13_drop_constant_columns_whole", with_views(
    "SELECT CustomerName, ProductCategory, Destination, Date, Quantity FROM demand", "demand"))
def q_p13_whole(spark, sf):
    d = view(spark, sf, "demand").withColumn("Unit", F.lit("piece"))
    return rel.drop_constant_columns(d, [*DEMAND_KEYS, "Unit"])


@query("P14_fill_missing_zero", with_views(
    "SELECT CustomerName, ProductCategory, Destination, Date, coalesce(Quantity, 0.0) AS Quantity FROM demand",
    "demand"))
def q_p14(spark, sf):
    return rel.fill_missing(view(spark, sf, "demand"), 0.0, ["Quantity"])


@query("P15_clamp_negatives", with_views(
    "SELECT AirportID, AdjustedDay, AdjustedHour, CASE WHEN DryBulbCelsius < 0 THEN 0.0 ELSE DryBulbCelsius END "
    "AS DryBulbCelsius, CASE WHEN DewPointCelsius < 0 THEN 0.0 ELSE DewPointCelsius END AS DewPointCelsius "
    "FROM weather", "weather"))
def q_p15(spark, sf):
    w = view(spark, sf, "weather").select("AirportID", "AdjustedDay", "AdjustedHour", "DryBulbCelsius",
                                          "DewPointCelsius")
    return rel.clamp_negatives(w, ["DryBulbCelsius", "DewPointCelsius"])


@query("P16_threshold_label", with_views(
    "SELECT doc_id, fname, TRY_CAST(regexp_extract(fname, '_(\\d+)\\.txt$', 1) AS INT) AS rating, "
    "TRY_CAST(regexp_extract(fname, '_(\\d+)\\.txt$', 1) AS INT) > 5 AS sentiment FROM reviews", "reviews"))
def q_p16(spark, sf):
    r = view(spark, sf, "reviews")
    return r.select("doc_id", "fname", fx.rating_from_name("fname").alias("rating"),
                    fx.threshold_label(fx.rating_from_name("fname"), 5).alias("sentiment"))


NAME_PATTERNS = ["sas", "i", "ii", "f", "ff"]


@query("P17_F10_case_insensitive_regex", with_views(
    "SELECT doc_id, category, " + ", ".join(
        f"regexp_matches(text, '{p}', 'i') AS has_{p}" for p in NAME_PATTERNS) + " FROM texts", "texts"))
def q_p17(spark, sf):
    n = view(spark, sf, "texts")
    return n.select("doc_id", "category", *[fx.regex_flag("text", p).alias(f"has_{p}") for p in NAME_PATTERNS])


@query("P18_F12_null_predicate", _fw_sql(
    "SELECT " + ", ".join(fw.FLIGHT_COLUMNS) + " FROM fw WHERE VisibilityOrigin IS NULL AND ArrDel15 IS NOT NULL"))
def q_p18(spark, sf):
    f = flights_weather(spark, sf)
    return f.where(F.col("VisibilityOrigin").isNull() & F.col("ArrDel15").isNotNull()).select(*fw.FLIGHT_COLUMNS)


@query("P19_date_range", with_views(
    "SELECT * FROM demand WHERE Date BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'", "demand"))
def q_p19(spark, sf):
    return rel.date_range(view(spark, sf, "demand"), "Date", F.lit("1996-01-01").cast("date"),
                          F.lit("1996-12-31").cast("date"))


# ---------------------------------------------------------------- joins
from loam.operators import sampling as smp  # noqa: E402

HOLDOUT_KEYS = ["medallion", "hack_license", "pickup_datetime"]


@query("J03_anti_join_holdout", with_views(
    f"SELECT t.* FROM trips t WHERE NOT EXISTS (SELECT 1 FROM (SELECT * FROM trips WHERE "
    f"{smp.hash_sql(HOLDOUT_KEYS, 98052)} % 10000 < 500) s WHERE s.medallion = t.medallion "
    f"AND s.hack_license = t.hack_license AND s.pickup_datetime = t.pickup_datetime)", "trips"))
def q_j03(spark, sf):
    t = view(spark, sf, "trips")
    sample = smp.repeatable_sample(t, HOLDOUT_KEYS, 5, 98052)
    return rel.anti_join(t, sample, HOLDOUT_KEYS)


_MONTHLY = ("m AS (SELECT CustomerName, ProductCategory, Destination, CAST(date_trunc('month', Date) AS DATE) "
            "AS Date, sum(Quantity) AS Quantity FROM demand GROUP BY ALL)")


def _monthly(spark, sf):
    return rel.monthly_sum(view(spark, sf, "demand"), "Date", DEMAND_KEYS, "Quantity")


@query("J04_full_join_fill_zero_whole", with_ctes(["demand"], _MONTHLY, """SELECT coalesce(a.CustomerName, f.CustomerName) AS CustomerName,
       coalesce(a.ProductCategory, f.ProductCategory) AS ProductCategory,
       coalesce(a.Destination, f.Destination) AS Destination, coalesce(a.Date, f.Date) AS Date,
       """ + s6("coalesce(a.Quantity, 0.0)") + " AS actual1, " + s6("coalesce(f.Quantity, 0.0)") + """ AS fcast1
FROM m a FULL JOIN (SELECT * REPLACE (CAST(Date + INTERVAL 1 MONTH AS DATE) AS Date) FROM m) f
  ON a.CustomerName = f.CustomerName AND a.ProductCategory = f.ProductCategory AND a.Destination = f.Destination
  AND a.Date = f.Date"""))
def q_j04_whole(spark, sf):
    m = _monthly(spark, sf).withColumn("Date", F.col("Date").cast("date"))
    act = m.select(*DEMAND_KEYS, "Date", F.col("Quantity").alias("actual1"))
    fc = m.select(*DEMAND_KEYS, F.add_months("Date", 1).alias("Date"), F.col("Quantity").alias("fcast1"))
    return r6(rel.full_join_fill(act, fc, [*DEMAND_KEYS, "Date"], 0.0), "actual1", "fcast1")


@query("J05_calendar_panel_fill", with_ctes(["demand"], _MONTHLY + """,
k AS (SELECT DISTINCT CustomerName, ProductCategory, Destination FROM m),
cal AS (SELECT CAST(unnest(generate_series((SELECT min(Date) FROM m), (SELECT max(Date) FROM m), INTERVAL 1 MONTH)) AS DATE) AS Date)""", """SELECT k.CustomerName, k.ProductCategory, k.Destination, cal.Date, """ + s6("coalesce(m.Quantity, 0.0)") + """ AS Quantity
FROM k CROSS JOIN cal LEFT JOIN m ON k.CustomerName IS NOT DISTINCT FROM m.CustomerName
  AND k.ProductCategory IS NOT DISTINCT FROM m.ProductCategory
  AND k.Destination IS NOT DISTINCT FROM m.Destination AND cal.Date = m.Date"""))
def q_j05(spark, sf):
    return r6(rel.calendar_panel(_monthly(spark, sf), DEMAND_KEYS, "Date", "Quantity"), "Quantity")


@query("J06_expand_level_grid", with_ctes(["demand"], """
a AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS i FROM (SELECT DISTINCT CustomerName AS v FROM demand WHERE CustomerName IS NOT NULL)),
b AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS i FROM (SELECT DISTINCT ProductCategory AS v FROM demand WHERE ProductCategory IS NOT NULL)),
c AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS i FROM (SELECT DISTINCT Destination AS v FROM demand WHERE Destination IS NOT NULL))""",
    """SELECT CAST(a.i + (SELECT count(*) FROM a) * (b.i + (SELECT count(*) FROM b) * c.i) + 1 AS INT) AS grid_id,
       a.v AS CustomerName, b.v AS ProductCategory, c.v AS Destination FROM a, b, c"""))
def q_j06(spark, sf):
    return rel.level_grid(view(spark, sf, "demand"), DEMAND_KEYS)


@query("J07_broadcast_level_table", with_views(
    "SELECT t.o_orderkey, t.hack_license, t.passenger_count, t.payment_type, l.payment_index FROM trips t "
    "LEFT JOIN (VALUES ('CSH', 0), ('CRD', 1), ('DIS', 2), ('NOC', 3), ('UNK', 4)) l(payment_type, payment_index) "
    "ON t.payment_type = l.payment_type", "trips"))
def q_j07(spark, sf):
    t = view(spark, sf, "trips").select("o_orderkey", "hack_license", "passenger_count", "payment_type")
    lv = spark.createDataFrame([(v, i) for i, v in enumerate(PAYMENT_LEVELS)],
                               "payment_type string, payment_index int")
    return t.join(rel.broadcast_fixed(lv, 10_000), on="payment_type", how="left")


# ---------------------------------------------------------------- aggregations
@query("A05_monthly_sum_per_keys", with_ctes(["demand"], _MONTHLY,
       "SELECT CustomerName, ProductCategory, Destination, Date, " + s6("Quantity") + " AS Quantity FROM m"))
def q_a05(spark, sf):
    return r6(_monthly(spark, sf), "Quantity")


_BIN_P = "CASE WHEN floor(passenger_count) BETWEEN 1 AND 6 THEN CAST(floor(passenger_count) AS INT) END"
_BIN_D = "CASE WHEN floor(trip_distance) BETWEEN 0 AND 25 THEN CAST(floor(trip_distance) AS INT) END"


@query("A06_summary_by_binned_factor", with_views(
    "SELECT CASE WHEN GROUPING(b) = 1 THEN 'all' ELSE CAST(b AS VARCHAR) END AS level, "
    f"{s6('avg(fare_amount)')} AS mean, {s6('stddev_samp(fare_amount)')} AS sd, min(fare_amount) AS min, "
    "max(fare_amount) AS max, count(fare_amount) AS valid_n, count(*) - count(fare_amount) AS missing_n "
    f"FROM (SELECT {_BIN_P} AS b, fare_amount FROM trips) GROUP BY GROUPING SETS ((), (b)) "
    "HAVING GROUPING(b) = 1 OR b IS NOT NULL", "trips"))
def q_a06(spark, sf):
    return r6(rel.summary_stats(view(spark, sf, "trips"), "fare_amount", "passenger_count", 1, 6), "mean", "sd")


@query("A07_cube_two_binned_factors", with_ctes(["trips"], f"""
g AS (SELECT p AS passenger_count, d AS trip_distance FROM range(1, 7) r1(p), range(0, 26) r2(d)),
c AS (SELECT {_BIN_P} AS passenger_count, {_BIN_D} AS trip_distance, avg(tip_amount) AS tip_amount,
             count(*) AS Counts FROM trips WHERE {_BIN_P} IS NOT NULL AND {_BIN_D} IS NOT NULL GROUP BY 1, 2)""",
    f"""SELECT CAST(g.passenger_count AS INT) AS passenger_count, CAST(g.trip_distance AS INT) AS trip_distance,
       {s6('c.tip_amount')} AS tip_amount, coalesce(c.Counts, 0) AS Counts
FROM g LEFT JOIN c ON g.passenger_count = c.passenger_count AND g.trip_distance = c.trip_distance"""))
def q_a07(spark, sf):
    out = rel.cube_cells(view(spark, sf, "trips"), "tip_amount", ("passenger_count", 1, 6), ("trip_distance", 0, 25))
    return r6(out, "tip_amount")


@query("A08_histogram_by_panel", with_ctes(["trips"], """
b AS (SELECT CAST(min(tip_amount) AS DOUBLE) AS lo, CAST(max(tip_amount) AS DOUBLE) AS hi FROM trips),
x AS (SELECT payment_type, CAST(CASE WHEN v = hi THEN 20 WHEN v > hi THEN 21 WHEN v < lo THEN 0
             ELSE floor((v - lo) * 20 / (hi - lo)) + 1 END AS INT) AS bin, lo, hi
      FROM (SELECT payment_type, CAST(tip_amount AS DOUBLE) AS v FROM trips WHERE tip_amount IS NOT NULL), b)""",
    f"""SELECT payment_type, bin, count(*) AS n, {s6('any_value(lo) + (bin - 1) * ((any_value(hi) - any_value(lo)) / 20)')} AS bin_low,
       {s6('any_value(lo) + bin * ((any_value(hi) - any_value(lo)) / 20)')} AS bin_high FROM x GROUP BY payment_type, bin"""))
def q_a08(spark, sf):
    return r6(rel.histogram(view(spark, sf, "trips"), "tip_amount", 20, by="payment_type"), "bin_low", "bin_high")


@query("A09_crosstab_counts", with_views(
    "SELECT PredictedLabel, category, count(*) AS n FROM scored GROUP BY PredictedLabel, category", "scored"))
def q_a09(spark, sf):
    return rel.crosstab_long(view(spark, sf, "scored"), "PredictedLabel", "category")


@query("A10_crosstab_with_predicates", with_views(
    "SELECT category, " + ", ".join(f"CAST(count_if(regexp_matches(text, '{p}', 'i')) AS BIGINT) AS n_{p}"
                                    for p in NAME_PATTERNS)
    + " FROM texts GROUP BY category", "texts"))
def q_a10(spark, sf):
    return rel.crosstab_predicates(view(spark, sf, "texts"), "category",
                                   {f"n_{p}": fx.regex_flag("text", p) for p in NAME_PATTERNS})


PROBS = [i / 100 for i in range(101)]
_PLIST = "[" + ", ".join(dlit(p) for p in PROBS) + "]"


@query("A11_exact_percentiles", with_views(
    f"SELECT unnest({_PLIST}) AS prob, {s6('unnest(quantile_cont(Probability, ' + _PLIST + '))')} AS value "
    "FROM scored", "scored"))
def q_a11(spark, sf):
    from loam.operators.ranking import exact_quantiles
    return r6(exact_quantiles(view(spark, sf, "scored"), "Probability", PROBS), "value")


@query("A12_distinct_count_per_column", with_views(" UNION ALL ".join(
    f"SELECT '{c}' AS column, count(DISTINCT {c}) AS n_distinct FROM demand"
    for c in DEMAND_KEYS + ["Date", "Quantity"]), "demand"))
def q_a12(spark, sf):
    return rel.distinct_counts(view(spark, sf, "demand"), DEMAND_KEYS + ["Date", "Quantity"])


@query("A15_mean_of_fold_means", with_views(
    f"SELECT category, {s6('avg(m)')} AS score FROM (SELECT category, {smp.hash_sql('event_id', 7)} % 3 + 1 AS fold, "
    "avg(Probability) AS m FROM scored GROUP BY 1, 2) GROUP BY category", "scored"))
def q_a15(spark, sf):
    s = smp.disjoint_parts(view(spark, sf, "scored"), "event_id", 3, 7, col="fold")
    return r6(rel.mean_of_means(s, ["category", "fold"], ["category"], "Probability"), "score")


@query("A16_arg_min_first_on_ties", with_views(
    "SELECT event_id, category, Probability, is_real, PredictedLabel FROM (SELECT *, row_number() OVER "
    "(PARTITION BY category ORDER BY Probability, event_id) AS rn FROM scored WHERE Probability IS NOT NULL) "
    "WHERE rn = 1", "scored"))
def q_a16(spark, sf):
    return rel.arg_min(view(spark, sf, "scored"), ["category"], "Probability", "event_id")


@query("A16_arg_max_keep_ties", with_views(
    "SELECT s.* FROM scored s JOIN (SELECT category, max(is_real * 100 + floor(Probability * 10)) AS m FROM scored "
    "GROUP BY category) x ON s.category = x.category AND s.is_real * 100 + floor(s.Probability * 10) = x.m", "scored"))
def q_a16b(spark, sf):
    s = view(spark, sf, "scored").withColumn("score", F.col("is_real") * 100 + F.floor(F.col("Probability") * 10))
    return rel.arg_max_all(s, ["category"], "score").drop("score")


@query("A17_grouping_sets_hierarchy", with_ctes(["demand"], _MONTHLY,
    "SELECT Date, CustomerName, ProductCategory, Destination, " + s6("sum(Quantity)") + " AS Quantity, "
    "CAST(GROUPING(CustomerName) * 4 + GROUPING(ProductCategory) * 2 + GROUPING(Destination) AS INT) AS gid "
    "FROM m GROUP BY GROUPING SETS ((Date), (Date, CustomerName), (Date, ProductCategory), (Date, Destination), "
    "(Date, CustomerName, ProductCategory, Destination))"))
def q_a17(spark, sf):
    return r6(rel.grouping_set_sums(_monthly(spark, sf), "Date", DEMAND_KEYS, "Quantity"), "Quantity")


@query("A18_distinct_rows_keep_lowest_id", with_views(
    "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY Carrier, OriginAirportID "
    "ORDER BY event_id) AS rn FROM flights) WHERE rn = 1", "flights"))
def q_a18(spark, sf):
    return rel.distinct_rows(view(spark, sf, "flights"), ["Carrier", "OriginAirportID"], keep_lowest="event_id")


# ---------------------------------------------------------------- sorts
@query("O01_sort", with_ctes(["demand"], _MONTHLY,
       "SELECT Date, CustomerName, ProductCategory, Destination, " + s6("Quantity") + " AS Quantity FROM m "
       "ORDER BY Date, CustomerName, ProductCategory, Destination"))
def q_o01(spark, sf):
    return r6(rel.sort(_monthly(spark, sf), "Date", *DEMAND_KEYS), "Quantity")


@query("O02_top_n", with_views(
    "SELECT * FROM scored ORDER BY Probability DESC, event_id LIMIT 3", "scored"))
def q_o02(spark, sf):
    return rel.top_n(view(spark, sf, "scored"), 3, [F.col("Probability").desc(), F.col("event_id")])


@query("O03_category_extremes", with_ctes(["scored"], """
c AS (SELECT *, CASE WHEN Probability > 0 THEN log10(Probability) END AS log10Probability FROM scored
      WHERE category = 'purchase')""",
    "SELECT * FROM c WHERE log10Probability > (SELECT quantile_cont(log10Probability, 0.99e0) FROM c) "
    "ORDER BY Probability DESC"))
def q_o03(spark, sf):
    return rel.category_extremes(view(spark, sf, "scored"), "category", "purchase", "Probability", 0.01, upper=True)


@query("O03_category_extremes_lower", with_ctes(["scored"], """
c AS (SELECT *, CASE WHEN Probability > 0 THEN log10(Probability) END AS log10Probability FROM scored
      WHERE category = 'view')""",
    "SELECT * FROM c WHERE log10Probability < (SELECT quantile_cont(log10Probability, 0.01e0) FROM c) "
    "ORDER BY Probability DESC"))
def q_o03b(spark, sf):
    return rel.category_extremes(view(spark, sf, "scored"), "category", "view", "Probability", 0.01, upper=False)


# ---------------------------------------------------------------- reshape
@query("R01_union_by_name_whole", with_views(
    "SELECT event_id, Probability FROM scored UNION ALL BY NAME SELECT event_id, is_real FROM scored", "scored"))
def q_r01_whole(spark, sf):
    s = view(spark, sf, "scored")
    return rel.union_by_name([s.select("event_id", "Probability"), s.select("event_id", "is_real")])


@query("R02_wide_to_long", with_views("", "weather").rstrip() + ",\n" + _W_SUMMARY + "\n" + " UNION ALL ".join(
    f"SELECT Year, Month, DayOfMonth, CRSDepTime, OriginAirportID, '{m}' AS measure, {s6(m)} AS value FROM ws"
    for m in MEASURES))
def q_r02(spark, sf):
    w = fw.weather_summary(view(spark, sf, "weather"))
    return r6(rel.wide_to_long(w, fw.WEATHER_KEYS, MEASURES, "measure", "value"), "value")


@query("R03_long_to_wide_fill", with_ctes(["demand"], _MONTHLY,
    "SELECT Destination, Date, " + ", ".join(
        f"{s6(f'coalesce(sum(CASE WHEN ProductCategory = {chr(39)}{v}{chr(39)} THEN Quantity END), 0.0)')} AS {v}"
        for v in "FOP") + " FROM m GROUP BY Destination, Date"))
def q_r03(spark, sf):
    out = rel.long_to_wide(_monthly(spark, sf), ["Destination", "Date"], "ProductCategory", None, "Quantity")
    return r6(out, "F", "O", "P")


@query("R04_unite_and_separate", with_views(
    "SELECT DISTINCT CustomerName, ProductCategory, Destination, "
    "concat_ws('_', CustomerName, ProductCategory, Destination) AS unique_group, "
    "split_part(concat_ws('_', CustomerName, ProductCategory, Destination), '_', 1) AS k1, "
    "split_part(concat_ws('_', CustomerName, ProductCategory, Destination), '_', 2) AS k2, "
    "split_part(concat_ws('_', CustomerName, ProductCategory, Destination), '_', 3) AS k3 FROM demand", "demand"))
def q_r04(spark, sf):
    d = view(spark, sf, "demand").select(*DEMAND_KEYS).distinct()
    return rel.separate(rel.unite(d, DEMAND_KEYS, "unique_group"), "unique_group", ["k1", "k2", "k3"])


@query("R05_transpose", with_ctes(["demand"], """
s AS (SELECT ProductCategory, CAST(count(*) AS DOUBLE) AS n_orders, sum(Quantity) AS total_quantity,
      avg(Quantity) AS mean_quantity FROM demand GROUP BY ProductCategory)""",
    " UNION ALL ".join(
        f"SELECT '{m}' AS column, " + ", ".join(
            f"{s6(f'max(CASE WHEN ProductCategory = {chr(39)}{v}{chr(39)} THEN {m} END)')} AS {v}" for v in "FOP")
        + " FROM s" for m in ["n_orders", "total_quantity", "mean_quantity"])))
def q_r05(spark, sf):
    d = view(spark, sf, "demand")
    s = d.groupBy("ProductCategory").agg(F.count(F.lit(1)).cast("double").alias("n_orders"),
                                         F.sum("Quantity").alias("total_quantity"),
                                         F.avg("Quantity").alias("mean_quantity"))
    out = rel.transpose(s, "ProductCategory", ["n_orders", "total_quantity", "mean_quantity"], None)
    return r6(out, "F", "O", "P")


@query("R06_row_complement", "SELECT d.doc_id, d.lang, d.n_chars FROM documents d WHERE NOT EXISTS "
       "(SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def q_r06(spark, sf):
    from loam.session import read_table
    docs = read_table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    return rel.anti_join(docs, read_table(spark, sf, "labels"), ["doc_id"])


# ---------------------------------------------------------------- scalar functions
@query("F02_F03_F04_math_functions", with_views(
    f"SELECT event_id, sin(Probability) AS s, cos(Probability) AS c, atan2(Probability, 1e0) AS a, "
    f"sqrt(Probability) AS r, pow(Probability, 2) AS p2, pi() * Probability AS pp, "
    f"{s6('CASE WHEN Probability > 0 THEN log10(Probability) END')} AS lg, {s6('exp(Probability)')} AS ex, "
    f"{s6('ln(Probability)')} AS lnp FROM scored", "scored"))
def q_f02(spark, sf):
    s = view(spark, sf, "scored")
    p = F.col("Probability")
    out = s.select("event_id", F.sin(p).alias("s"), F.cos(p).alias("c"), F.atan2(p, F.lit(1.0)).alias("a"),
                   F.sqrt(p).alias("r"), F.pow(p, 2).alias("p2"), (F.pi() * p).alias("pp"),
                   fx.log10_or_null(p).alias("lg"), F.exp(p).alias("ex"), F.ln(p).alias("lnp"))
    return r6(out, "lg", "ex", "lnp")


@query("F05_F06_U01_U04_distance", with_views(
    f"SELECT o_orderkey, hack_license, passenger_count, {s6(_HAV)} AS d_long_first, {s6(_HAV)} AS d_lat_first, "
    f"{s6(_HAV)} AS d_sql FROM trips", "trips"))
def q_f05(spark, sf):
    from loam.functions.geo import register_distance_function
    register_distance_function(spark)
    t = view(spark, sf, "trips")
    out = t.select("o_orderkey", "hack_license", "passenger_count",
                   haversine_miles("pickup_longitude", "pickup_latitude", "dropoff_longitude",
                                   "dropoff_latitude").alias("d_long_first"),
                   calculate_distance("pickup_latitude", "pickup_longitude", "dropoff_latitude",
                                      "dropoff_longitude").alias("d_lat_first"),
                   F.expr("fnCalculateDistance(pickup_latitude, pickup_longitude, dropoff_latitude, "
                          "dropoff_longitude)").alias("d_sql"))
    return r6(out, "d_long_first", "d_lat_first", "d_sql")


@query("F07_date_parts", with_views(
    "SELECT DISTINCT Date, CAST(year(Date) AS INT) AS y, CAST(month(Date) AS INT) AS mo, "
    "CAST(date_trunc('month', Date) AS DATE) AS month_start FROM demand", "demand"))
def q_f07(spark, sf):
    d = view(spark, sf, "demand")
    return d.select("Date", F.year("Date").alias("y"), F.month("Date").alias("mo"),
                    F.trunc("Date", "MM").alias("month_start")).distinct()


@query("F08_F09_string_functions", with_views(
    "SELECT doc_id, split_part(fname, '/', 2) AS split_set, split_part(fname, '/', 3) AS split_label, "
    "regexp_extract(fname, '_(\\d+)\\.txt$', 1) AS rating_text, "
    "regexp_replace(fname, '^src/(train|test)/.*$', '\\1') AS set_name, "
    "concat('f', CAST(doc_id AS VARCHAR), '_', split_part(fname, '/', 3)) AS pasted, "
    "printf('%s-%05d', split_part(fname, '/', 3), doc_id) AS formatted FROM reviews", "reviews"))
def q_f08(spark, sf):
    r = view(spark, sf, "reviews")
    parts = F.split("fname", "/")
    return r.select("doc_id", parts.getItem(1).alias("split_set"), parts.getItem(2).alias("split_label"),
                    F.regexp_extract("fname", r"_(\d+)\.txt$", 1).alias("rating_text"),
                    F.regexp_replace("fname", r"^src/(train|test)/.*$", "$1").alias("set_name"),
                    F.concat(F.lit("f"), F.col("doc_id").cast("string"), F.lit("_"), parts.getItem(2)).alias("pasted"),
                    F.format_string("%s-%05d", parts.getItem(2), F.col("doc_id")).alias("formatted"))


@query("F13_power_set_cube", with_ctes(["demand"], _MONTHLY,
    "SELECT CustomerName, ProductCategory, Destination, " + s6("sum(Quantity)") + " AS Quantity, "
    "CAST(GROUPING(CustomerName) * 4 + GROUPING(ProductCategory) * 2 + GROUPING(Destination) AS INT) AS gid, "
    "count(*) AS n_cells FROM m GROUP BY CUBE (CustomerName, ProductCategory, Destination)"))
def q_f13(spark, sf):
    sets = fx.power_set_list(DEMAND_KEYS)
    m = _monthly(spark, sf)
    n = len(DEMAND_KEYS)
    from functools import reduce
    gid = reduce(lambda a, b: a + b, [F.grouping(k) * (1 << (n - 1 - i)) for i, k in enumerate(DEMAND_KEYS)])
    out = m.groupingSets([list(s) for s in sets], *DEMAND_KEYS).agg(
        F.sum("Quantity").alias("Quantity"), gid.cast("int").alias("gid"), F.count(F.lit(1)).alias("n_cells"))
    return r6(out, "Quantity")


# ---------------------------------------------------------------- file round trips
from loam.session import read_table, scratch_path  # noqa: E402
from loam.sources import types as ty  # noqa: E402
from loam.sources import files as fl  # noqa: E402

_FL_TYPES = {"event_id": "bigint", "ArrDel15": "int", "Year": "int", "Month": "int", "DayOfMonth": "int",
             "DayOfWeek": "int", "Carrier": "string", "OriginAirportID": "int", "DestAirportID": "int",
             "CRSDepTime": "int", "CRSArrTime": "int"}


def _flights_csv(spark, sf) -> str:
    """The flights rows written as header CSV with the text null token."""
    path = scratch_path(spark, "flights-csv")
    view(spark, sf, "flights").write.option("header", True).option("nullValue", "null").csv(path)
    return path


@query("S01_csv_all_text_null_token", with_views(
    "SELECT " + ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in _FL_TYPES) + " FROM flights", "flights"))
def q_s01(spark, sf):
    return fl.read_csv_text(spark, _flights_csv(spark, sf), list(_FL_TYPES))


@query("S02_S03_csv_declared_types", with_views("SELECT * FROM flights", "flights"))
def q_s02(spark, sf):
    return fl.read_csv_typed(spark, _flights_csv(spark, sf), _FL_TYPES)


#: Text columns of orders, as Spark and DuckDB both spell them.
_DIRTY = {
    "k": "CASE WHEN o_orderkey % 10 = 0 THEN 'NA' ELSE CAST(o_orderkey AS STRING) END",
    "big": "concat(CAST(o_orderkey AS STRING), '000000000000')",
    "num": "CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderkey AS STRING) ELSE concat('-', CAST(o_orderkey AS STRING), '.5e1') END",
    "flag": "CASE WHEN o_orderkey % 4 = 0 THEN 'null' WHEN o_orderkey % 2 = 0 THEN 'TRUE' ELSE 'false' END",
    "day": "concat('2024-0', CAST(o_orderkey % 9 + 1 AS STRING), '-1', CAST(o_orderkey % 10 AS STRING))",
    "moment": "CASE WHEN o_orderkey % 5 = 0 THEN '2024-02-29' ELSE concat('2024-01-01T0', CAST(o_orderkey % 10 AS STRING), ':30:00.25') END",
    "bad_day": "CASE WHEN o_orderkey % 97 = 1 THEN '2023-02-29' ELSE '2024-02-29' END",
    "rare_word": "CASE WHEN o_orderkey % 997 = 1 THEN concat('x', CAST(o_orderkey AS STRING)) ELSE CAST(o_orderkey AS STRING) END",
    "none": "CASE WHEN o_orderkey % 2 = 0 THEN 'NA' ELSE 'N/A' END",
    "name": "o_orderstatus"}
_NULLS = ", ".join(f"'{t}'" for t in ty.NULL_TOKENS)


def _lattice_sql(name: str) -> str:
    whole = f"regexp_matches(c, '{ty.INTEGER}')"
    fits = {"boolean": "lower(c) IN ('true', 'false')",
            "int": f"{whole} AND coalesce(TRY_CAST(c AS BIGINT) BETWEEN -2147483648 AND 2147483647, false)",
            "bigint": whole, "double": f"regexp_matches(c, '{ty.NUMBER}')",
            "date": f"regexp_matches(c, '{ty.DAY}') AND TRY_CAST(c AS DATE) IS NOT NULL",
            "timestamp": f"regexp_matches(c, '{ty.MOMENT}') AND TRY_CAST(c AS TIMESTAMP) IS NOT NULL"}
    whens = " ".join(f"WHEN bool_and({fits[t]}) FILTER (WHERE c IS NOT NULL) THEN '{t}'" for t in ty.ORDER)
    return (f"SELECT '{name}' AS \"column\", CASE {whens} ELSE 'string' END AS type, count(*) - count(c) AS nulls, count(c) AS known, "
            f"CAST(max(length(c)) AS INT) AS longest FROM (SELECT CASE WHEN {name} NOT IN ({_NULLS}) THEN {name} END AS c FROM d)")


@query("S02_type_lattice_of_dirty_columns", "WITH d AS (SELECT " + ", ".join(f"{e} AS {c}" for c, e in _DIRTY.items())
       + " FROM orders) " + " UNION ALL ".join(_lattice_sql(c) for c in _DIRTY))
def q_s02_lattice(spark, sf):
    """Types of ten dirty text columns, inferred from a CSV of all orders and read back from the record."""
    path = scratch_path(spark, "dirty-csv")
    read_table(spark, sf, "orders").selectExpr(*[f"{e} AS {c}" for c, e in _DIRTY.items()]).write.option("header", True).csv(path)
    return ty.infer_csv_types(spark, path, scratch_path(spark, "types"))


@query("S04_csv_integer_matrix", with_views(
    "SELECT " + ", ".join(c for c, t in _FL_TYPES.items() if t == "int") + " FROM flights", "flights"))
def q_s04(spark, sf):
    ints = [c for c, t in _FL_TYPES.items() if t == "int"]
    path = scratch_path(spark, "flights-int-csv")
    view(spark, sf, "flights").select(*ints).write.option("header", True).option("nullValue", "NA").csv(path)
    return fl.read_csv_int_matrix(spark, path, ints)


@query("S07_parquet_table_round_trip", with_views("SELECT * FROM trips", "trips"))
def q_s07(spark, sf):
    path = fl.write_table(view(spark, sf, "trips"), scratch_path(spark, "trips"), max_records_per_file=20000)
    return spark.read.parquet(path)


@query("S14_stage_only_if_missing", with_views("SELECT * FROM flights", "flights"))
def q_s14(spark, sf):
    path = scratch_path(spark, "staged")
    f = view(spark, sf, "flights")
    fl.stage_if_missing(f, path)
    fl.stage_if_missing(f, path)                   # already there: left as it is, no duplicate rows
    return spark.read.parquet(path)


# ---------------------------------------------------------------- more ids
@query("P10_positional_rename", with_views("", "weather").rstrip() + ",\n" + _W_SUMMARY
       + "\nSELECT Year AS y, Month AS mo, DayOfMonth AS dom, CRSDepTime AS hr, OriginAirportID AS airport, "
       + ", ".join(s6(m) + f" AS m{i}" for i, m in enumerate(MEASURES)) + " FROM ws")
def q_p10(spark, sf):
    w = r6(fw.weather_summary(view(spark, sf, "weather")), *MEASURES)
    return rel.rename_positional(w, ["y", "mo", "dom", "hr", "airport"] + [f"m{i}" for i in range(len(MEASURES))])


@query("R07_column_set_difference", with_views("SELECT * EXCLUDE (ArrDel15) FROM flights", "flights"))
def q_r07(spark, sf):
    f = view(spark, sf, "flights")
    return f.select(*rel.column_difference(f.columns, ["ArrDel15"]))


@query("H04_path_based_split", with_views(
    "SELECT doc_id, fname, CASE WHEN regexp_matches(fname, '/train/') THEN 'train' ELSE 'rest' END AS split "
    "FROM reviews", "reviews"))
def q_h04(spark, sf):
    r = view(spark, sf, "reviews").select("doc_id", "fname")
    train, rest = smp.path_split(r, "fname", "/train/")
    return train.withColumn("split", F.lit("train")).unionByName(rest.withColumn("split", F.lit("rest")))


@query("S11_import_with_known_levels", with_views(
    "SELECT o_orderkey, hack_license, passenger_count, CASE WHEN payment_type IN ('CSH','CRD','DIS','NOC','UNK') "
    "THEN payment_type END AS payment_type FROM trips", "trips"))
def q_s11(spark, sf):
    t = view(spark, sf, "trips").select("o_orderkey", "hack_license", "passenger_count", "payment_type")
    return tb.import_with_levels(t, {"payment_type": PAYMENT_LEVELS})


@query("S08_text_file_directory", with_views(
    "SELECT doc_id, CAST(regexp_extract(fname, '_(\\d+)\\.txt$', 1) AS INT) AS rating, "
    "CAST(regexp_extract(fname, '_(\\d+)\\.txt$', 1) AS INT) > 5 AS sentiment, review || chr(10) AS review "
    "FROM reviews WHERE NOT regexp_matches(fname, 'unsup')", "reviews"))
def q_s08(spark, sf):
    """Reviews written as one text file per review (directories named by the
    review's file name), then read back as a directory of files."""
    root = scratch_path(spark, "review-files")
    r = view(spark, sf, "reviews").withColumn(
        "file", F.replace(F.regexp_replace("fname", "^src/(train|test)/", ""), F.lit("/"), F.lit("-")))
    fl.write_text_files(r.select("file", "review"), root, "file")
    got = fl.read_text_files(spark, root, label_pattern=r"_(\d+)\.txt(?:/|$)")
    return got.select(F.regexp_extract("fname", r"file=(?:pos|neg)-(\d+)_", 1).cast("bigint").alias("doc_id"),
                      F.regexp_extract("fname", r"_(\d+)\.txt(?:/|$)", 1).cast("int").alias("rating"),
                      "sentiment", "review")


@query("U02_batch_function_adds_columns", with_views(
    f"SELECT o_orderkey, hack_license, passenger_count, {s6(_HAV)} AS direct_distance FROM trips", "trips"))
def q_u02(spark, sf):
    from loam.functions.geo import haversine_numpy
    from loam.operators.batch import add_columns_in_batches
    t = view(spark, sf, "trips").select("o_orderkey", "hack_license", "passenger_count", "pickup_longitude",
                                        "pickup_latitude", "dropoff_longitude", "dropoff_latitude")

    def fn(pdf):
        return pdf.assign(direct_distance=haversine_numpy(pdf.pickup_longitude, pdf.pickup_latitude,
                                                          pdf.dropoff_longitude, pdf.dropoff_latitude))
    out = add_columns_in_batches(t, fn, "direct_distance double")
    return r6(out.select("o_orderkey", "hack_license", "passenger_count", "direct_distance"), "direct_distance")


EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


@query("A09_crosstab_wide_layout", with_views(
    "SELECT PredictedLabel, " + ", ".join(f"CAST(count_if(category = '{c}') AS BIGINT) AS {c}" for c in EVENT_TYPES)
    + " FROM scored GROUP BY PredictedLabel", "scored"))
def q_a09w(spark, sf):
    return rel.crosstab_wide(view(spark, sf, "scored"), "PredictedLabel", "category")


@query("A11_stored_sketch_unions", with_views(
    "SELECT category, n, prob, true AS within_error FROM (SELECT category, count(Probability) AS n FROM scored GROUP BY category "
    f"UNION ALL SELECT 'all', count(Probability) FROM scored), (SELECT unnest({_PLIST}) AS prob)", "scored"))
def q_a11_stored(spark, sf):
    """Sketches by category and fold, stored; quantiles of each category and of all
    rows from unions of them, each held against the rows' own ranks."""
    from loam.operators import ranking as rk
    s = view(spark, sf, "scored").withColumn("fold", smp.fold_id("event_id", 3, 5))
    path = scratch_path(spark, "quantile-sketches")
    rk.quantile_sketches(s, "Probability", ["category", "fold"]).write.parquet(path)
    stored = spark.read.parquet(path)
    got = rk.sketch_quantiles(stored, PROBS, ["category"]).unionByName(
        rk.sketch_quantiles(stored, PROBS).withColumn("category", F.lit("all")))
    rows = s.select("category", "Probability").unionByName(s.select(F.lit("all").alias("category"), "Probability"))
    error = rk.sketch_rank_error(4096)
    ranks = rows.join(got, "category").groupBy("category", "n", "prob").agg(
        F.count_if(F.col("Probability") < F.col("value")).alias("below"), F.count_if(F.col("Probability") <= F.col("value")).alias("upto"))
    ok = (F.col("below") <= (F.col("prob") + error) * F.col("n") + 1) & (F.col("upto") >= (F.col("prob") - error) * F.col("n") - 1)
    return ranks.select("category", "n", "prob", ok.alias("within_error"))


@query("A11_approx_percentiles_sketch")
def q_a11_sketch(spark, sf):
    """A11, sketch form: mergeable quantile summaries (bounded memory per
    task); values are within the sketch's rank error of the exact ones."""
    from loam.operators.ranking import approx_quantiles
    return approx_quantiles(view(spark, sf, "scored"), "Probability", PROBS, accuracy=10000)


# the names of earlier rounds for the queries over whole tables
for _name in ("P13_drop_constant_columns", "J04_full_join_fill_zero", "R01_union_by_name"):
    QUERIES[_name], ORACLE[_name] = QUERIES[f"{_name}_whole"], ORACLE[f"{_name}_whole"]
