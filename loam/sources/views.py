"""Views that map the driver's tables onto the shapes the operators expect
(flights, weather, trips, demand, names, reviews, scored).

Each view is one SQL text with ``{table}`` placeholders.  On Spark the
placeholders are bound to DataFrames (``spark.sql(text, events=df)``), so no
global temp view is needed; for the DuckDB oracle they become plain table
names.  No operator knows about these views.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from loam.session import read_table

# Fixed view texts (the test-data mapping; values are part of the fixture).
VIEW_SQL = {
    "flights": """
SELECT event_id,
       CASE WHEN event_id % 50 = 0 THEN NULL ELSE CAST(event_type = 'error' AS INT) END AS ArrDel15,
       CAST(year(ts) AS INT) AS Year, CAST(month(ts) AS INT) AS Month,
       CAST(day(ts) AS INT) AS DayOfMonth, CAST((day(ts) - 1) % 7 + 1 AS INT) AS DayOfWeek,
       concat('C', CAST(user_id % 5 AS STRING)) AS Carrier,
       CAST(user_id % 25 AS INT) AS OriginAirportID,
       CAST((user_id * 7 + event_id) % 25 AS INT) AS DestAirportID,
       CAST(hour(ts) * 100 + minute(ts) AS INT) AS CRSDepTime,
       CAST(((hour(ts) + 2) % 24) * 100 + minute(ts) AS INT) AS CRSArrTime
FROM {events} WHERE event_type IN ('purchase', 'error')
""",
    "weather": """
SELECT CAST(year(ts) AS INT) AS AdjustedYear, CAST(month(ts) AS INT) AS AdjustedMonth,
       CAST(day(ts) AS INT) AS AdjustedDay, CAST(hour(ts) AS INT) AS AdjustedHour,
       CAST(user_id % 25 AS INT) AS AirportID,
       CASE WHEN event_id % 40 = 0 THEN NULL ELSE value / 50e0 END AS Visibility,
       CAST(event_id % 40 AS DOUBLE) - 5e0 AS DryBulbCelsius,
       CAST(event_id % 30 AS DOUBLE) - 8e0 AS DewPointCelsius,
       CAST(event_id % 100 AS DOUBLE) AS RelativeHumidity,
       value / 20e0 AS WindSpeed,
       29e0 + (event_id % 20) / 10e0 AS Altimeter
FROM {events} WHERE event_type IN ('view', 'click', 'signup')
""",
    "trips": """
SELECT o_orderkey, o_custkey AS medallion, l_suppkey AS hack_license,
       o_orderdate AS pickup_datetime, l_shipdate AS dropoff_datetime,
       l_linenumber AS passenger_count,
       CAST(l_quantity * 60 AS INT) AS trip_time_in_secs, l_quantity AS trip_distance,
       l_extendedprice / 1000e0 AS fare_amount,
       l_extendedprice * l_discount / 1000e0 AS tip_amount,
       CAST(l_discount > 4e-2 AS INT) AS tipped,
       -74e0 + (l_partkey % 100) / 500e0 AS pickup_longitude,
       40.6e0 + (l_partkey % 70) / 350e0 AS pickup_latitude,
       -74e0 + (l_suppkey % 90) / 450e0 AS dropoff_longitude,
       40.6e0 + (l_suppkey % 60) / 300e0 AS dropoff_latitude,
       CASE WHEN o_orderstatus = 'P' THEN 'XXX' WHEN l_returnflag = 'A' THEN 'CSH'
            WHEN l_returnflag = 'R' THEN 'CRD' ELSE 'UNK' END AS payment_type
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
""",
    "demand": """
SELECT c_mktsegment AS CustomerName, o_orderstatus AS ProductCategory, r_name AS Destination,
       CAST(o_orderdate AS DATE) AS Date,
       CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_totalprice / 1000e0 END AS Quantity
FROM {orders} JOIN {customer} ON o_custkey = c_custkey
            JOIN {nation} ON c_nationkey = n_nationkey
            JOIN {region} ON n_regionkey = r_regionkey
""",
    "names": """
SELECT d.doc_id, d.text AS name, d.lang AS category, l.quality AS is_real
FROM {documents} d JOIN {labels} l ON d.doc_id = l.doc_id
""",
    "reviews": """
SELECT d.doc_id,
       concat('src/', CASE WHEN d.doc_id % 2 = 0 THEN 'train' ELSE 'test' END, '/',
              CASE WHEN l.quality = 1 THEN 'pos' WHEN l.quality = 0 THEN 'neg' ELSE 'unsup' END, '/',
              CAST(d.doc_id AS STRING), '_',
              CAST(CASE WHEN l.quality = 1 THEN 6 + d.doc_id % 5 WHEN l.quality = 0 THEN 1 + d.doc_id % 5 ELSE 0 END AS STRING),
              '.txt') AS fname,
       d.text AS review
FROM {documents} d LEFT JOIN {labels} l ON d.doc_id = l.doc_id
""",
    # whole documents with their labels (the text counterpart of "names")
    "texts": """
SELECT d.doc_id, d.text, d.lang AS category, l.quality AS is_real
FROM {documents} d LEFT JOIN {labels} l ON d.doc_id = l.doc_id
""",
    "scored": """
SELECT event_id, event_type AS category, value / 500e0 AS Probability,
       CAST(event_type IN ('purchase', 'error') AS INT) AS is_real,
       value > 50 AS PredictedLabel
FROM {events}
""",
}

_PLACEHOLDER = re.compile(r"\{(\w+)\}")


def base_tables(view: str) -> list[str]:
    return sorted(set(_PLACEHOLDER.findall(VIEW_SQL[view])))


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The named view over the parquet tables in ``sf_dir`` (lazy)."""
    text = VIEW_SQL[name]
    dfs = {t: read_table(spark, sf_dir, t) for t in base_tables(name)}
    return spark.sql(text, **dfs)


def views(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    return [view(spark, sf_dir, n) for n in names]


def duckdb_view_sql(name: str) -> str:
    """The same view text with plain table names (for the DuckDB oracle)."""
    return _PLACEHOLDER.sub(lambda m: m.group(1), VIEW_SQL[name])


def with_views(sql: str, *names: str) -> str:
    """Prefix an oracle query with the views it uses as CTEs."""
    ctes = ",\n".join(f"{n} AS ({duckdb_view_sql(n).strip()})" for n in names)
    return f"WITH {ctes}\n{sql}"


def with_ctes(names, ctes: str, select: str) -> str:
    """Views ``names`` plus further CTE definitions ``ctes`` (``a AS (...),
    b AS (...)``), then the final ``select``."""
    parts = [f"{n} AS ({duckdb_view_sql(n).strip()})" for n in names]
    if ctes.strip():
        parts.append(ctes.strip().rstrip(","))
    return "WITH " + ",\n".join(parts) + "\n" + select
