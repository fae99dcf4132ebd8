"""Great-circle distance (F05, F06, U01, U04) as one column expression."""

from __future__ import annotations

import math

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Earth radius in miles as used by the distance feature.
EARTH_RADIUS_MILES = 6371 / 1.609344


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def haversine_miles(pickup_long, pickup_lat, dropoff_long, dropoff_lat) -> Column:
    """haversine distance in miles; argument order (long, lat, long, lat)."""
    lon1, lat1, lon2, lat2 = map(_c, (pickup_long, pickup_lat, dropoff_long, dropoff_lat))
    rad = math.pi / 180.0
    a1 = F.sin((lat2 - lat1) / 2 * rad)
    a5 = F.sin((lon2 - lon1) / 2 * rad)
    a = a1 * a1 + F.cos(lat1 * rad) * F.cos(lat2 * rad) * (a5 * a5)
    c = 2 * F.atan2(F.sqrt(a), F.sqrt(1 - a))
    return F.lit(EARTH_RADIUS_MILES) * c


def haversine_numpy(pickup_long, pickup_lat, dropoff_long, dropoff_lat):
    """The same formula on numpy arrays (for batch functions, U02)."""
    import numpy as np
    rad = math.pi / 180.0
    a1 = np.sin((dropoff_lat - pickup_lat) / 2 * rad)
    a5 = np.sin((dropoff_long - pickup_long) / 2 * rad)
    a = a1 * a1 + np.cos(pickup_lat * rad) * np.cos(dropoff_lat * rad) * (a5 * a5)
    return EARTH_RADIUS_MILES * (2 * np.arctan2(np.sqrt(a), np.sqrt(1 - a)))


def calculate_distance(lat1, lon1, lat2, lon2) -> Column:
    """the database-function form, latitude first."""
    return haversine_miles(lon1, lat1, lon2, lat2)


def dlit(x: float) -> str:
    """A double literal for SQL text (plain ``1.5`` is a DECIMAL in Spark SQL
    and DuckDB)."""
    r = repr(float(x))
    return r if "e" in r or "inf" in r or "nan" in r else r + "e0"


def haversine_sql(lon1: str, lat1: str, lon2: str, lat2: str) -> str:
    """The same formula as SQL text (same operation order as the Column form)."""
    rad = dlit(math.pi / 180.0)
    a1 = f"sin(({lat2} - {lat1}) / 2 * {rad})"
    a5 = f"sin(({lon2} - {lon1}) / 2 * {rad})"
    a = f"({a1} * {a1} + cos({lat1} * {rad}) * cos({lat2} * {rad}) * ({a5} * {a5}))"
    return f"({dlit(EARTH_RADIUS_MILES)} * (2 * atan2(sqrt({a}), sqrt(1 - {a}))))"


def register_distance_function(spark: SparkSession, name: str = "fnCalculateDistance") -> None:
    """A SQL scalar function for SQL-text callers (no Python UDF)."""
    body = haversine_sql("lon1", "lat1", "lon2", "lat2")
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}"
        f"(lat1 DOUBLE, lon1 DOUBLE, lat2 DOUBLE, lon2 DOUBLE) RETURNS DOUBLE RETURN {body}"
    )
