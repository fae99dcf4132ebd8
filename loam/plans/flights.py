"""L1: flight / weather clean-and-join.

The hourly weather summary is aggregated once (map-side partial aggregation)
before either join, so the joins cannot fan out; the destination join reuses
the same aggregate (the exchange is reused; only a rename sits above it).
Note: the destination weather is matched on the *departure* hour, because the
shared column name is ``CRSDepTime`` -- kept as in the original workflow.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loam.operators.relational import floor_to_hour, group_means, natural_left_join, rename

FLIGHT_COLUMNS = ["ArrDel15", "Year", "Month", "DayOfMonth", "DayOfWeek", "Carrier",
                  "OriginAirportID", "DestAirportID", "CRSDepTime", "CRSArrTime"]
WEATHER_RENAME = {"AirportID": "OriginAirportID", "AdjustedYear": "Year", "AdjustedMonth": "Month",
                  "AdjustedDay": "DayOfMonth", "AdjustedHour": "CRSDepTime"}
WEATHER_MEASURES = ["Visibility", "DryBulbCelsius", "DewPointCelsius", "RelativeHumidity",
                    "WindSpeed", "Altimeter"]
WEATHER_KEYS = ["Year", "Month", "DayOfMonth", "CRSDepTime", "OriginAirportID"]


def prepare_flights(flights: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """P02 + P03: keep the model columns, truncate departure time to the hour."""
    return floor_to_hour(flights.select(*(carry or []), *FLIGHT_COLUMNS), "CRSDepTime")


def weather_summary(weather: DataFrame) -> DataFrame:
    """P01 + A01: rename to the flight key names, hourly means per airport."""
    w = rename(weather, WEATHER_RENAME)
    return group_means(w, WEATHER_KEYS, WEATHER_MEASURES)


def _suffix(df: DataFrame, suffix: str) -> DataFrame:
    return df.withColumnsRenamed({m: m + suffix for m in WEATHER_MEASURES})


def join_flights_weather(flights: DataFrame, weather: DataFrame,
                         carry: list[str] | None = None) -> DataFrame:
    """J01 + J02: flights with origin and destination weather."""
    fl = prepare_flights(flights, carry)
    summary = weather_summary(weather)
    origin = _suffix(natural_left_join(fl, summary, on=WEATHER_KEYS), "Origin")
    dest_summary = summary.withColumnRenamed("OriginAirportID", "DestAirportID")
    dest_keys = ["Year", "Month", "DayOfMonth", "CRSDepTime", "DestAirportID"]
    return _suffix(natural_left_join(origin, dest_summary, on=dest_keys), "Dest")


def register(df: DataFrame, name: str, cache: bool = True) -> DataFrame:
    """Register a result under a name for SQL callers; persist it when it
    feeds several actions (spills to disk, survives executor loss by
    recomputation from lineage)."""
    if cache:
        from pyspark import StorageLevel
        df = df.persist(StorageLevel.MEMORY_AND_DISK)
    df.createOrReplaceTempView(name)
    return df


def time_split(df: DataFrame, train_before: tuple, test_from: tuple, test_before: tuple,
               cols=("Year", "Month", "DayOfMonth")) -> tuple[DataFrame, DataFrame]:
    """train = date < ``train_before``; test = ``test_from`` <= date <
    ``test_before``; dates given as (year, month, day) tuples on ``cols``."""
    d = F.make_date(*[F.col(c) for c in cols])
    mk = lambda t: F.make_date(F.lit(t[0]), F.lit(t[1]), F.lit(t[2]))
    return df.where(d < mk(train_before)), df.where((d >= mk(test_from)) & (d < mk(test_before)))
