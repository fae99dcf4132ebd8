"""Registered checks: one Spark query per operator id (``queries``) and, where
the result is SQL-expressible, the equivalent DuckDB SQL (``oracle_sql``).

Every query reads the driver's tables (through ``loam.sources.views``) in
full.  Aggregated doubles are rounded to 6 decimals on both sides; raw values
are compared as computed (both engines do the same IEEE operations).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle.strip()
        return fn
    return deco


def r6(df: DataFrame, *cols: str) -> DataFrame:
    """Round the given double columns to 6 decimals (aggregates only)."""
    return df.withColumns({c: F.round(F.col(c), 6) for c in cols})


def s6(expr: str) -> str:
    """The SQL side of ``r6`` (``+ 0.0`` turns -0.0 into 0.0 like Spark)."""
    return f"(round({expr}, 6) + 0.0)"


# Import the modules that register queries (order = report order).
from loam import suite_relational, suite_sampling, suite_metrics, suite_models, suite_forecast  # noqa: E402,F401
