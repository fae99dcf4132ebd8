"""Table/query sources and inspection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loam.functions.scalar import factor_value

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
           T.DecimalType)


def sql_source(spark: SparkSession, query: str, col_types: Mapping[str, str] | None = None,
               **tables: DataFrame) -> DataFrame:
    """A SQL query as a lazy source.  ``{name}`` placeholders in the text
    are bound to the given DataFrames; ``col_types`` casts result columns."""
    df = spark.sql(query, **tables)
    return typed_columns(df, col_types or {})


def jdbc_source(spark: SparkSession, url: str, query: str, fetch_size: int = 10000,
                **options) -> DataFrame:
    """S05 for an external database: the query runs there, rows arrive in
    batches of ``fetch_size``."""
    r = (spark.read.format("jdbc").option("url", url).option("query", query)
              .option("fetchsize", fetch_size))
    for k, v in options.items():
        r = r.option(k, v)
    return r.load()


def typed_columns(df: DataFrame, col_types: Mapping[str, str]) -> DataFrame:
    """Open a table with declared column types (``try_cast``)."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in col_types.items()})


def import_with_levels(df: DataFrame, levels: Mapping[str, Sequence[str]]) -> DataFrame:
    """Rows imported with known factor levels; unlisted values -> null."""
    return df.withColumns({c: factor_value(c, lv) for c, lv in levels.items()})


def inspect(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """One row per column: name, type, low, high (numeric columns),
    valid and missing counts -- all from one aggregation pass."""
    cols = list(cols or df.columns)
    types = {f.name: f.dataType for f in df.schema.fields}
    aggs, rows = [], []
    for i, c in enumerate(cols):
        num = isinstance(types[c], NUMERIC)
        aggs += [F.count(F.col(c)).alias(f"v{i}")]
        if num:
            aggs += [F.min(F.col(c)).cast("double").alias(f"lo{i}"),
                     F.max(F.col(c)).cast("double").alias(f"hi{i}")]
        lo = f"lo{i}" if num else "CAST(NULL AS DOUBLE)"
        hi = f"hi{i}" if num else "CAST(NULL AS DOUBLE)"
        rows.append(f"'{c}', '{types[c].simpleString()}', {lo}, {hi}, v{i}, _n - v{i}")
    one = df.agg(F.count(F.lit(1)).alias("_n"), *aggs)
    return one.selectExpr(
        f"stack({len(cols)}, {', '.join(rows)}) AS (name, type, low, high, valid_n, missing_n)")


def level_record(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The levels of each factor column, one row per (column, level)."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("level")) for c in cols])
    return df.select(F.explode(pairs).alias("p")).select("p.*").where("level IS NOT NULL").distinct()
