"""Inferred column types (S02): a type lattice per column, merged in one
aggregation over all rows, and kept as a record.

A cell is a null token or belongs to every type whose pattern and range it fits:
boolean; int, within bigint, within double; date, within timestamp; string holds
all.  A column's type is the narrowest one that all its known cells fit.  What a
task keeps for a column is a flag a type, two counts and a length, so parts of the
rows merge in any order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loam.sources.files import read_csv_text

NULL_TOKENS = ("", "NA", "N/A", "NULL", "null", "NaN")
INTEGER = r"^[+-]?[0-9]{1,18}$"
NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]{1,3})?$"
DAY = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
MOMENT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,6})?)?)?$"
#: Narrowest first; a column that fits none is a string.
ORDER = ("boolean", "int", "bigint", "double", "date", "timestamp")


def cell_fits(c: Column) -> dict[str, Column]:
    """Whether a known cell is of each type."""
    whole = F.regexp_like(c, F.lit(INTEGER))
    big = F.when(whole, c.try_cast("bigint"))
    return {
        "boolean": F.lower(c).isin("true", "false"),
        "int": whole & F.coalesce(big.between(-(2 ** 31), 2 ** 31 - 1), F.lit(False)),
        "bigint": whole,
        "double": F.regexp_like(c, F.lit(NUMBER)),
        "date": F.regexp_like(c, F.lit(DAY)) & c.try_cast("date").isNotNull(),
        "timestamp": F.regexp_like(c, F.lit(MOMENT)) & c.try_cast("timestamp").isNotNull(),
    }


def column_types(df: DataFrame, null_tokens: Sequence[str] = NULL_TOKENS) -> DataFrame:
    """The record of a frame of text columns: rows (column, type, nulls, known,
    longest) with the longest known text in characters (null without any).  A
    column without a known cell is a string; an empty frame has all counts 0."""
    if not df.columns:
        return df.sparkSession.createDataFrame([], "column string, type string, nulls long, known long, longest int")
    aggs = []
    for i, name in enumerate(df.columns):
        text = F.col(f"`{name}`").cast("string")
        c = F.when(~text.isin(list(null_tokens)), text)
        aggs += [F.count(c).alias(f"k{i}"), F.max(F.char_length(c)).alias(f"l{i}"),
                 *[F.bool_and(F.when(c.isNotNull(), ok)).alias(f"{t}{i}") for t, ok in cell_fits(c).items()]]
    one = df.agg(F.count(F.lit(1)).alias("n"), *aggs)
    rows = []
    for i, name in enumerate(df.columns):
        kind = F.coalesce(*[F.when(F.col(f"{t}{i}"), F.lit(t)) for t in ORDER], F.lit("string"))
        rows.append(F.struct(F.lit(name).alias("column"), kind.alias("type"), (F.col("n") - F.col(f"k{i}")).alias("nulls"),
                             F.col(f"k{i}").alias("known"), F.col(f"l{i}").alias("longest")))
    return one.select(F.inline(F.array(*rows)))


def infer_csv_types(spark: SparkSession, path: str, record_path: str | None = None, null_tokens: Sequence[str] = NULL_TOKENS,
                    sep: str = ",") -> DataFrame:
    """The record of a header CSV from all its rows; kept at ``record_path``
    (parquet) where that is given."""
    record = column_types(read_csv_text(spark, path, null_value="", sep=sep), null_tokens)
    if record_path is None:
        return record
    record.coalesce(1).write.mode("overwrite").parquet(record_path)
    return spark.read.parquet(record_path)


def read_csv_inferred(spark: SparkSession, path: str, record: DataFrame, null_tokens: Sequence[str] = NULL_TOKENS, sep: str = ",") -> DataFrame:
    """The CSV with the types of its record; null tokens are null."""
    types = {r["column"]: r["type"] for r in record.collect()}         # one row a column
    names = read_csv_text(spark, path, null_value="", sep=sep).columns
    text = read_csv_text(spark, path, names, null_value="", sep=sep)
    return text.select(*[F.when(~F.col(f"`{c}`").isin(list(null_tokens)), F.col(f"`{c}`")).try_cast(types.get(c, "string")).alias(c)
                         for c in names])
