"""The Python escape hatches (U02, U03), for logic that column expressions
cannot state.  Data stays partitioned: ``mapInPandas`` runs per partition on
Arrow batches, ``applyInPandas`` per group -- to be used on groups of bounded
size (e.g. pre-aggregated buckets), never on raw hot keys."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import DataFrame


def add_columns_in_batches(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame],
                           new_fields: str) -> DataFrame:
    """``fn(batch) -> batch`` adds columns; ``new_fields`` is the DDL of
    the added columns (appended to the input schema)."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields) + ", " + new_fields

    def run(batches):
        for pdf in batches:
            yield fn(pdf)
    return df.mapInPandas(run, schema)


def grouped_state(df: DataFrame, by: Sequence[str], fn: Callable[[pd.DataFrame], pd.DataFrame],
                  schema: str) -> DataFrame:
    """A per-group reducer with running state, on groups of bounded size."""
    return df.groupBy(*by).applyInPandas(fn, schema)
