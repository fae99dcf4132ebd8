"""Repeatable sampling, folds and splits.

Every random choice is a function of a row key and a salt (md5 of
``key:salt``), so a row gets the same fold / sample flag whatever the
partitioning, file layout or executor that computes it -- recomputation after
an executor loss gives the same rows, and two passes (fit, then score the
held-out rows) agree.  The same expression runs in DuckDB, so the folds can be
checked there.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loam.operators.ranking import equal_sets, group_row_number

HASH_SPACE = 2 ** 32


def _key_text(key_cols) -> Column:
    cols = [key_cols] if isinstance(key_cols, str) else list(key_cols)
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols]
    return parts[0] if len(parts) == 1 else F.concat_ws("|", *parts)


def hash_unit(key_cols, salt) -> Column:
    """Uniform integer in [0, 2^32) from ``md5(key ':' salt)`` (first 32 bits)."""
    h = F.md5(F.concat(_key_text(key_cols), F.lit(f":{salt}")))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint")


def fold_id(key_cols, k: int, salt) -> Column:
    """Fold number 1..k."""
    return (hash_unit(key_cols, salt) % k + 1).cast("int")


def repeatable_sample(df: DataFrame, key_cols, percent: float, seed) -> DataFrame:
    """A ``percent`` % sample that is the same on every run and layout
    (``TABLESAMPLE ... REPEATABLE`` is not layout-independent on Spark)."""
    return df.where(hash_unit(key_cols, seed) % 10000 < F.lit(int(round(percent * 100))))


def tag_rows(df: DataFrame, key_cols, kfolds: int, kfold_id: int, prob: float, salt,
             fold_col: str = "kfold", test_col: str = "in_test_set",
             train_col: str = "in_training_set") -> DataFrame:
    """Fold id, test flag (fold == ``kfold_id``) and training flag (a
    ``prob`` fraction of the other rows).  Training sets for growing ``prob``
    are nested because the same second hash is compared to a growing
    threshold."""
    fold = fold_id(key_cols, kfolds, salt)
    u = hash_unit(key_cols, f"{salt}:train")
    return (df.withColumn(fold_col, fold)
              .withColumn(test_col, F.col(fold_col) == kfold_id)
              .withColumn(train_col, (~F.col(test_col)) & (u < F.lit(int(math.floor(prob * HASH_SPACE))))))


def tag_rows_exact(df: DataFrame, key_cols, kfolds: int, kfold_id: int, prob: float, salt,
                   fold_col: str = "kfold", test_col: str = "in_test_set",
                   train_col: str = "in_training_set") -> DataFrame:
    """Like :func:`tag_rows`, but exactly ``floor(prob * candidates)``
    training rows: the candidates with the smallest second hash, ranked by a
    distributed sort (no single-task window)."""
    cols = [key_cols] if isinstance(key_cols, str) else list(key_cols)
    base = (df.withColumn(fold_col, fold_id(cols, kfolds, salt))
              .withColumn(test_col, F.col(fold_col) == kfold_id)
              .withColumn("_u", hash_unit(cols, f"{salt}:train")))
    ranked = group_row_number(base, ["_u", *cols], [test_col], name="_rn", size_name="_cand")
    keep = (~F.col(test_col)) & (F.col("_rn") < F.floor(F.col("_cand") * F.lit(float(prob))))
    return ranked.withColumn(train_col, keep).drop("_u", "_rn", "_cand")


def shuffle_rows(df: DataFrame, key_cols, salt) -> DataFrame:
    """A seeded permutation (order by the key hash, key as tie-break)."""
    cols = [key_cols] if isinstance(key_cols, str) else list(key_cols)
    return df.orderBy(F.md5(F.concat(_key_text(cols), F.lit(f":{salt}"))), *cols)


def disjoint_parts(df: DataFrame, key_cols, k: int, salt, col: str = "part") -> DataFrame:
    """``k`` disjoint parts for an ensemble (H02 with k parts)."""
    return df.withColumn(col, fold_id(key_cols, k, salt))


def training_fractions(min_tss: float, max_tss: float, n: int) -> list[float]:
    """Geometric training fractions from min/max to 1."""
    if n == 1:
        return [1.0]
    a = math.log(min_tss / max_tss)
    return [math.exp(a + (0.0 - a) * i / (n - 1)) for i in range(n)]


def training_fractions_col(min_tss: Column | float, max_tss: Column | float, n: int) -> Column:
    """H07 as a column: array of the n fractions (``max_tss`` may be a count
    from the data, e.g. a scalar subquery)."""
    mn = min_tss if isinstance(min_tss, Column) else F.lit(float(min_tss))
    mx = max_tss if isinstance(max_tss, Column) else F.lit(float(max_tss))
    a = F.log(mn / mx)
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)),
                       lambda i: F.exp(a + (F.lit(0.0) - a) * i / F.lit(max(n - 1, 1))))


def path_split(df: DataFrame, path_col: str, pattern: str = "/train/") -> tuple[DataFrame, DataFrame]:
    """Rows whose path matches ``pattern`` and the rest."""
    m = F.col(path_col).rlike(pattern)
    return df.where(m), df.where(~m)


def time_split(df: DataFrame, date_col: str, cutoff, end=None) -> tuple[DataFrame, DataFrame]:
    """Train before ``cutoff``, test from ``cutoff`` (up to ``end``)."""
    d = F.col(date_col)
    test = d >= F.lit(cutoff) if end is None else (d >= F.lit(cutoff)) & (d < F.lit(end))
    return df.where(d < F.lit(cutoff)), df.where(test)


def row_sets(df: DataFrame, n_sets: int, key_cols: Sequence[str], col: str = "set_id") -> DataFrame:
    """Equal-size row sets (sizes differ by at most one)."""
    return equal_sets(df, n_sets, list(key_cols), name=col)


def key_text_sql(cols) -> str:
    """SQL text of the hashed key (same as the Column form)."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    parts = [f"coalesce(CAST({c} AS VARCHAR), '')" for c in cols]
    return parts[0] if len(parts) == 1 else "concat_ws('|', " + ", ".join(parts) + ")"


def hash_sql(cols, salt) -> str:
    """``hash_unit`` as DuckDB SQL text."""
    return (f"CAST('0x' || substr(md5(concat({key_text_sql(cols)}, ':{salt}')), 1, 8) AS BIGINT)")
