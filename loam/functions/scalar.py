"""Column expressions.

All of these are plain Catalyst expressions: they stay inside whole-stage
codegen and need no Python at run time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def hour_of_hhmm(col) -> Column:
    """Whole-hour truncation of an ``hhmm`` value, ``floor(x / 100)``.

    Text input is converted with ``try_cast`` so dirty values become null
    instead of failing under ANSI mode.  Result type: bigint.
    """
    c = _c(col)
    return F.floor(c.try_cast("int") / F.lit(100))


def safe_int(col) -> Column:
    return _c(col).try_cast("int")


def cast_scale(col, factor: float = 100.0) -> Column:
    """``cast(x as float) * factor``."""
    return _c(col).try_cast("double") * F.lit(float(factor))


def bin_factor(col, low: int, high: int) -> Column:
    """``F(x, low, high)``: integer factor from a numeric value.

    ``floor(x)`` as int, null when outside ``[low, high]`` (such rows leave the
    by-factor tables, as missing factor levels do).
    """
    v = F.floor(_c(col)).cast("int")
    return F.when((v >= low) & (v <= high), v)


def factor_value(col, levels: Sequence[str]) -> Column:
    """Keep values in the declared level list, anything else -> null."""
    c = _c(col)
    return F.when(c.isin(list(levels)), c)


def factor_index(col, levels: Sequence[str]) -> Column:
    """0-based level index in the declared order, null for unlisted values."""
    pos = F.array_position(F.array(*[F.lit(x) for x in levels]), _c(col))
    return F.when(pos > 0, (pos - 1).cast("int"))


def clamp_nonnegative(col) -> Column:
    """Negative values -> 0 (null stays null)."""
    c = _c(col)
    return F.when(c < 0, F.lit(0.0)).otherwise(c)


def threshold_label(col, threshold: float) -> Column:
    """Boolean label ``x > threshold``."""
    return _c(col) > F.lit(threshold)


def log10_or_null(col) -> Column:
    """``log10`` (null for values <= 0)."""
    c = _c(col)
    return F.when(c > 0, F.log10(c))


def regex_flag(col, pattern: str, ignore_case: bool = True) -> Column:
    """``grepl(pattern, x, ignore.case)`` as a boolean column."""
    p = f"(?i){pattern}" if ignore_case else pattern
    return _c(col).rlike(p)


def rating_from_name(path_col) -> Column:
    """the integer after the last ``_`` in ``<id>_<rating>.txt``."""
    return F.regexp_extract(_c(path_col), r"_(\d+)\.txt$", 1).try_cast("int")


def power_set(arr_col) -> Column:
    """all subsets of an array column, subset ``u`` holding element ``i``
    iff bit ``i`` of ``u`` is set (``u`` = 0 .. 2^n - 1)."""
    a = _c(arr_col)
    n = F.size(a)
    return F.transform(
        F.sequence(F.lit(0), F.shiftleft(F.lit(1), n) - 1),
        lambda u: F.filter(a, lambda _x, i: F.shiftright(u, i).bitwiseAND(F.lit(1)) == 1),
    )


def power_set_list(items: Sequence) -> list[list]:
    """F13 on a small driver-side list (e.g. key column names)."""
    items = list(items)
    return [[x for i, x in enumerate(items) if (u >> i) & 1] for u in range(2 ** len(items))]
