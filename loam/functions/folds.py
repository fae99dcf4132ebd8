"""Small linear algebra inside one row: vectors are ``array<double>``, matrices
arrays of rows.  Everything is a higher-order function over arrays whose length
the caller bounds (a calendar, a model order), so it runs where the row is, in
the JVM, without a shuffle or a Python worker.

``let`` names an intermediate value: a column used inside a lambda would be
inlined there and evaluated once an element.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def doubles() -> Column:
    return F.array().cast("array<double>")


def indices(a: Column) -> Column:
    """0 .. size - 1 (none for an empty array, unlike ``sequence``)."""
    return F.transform(a, lambda _, i: i)


def total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, v: s + v)


def mean(a: Column) -> Column:
    return total(a) / F.greatest(F.size(a), F.lit(1))


def dot(a: Column, b: Column) -> Column:
    return total(F.zip_with(a, b, lambda x, y: x * y))


def tail(a: Column, skip) -> Column:
    """``a`` without its first ``skip`` values."""
    return F.slice(a, F.lit(skip) + 1 if isinstance(skip, int) else skip + 1, F.greatest(F.size(a) - skip, F.lit(0)))


def diff(a: Column) -> Column:
    """First differences (one value fewer; none for fewer than two)."""
    n = F.greatest(F.size(a) - 1, F.lit(0))
    return F.zip_with(F.slice(a, 2, n), F.slice(a, 1, n), lambda x, y: x - y)


def cumulate(a: Column, start: Column) -> Column:
    """Running sums of ``a`` from ``start`` (excluded)."""
    step = lambda s, v: F.struct((s["l"] + v).alias("l"), F.concat(s["out"], F.array(s["l"] + v)).alias("out"))
    return F.aggregate(a, F.struct(start.alias("l"), doubles().alias("out")), step)["out"]


def moments(rows: Column, width: int) -> Column:
    """Sum of ``r r'`` over the rows of length ``width``."""
    zero = F.array_repeat(F.array_repeat(F.lit(0.0), width), width)
    return F.aggregate(rows, zero, lambda g, r: F.zip_with(g, r, lambda line, v: F.zip_with(line, r, lambda s, w: s + v * w)))


def solve(gram: Column, chosen: Column, target: Column, tol: float = 1e-10) -> Column:
    """Least-squares coefficients of column ``target`` on the columns ``chosen``
    (positions in the moment matrix) by Gauss-Jordan elimination; null where a
    chosen column is, up to ``tol``, a combination of those before it."""
    def eliminate(m, j):
        pivot = F.get(F.get(m, j), j)
        size = F.get(chosen, j)
        fine = F.abs(pivot) > F.abs(F.get(F.get(gram, size), size)) * tol
        return F.when(fine, let(F.transform(F.get(m, j), lambda v: v / pivot), lambda p: F.transform(
            m, lambda r, i: F.when(i == j, p).otherwise(let(F.get(r, j), lambda f: F.zip_with(r, p, lambda x, y: x - f * y))))))

    system = F.transform(chosen, lambda i: let(F.get(gram, i), lambda line: F.concat(
        F.transform(chosen, lambda j: F.get(line, j)), F.array(F.get(line, target)))))
    return F.transform(F.aggregate(indices(chosen), system, eliminate), lambda r: F.element_at(r, -1))


def stable(a: Column, limit: float = 0.999) -> Column:
    """Whether z_t = a_1 z_{t-1} + ... dies out: every partial autocorrelation of
    the step-down recursion lies within ``limit``."""
    def down(s, j):
        return let(F.get(s["a"], j - 1), lambda r: F.struct(
            F.transform(F.slice(s["a"], F.lit(1), j - 1), lambda x, i: F.when(
                F.abs(r) < limit, (x + r * F.get(s["a"], j - 2 - i)) / (1 - r * r)).otherwise(x)).alias("a"),
            (s["ok"] & (F.abs(r) < limit)).alias("ok")))
    return F.aggregate(F.transform(a, lambda _, i: F.size(a) - i), F.struct(a.alias("a"), F.lit(True).alias("ok")), down)["ok"]
