"""Binomial regression by reweighted least squares on a tree of QR factors.

Each iteration is one pass: a task folds its weighted rows ``sqrt(w) [X, z]``
into one triangular factor (chunk by chunk, so it holds at most ``CHUNK_VALUES``
numbers and a matrix of the columns squared); factors of many tasks are folded
into fewer in further tasks, and a last one of the columns squared comes to the
driver.  The normal equations are never formed.

The rank is read off the last factor in the order of the terms: a term whose part
outside the span of the terms before it is below ``RANK_TOLERANCE`` of its length
is redundant.  It has no estimate and no error, and the others keep theirs, as if
the formula did not name it.  Iterations end when the deviance settles.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RANK_TOLERANCE = 1e-9
CHUNK_VALUES = 1 << 21
MAX_COLUMNS = 4096
SENT_BYTES = 64 << 20


@dataclass
class GlmFit:
    """Estimates in the order (intercept, features..); None for redundant terms."""

    terms: list[str]
    estimate: list[float | None]
    std_error: list[float | None]
    deviance: float
    null_deviance: float
    rows: int
    rank: int
    iterations: int
    converged: bool

    def table(self, spark) -> DataFrame:
        """(term, estimate, std_error, t_value, p_value); nulls for redundant terms."""
        rows = []
        for t, b, s in zip(self.terms, self.estimate, self.std_error):
            v = None if b is None or not s else b / s
            rows.append((t, b, s, v, None if v is None else math.erfc(abs(v) / math.sqrt(2))))
        return spark.createDataFrame(rows, "term string, estimate double, std_error double, t_value double, p_value double")

    @property
    def aic(self) -> float:
        return self.deviance + 2 * self.rank


def fold(r: np.ndarray | None, rows: np.ndarray) -> np.ndarray:
    """The triangular factor of ``r`` with further rows below it."""
    return np.linalg.qr(rows if r is None else np.vstack([r, rows]), mode="r")


def solve(r: np.ndarray, tolerance: float = RANK_TOLERANCE) -> tuple[np.ndarray, list[int], np.ndarray]:
    """Least squares from the factor of ``[X, z]``: coefficients of the kept
    columns, which columns those are, and their unscaled variances."""
    p = r.shape[1] - 1
    r = np.vstack([r, np.zeros((max(0, p + 1 - len(r)), p + 1))])
    x, z = r[:, :p], r[:, p]
    basis, kept = np.zeros((len(r), 0)), []
    for j in range(p):
        c = x[:, j]
        size = np.linalg.norm(c)
        for _ in range(2):
            c = c - basis @ (basis.T @ c)
        left = np.linalg.norm(c)
        if size > 0 and left > tolerance * size:
            kept.append(j)
            basis = np.column_stack([basis, c / left])
    upper = basis.T @ x[:, kept]
    inverse = np.linalg.solve(np.triu(upper), np.eye(len(kept))) if kept else np.zeros((0, 0))
    return inverse @ (basis.T @ z), kept, (inverse * inverse).sum(axis=1)


def _design(batches, width: int, step: int):
    """Blocks (n, p: the sum of y, y, x) of at most ``step`` dense rows with a leading 1: what every
    iteration reads, decoded once."""
    for b in batches:
        for a in range(0, b.num_rows, step):
            n = min(step, b.num_rows - a)
            y = b.column(0).slice(a, n).to_numpy(zero_copy_only=False).astype(float)
            x = np.zeros((n, width + 1))
            x[:, 0] = 1.0
            idx, val = b.column(1).slice(a, n), b.column(2).slice(a, n)
            many = np.diff(val.offsets.to_numpy())
            x[np.repeat(np.arange(n), many), idx.flatten().to_numpy(zero_copy_only=False) + 1] = val.flatten().to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([y.sum()]), pa.array([y.tobytes()], pa.binary()),
                                              pa.array([x.tobytes()], pa.binary())], names=["n", "p", "y", "x"])


def fit_binomial(df: DataFrame, terms: Sequence[str], label_col: str = "label", features_col: str = "features",
                 max_iter: int = 50, tol: float = 1e-12) -> GlmFit:
    """Logit link, labels 0 and 1, an intercept and an ML vector column whose
    places ``terms`` names.  Rows with a null label or vector, or with a number
    that is not finite, are left out.  ``tol``: change of the deviance over it."""
    width = len(terms)
    if width + 1 > MAX_COLUMNS:
        raise ValueError(f"the design has {width + 1} columns, more than {MAX_COLUMNS}: use learner 'logistic'")
    v = F.unwrap_udt(features_col)
    idx = F.when(F.size(v["values"]) > 0, F.coalesce(v["indices"], F.sequence(F.lit(0), F.size(v["values"]) - 1))) \
        .otherwise(F.array().cast("array<int>"))
    bad = F.exists(v["values"], lambda x: F.isnan(x) | (F.abs(x) == float("inf")))
    rows = df.where(F.col(label_col).isNotNull() & F.col(features_col).isNotNull()).where(~bad).select(
        F.col(label_col).cast("double").alias("y"), idx.alias("i"), v["values"].alias("v"))
    step = max(1, CHUNK_VALUES // (width + 2))
    held = rows.mapInArrow(lambda batches: _design(batches, width, step), "n long, p double, y binary, x binary").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        first = held.agg(F.sum("n").alias("n"), F.sum("p").alias("p")).first()
        n = first.n
        if not n:
            raise ValueError("no rows to fit")
        null = _deviance_of_share(n, first.p)
        blocks = held.select("y", "x")
        beta, kept, deviance, done, converged = None, [], math.inf, 0, False
        tasks = held.rdd.getNumPartitions()
        for done in range(1, max_iter + 1):
            r, now = _pass(held.select("y", "x"), width, beta, tasks)
            if beta is not None:
                if abs(now - deviance) <= tol * (abs(now) + 0.1):
                    converged = True
                    break
                deviance = now
            found, kept, variance = solve(r)
            beta = np.zeros(width + 1)
            beta[kept] = found
        at = {j: k for k, j in enumerate(kept)}
        return GlmFit(["(Intercept)", *terms], [float(beta[j]) if j in at else None for j in range(width + 1)],
                      [float(math.sqrt(variance[at[j]])) if j in at else None for j in range(width + 1)],
                      float(now), null, n, len(kept), done, converged)
    finally:
        held.unpersist()


def _deviance_of_share(n: int, p: float) -> float:
    return -2 * sum(k * math.log(k / n) for k in (p, n - p) if k > 0)


def _pass(rows: DataFrame, width: int, beta: np.ndarray | None, tasks: int) -> tuple[np.ndarray, float]:
    """The factor of the weighted rows and the deviance, both at ``beta`` (None:
    the usual start from the labels)."""
    def local(batches):
        r, deviance = None, 0.0
        for b in batches:
            for k in range(b.num_rows):
                y = np.frombuffer(b.column(0)[k].as_buffer())
                x = np.frombuffer(b.column(1)[k].as_buffer()).reshape(len(y), -1)
                if beta is None:
                    mu = (y + 0.5) / 2
                    eta = np.log(mu / (1 - mu))
                else:
                    eta = x @ beta
                    mu = np.clip(1 / (1 + np.exp(-np.clip(eta, -700, 700))), 1e-15, 1 - 1e-15)
                deviance -= 2 * float(np.sum(y * np.log(mu) + (1 - y) * np.log1p(-mu)))
                w = mu * (1 - mu)
                root = np.sqrt(w)
                r = fold(r, np.column_stack([x * root[:, None], root * (eta + (y - mu) / w)]))
        if r is not None:
            yield _factor(r, deviance)

    def merge(batches):
        r, deviance = None, 0.0
        for b in batches:
            for row in b.to_pylist():
                r = fold(r, np.frombuffer(row["r"]).reshape(-1, width + 2))
                deviance += row["deviance"]
        if r is not None:
            yield _factor(r, deviance)

    parts = rows.mapInArrow(local, "r binary, deviance double")
    while tasks > 4 and tasks * (width + 2) ** 2 * 8 > SENT_BYTES:
        tasks = max(2, tasks // 8)
        parts = parts.repartition(tasks).mapInArrow(merge, "r binary, deviance double")
    r, deviance = None, 0.0
    for row in parts.toLocalIterator():
        r = fold(r, np.frombuffer(row["r"]).reshape(-1, width + 2))
        deviance += row["deviance"]
    return r, deviance


def _factor(r: np.ndarray, deviance: float) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(r).tobytes()], pa.binary()), pa.array([deviance])],
                                      names=["r", "deviance"])


def fit_formula(df: DataFrame, formula: str, full: DataFrame | None = None, **kw) -> GlmFit:
    """A binomial formula.  Factors are encoded with one real level as
    reference; their levels are those of ``full`` (by default of ``df``).  Rows that
    cannot be encoded are left out."""
    from loam.plans.models import feature_names, formula_stage
    rf = formula_stage(formula, handle_invalid="skip").fit(df if full is None else full)
    coded = rf.transform(df)
    return fit_binomial(coded, feature_names(coded), **kw)
