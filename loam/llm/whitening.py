"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation (operator 13).

Every component ``c`` of a vector becomes the whole number ``floor(64 c) +
1000000``; sums over rows are exact.  Step ``j`` of the bidiagonalisation is one
distributed pass over the centred rows ``X``: the product ``p = X v`` gives each
row its entry of the next left vector, the product ``X' p`` comes back summed.

* Left vectors are never stored.  Each is ``X w`` for a short ``w`` that the
  driver keeps, so a row's entry is computed where the row is, by any executor,
  again after a loss.
* Full reorthogonalisation on both sides, twice each: left coefficients first
  from the products ``X' u`` of earlier steps, then from ``U' p`` measured over
  the rows in the same pass; right vectors against all earlier ones.
* The SVD of the small bidiagonal matrix gives components and deviations.  Steps
  end when the wanted singular values have residuals below ``TOLERANCE`` and
  what the rows hold outside the space (total sum of squares, exact, less that
  of the steps) is below the least of them, so that no equal or larger one can
  be missing; at the latest when the space is whole (as many steps as the
  vectors are wide).  A vanishing step starts again in a new direction.

A pass returns one row of ``2 * width`` numbers a task; where those of all tasks
exceed ``SENT_BYTES`` they are added in a second level of tasks first.

Defined results: null vectors and those with a null or non-finite component are
left out; shorter vectors are read as followed by zeros (an empty one as all
zeros); repeated rows and null ids count and come back like any other; numbers
beyond ``2 ** 62`` are held there; ``deviation`` is null where it does not fit a
long; directions without variance are no components, so equal vectors, a single
one and an empty table give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from loam.llm.common import stored

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
TOLERANCE = 1e-14
NOTHING = 1e-13
SENT_BYTES = 32 << 20
SEED = 20_231
LIMIT = 2 ** 62


def finite_vectors(df: DataFrame, vec_col: str = "embedding") -> DataFrame:
    """Rows whose vector is not null and holds finite numbers only."""
    bad = F.exists(vec_col, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return df.where(F.col(vec_col).isNotNull() & ~bad)


def whole_numbers(df: DataFrame, width: int, id_col: str, vec_col: str) -> DataFrame:
    """Rows (vec_id, x): x the little-endian longs ``floor(64 c) + 1000000``."""
    kind = df.schema[id_col].dataType
    schema = StructType([StructField("vec_id", kind), *StructType.fromDDL("x binary").fields])

    def convert(batches):
        for b in batches:
            lists = b.column(1)
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            n = np.diff(lists.offsets.to_numpy())
            c = np.zeros((len(n), width))
            c[np.arange(width) < n[:, None]] = flat
            with np.errstate(over="ignore"):
                x = np.clip(np.floor(SCALE * c), -float(LIMIT), float(LIMIT)).astype("<i8") + SHIFT
            data = pa.array([r.tobytes() for r in x], type=pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), data], names=["vec_id", "x"])

    return df.select(id_col, F.col(vec_col).cast("array<double>")).mapInArrow(convert, schema)


def matrix(column, width: int) -> np.ndarray:
    """The rows of an Arrow column of packed longs."""
    out = np.frombuffer(b"".join(column.to_pylist()), dtype="<i8")
    return out.reshape(len(column), width)


def spread(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``n * x - sums``, exact: longs where they hold it, else Python's numbers."""
    if not len(x):
        return x
    top = max(int(x.max()), -int(x.min()))
    if n * top + max(abs(s) for s in sums) < LIMIT:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def squares(d: np.ndarray) -> list[int]:
    """Exact sums of squares of the rows of ``spread``."""
    if d.dtype != object:
        top = int(np.abs(d).max(initial=0))
        if top * top * d.shape[1] < LIMIT:
            return (d * d).sum(axis=1).tolist()
    return [sum(int(v) * int(v) for v in r) for r in d]


def total(rows: DataFrame, width: int, tasks: int, fn: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """Sum of ``fn(longs of a batch)`` (``size`` doubles) over all rows: one row
    a task, added in tasks first where they are many."""
    def part(batches):
        out = np.zeros(size)
        for b in batches:
            if b.num_rows:
                out += fn(matrix(b.column(0), width))
        yield pa.RecordBatch.from_arrays([pa.array([out.tobytes()], type=pa.binary())], names=["v"])

    def add(batches):
        out = np.zeros(size)
        for b in batches:
            for v in b.column(0).to_pylist():
                out += np.frombuffer(v)
        yield pa.RecordBatch.from_arrays([pa.array([out.tobytes()], type=pa.binary())], names=["v"])

    parts = rows.select("x").mapInArrow(part, "v binary")
    left = tasks
    while left > 16 and left * size * 8 > SENT_BYTES:
        left = math.isqrt(left) + 1
        parts = parts.repartition(left).mapInArrow(add, "v binary")
    return np.sum([np.frombuffer(r.v) for r in parts.collect()], axis=0)


def exact_sums(rows: DataFrame, width: int, tasks: int) -> tuple[int, list[int]]:
    """Row count and exact sum of every dimension (in quarters of 16 bits whose sums a double holds for 2 ** 37 rows)."""
    def quarters(x):
        hi, lo = x >> 32, x & 0xFFFFFFFF
        return np.concatenate([[len(x)], (hi >> 16).sum(0), (hi & 0xFFFF).sum(0), (lo >> 16).sum(0), (lo & 0xFFFF).sum(0)])

    got = total(rows, width, tasks, quarters, 1 + 4 * width)
    a = [[int(v) for v in got[1 + k * width:1 + (k + 1) * width]] for k in range(4)]
    return int(got[0]), [(p << 48) + (q << 32) + (r << 16) + s for p, q, r, s in zip(*a)]


def against(r: np.ndarray, basis: list[np.ndarray]) -> np.ndarray:
    """``r`` less its parts along the basis, twice."""
    if basis:
        b = np.array(basis)
        for _ in range(2):
            r = r - b.T @ (b @ r)
    return r


def bidiagonalise(product: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, float]],
                  width: int, k: int, energy: float, seed: int = SEED) -> tuple[np.ndarray, np.ndarray, int]:
    """Leading singular values (falling) and right vectors (columns) of ``X``.

    ``product(w, W)`` gives ``U'p``, ``X'p`` and ``p'p`` for ``p = X w`` and the
    left vectors ``U = X W``; ``energy`` is the sum of squares of ``X``."""
    rng = np.random.default_rng(seed)
    scale = math.sqrt(energy)
    right: list[np.ndarray] = []
    maps: list[np.ndarray] = []      # left vector i is X maps[i]
    back: list[np.ndarray] = []      # X' left vector i
    alphas: list[float] = []
    betas: list[float] = []

    def fresh() -> np.ndarray:
        r = against(rng.standard_normal(width), right)
        return r / np.linalg.norm(r)

    v, beta = fresh(), 0.0
    while True:
        right.append(v)
        w = v
        if maps:
            w = v - np.array(maps).T @ (np.array(back) @ v)
        left = np.array(maps).T.reshape(width, len(maps))
        t, g, pp = product(w, left)
        if maps:
            w, g, pp = w - np.array(maps).T @ t, g - np.array(back).T @ t, pp - float(t @ t)
        alpha = math.sqrt(max(pp, 0.0))
        if alpha <= NOTHING * scale:
            alpha, w, g = 0.0, np.zeros(width), np.zeros(width)
        else:
            w, g = w / alpha, g / alpha
        maps.append(w)
        back.append(g)
        alphas.append(alpha)
        r = against(g - alpha * v, right)
        beta = float(np.linalg.norm(r))
        j = len(right)
        bidiagonal = np.diag(alphas) + np.diag(betas, 1)
        p, s, qt = np.linalg.svd(bidiagonal)
        rest = energy - float(np.sum(np.square(alphas)) + np.sum(np.square(betas)))
        small = beta <= NOTHING * scale
        if j == width:
            break
        kept = s[:k] > NOTHING * scale
        least = s[k - 1] if j >= k else 0.0
        settled = small or np.all(beta * np.abs(p[-1, :k])[kept] <= TOLERANCE * s[0])
        if settled and rest <= max(least * least * (1 - 1e-9), energy * NOTHING):
            break
        v, beta = (fresh(), 0.0) if small else (r / beta, beta)
        betas.append(beta)
    basis = np.array(right).T
    keep = int(np.sum(s[:k] > NOTHING * 10 * scale))
    return s[:keep], (basis @ qt.T)[:, :keep], len(right)


def whiten(df: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """Rows (vec_id, component, n, deviation, whitened, explained,
    identity_error) of every usable vector, see the module."""
    spark = df.sparkSession
    good = finite_vectors(df.select(id_col, vec_col), vec_col)
    kind = df.schema[id_col].dataType
    schema = StructType([StructField("vec_id", kind), *StructType.fromDDL(
        "component int, n long, deviation long, whitened double, explained double, identity_error double").fields])
    width = good.agg(F.max(F.size(vec_col))).first()[0]
    if not width:
        return spark.createDataFrame([], schema)
    rows = stored(whole_numbers(good, width, id_col, vec_col), "whitening")
    tasks = rows.select("x").rdd.getNumPartitions()
    held = rows.select("x").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n, sums = exact_sums(held, width, tasks)

        def centred(x):
            return spread(x, n, sums).astype(np.float64) / n

        def energies(x):
            c = centred(x)
            return np.array([(c * c).sum()])

        energy = float(total(held, width, tasks, energies, 1)[0])
        if energy <= 0.0:
            return spark.createDataFrame([], schema)

        def product(w, left):
            j = left.shape[1]

            def step(x):
                c = centred(x)
                p = c @ w
                return np.concatenate([(c @ left).T @ p, c.T @ p, [p @ p]])
            got = total(held, width, tasks, step, j + width + 1)
            return got[:j], got[j:j + width], float(got[-1])

        s, vectors, _ = bidiagonalise(product, width, min(components, width), energy)
        k = len(s)
        e = s * s / n
        turn = vectors / np.sqrt(e)

        def covariance(x):
            z = centred(x) @ turn
            return (z.T @ z).ravel()
        cov = total(held, width, tasks, covariance, k * k).reshape(k, k) / n
        error = float(np.abs(cov - np.eye(k)).max())
        explained = e / (energy / n)
    finally:
        held.unpersist()

    def emit(batches):
        for b in batches:
            m = b.num_rows
            if not m:
                continue
            d = spread(matrix(b.column(1), width), n, sums)
            dev = [v if v < 2 ** 63 else None for v in squares(d)]
            z = (d.astype(np.float64) / n) @ turn
            yield pa.RecordBatch.from_arrays([
                b.column(0).take(pa.array(np.repeat(np.arange(m), k))),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                pa.array(np.full(m * k, n, np.int64)),
                pa.array(dev, type=pa.int64()).take(pa.array(np.repeat(np.arange(m), k))),
                pa.array(z.ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))], names=schema.names)

    return rows.mapInArrow(emit, schema)
