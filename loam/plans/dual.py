"""Linear learners by stochastic dual coordinate ascent.

For rows ``(x_i, y_i)`` the learner minimises

    (1/n) sum_i loss(x_i . w, y_i) + l2/2 |w|^2 + l1 |w|_1

through its dual: one number ``a_i`` a row, ``v = (1/(l2 n)) sum_i a_i x_i`` and
``w = shrink(v, l1/l2)``.  Rows lie in blocks dealt by a hash of their content, so
the layout of the input does not change the result.  A round is one pass:

* every block takes local coordinate steps over its own rows, in an order drawn
  from (seed, round, block), on a bound of the dual in which the other blocks
  move as this one does, so that all changes may be added, not averaged; where
  rows weigh little against the penalty, runs of them step at once on the same
  kind of bound, and where they weigh much, all of a block's rows step at once by
  Newton's method on that bound, while a side of its matrix is small enough; where
  they weigh much and lie in several blocks, the rows of all blocks step together
  by Newton's method on the dual itself (``_Together``), as rows of few features do
  whatever they weigh;
* the blocks' changes of ``v`` are summed and shared for the next round;
* the primal and the dual value before the steps are summed in the same pass;
  fitting ends when the duality gap, which bounds the distance to the optimum,
  is at most ``tol`` times the primal value.

Many settings (penalties, row subsets, feature views) go through the same
passes: a block keeps its duals of every setting, and a setting leaves when its
gap is small enough.  The number of scans is that of the slowest setting,
whatever the size of the grid.

Features are identified by longs and the dictionary has no limit: a feature that
occurs in no training row of a setting keeps weight zero.  While the shared
values of all settings stay below ``SENT_BYTES`` they are sent to the tasks;
beyond, every block fetches those of its own features by a join.

Duals are written to the shared folder after each round, keyed by block and by
the row's place in it; a lost executor recomputes a block from the stored blocks
and the last stored duals, with the same steps.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel, keyword_only
from pyspark.ml import Estimator
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from loam.plans.partials import packed, summed
from loam.session import materialize

#: The feature of value 1 in every row.
INTERCEPT = -(1 << 63)
BLOCK_VALUES = 1 << 22
#: Rows on their way to a block are packed in tables of about so many bytes.
BUNDLE_BYTES = 32 << 20
#: Local passes a round: one block alone gains nothing from an early end.
PASSES, PASSES_ALONE = 8, 40
SENT_BYTES = 64 << 20
#: Rows step at once where at least ``GROUP_ROWS`` of them add at most ``GROUP_SHARE`` to a row's step bound.
GROUP_ROWS, GROUP_SHARE = 64, 0.125
#: Newton steps where a row's mean step bound is at least ``NEWTON_WEIGHT`` and a block's
#: used rows, or its features, are at most ``NEWTON_SIDE``; its matrix is built from ``NEWTON_VALUES`` dense values at once.
NEWTON_WEIGHT, NEWTON_SIDE, NEWTON_VALUES, NEWTON_STEPS = 1.0, 5120, 1 << 23, 200
#: Rows of several blocks step together: features of the summed matrix at most, its rows in a sum, the values of a piece
#: of a block, and passes for a system beyond that matrix.
TOGETHER_SIDE, TOGETHER_ROWS, TOGETHER_VALUES, TOGETHER_PASSES = 5120, 64, 1 << 20, 10
#: Rows of so few features step together however little they weigh: stored duals would be as large as the rows.
TOGETHER_FEW = 4
SEED = 17

BLOCK_SCHEMA = "block long, n int, y binary, uses binary, feats array<long>, ptr array<binary>, loc array<binary>, val array<binary>, packed boolean"


@dataclass(frozen=True)
class Setting:
    """Penalties, and which of the rows' flags and feature views it uses."""

    l1: float = 0.0
    l2: float = 1e-4
    use: int = 0
    view: int = 0


# -------------------------------------------------------------- losses
def _log_values(z, y):
    m = y * z
    return np.where(m > 0, np.log1p(np.exp(-np.abs(m))), np.log1p(np.exp(-np.abs(m))) - m)


def _log_dual(a, y):
    b = np.clip(a * y, 0.0, 1.0)
    with np.errstate(divide="ignore", invalid="ignore"):
        return -(np.where(b > 0, b * np.log(b), 0.0) + np.where(b < 1, (1 - b) * np.log1p(-b), 0.0))


def _log_step(a, y, z, q):
    """The new dual of one row: root of logit(b) + y z + q (b - b_now) = 0, which
    rises in t = logit(b), so Newton stays within a shrinking bracket."""
    b, m = a * y, y * z
    low, high = -m - q * (1.0 - b), -m + q * b
    t = min(max(-m, low), high)
    for _ in range(50):
        s = 1.0 / (1.0 + math.exp(-t)) if t > -700 else 0.0
        h = t + m + q * (s - b)
        if h > 0:
            high = t
        else:
            low = t
        new = t - h / (1.0 + q * s * (1.0 - s))
        new = new if low < new < high else 0.5 * (low + high)
        if abs(new - t) <= 1e-14 * max(1.0, abs(t)):
            break
        t = new
    return y / (1.0 + math.exp(-t)) if t > -700 else 0.0


def _log_steps(a, y, z, q):
    """``_log_step`` of many rows at once."""
    b, m = a * y, y * z
    low, high = -m - q * (1.0 - b), -m + q * b
    t = np.minimum(np.maximum(-m, low), high)
    left = np.arange(len(t))
    for _ in range(50):
        k = t[left]
        s = 1.0 / (1.0 + np.exp(-np.maximum(k, -700.0)))
        h = k + m[left] + q[left] * (s - b[left])
        high[left] = np.where(h > 0, k, high[left])
        low[left] = np.where(h > 0, low[left], k)
        new = k - h / (1.0 + q[left] * s * (1.0 - s))
        new = np.where((low[left] < new) & (new < high[left]), new, 0.5 * (low[left] + high[left]))
        moved = np.abs(new - k) > 1e-14 * np.maximum(1.0, np.abs(k))
        t[left] = new
        left = left[moved]
        if not len(left):
            break
    return np.where(t > -700, y / (1.0 + np.exp(-np.maximum(t, -700.0))), 0.0)


def _square_values(z, y):
    return 0.5 * (z - y) ** 2


def _square_dual(a, y):
    return a * y - 0.5 * a * a


def _square_step(a, y, z, q):
    return a + (y - z - a) / (1.0 + q)


def _log_state(t, y):
    """The duals at margins ``t``, and minus their slope."""
    b = 1.0 / (1.0 + np.exp(np.clip(y * t, -700.0, 700.0)))
    return y * b, b * (1.0 - b)


def _square_state(t, y):
    return y - t, np.ones(len(t))


LOSSES = {"log": (_log_values, _log_dual, (_log_step, _log_steps)),
          "squared": (_square_values, _square_dual, (_square_step, _square_step))}
#: The duals at given margins, by the loss's dual.
STATES = {_log_dual: _log_state, _square_dual: _square_state}


def shrink(v: np.ndarray, by: float) -> np.ndarray:
    return np.sign(v) * np.maximum(np.abs(v) - by, 0.0)


# -------------------------------------------------------------- blocks
def rows_of_vectors(df: DataFrame, label_col: str = "label", features_col: str = "features") -> DataFrame:
    """(y, uses, idx, val) of an ML vector column: dense or sparse, one flag, one view."""
    v = F.unwrap_udt(features_col)
    idx = F.coalesce(v["indices"], F.sequence(F.lit(0), F.size(v["values"]) - 1))
    idx = F.when(F.size(v["values"]) > 0, idx).otherwise(F.array().cast("array<int>"))
    return df.select(F.col(label_col).cast("double").alias("y"), F.array(F.lit(True)).alias("uses"),
                     F.array(idx.cast("array<long>")).alias("idx"), F.array(v["values"]).alias("val"))


def _view_of(idx: pa.Array, val: pa.Array, k: int, intercept: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ptr, features, values) of view ``k``: a row's features in order, repeats
    added up in the order of their mentions, then the intercept; no zeros."""
    lists, n = pc.list_element(idx, k), len(idx)
    size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
    f = lists.flatten().to_numpy().astype(np.int64)
    x, given = np.ones(len(f)), pc.is_valid(val).to_numpy(zero_copy_only=False).astype(bool)
    if given.any():
        values = pc.list_element(val.filter(pa.array(given)), k)
        if not np.array_equal(pc.fill_null(pc.list_value_length(values), 0).to_numpy(), size[given]):
            raise ValueError("a row's features and values differ in number")
        x[np.repeat(given, size)] = values.flatten().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(n), size)
    order = np.lexsort((f, row))
    first = np.ones(len(f), bool)
    first[1:] = (f[order][1:] != f[order][:-1]) | (row[order][1:] != row[order][:-1])
    which = np.empty(len(f), np.int64)
    which[order] = np.cumsum(first) - 1
    row, f, x = row[order][first], f[order][first], np.bincount(which, weights=x, minlength=int(first.sum()))
    if intercept:
        at = np.cumsum(np.bincount(row, minlength=n))
        row, f, x = np.insert(row, at, np.arange(n)), np.insert(f, at, INTERCEPT), np.insert(x, at, 1.0)
    row, f, x = row[x != 0], f[x != 0], x[x != 0]
    return np.concatenate([[0], np.cumsum(np.bincount(row, minlength=n))]), f, x


def _squeezed(x: np.ndarray) -> bytes:
    """An array of a block, compressed: Spark holds several copies of what it reads."""
    data = np.ascontiguousarray(x).tobytes()
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def _unsqueezed(data: bytes, kind=np.float64) -> np.ndarray:
    return np.frombuffer(pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True), kind)


def blocks_of(rows: DataFrame, intercept: bool = True, block_values: int = BLOCK_VALUES) -> tuple[DataFrame, int, list[int]]:
    """Stored blocks of about ``block_values`` feature values, their number and
    the rows each flag holds for.  Rows with a null label, flags or features are left out;
    null values count each mention of a feature; repeated features of a row add up."""
    rows = rows.where("y is not null and idx is not null and uses is not null")
    # the features are made once, and read by the counts and by the blocks; a repeated feature is one value of a block
    rows = materialize(rows.select("y", "uses", "idx", "val"), "dual-rows")
    stats = rows.agg(F.sum(F.aggregate("idx", F.lit(0).cast("long"),
                                       lambda s, x: s + F.coalesce(F.size(F.array_distinct(x)), F.lit(0)) + 1)).alias("values"),
                     F.max(F.size("uses")).alias("flags")).first()
    if not stats.flags:
        return rows.sparkSession.createDataFrame([], BLOCK_SCHEMA), 0, []
    used = rows.agg(*[F.count_if(F.col("uses")[k]).alias(f"u{k}") for k in range(stats.flags)]).first()
    count = max(1, -(-int(stats["values"]) // block_values))
    keyed = rows.withColumn("h", F.xxhash64("y", "uses", "idx", "val")).withColumn("block", F.pmod("h", F.lit(count)))

    columns = keyed.select("h", "y", "uses", "idx", "val").columns

    def bundle(batches):
        """The rows of several batches, those of a block as one packed table."""
        held, size = [], 0

        def packed():
            t = pa.Table.from_batches(held)
            block = t.column("block").to_numpy()
            order = np.argsort(block, kind="stable")
            t, block = t.take(pa.array(order)).combine_chunks(), block[order]
            cuts = np.concatenate([[0], np.flatnonzero(block[1:] != block[:-1]) + 1, [len(block)]]).tolist()
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                out = pa.BufferOutputStream()
                part = t.slice(lo, hi - lo).select(columns)
                with pa.ipc.new_stream(out, part.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
                    w.write_table(part)
                yield pa.RecordBatch.from_arrays([pa.array([int(block[lo])], pa.int64()), pa.array([out.getvalue().to_pybytes()], pa.binary())],
                                                 names=["block", "rows"])

        for b in batches:
            if b.num_rows:
                held.append(b)
                size += b.nbytes
            if size >= BUNDLE_BYTES:
                yield from packed()
                held, size = [], 0
        if held:
            yield from packed()

    def pack(t: pa.Table) -> pa.Table:
        number = t.column("block")[0].as_py()
        t = pa.concat_tables([pa.ipc.open_stream(x).read_all() for x in t.column("rows").to_pylist()])
        h, y = t.column("h").to_numpy(), t.column("y").to_numpy()
        order = np.lexsort((y, h))
        y = y[order]
        uses = t.column("uses").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.uint8).reshape(len(y), -1)[order]
        idx, val = (t.column(c).combine_chunks().take(pa.array(order)) for c in ("idx", "val"))
        views = [_view_of(idx, val, k, intercept) for k in range(len(idx[0]))]
        feats = np.unique(np.concatenate([f for _, f, _ in views] or [np.zeros(0, np.int64)]))
        ptr = [_squeezed(p.astype(np.int64)) for p, _, _ in views]
        loc = [_squeezed(np.searchsorted(feats, f).astype(np.int32)) for _, f, _ in views]
        vals = [_squeezed(x.astype(np.float64)) for _, _, x in views]
        return pa.table({"block": pa.array([number], pa.int64()), "n": pa.array([len(y)], pa.int32()),
                         "y": pa.array([_squeezed(y)], pa.binary()), "uses": pa.array([_squeezed(uses)], pa.binary()),
                         "feats": pa.array([feats.tolist()], pa.list_(pa.int64())),
                         "ptr": pa.array([ptr], pa.list_(pa.binary())), "loc": pa.array([loc], pa.list_(pa.binary())),
                         "val": pa.array([vals], pa.list_(pa.binary())), "packed": pa.array([True])})

    bundles = keyed.select("block", *columns).mapInArrow(bundle, "block long, rows binary")
    # blocks are larger than their bundles: few share a file, of which a task reads all at once
    return materialize(bundles.repartition(4 * count, "block").groupBy("block").applyInArrow(pack, BLOCK_SCHEMA), "dual-blocks"), count, [int(x) for x in used]


class Block:
    """One block's rows; features by their place in the block's own list."""

    def __init__(self, row: dict):
        self.number, n = row["block"], row["n"]
        read = _unsqueezed if row.get("packed") else np.frombuffer
        self.y = read(row["y"])
        self.uses = read(row["uses"], np.uint8).reshape(n, -1).astype(bool)
        self.feats = np.asarray(row["feats"], np.int64)
        self.views = [(read(p, np.int64), read(c, np.int32), read(v))
                      for p, c, v in zip(row["ptr"], row["loc"], row["val"])]

    def margins(self, w: np.ndarray, view: int) -> np.ndarray:
        ptr, loc, val = self.views[view]
        out = np.zeros(len(self.y))
        full = ptr[1:] > ptr[:-1]
        if full.any():
            out[full] = np.add.reduceat(val * w[loc], ptr[:-1][full])
        return out

    def ascend(self, a: np.ndarray, v: np.ndarray, s: Setting, n: int, blocks: int, passes: int, rng, loss, tol: float = 0.0) -> np.ndarray:
        """Local steps on the duals ``a`` (changed in place); the change of ``v``.  Of a ``loss``
        with its two kinds of steps alone, no Newton steps are taken."""
        one, many = loss[-1] if len(loss) == 3 else loss
        ptr, loc, val = self.views[s.view]
        use = np.flatnonzero(self.uses[:, s.use])
        squares = np.concatenate([[0.0], np.cumsum(val * val)])
        q = (squares[ptr[1:]] - squares[ptr[:-1]]) * blocks / (s.l2 * n)
        u, rate, by = v.copy(), blocks / (s.l2 * n), s.l1 / s.l2
        weight = float(q[use].mean()) if len(use) else 0.0
        group = min(len(use), int(GROUP_SHARE / weight)) if weight > 0 else len(use)
        if len(loss) == 3 and weight >= NEWTON_WEIGHT and min(len(use), len(np.unique(loc))) <= NEWTON_SIDE:
            return self._ascend_newton(a, v, use, 1.0 / rate, by, s.view, loss, tol) / blocks
        if group >= GROUP_ROWS:
            self._ascend_groups(a, u, use, group, q, rate, by, s.view, passes, rng, many)
            return (u - v) / blocks
        q, y, cut = q.tolist(), self.y.tolist(), ptr.tolist()
        for _ in range(passes):
            for i in rng.permutation(use).tolist():
                at, x = loc[cut[i]:cut[i + 1]], val[cut[i]:cut[i + 1]]
                here = u[at]
                w = shrink(here, by) if by else here
                new = one(a[i], y[i], float(w @ x), q[i])
                d = new - a[i]
                if d:
                    a[i] = new
                    u[at] = here + (rate * d) * x
        return (u - v) / blocks

    def _ascend_newton(self, a, v, use, c, by, view, loss, tol) -> np.ndarray:
        """All used rows step at once: semismooth Newton on the block's bound
        sum conj(a) - c/2 |shrink(v + X'(a - was)/c, by)|^2, along weights ``p`` whose
        margins give the duals, until its gap is a part of ``tol``.  Steps lower the primal
        of the bound; from the first that cannot, they raise the bound itself, as short ones always do."""
        values, conjugate, _ = loss
        state = STATES[conjugate]
        ptr, at, val = self.views[view]
        size = np.diff(ptr)
        mine = np.repeat(np.isin(np.arange(len(size)), use, assume_unique=True), size)
        size, val, y, n = size[use], val[mine], self.y[use], len(use)
        feats, at = np.unique(at[mine], return_inverse=True)
        row = np.repeat(np.arange(n), size)
        cut = np.concatenate([[0], np.cumsum(size)])
        by_feat = np.argsort(at, kind="stable")
        cols = np.concatenate([[0], np.cumsum(np.bincount(at, minlength=len(feats)))])

        def gram(on, root):
            """x' s s x over the features ``on``, a run of rows at once."""
            place, width = np.where(on, np.cumsum(on) - 1, -1), int(on.sum())
            out, run = np.zeros((width, width)), max(1, NEWTON_VALUES // max(width, 1))
            for lo in range(0, n, run):
                hi = min(lo + run, n)
                k = slice(cut[lo], cut[hi])
                kept = place[at[k]] >= 0
                part = np.zeros((hi - lo, width))
                part[row[k][kept] - lo, place[at[k]][kept]] = (val[k] * root[row[k]])[kept]
                out += part.T @ part
            return out

        def kernel_of(on):
            """x x' over the features ``on``, a run of features at once."""
            out, run = np.zeros((n, n)), max(1, NEWTON_VALUES // n)
            for lo in range(0, len(feats), run):
                hi = min(lo + run, len(feats))
                k = by_feat[cols[lo]:cols[hi]]
                k = k[on[at[k]]]
                part = np.zeros((n, hi - lo))
                part[row[k], at[k] - lo] = val[k]
                out += part @ part.T
            return out

        def back(d):
            return np.bincount(at, weights=d[row] * val, minlength=len(feats))

        def ahead(w):
            return np.bincount(row, weights=w[at] * val, minlength=n)

        was, kernel, held = a[use], None, None
        still = v[feats] - back(was) / c

        def measure(p, t):
            d, slope = state(t, y)
            u = still + back(d) / c
            w = shrink(u, by)
            bound = float(conjugate(d, y).sum()) - c / 2 * float(w @ w)
            primal = float(values(t, y).sum()) + c * float(0.5 * (p @ p) + by * np.abs(p).sum() - p @ still)
            return d, slope, u, w, bound, primal

        p = shrink(v[feats], by)
        t = ahead(p)
        # duals that are good enough stay: those of the margins ``t`` may be far from them
        if float((values(t, y) - conjugate(was, y) + was * t).sum()) <= 0.25 * tol * float(values(t, y).sum()):
            return np.zeros(len(v))
        now = measure(p, t)
        by_primal = True
        for _ in range(NEWTON_STEPS):
            d, slope, u, w, bound, primal = now
            z = ahead(w)
            cost = float(values(z, y).sum())
            if float((values(z, y) - conjugate(d, y) + d * z).sum()) <= 0.25 * tol * cost:
                break
            # (1 + s x x' s / c) q = s (z - t) over the features in use, by its smaller side
            root, rest = np.sqrt(slope), z - t
            on = np.abs(u) > by if by else np.ones(len(feats), bool)
            if on.sum() < n:
                square = gram(on, root)
                square.flat[::len(square) + 1] += c
                move = -np.linalg.solve(square, back(slope * rest)[on])
            else:
                if kernel is None or not np.array_equal(on, held):
                    kernel, held = kernel_of(on), on
                square = root[:, None] * kernel
                square *= root / c
                square.flat[::n + 1] += 1.0
                q = root * np.linalg.solve(square, root * rest)
                move = -back(q)[on] / c
            toward = w - p
            toward[on] += move
            far = ahead(toward)
            rise, rate, better = float(rest @ (slope * far)), 1.0, None
            for halvings in range(60):
                new = measure(p + rate * toward, t + rate * far)
                if by_primal and new[5] < primal - 1e-12 * abs(primal) or not by_primal and new[4] >= bound + 1e-4 * rate * rise:
                    better = new
                    break
                rate /= 2
                if by_primal and halvings == 9:
                    by_primal, rate = False, 1.0
            if better is None:
                break
            p, t, now = p + rate * toward, t + rate * far, better
        before = float(conjugate(was, y).sum()) - c / 2 * float((shrink(v[feats], by) ** 2).sum())
        if now[4] <= before:
            return np.zeros(len(v))
        a[use] = now[0]
        change = np.zeros(len(v))
        change[feats] = now[2] - v[feats]
        return change

    def _ascend_groups(self, a, u, use, group, q, rate, by, view, passes, rng, step) -> None:
        """Runs of ``group`` rows step at once: |sum d_i x_i|^2 <= group * sum d_i^2 |x_i|^2
        for any rows, so with ``group`` times their ``q`` the sum of the steps still ascends."""
        ptr, loc, val = self.views[view]
        size = np.diff(ptr)
        if len(use) < len(size):
            mine = np.repeat(np.isin(np.arange(len(size)), use, assume_unique=True), size)
            size, loc, val = size[use], loc[mine], val[mine]
            ptr = np.concatenate([[0], np.cumsum(size)])
        row = np.repeat(np.arange(len(use)), size)
        for _ in range(passes):
            for k in rng.permutation(-(-len(use) // group)).tolist():
                lo, hi = k * group, min((k + 1) * group, len(use))
                i, at, x, r = use[lo:hi], loc[ptr[lo]:ptr[hi]], val[ptr[lo]:ptr[hi]], row[ptr[lo]:ptr[hi]] - lo
                w = shrink(u[at], by) if by else u[at]
                new = step(a[i], self.y[i], np.bincount(r, weights=w * x, minlength=hi - lo), q[i] * (hi - lo))
                np.add.at(u, at, rate * (new - a[i])[r] * x)
                a[i] = new


# -------------------------------------------------------------- fitting
@dataclass
class Fit:
    """Weights (setting, feature, weight), the gap by round (setting, round,
    primal, dual, gap) and, per setting, whether the gap was reached."""

    weights: DataFrame
    history: DataFrame
    reached: list[bool]
    rounds: int


def ascend(rows: DataFrame, settings: Sequence[Setting], loss: str = "log", tol: float = 1e-3, max_rounds: int = 200,
           passes: int | None = None, intercept: bool = True, block_values: int = BLOCK_VALUES, sent_bytes: int = SENT_BYTES) -> Fit:
    """Fit all settings to rows (y, uses array<boolean>, idx array<array<long>>,
    val array<array<double>>): ``y`` is 0 or 1 for the log loss; an entry of
    ``idx`` and ``val`` is a feature view (``val`` null: every mention counts 1).

    Settings need ``l2 > 0`` and at least one row.  The intercept is a feature of
    value 1, penalised like the others."""
    for s in settings:
        if s.l2 <= 0:
            raise ValueError("dual coordinate ascent needs l2 > 0")
    if loss == "log":
        rows = rows.withColumn("y", F.when(F.col("y") > 0.5, 1.0).when(F.col("y").isNotNull(), -1.0))
    spark = rows.sparkSession
    blocks, count, used = blocks_of(rows, intercept, block_values)
    if any(not used or used[s.use] == 0 for s in settings):
        raise ValueError("a setting has no training rows")
    passes = passes or (PASSES_ALONE if count == 1 else PASSES)
    # few blocks: their settings are dealt to several tasks
    parts = min(len(settings), -(-spark.sparkContext.defaultParallelism // count))
    held = (blocks.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
                  .repartitionByRange(count * parts, "block", "part").persist(StorageLevel.MEMORY_AND_DISK))
    together = None
    try:
        n_feats = blocks.select(F.explode("feats").alias("f")).agg(F.count_distinct("f")).first()[0]
        sent = n_feats * len(settings) * 8 <= sent_bytes
        shared = _Sent(blocks, len(settings)) if sent else _Joined(blocks, len(settings))
        active, duals, history = list(range(len(settings))), None, []
        heavy = set()
        if sent and count > 1:
            heavy = {i for i, q in enumerate(_row_weights(blocks, settings, used) if n_feats > TOGETHER_FEW else [NEWTON_WEIGHT] * len(settings))
                     if q >= NEWTON_WEIGHT}
        together = _Together(blocks, count, block_values, shared.feats) if heavy else None
        known = {}      # weights whose margins give the duals
        reached = [False] * len(settings)
        done = 0
        for done in range(1, max_rounds + 1):
            now, r = list(active), done
            # blocks that keep no duals are read as they are stored: none moves, none is held
            keeps = bool(set(now) - heavy)
            inputs = (held if duals is None else held.join(duals, ["block", "part"], "left")) if keeps else blocks.withColumn("part", F.lit(0))
            out = materialize(shared.ready(inputs, settings).mapInArrow(
                _round(settings, now, duals is not None, used, count, parts if keeps else 1, passes, r, LOSSES[loss], tol, shared.lookup(), set(heavy),
                       dict(known), shared.feats if known else None),
                "block long, part int, of array<int>, feats array<long>, duals binary, loss array<double>, dual array<double>, change array<binary>"), "dual-round")
            sums = out.agg(*[F.sum(F.col(c)[k]).alias(f"{c}{k}") for c in ("loss", "dual") for k in range(len(now))]).first()
            norms = shared.norms(settings, now)
            active = []
            for k, i in enumerate(now):
                s, (square, absolute) = settings[i], norms[k]
                primal = sums[f"loss{k}"] / used[s.use] + s.l2 / 2 * square + s.l1 * absolute
                dual = sums[f"dual{k}"] / used[s.use] - s.l2 / 2 * square
                history.append((i, r, float(primal), float(dual), float(primal - dual)))
                reached[i] = primal - dual <= tol * abs(primal)
                if not reached[i]:
                    active.append(i)
            if not active:
                break
            shared.add(out, now, active)
            for i in [i for i in known if i not in heavy or i not in active]:
                del known[i]        # stored with the others by now
            for i in sorted(heavy & set(active)):
                s = settings[i]
                found = together.climb(known.get(i), shared.v[i], s, used[s.use], LOSSES[loss], tol)
                if found is None:       # coordinate steps go on
                    heavy.discard(i)
                else:
                    known[i], shared.v[i] = found
            duals = out.select("block", "part", F.col("duals").alias("was"), "of") if keeps else None
        return Fit(shared.weights(spark, settings),
                   spark.createDataFrame(history, "setting int, round int, primal double, dual double, gap double"), reached, done)
    finally:
        held.unpersist()
        if together:
            together.pieces.unpersist()


def _round(settings, now, started, used, blocks, parts, passes, r, loss, tol, lookup, heavy, known, feats):
    values, conjugate, _ = loss
    state = STATES[conjugate]

    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                block = Block(row)
                n = len(block.y)
                v = lookup(row, block)
                was = {}
                if started and row["of"]:
                    was = dict(zip(row["of"], np.frombuffer(row["was"]).reshape(len(row["of"]), n)))
                mine = [i for i in now if i % parts == row["part"]]
                kept = [i for i in mine if i not in heavy]
                duals, losses, dual, change = [np.zeros(0)], [0.0] * len(now), [0.0] * len(now), [None] * len(now)
                for k, i in enumerate(now):
                    if i not in mine:
                        continue
                    s = settings[i]
                    a = was[i].copy() if i in was else np.zeros(n)
                    w = shrink(v[i], s.l1 / s.l2)
                    use = block.uses[:, s.use]
                    if i in known:
                        p = known[i][np.searchsorted(feats, block.feats)]
                        a[use] = state(block.margins(p, s.view), block.y)[0][use]
                    losses[k] = float(values(block.margins(w, s.view), block.y)[use].sum())
                    dual[k] = float(conjugate(a, block.y)[use].sum())
                    if i in heavy:
                        continue
                    rng = np.random.default_rng([SEED, r, block.number, i])
                    change[k] = block.ascend(a, v[i], s, used[s.use], blocks, passes, rng, loss, tol).tobytes()
                    duals.append(a)
                yield pa.RecordBatch.from_arrays([
                    pa.array([block.number], pa.int64()), pa.array([row["part"]], pa.int32()), pa.array([kept], pa.list_(pa.int32())),
                    pa.array([block.feats], pa.list_(pa.int64())), pa.array([np.concatenate(duals).tobytes()], pa.binary()),
                    pa.array([losses], pa.list_(pa.float64())), pa.array([dual], pa.list_(pa.float64())),
                    pa.array([change], pa.list_(pa.binary()))],
                    names=["block", "part", "of", "feats", "duals", "loss", "dual", "change"])
    return run


def _row_weights(blocks: DataFrame, settings, used) -> list[float]:
    """Every setting's mean step bound of a row, were all rows one block."""
    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                block, out = Block(row), []
                for s in settings:
                    ptr, _, val = block.views[s.view]
                    out.append(float((val * val)[np.repeat(block.uses[:, s.use], np.diff(ptr))].sum()))
                yield pa.RecordBatch.from_arrays([pa.array([out], pa.list_(pa.float64()))], names=["squares"])

    sums = blocks.mapInArrow(run, "squares array<double>").agg(*[F.sum(F.col("squares")[i]) for i in range(len(settings))]).first()
    return [q / used[s.use] / (s.l2 * used[s.use]) for q, s in zip(sums, settings)]


class _Rows:
    """The rows of a piece that a setting uses; features by their place in the shared list."""

    def __init__(self, piece, s: Setting, feats: int):
        y, uses, views = piece
        ptr, self.at, self.val = views[s.view]
        size, use, self.feats = np.diff(ptr), uses[:, s.use], feats
        if not use.all():
            mine = np.repeat(use, size)
            y, size, self.at, self.val = y[use], size[use], self.at[mine], self.val[mine]
        self.y, self.cut = y, np.concatenate([[0], np.cumsum(size)])
        self.row = np.repeat(np.arange(len(y)), size)

    def ahead(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights=w[self.at] * self.val, minlength=len(self.y))

    def back(self, d: np.ndarray) -> np.ndarray:
        return np.bincount(self.at, weights=d[self.row] * self.val, minlength=self.feats)

    def add_gram(self, sums: list[np.ndarray], place: np.ndarray, width: int, root: np.ndarray) -> None:
        """x' s s x over the features with a ``place``, the upper side in runs of rows."""
        run = max(1, NEWTON_VALUES // max(width, 1))
        for lo in range(0, len(self.y), run):
            hi = min(lo + run, len(self.y))
            k = slice(self.cut[lo], self.cut[hi])
            to = place[self.at[k]]
            kept = to >= 0
            part = np.zeros((hi - lo, width))
            part[self.row[k][kept] - lo, to[kept]] = (self.val[k] * root[self.row[k]])[kept]
            for out in sums:
                at = width - out.shape[1]
                out += part[:, at:at + len(out)].T @ part[:, at:]


class _Together:
    """Newton steps of the rows of all blocks, which lie in pieces in tasks of their own.

    A step's matrix is summed over the tasks for at most ``TOGETHER_SIDE`` features and
    solved in a task; with more features in use its inverse preconditions conjugate gradients,
    one pass each.  Several step lengths are measured in one pass."""

    def __init__(self, blocks: DataFrame, count: int, block_values: int, feats: np.ndarray):
        cuts = max(-(-block_values // TOGETHER_VALUES), -(-blocks.sparkSession.sparkContext.defaultParallelism // count))
        self.feats, self.tasks = len(feats), count * cuts

        def slices(batches):
            for b in batches:
                for row in b.to_pylist():
                    block = Block(row)
                    to = np.searchsorted(feats, block.feats).astype(np.int32)
                    ends = np.linspace(0, len(block.y), cuts + 1).astype(int)
                    for j, (lo, hi) in enumerate(zip(ends[:-1], ends[1:])):
                        views = [(p[lo:hi + 1] - p[lo], to[c[p[lo]:p[hi]]], x[p[lo]:p[hi]]) for p, c, x in block.views]
                        piece = pickle.dumps((block.y[lo:hi], block.uses[lo:hi], views), 5)
                        yield pa.RecordBatch.from_arrays([pa.array([block.number * cuts + j], pa.int64()), pa.array([piece], pa.binary())],
                                                         names=["number", "piece"])

        # cut before rows go to Python one by one: a whole block is large there
        pieces = blocks.mapInArrow(slices, "number long, piece binary").rdd.map(lambda r: (r.number, pickle.loads(r.piece)))
        # blocks that lie in enough tasks stay where they are read
        if pieces.getNumPartitions() < blocks.sparkSession.sparkContext.defaultParallelism:
            pieces = pieces.partitionBy(self.tasks, int)
        self.pieces = pieces.values().persist(StorageLevel.MEMORY_AND_DISK)

    def _summed(self, s: Setting, size, add) -> np.ndarray:
        """An array of ``size`` that ``add`` adds a piece's rows to, summed over all."""
        feats = self.feats

        def run(pieces):
            out = np.zeros(size)
            for piece in pieces:
                add(out, _Rows(piece, s, feats))
            yield out
        return self.pieces.mapPartitions(run).treeReduce(np.add)

    def _curve(self, s: Setting, state, values, conjugate, p, w, on, core):
        """At weights ``p`` with shrunk weights ``w``: X' s X (w - p), the part of it from features not ``on``,
        the squares of s x, the loss of ``w``, its gap, and the matrix over the features ``core``."""
        feats, width = self.feats, len(core)
        place = np.full(feats, -1)
        place[core] = np.arange(width)
        off = np.where(on, 0.0, w - p)

        def run(pieces):
            sums = [np.zeros((min(TOGETHER_ROWS, width - at), width - at)) for at in range(0, width, TOGETHER_ROWS)]
            out = np.zeros(3 * feats + 2)
            for piece in pieces:
                rows = _Rows(piece, s, feats)
                t, z = rows.ahead(p), rows.ahead(w)
                d, slope = state(t, rows.y)
                cost = values(z, rows.y)
                out[:feats] += rows.back(slope * (z - t))
                out[feats:2 * feats] += rows.back(slope * rows.ahead(off))
                out[2 * feats:-2] += np.bincount(rows.at, weights=slope[rows.row] * rows.val ** 2, minlength=feats)
                out[-2:] += cost.sum(), (cost - conjugate(d, rows.y) + d * z).sum()
                rows.add_gram(sums, place, width, np.sqrt(slope))
            yield -1, out
            yield from enumerate(sums)

        got = self.pieces.mapPartitions(run).reduceByKey(np.add, self.tasks, int).persist(StorageLevel.MEMORY_AND_DISK)
        (out,) = got.filter(lambda kv: kv[0] < 0).values().collect()
        return out[:feats], out[feats:2 * feats], out[2 * feats:-2], float(out[-2]), float(out[-1]), got

    def _solved(self, s: Setting, state, p, on, core, sums, squares, b, c) -> np.ndarray:
        """(c + x' s x) m = b over the features ``on``; 0 elsewhere."""
        width, whole, pulled = len(core), len(core) == on.sum(), b[core]

        def solve(parts):
            square = np.zeros((width, width))
            for j, part in parts:
                at = j * TOGETHER_ROWS
                square[at:at + len(part), at:] = part
                square[at:, at:at + len(part)] = part.T
            square.flat[::width + 1] += c
            if whole:
                yield 0, np.linalg.solve(square, pulled)
                return
            square = np.linalg.inv(square)
            for j, at in enumerate(range(0, width, TOGETHER_ROWS)):
                yield j, square[at:at + TOGETHER_ROWS]

        solved = sums.filter(lambda kv: kv[0] >= 0).partitionBy(1, int).mapPartitions(solve)
        m = np.zeros(self.feats)
        if whole:
            ((_, m[core]),) = solved.collect()
            return m
        inverse = solved.persist(StorageLevel.MEMORY_AND_DISK)

        def near(r):
            out, mine = r / (c + squares), r[core]
            out[core] = np.concatenate([x for _, x in sorted(inverse.mapValues(lambda rows: rows @ mine).collect(), key=lambda kv: kv[0])])
            return out

        def times(x):
            def add(out, rows):
                out += rows.back(state(rows.ahead(p), rows.y)[1] * rows.ahead(x))
            return np.where(on, c * x + self._summed(s, self.feats, add), 0.0)

        r = np.where(on, b, 0.0)
        z = near(r)
        x, size = z.copy(), float(r @ z)
        first = size
        for _ in range(TOGETHER_PASSES):
            if size <= 1e-3 * first:
                break
            ax = times(x)
            rate = size / float(x @ ax)
            m, r = m + rate * x, r - rate * ax
            z = near(r)
            size, was = float(r @ z), size
            x = z + size / was * x
        inverse.unpersist()
        return m

    def climb(self, p, v: np.ndarray, s: Setting, n: int, loss, tol: float):
        """(p, v): weights whose margins give the duals, as in ``Block._ascend_newton``, and the duals' ``v``;
        None where the dual does not rise."""
        values, conjugate, _ = loss
        state = STATES[conjugate]
        c, by, feats = s.l2 * n, s.l1 / s.l2, self.feats
        started = p is not None
        p = p if started else shrink(v, by)

        def measure(p, q, rates):
            def add(out, rows):
                t, far = rows.ahead(p), rows.ahead(q)
                for k, rate in enumerate(rates):
                    d, _ = state(t + rate * far, rows.y)
                    out[k, :feats] += rows.back(d)
                    out[k, feats:] += conjugate(d, rows.y).sum(), values(t + rate * far, rows.y).sum()
            for rate, x in zip(rates, self._summed(s, (len(rates), feats + 2), add)):
                u, to = x[:feats] / c, p + rate * q
                w = shrink(u, by)
                yield rate, to, u, w, float(x[feats]) - c / 2 * float(w @ w), \
                    float(x[feats + 1]) + c * float(0.5 * (to @ to) + by * np.abs(to).sum())

        def mentions(out, rows):
            out += rows.back(np.ones(len(rows.y)))

        weight = np.abs(self._summed(s, feats, mentions))
        before = None
        (now,) = measure(p, np.zeros(feats), [1.0])
        if started:
            before = now[4]
        by_primal = True
        for _ in range(NEWTON_STEPS):
            _, p, u, w, bound, primal = now
            on = np.abs(u) > by if by else np.ones(feats, bool)
            core = np.sort(np.flatnonzero(on)[np.argsort(-weight[on], kind="stable")[:TOGETHER_SIDE]])
            pull, rest, squares, cost, gap, sums = self._curve(s, state, values, conjugate, p, w, on, core)
            if gap <= 0.25 * tol * cost:
                sums.unpersist()
                break
            # from no step on, every step of the solver lowers the primal's model
            toward = np.where(on, self._solved(s, state, p, on, core, sums, squares, c * (w - p) - rest, c), w - p)
            sums.unpersist()
            rise, better, halved = float(pull @ toward), None, 0
            while better is None and halved < 60:
                for new in measure(p, toward, [0.5 ** (halved + k) for k in range(4)]):
                    if by_primal and new[5] < primal - 1e-12 * abs(primal) or not by_primal and new[4] >= bound + 1e-4 * new[0] * rise:
                        better = new
                        break
                halved += 4
                if better is None and by_primal and halved >= 12:
                    by_primal, halved = False, 0
            if better is None:
                break
            now = better
        # the dual of no duals is 0
        if now[4] <= (before if started else 0.0):
            return None
        return now[1], now[2]


class _Sent:
    """Shared values on the driver, sent to the tasks: one array a setting over
    the sorted list of all features (checked against ``SENT_BYTES``)."""

    def __init__(self, blocks: DataFrame, settings: int):
        self.blocks = blocks
        feats = blocks.select(F.explode("feats").alias("f")).distinct().toArrow().column(0).to_numpy()
        self.feats = np.sort(feats)
        self.v = np.zeros((settings, len(self.feats)))

    def ready(self, inputs: DataFrame, settings) -> DataFrame:
        return inputs

    def lookup(self):
        sent = self.blocks.sparkSession.sparkContext.broadcast((self.feats, self.v))

        def find(row, block):
            feats, v = sent.value
            return v[:, np.searchsorted(feats, block.feats)]
        return find

    def norms(self, settings, now):
        out = []
        for i in now:
            w = shrink(self.v[i], settings[i].l1 / settings[i].l2)
            out.append((float(w @ w), float(np.abs(w).sum())))
        return out

    def add(self, out: DataFrame, now, active) -> None:
        """Changes summed in tasks, each at most as large as the shared values."""
        feats, rows = self.feats, len(now)

        def total(batches):
            sums = np.zeros((rows, len(feats)))
            for b in batches:
                for row in b.to_pylist():
                    at = np.searchsorted(feats, np.asarray(row["feats"], np.int64))
                    for k, c in enumerate(row["change"]):
                        if c is not None:
                            sums[k, at] += np.frombuffer(c)
            yield packed(sums)

        parts = out.select("feats", "change").mapInArrow(total, "v binary")
        change = summed(parts, max(1, out.rdd.getNumPartitions()), rows * len(feats)).reshape(rows, -1)
        for k, i in enumerate(now):
            if i in active:
                self.v[i] += change[k]

    def weights(self, spark: SparkSession, settings) -> DataFrame:
        cols = [(i, shrink(v, s.l1 / s.l2)) for i, (v, s) in enumerate(zip(self.v, settings))]
        table = pa.table({"setting": np.concatenate([np.full(int((w != 0).sum()), i, np.int32) for i, w in cols]),
                          "feature": np.concatenate([self.feats[w != 0] for _, w in cols]),
                          "weight": np.concatenate([w[w != 0] for _, w in cols])})
        return spark.createDataFrame(table, "setting int, feature long, weight double")


class _Joined:
    """Shared values as a stored table (feature, v array<double>): every block
    joins those of its own features."""

    def __init__(self, blocks: DataFrame, settings: int):
        self.blocks, self.settings = blocks, settings
        self.v: DataFrame | None = None

    def ready(self, inputs: DataFrame, settings) -> DataFrame:
        if self.v is None:
            return inputs
        own = (self.blocks.select("block", F.posexplode("feats").alias("at", "feature")).join(self.v, "feature")
                   .groupBy("block").agg(F.array_sort(F.collect_list(F.struct("at", "v"))).alias("own")))
        return inputs.join(own, "block", "left")

    def lookup(self):
        settings = self.settings

        def find(row, block):
            v = np.zeros((settings, len(block.feats)))
            for x in row.get("own") or ():
                v[:, x["at"]] = x["v"]
            return v
        return find

    def norms(self, settings, now):
        if self.v is None:
            return [(0.0, 0.0)] * len(now)
        cols = []
        for k, i in enumerate(now):
            w = F.greatest(F.abs(F.col("v")[i]) - settings[i].l1 / settings[i].l2, F.lit(0.0))
            cols += [F.sum(w * w).alias(f"s{k}"), F.sum(w).alias(f"a{k}")]
        r = self.v.agg(*cols).first()
        return [(r[f"s{k}"] or 0.0, r[f"a{k}"] or 0.0) for k in range(len(now))]

    def add(self, out: DataFrame, now, active) -> None:
        settings, stay = self.settings, set(active)

        def spread(batches):
            for b in batches:
                for row in b.to_pylist():
                    feats = np.asarray(row["feats"], np.int64)
                    d = np.zeros((settings, len(feats)))
                    for i, c in zip(now, row["change"]):
                        if i in stay and c is not None:
                            d[i] = np.frombuffer(c)
                    yield pa.RecordBatch.from_arrays([pa.array(feats), pa.array(d.T.tolist(), pa.list_(pa.float64()))], names=["feature", "v"])

        moved = out.select("feats", "change").mapInArrow(spread, "feature long, v array<double>")
        both = moved if self.v is None else self.v.unionByName(moved)
        sums = both.groupBy("feature").agg(*[F.sum(F.col("v")[i]).alias(f"v{i}") for i in range(settings)])
        self.v = materialize(sums.select("feature", F.array(*[f"v{i}" for i in range(settings)]).alias("v")), "dual-shared")

    def weights(self, spark: SparkSession, settings) -> DataFrame:
        if self.v is None:
            return spark.createDataFrame([], "setting int, feature long, weight double")
        cut = F.array(*[F.lit(float(s.l1 / s.l2)) for s in settings])
        w = F.signum("v") * F.greatest(F.abs("v") - F.col("cut"), F.lit(0.0))
        return (self.v.select("feature", F.posexplode("v").alias("setting", "v")).withColumn("cut", F.get(cut, F.col("setting")))
                      .select("setting", "feature", w.alias("weight")).where("weight != 0"))


# -------------------------------------------------------------- scoring
def margins(df: DataFrame, weights: DataFrame, settings: int, carry: Sequence[str], view_of: Sequence[int] | None = None,
            intercept: bool = True, key: Sequence[str] | None = None, sent_bytes: int = SENT_BYTES) -> DataFrame:
    """Rows (carry.., margins array<double>): ``x . w`` of every setting for rows
    with ``idx`` (and ``val``, may be null), one view a setting by ``view_of``.

    Weights are sent to the tasks while they measure below ``sent_bytes``: no row
    moves.  Beyond, the features are exploded and joined, and a row is put
    together again by its ``key`` columns, which must tell rows apart."""
    spark = df.sparkSession
    view_of = list(view_of or [0] * settings)
    if weights.count() * 24 > sent_bytes:
        return _margins_joined(df, weights, settings, carry, view_of, intercept, key)
    table = weights.toArrow()
    by = []
    for i in range(settings):
        m = table.column("setting").to_numpy() == i
        f, w = table.column("feature").to_numpy()[m], table.column("weight").to_numpy()[m]
        order = np.argsort(f)
        by.append((f[order], w[order]))
    sent = spark.sparkContext.broadcast(by)
    out_schema = df.select(*carry).schema.add("margins", ArrayType(DoubleType()))
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(out_schema)

    def run(batches):
        for b in batches:
            idx, val = b.column(b.num_columns - 2), b.column(b.num_columns - 1)
            n, given = len(idx), pc.is_valid(idx).to_numpy(zero_copy_only=False).astype(bool)
            at, totals = np.flatnonzero(given), np.zeros((n, settings))
            idx, val = idx.filter(pa.array(given)), val.filter(pa.array(given))
            for view in sorted(set(view_of)) if len(at) else ():
                ptr, f, x = _view_of(idx, val, view, intercept)
                row = np.repeat(at, np.diff(ptr))
                feats, place = np.unique(f, return_inverse=True)
                for i in range(settings):
                    own, w = sent.value[i]
                    if view_of[i] == view and len(own):
                        k = np.minimum(np.searchsorted(own, feats), len(own) - 1)
                        totals[:, i] = np.bincount(row, weights=np.where(own[k] == feats, w[k], 0.0)[place] * x, minlength=n)
            out = pa.array([m if g else None for m, g in zip(totals.tolist(), given)], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*[b.column(k).cast(f.type) for k, f in enumerate(arrow) if k < len(carry)], out], schema=arrow)

    has = "val" in df.columns
    return df.select(*carry, F.col("idx").alias("__idx"),
                     (F.col("val") if has else F.lit(None).cast("array<array<double>>")).alias("__val")).mapInArrow(run, out_schema)


def _margins_joined(df, weights, settings, carry, view_of, intercept, key):
    if not key:
        raise ValueError("weights beyond sent_bytes need key columns that tell rows apart")
    views = F.array(*[F.lit(v) for v in view_of])
    long = df.select(*key, F.posexplode("idx").alias("view", "fs"), *([F.col("val")] if "val" in df.columns else []))
    x = F.get(F.get("val", F.col("view")), F.col("k")) if "val" in df.columns else F.lit(1.0)
    long = long.select("*", F.posexplode("fs").alias("k", "feature")).select(*key, "view", "feature", F.coalesce(x, F.lit(1.0)).alias("x"))
    w = weights.withColumn("view", F.get(views, F.col("setting")))
    parts = (long.join(w.where(F.col("feature") != INTERCEPT), ["view", "feature"])
                 .groupBy(*key).agg(*[F.sum(F.when(F.col("setting") == i, F.col("x") * F.col("weight"))).alias(f"m{i}")
                                      for i in range(settings)]))
    base = {r.setting: r.weight for r in weights.where(F.col("feature") == INTERCEPT).collect()} if intercept else {}
    out = df.select(*carry, *[c for c in key if c not in carry], F.col("idx").isNull().alias("__none"))
    same = [out[c].eqNullSafe(parts[c]) for c in key]
    cond = same[0]
    for c in same[1:]:
        cond = cond & c
    m = F.array(*[F.coalesce(parts[f"m{i}"], F.lit(0.0)) + F.lit(float(base.get(i, 0.0))) for i in range(settings)])
    return out.join(parts, cond, "left").select(*[out[c] for c in carry], F.when(~F.col("__none"), m).alias("margins"))


# -------------------------------------------------------------- estimator

class FastLinear(Estimator, HasFeaturesCol, HasLabelCol):
    """M09 as a pipeline stage over an ML vector column: a Spark logistic or
    linear regression model with the weights of ``ascend``.  ``history`` of the
    fitted model is the gap by round."""

    kind = Param(Params._dummy(), "kind", "classification or regression", TypeConverters.toString)
    l1 = Param(Params._dummy(), "l1", "weight of the absolute values", TypeConverters.toFloat)
    l2 = Param(Params._dummy(), "l2", "weight of half the squares", TypeConverters.toFloat)
    tol = Param(Params._dummy(), "tol", "duality gap over the primal value", TypeConverters.toFloat)
    maxIter = Param(Params._dummy(), "maxIter", "most rounds", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", kind="classification", l1=0.0, l2=1e-4, tol=1e-3, maxIter=200):
        super().__init__()
        self._setDefault(kind="classification", l1=0.0, l2=1e-4, tol=1e-3, maxIter=200)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame):
        g = self.getOrDefault
        kind, features = g("kind"), g("featuresCol")
        rows = rows_of_vectors(dataset, g("labelCol"), features)
        size = dataset.select(F.unwrap_udt(features).alias("v")).select(
            F.max(F.coalesce(F.col("v.size"), F.size("v.values")))).first()[0] or 0
        fit = ascend(rows, [Setting(g("l1"), g("l2"))], "log" if kind == "classification" else "squared", g("tol"), g("maxIter"))
        w = {r.feature: r.weight for r in fit.weights.collect()}     # at most the vector's length
        return linear_model(dataset.sparkSession, kind, size, w, features, g("labelCol"), fit)


def linear_model(spark: SparkSession, kind: str, size: int, weights: dict[int, float], features_col: str, label_col: str, fit: Fit):
    """Spark's own model class with given weights, so that scoring, saving and
    coefficient tables work as for any other learner."""
    from pyspark.ml.classification import LogisticRegressionModel
    from pyspark.ml.regression import LinearRegressionModel
    from pyspark.ml.util import Identifiable
    intercept = float(weights.pop(INTERCEPT, 0.0))
    jvm = spark.sparkContext._jvm
    dense = np.zeros(size)
    for k, v in weights.items():
        dense[k] = v
    vector = jvm.org.apache.spark.ml.linalg.Vectors.dense(spark.sparkContext._gateway.new_array(jvm.double, 0)) if not size else \
        jvm.org.apache.spark.ml.linalg.Vectors.dense(float(dense[0]), _doubles(spark, dense[1:]))
    cls, java = ((LogisticRegressionModel, "org.apache.spark.ml.classification.LogisticRegressionModel") if kind == "classification"
                 else (LinearRegressionModel, "org.apache.spark.ml.regression.LinearRegressionModel"))
    made = jvm
    for part in java.split("."):
        made = getattr(made, part)
    uid = Identifiable().uid.replace("Identifiable", "fastlinear")
    model = cls(made(uid, vector, intercept))
    model._resetUid(uid)
    model.set(model.featuresCol, features_col)
    model._transfer_params_to_java()
    model.history, model.reached = fit.history, fit.reached
    return model


def _doubles(spark: SparkSession, values: np.ndarray):
    """A JVM sequence of doubles."""
    return spark.sparkContext._jvm.PythonUtils.toSeq([float(v) for v in values])
