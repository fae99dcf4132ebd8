"""Boosted regression trees on disjoint parts, all parts in the same passes.

Every part has a model of its own: trees on the residuals of the part's rows,
grown level by level.  One pass over the rows gives the histograms of all parts
at once, keyed (part, node, feature, bin); those of a part are added in a task,
which picks each node's split, and the driver sends the grown level back.  The number of jobs is that of the
levels and trees, whatever the number of parts.

Rows are kept as blocks of bin numbers (one byte a value) in the shared folder.
A block's running predictions are written after each tree; a lost executor takes
them up from there.  What the driver holds is bounded by parts x trees x nodes, what a
task holds beside its block by parts x nodes x bins of all features.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loam.session import materialize

BINS = 32
BLOCK_ROWS = 1 << 15
BLOCK_SCHEMA = "block long, n int, part binary, y binary, bins binary"


def bin_edges(df: DataFrame, width: int, features: str = "x", bins: int = BINS) -> list[np.ndarray]:
    """Upper edges of each feature's bins: quantiles of the known values (all of
    them where there are few); the last bin has none."""
    probs = F.array(*[F.lit(k / bins) for k in range(1, bins)])
    edges = []
    for a in range(0, width, 100):
        cols = range(a, min(a + 100, width))
        row = df.agg(*[F.percentile_approx(F.when(~F.isnan(F.col(features)[k]), F.col(features)[k]), probs, 10_000).alias(f"c{k}") for k in cols],
                     *[F.max(F.when(~F.isnan(F.col(features)[k]), F.col(features)[k])).alias(f"m{k}") for k in cols]).first()
        for k in cols:
            e = np.unique(np.array(row[f"c{k}"] or [], float))
            edges.append(e[e < row[f"m{k}"]] if row[f"m{k}"] is not None else e[:0])
    return edges


def block_rows(df: DataFrame, edges: list[np.ndarray], part_col: str, label_col: str, features: str = "x") -> DataFrame:
    """Stored blocks of (part, y, bin of every feature); no row moves.  A value
    that is no number is in the last bin."""
    width = len(edges)

    def pack(batches):
        number, waiting, held = TaskContext.get().partitionId() << 32, [], 0
        for b in batches:
            if b.num_rows:
                waiting.append(b)
                held += b.num_rows
            if held >= BLOCK_ROWS:
                yield block(number, pa.Table.from_batches(waiting))
                number, waiting, held = number + 1, [], 0
        if waiting:
            yield block(number, pa.Table.from_batches(waiting))

    def block(number, t):
        n = t.num_rows
        x = t.column(2).combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(n, width)
        bins = np.empty((width, n), np.uint8)
        for k, e in enumerate(edges):
            bins[k] = np.where(np.isnan(x[:, k]), len(e), np.searchsorted(e, x[:, k], "left"))
        return pa.RecordBatch.from_arrays([
            pa.array([number], pa.int64()), pa.array([n], pa.int32()),
            pa.array([t.column(0).to_numpy().astype(np.int32).tobytes()], pa.binary()),
            pa.array([t.column(1).to_numpy().astype(float).tobytes()], pa.binary()),
            pa.array([bins.tobytes()], pa.binary())], names=["block", "n", "part", "y", "bins"])

    rows = df.select(F.col(part_col).cast("int").alias("p"), F.col(label_col).cast("double").alias("y"), features)
    return materialize(rows.mapInArrow(pack, BLOCK_SCHEMA), "tree-blocks")


@dataclass
class PartsEnsemble:
    """One boosted model a part.  Arrays by (part, tree, node): ``feature`` (-1: a
    leaf), ``edge`` (rows with value <= edge go left), ``value`` of a leaf; node
    ``i`` has children ``2 i + 1`` and ``2 i + 2``."""

    parts: list[int]
    base: np.ndarray
    feature: np.ndarray
    edge: np.ndarray
    value: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Predictions (rows, parts) for a matrix of feature values."""
        n, (parts, trees, nodes) = len(x), self.feature.shape
        out = np.tile(self.base, (n, 1))
        rows = np.arange(n)
        for p in range(parts):
            for t in range(trees):
                at = np.zeros(n, np.int64)
                feature, edge = self.feature[p, t], self.edge[p, t]
                while True:
                    f = feature[at]
                    inner = f >= 0
                    if not inner.any():
                        break
                    left = x[rows, np.maximum(f, 0)] <= edge[at]
                    at = np.where(inner, 2 * at + 2 - left, at)
                out[:, p] += self.value[p, t, at]
        return out

    def table(self, spark: SparkSession) -> DataFrame:
        """Rows (part, tree, node, feature, edge, value) of all reachable nodes."""
        rows = []
        for i, part in enumerate(self.parts):
            for t in range(self.feature.shape[1]):
                todo = [0]
                while todo:
                    k = todo.pop()
                    f = int(self.feature[i, t, k])
                    rows.append((part, t, k, f, float(self.edge[i, t, k]) if f >= 0 else None, float(self.value[i, t, k]) if f < 0 else None))
                    todo += [2 * k + 1, 2 * k + 2] if f >= 0 else []
        return spark.createDataFrame(rows, "part int, tree int, node int, feature int, edge double, value double")


def fit_parts(df: DataFrame, part_col: str, label_col: str = "label", features_col: str = "features", trees: int = 50,
              depth: int = 5, rate: float = 0.1, min_rows: int = 1, bins: int = BINS) -> PartsEnsemble:
    """A boosted model for every part of ``df`` (``features_col``: an ML
    vector).  Squared loss; a leaf adds ``rate`` times its mean residual; a split
    has the largest drop of the squared error (ties: the first feature, then the
    lowest edge) and at least ``min_rows`` rows a side.  Rows with a null part,
    label or vector are left out."""
    data = materialize(df.where(F.col(part_col).isNotNull() & F.col(label_col).isNotNull() & F.col(features_col).isNotNull()).select(
        part_col, F.col(label_col).cast("double").alias(label_col), vector_to_array(features_col).alias("x")), "tree-rows")
    means = {int(r[0]): (r.m, r.n) for r in data.groupBy(F.col(part_col).cast("int")).agg(F.avg(label_col).alias("m"), F.count("*").alias("n")).collect()}
    if not means:
        raise ValueError("no rows to fit")
    parts = sorted(means)
    base = np.array([means[p][0] for p in parts])
    width = data.select(F.size("x")).first()[0]
    edges = bin_edges(data, width, bins=bins)
    stored = block_rows(data, edges, part_col, label_col)
    # one histogram a task and part: twice the cores keep all busy, more tasks would only add histograms
    tasks = max(1, min(stored.rdd.getNumPartitions(), 2 * df.sparkSession.sparkContext.defaultParallelism))
    held = stored.repartition(tasks, "block").persist(StorageLevel.MEMORY_AND_DISK)
    nodes = 2 ** (depth + 1) - 1
    feature = np.full((len(parts), trees, nodes), -1, np.int32)
    cut = np.full((len(parts), trees, nodes), 255, np.int32)
    edge, value = np.zeros((len(parts), trees, nodes)), np.zeros((len(parts), trees, nodes))
    number = {p: i for i, p in enumerate(parts)}
    state = None
    try:
        for t in range(trees):
            # joined once for the passes of a tree
            inputs = held if state is None else held.join(state, "block").persist(StorageLevel.MEMORY_AND_DISK)
            for level in range(depth):
                splits = _histograms(inputs, number, base, feature[:, t], cut[:, t], level, bins, edges, rate, min_rows, tasks)
                if not _grow(splits, level, feature[:, t], cut[:, t], edge[:, t], value[:, t], edges):
                    break
            if t + 1 < trees:
                state = _advance(inputs, number, base, feature[:, t], cut[:, t], value[:, t])
            if inputs is not held:
                inputs.unpersist()
    finally:
        held.unpersist()
    return PartsEnsemble(parts, base, feature, edge, value)


def _block(row: dict, number: dict, base: np.ndarray):
    """Part number, residual target, running prediction and bins of a block."""
    n = row["n"]
    part = np.frombuffer(row["part"], np.int32)
    lookup = np.array(sorted(number))
    part = np.array([number[int(p)] for p in lookup])[np.searchsorted(lookup, part)]
    now = np.frombuffer(row["now"]) if row.get("now") is not None else base[part]
    return part, np.frombuffer(row["y"]), now, np.frombuffer(row["bins"], np.uint8).reshape(-1, n)


def _reach(part, bins, feature, cut, steps: int) -> np.ndarray:
    """The node of each row after at most ``steps`` splits."""
    at = np.zeros(len(part), np.int64)
    rows = np.arange(len(part))
    for _ in range(steps):
        f = feature[part, at]
        left = bins[np.maximum(f, 0), rows] <= cut[part, at]
        at = np.where(f >= 0, 2 * at + 2 - left, at)
    return at


def _histograms(inputs, number, base, feature, cut, level, bins, edges, rate, min_rows, tasks) -> pa.Table:
    """The level's nodes with rows: (part, node, feature, bin, left, right), the
    feature -1 and the node's value in ``left`` where none splits it.  A task sums
    the histograms of its blocks (nodes, bins of all features, [residual, rows]) by
    part, those of a part meet in one task, and the driver gets the chosen splits."""
    parts, nodes, width = len(number), 2 ** level, len(edges)
    sizes = [len(e) + 1 for e in edges]
    starts = np.concatenate([[0], np.cumsum(sizes)]).astype(int)
    of = np.repeat(np.arange(width), sizes)
    place = np.arange(starts[-1]) - starts[of]
    shape = (parts, nodes, int(starts[-1]), 2)

    def local(batches):
        out = np.zeros(shape)
        for b in batches:
            for row in b.to_pylist():
                part, y, now, values = _block(row, number, base)
                at = _reach(part, values, feature, cut, level)
                here = np.flatnonzero(at >= nodes - 1)
                group = part[here] * nodes + at[here] - (nodes - 1)
                rest = (y - now)[here]
                for k, size in enumerate(sizes):
                    key = group * size + values[k, here]
                    cells = out[:, :, starts[k]:starts[k + 1]]
                    cells[..., 0] += np.bincount(key, rest, parts * nodes * size).reshape(parts, nodes, size)
                    cells[..., 1] += np.bincount(key, minlength=parts * nodes * size).reshape(parts, nodes, size)
        some = [p for p in range(parts) if out[p, :, :, 1].any()]
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([out[p].tobytes() for p in some], pa.binary())], names=["part", "v"])

    def choose(batches):
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for p, v in zip(b.column(0).to_pylist(), b.column(1)):
                sums[p] = sums.get(p, 0.0) + np.frombuffer(v.as_buffer()).reshape(shape[1:])
        found = []
        for p, cells in sums.items():
            for k in range(nodes):
                h = np.zeros((width, bins, 2))
                h[of, place] = cells[k]
                rows = h[0, :, 1].sum()
                if not rows:
                    continue
                best = best_split(h, min_rows)
                if best is None:
                    found.append((p, k, -1, -1, rate * h[0, :, 0].sum() / rows, 0.0))
                    continue
                f, b = best
                left, right = h[f, :b + 1], h[f, b + 1:]
                found.append((p, k, f, b, rate * left[:, 0].sum() / left[:, 1].sum(), rate * right[:, 0].sum() / right[:, 1].sum()))
        cols = list(zip(*found)) or [()] * 6
        yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.int32()) for c in cols[:4]], *[pa.array(c, pa.float64()) for c in cols[4:]]],
                                         names=["part", "node", "feature", "bin", "left", "right"])

    sums = inputs.mapInArrow(local, "part int, v binary").repartition(min(parts, tasks), "part")
    return sums.mapInArrow(choose, "part int, node int, feature int, bin int, left double, right double").toArrow()


def best_split(hist: np.ndarray, min_rows: int) -> tuple[int, int] | None:
    """(feature, bin) with the largest drop of the squared error of a node's
    histogram (features, bins, [residual, rows])."""
    s, n = np.cumsum(hist[:, :-1, 0], axis=1), np.cumsum(hist[:, :-1, 1], axis=1)
    total, rows = hist[0, :, 0].sum(), hist[0, :, 1].sum()
    ok = (n >= min_rows) & (rows - n >= min_rows)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where(ok, s * s / n + (total - s) ** 2 / (rows - n) - total * total / rows, -np.inf)
    if not ok.any():
        return None
    top = gain.max()
    if not top > 1e-12 * max(1.0, total * total / rows):
        return None
    # sums of tasks come in any order: what differs by rounding alone is a tie
    f, b = np.unravel_index(np.argmax(gain >= top - 1e-10 * abs(top)), gain.shape)
    return int(f), int(b)


def _grow(splits: pa.Table, level: int, feature, cut, edge, value, edges) -> bool:
    """Splits of one level, and the value of every child should it stay a leaf;
    whether any node was split."""
    grown = False
    for r in splits.to_pylist():
        p, at, f, b = r["part"], 2 ** level - 1 + r["node"], r["feature"], r["bin"]
        if f < 0:
            value[p, at] = r["left"]
            continue
        feature[p, at], cut[p, at], edge[p, at], grown = f, b, edges[f][b], True
        value[p, 2 * at + 1], value[p, 2 * at + 2] = r["left"], r["right"]
    return grown


def _advance(inputs, number, base, feature, cut, value) -> DataFrame:
    """Stored running predictions with one more tree."""
    steps = int(np.log2(feature.shape[1] + 1)) - 1

    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                part, _, now, bins = _block(row, number, base)
                new = now + value[part, _reach(part, bins, feature, cut, steps)]
                yield pa.RecordBatch.from_arrays([pa.array([row["block"]], pa.int64()), pa.array([new.tobytes()], pa.binary())], names=["block", "now"])

    return materialize(inputs.mapInArrow(run, "block long, now binary"), "tree-state")


def predict(model: PartsEnsemble, df: DataFrame, keep: Sequence[str], features_col: str = "features", name: str = "prediction") -> DataFrame:
    """The mean of the parts' predictions beside the kept columns; null for a null vector."""
    schema = df.select(*keep).schema.add(name, "double")
    sent = df.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            x = b.column(b.num_columns - 1)
            full = ~np.asarray(x.is_null().to_numpy(zero_copy_only=False), bool)
            out = np.full(b.num_rows, np.nan)
            if full.any():
                out[full] = sent.value.scores(x.flatten().to_numpy(zero_copy_only=False).reshape(int(full.sum()), -1)).mean(axis=1)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(out, mask=~full)], names=[*[f.name for f in schema]])

    x = F.when(F.col(features_col).isNotNull(), vector_to_array(features_col))
    return df.select(*keep, x.alias("__x")).mapInArrow(run, schema)
