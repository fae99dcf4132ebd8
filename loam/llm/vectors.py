"""Embedding near-dedup by PCA-ordered tiled comparison (operator 6).

Equal vectors collapse into one with a count.  Vectors are scaled to length 1
and turned into the axes of a principal component analysis (fitted on a bounded
sample; any axes give the same links, good ones give them sooner).  Two vectors
at cosine ``t`` are at most ``sqrt(2 - 2t)`` apart, so also along the leading
axes: a grid of that width over the first ``GRID_AXES`` axes (at most
``7 ** GRID_AXES`` cells at 0.95) deals vectors to their own cell and to those
neighbours that the vector is near enough to.  Cells above ``TILE`` vectors are
cut into chunks; two chunks meet in one task.

A tile adds up products over the leading axes first.  What the remaining axes
can add is at most the product of the two vectors' suffix norms; pairs that
cannot reach the threshold stop there, the others go on to the next axes.  Every link is
decided by the whole product in double precision.  Tiles return link counts and only
those links that join two of their trees.

The comparison is exact, so its work grows with the pairs in neighbouring
cells; vectors that fill space evenly make that nearly quadratic.

Defined results: null, empty and zero vectors and those with a null or
non-finite component link with nothing; shorter vectors read as followed by
zeros; a null id is never a component's id unless all ids in it are null;
repeated rows link with each other; an empty table gives none.
"""

from __future__ import annotations

import math
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loam.llm.common import Forest, components, in_groups, stored

TILE = 4096
GRID_AXES = 3
SAMPLE = 20_000
STEPS = (16, 32, 64, 128, 256, 512)
SLACK = 1e-9


def unit(v: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1 (first by their largest component: no overflow)."""
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def matrix(lists, width: int) -> np.ndarray:
    """Rows of an Arrow list column, shorter ones followed by zeros."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    n = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(n), width))
    out[np.arange(width) < n[:, None]] = flat
    return out


def axes(sample: np.ndarray, width: int) -> np.ndarray:
    """Orthonormal axes, the strongest first."""
    if not len(sample):
        return np.eye(width)
    x = unit(sample)
    return np.linalg.eigh(x.T @ x)[1][:, ::-1].copy()


def suffix_norms(y: np.ndarray) -> np.ndarray:
    """Column k: norm of what stands from axis k on (last column: zero)."""
    out = np.zeros((y.shape[0], y.shape[1] + 1))
    out[:, :-1] = np.sqrt(np.cumsum((y * y)[:, ::-1], axis=1)[:, ::-1])
    return out


def close_pairs(x: np.ndarray, y: np.ndarray, t: float, block: int = 512):
    """Yield (i, j) index arrays with x[i] . y[j] >= t, block by block."""
    width = x.shape[1]
    stops = [s for s in STEPS if s < width] + [width]
    sx, sy = suffix_norms(x), suffix_norms(y)
    for a in range(0, len(x), block):
        xa, sa = x[a:a + block], sx[a:a + block]
        k = stops[0]
        dot = xa[:, :k] @ y[:, :k].T
        i, j = np.nonzero(dot + np.outer(sa[:, k], sy[:, k]) >= t - SLACK)
        got = dot[i, j]
        for lo, hi in zip(stops, stops[1:]):
            if not len(i):
                break
            step = max(1, (1 << 21) // (hi - lo))
            got = got + np.concatenate([np.einsum("ij,ij->i", xa[i[b:b + step], lo:hi], y[j[b:b + step], lo:hi])
                                        for b in range(0, len(i), step)])
            alive = got + sa[i, hi] * sy[j, hi] >= t - SLACK
            i, j, got = i[alive], j[alive], got[alive]
        alive = got >= t
        if alive.any():
            yield i[alive] + a, j[alive]


def valid(v: str) -> str:
    """SQL: the vector has a direction."""
    return (f"{v} is not null and forall({v}, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) "
            f"and exists({v}, x -> x <> 0)")


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vector: str = "embedding", threshold: float = 0.95,
                    tile: int = TILE) -> DataFrame:
    """One row per row of ``df``: (``id_col``, n_links, component_id, kept)."""
    spark = df.sparkSession
    rows = df.select(F.col(id_col).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    rows = rows.withColumn("v", F.expr(f"if({valid('v')}, v, null)"))
    reps = stored(rows.where("v is not null").groupBy("v").agg(F.min("id").alias("rep"), F.count("*").alias("many"))
                  .withColumn("uid", F.monotonically_increasing_id()), "vectors")
    n, width = reps.agg(F.count("*"), F.max(F.size("v"))).first()
    if not n:
        return rows.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"),
                           F.col("id").cast("long").alias("component_id"), F.lit(True).alias("kept"))
    some = reps.where(F.pmod(F.xxhash64("uid"), F.lit(max(1, n // SAMPLE))) == 0).select("v").limit(SAMPLE)
    basis = axes(matrix(some.toArrow().column("v"), width), width)
    reach = math.sqrt(2 - 2 * threshold) + 1e-6
    lead = min(GRID_AXES, width)
    per_axis = int(2 / reach) + 2

    def turn(batches):
        for b in batches:
            if not b.num_rows:
                continue
            y = np.clip(unit(matrix(b.column("v"), width)) @ basis, -1, 1)  # a rounded -1 - 2e-16 has no cell
            at = np.floor((y[:, :lead] + 1) / reach).astype(np.int64)
            cell = at @ (per_axis ** np.arange(lead))
            yield pa.RecordBatch.from_arrays([b.column("uid"), b.column("many"), pa.array(cell),
                                              pa.array([r.tobytes() for r in y], pa.binary())],
                                             names=["uid", "many", "cell", "y"])

    turned = stored(reps.select("uid", "many", "v").mapInArrow(turn, "uid long, many long, cell long, y binary"), "turned")
    chunks = {r.cell: -(-r.n // tile) for r in turned.groupBy("cell").agg(F.count("*").alias("n")).collect()}

    def deal(batches):
        names = ["ta", "tb", "side", "uid", "many", "y"]
        for b in batches:
            for a in range(0, b.num_rows, 1024):
                part = b.slice(a, 1024)
                uid, cell = part.column("uid").to_numpy(), part.column("cell").to_numpy()
                y = np.frombuffer(b"".join(part.column("y").to_pylist())).reshape(-1, width)[:, :lead]
                own_chunks = np.array([chunks[c] for c in cell.tolist()])
                own = (cell << 24) + (uid * 2654435761 % (1 << 31)) % own_chunks
                for step in product((-1, 0, 1), repeat=lead):
                    step = np.array(step)
                    at = np.floor((y + 1) / reach).astype(np.int64) + step
                    inside = ((at >= 0) & (at < per_axis)).all(axis=1)
                    low, high = at * reach - 1, (at + 1) * reach - 1
                    gap = np.maximum(0, np.maximum(low - y, y - high))
                    other = at @ (per_axis ** np.arange(lead))
                    there = np.array([chunks.get(c, 0) for c in other.tolist()])
                    pick = np.flatnonzero(inside & (there > 0) & ((gap * gap).sum(axis=1) <= reach * reach))
                    if not len(pick):
                        continue
                    i = np.repeat(pick, there[pick])
                    ends = np.cumsum(there[pick])
                    k = np.arange(len(i)) - np.repeat(ends - there[pick], there[pick])
                    that = (other[i] << 24) + k
                    this = own[i]
                    at_row = pa.array(i)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.minimum(this, that)), pa.array(np.maximum(this, that)),
                         pa.array((this > that).astype(np.int32)), part.column("uid").take(at_row),
                         part.column("many").take(at_row), part.column("y").take(at_row)], names=names)

    def compare(g):
        y = np.frombuffer(b"".join(g["y"].tolist())).reshape(-1, width)
        uid, many = g["uid"], g["many"]
        if g["ta"][0] == g["tb"][0]:
            p = q = np.arange(len(y))
        else:
            p, q = np.flatnonzero(g["side"] == 0), np.flatnonzero(g["side"] == 1)
        links = np.zeros(len(y), np.int64)
        f = Forest(len(y))
        for i, j in close_pairs(y[p], y[q], threshold):
            i, j = p[i], q[j]
            if p is q:
                i, j = i[i < j], j[i < j]
            np.add.at(links, i, many[j])
            np.add.at(links, j, many[i])
            for s, t in zip(i.tolist(), j.tolist()):
                f.join(s, t)
        at = np.flatnonzero(links)
        yield {"a": uid[at], "b": uid[at], "n": links[at]}
        if f.edges:
            e = np.array(f.edges)
            yield {"a": uid[e[:, 0]], "b": uid[e[:, 1]], "n": np.zeros(len(e), np.int64)}

    tiles = turned.mapInArrow(deal, "ta long, tb long, side int, uid long, many long, y binary")
    found = stored(in_groups(tiles, ["ta", "tb"], "a long, b long, n long", compare), "links")
    counts = found.groupBy(F.col("a").alias("uid")).agg(F.sum("n").alias("n"))
    roots = components(found.where("a <> b"))
    named = (reps.select("uid", "rep", "many").join(counts, "uid", "left")
                 .join(roots, F.col("uid") == F.col("node"), "left")
                 .select("uid", "rep", (F.coalesce("n", F.lit(0)) + F.col("many") - 1).alias("n_links"),
                         F.coalesce("root", "uid").alias("root")))
    least = named.groupBy("root").agg(F.min("rep").alias("component_id"))
    known = named.join(least, "root").select("uid", "n_links", "component_id")
    out = (rows.join(reps.select("uid", F.col("v").alias("v2")), F.col("v") == F.col("v2"), "left")
               .join(known, "uid", "left"))
    comp = F.when(F.col("uid").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      comp.cast("long").alias("component_id"), F.col("id").eqNullSafe(comp).alias("kept"))
