"""Reconciliation of node forecasts.

Notation: ``S`` maps bottom series to nodes (``membership`` table, one row per
(bottom, node) pair), ``yhat`` are base forecasts per node, ``W`` a diagonal
weight per node.

* bottom-up (T06): node forecast = sum of its bottom forecasts;
* optimal combination (T07): bottom forecasts ``b`` minimising
  ``(yhat - S b)' W (yhat - S b)``, i.e. ``(S'WS) b = S'W yhat``.  Two exact
  forms, chosen by the counted size of the smaller one:

  - *upper-node systems*: with ``U`` the upper rows of ``S``, ``D`` the bottom
    weights and ``V`` the upper weights, ``b = yb + D^-1 U' mu`` where
    ``(V^-1 + U D^-1 U') mu = yu - U yb``.  One grouped sum builds the matrix
    of every system -- one per (setting, origin, step) --, one task solves each,
    and one join brings ``mu`` back to the bottom series: a fixed number of
    jobs, whatever the number of series.
  - *conjugate gradient* with matrix-free products on long tables, where a
    system has more than ``TASK_ENTRIES`` matrix entries: ``S v`` is a join to
    ``membership`` + sum per node, ``S' u`` a join + sum per bottom.  All
    systems run in the same DataFrame iteration; the per-system scalars (step
    sizes) are tables with one row per system.  Each iteration's state is
    checkpointed to the shared checkpoint folder, which cuts the lineage and
    survives executor loss.

Weights: ``ols`` 1, ``nseries`` 1 / (number of bottom series under the node),
``wls`` 1 / (in-sample one-step residual variance of the node's base model).
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loam.session import checkpoint_dir, materialize

#: Largest matrix of one system that a task solves (entries of 24 bytes plus two node names).
TASK_ENTRIES = 1_000_000
#: Unknowns up to which a task solves densely (8 bytes each squared); beyond, conjugate gradient on the entries.
DENSE_NODES = 1_000

# (steps, final relative residual) of the recent solves, for diagnostics
SOLVE_LOG: list[tuple[int, float]] = []


def bottom_up(bottom_fc: DataFrame, membership: DataFrame, sys_keys: Sequence[str],
              value: str = "fcast") -> DataFrame:
    """Node forecasts as sums of bottom forecasts (one shuffle)."""
    sys_keys = list(sys_keys)
    return (bottom_fc.join(membership.select("bottom", "node"), on="bottom")
                     .groupBy(*sys_keys, "node").agg(F.sum(value).alias(value)))


def node_weights(membership: DataFrame, node_fc: DataFrame, sys_keys: Sequence[str], scheme: str) -> DataFrame:
    """Per (system, node) weight for the chosen scheme."""
    sys_keys = list(sys_keys)
    if scheme == "ols":
        return node_fc.select(*sys_keys, "node", F.lit(1.0).alias("w"))
    if scheme == "nseries":
        n = membership.groupBy("node").agg(F.count(F.lit(1)).alias("_n"))
        return node_fc.select(*sys_keys, "node").join(n, on="node").select(
            *sys_keys, "node", (1.0 / F.col("_n")).alias("w"))
    if scheme == "wls":
        return node_fc.select(*sys_keys, "node", (1.0 / F.greatest(F.col("resid_var"), F.lit(1e-9))).alias("w"))
    raise ValueError(f"unknown weights {scheme!r}")


class _Structure:
    """The summing matrix S split into its bottom rows (identity: a bottom
    node *is* its bottom series) and its upper rows (total and one node per
    value of each key -- their number is bounded by the key cardinalities,
    not by the data).  Products never join on an upper node against the whole
    membership table (the total node covers every series, a hot key): the
    upper-node vectors are broadcast when their measured bytes allow; otherwise
    a node is split into parts of ``PART`` series, and the join runs on (node,
    part), so no key has more than about ``PART`` rows per system.  The bottom
    part joins on the series key, which is evenly spread."""

    PART = 10_000

    def __init__(self, membership: DataFrame, n_systems: int, broadcast_bytes: int = 64 << 20):
        self.up = membership.where(F.col("node") != F.col("bottom")).select("bottom", "node")
        per = self.up.groupBy("node").agg(F.count(F.lit(1)).alias("_n"))
        self.up_nodes = per.select("node", F.ceil(F.col("_n") / self.PART).cast("int").alias("_parts"))
        # names plus about 64 bytes of keys and values a row; one row per upper node and system
        size = self.up_nodes.agg(F.sum(F.octet_length("node") + 64)).first()[0] or 0
        self.bcast = size * max(n_systems, 1) <= broadcast_bytes
        self.up_nodes_small = F.broadcast(self.up_nodes) if size <= broadcast_bytes else self.up_nodes

    def flag(self, w: DataFrame) -> DataFrame:
        """Weights with an ``up`` flag (upper node or bottom node); every
        node-level vector of the solver inherits it through its join with the
        weights, so splitting needs no further join."""
        return (w.join(self.up_nodes_small.select("node", F.lit(True).alias("up")), on="node", how="left")
                 .fillna(False, subset=["up"]))

    def _to_bottoms(self, u_up: DataFrame) -> DataFrame:
        """Upper-node rows brought to every bottom series under them."""
        if self.bcast:
            return self.up.join(F.broadcast(u_up), on="node")
        parts = self.up.join(self.up_nodes_small, on="node").withColumn(
            "_part", F.pmod(F.xxhash64("bottom"), F.col("_parts")).cast("int")).drop("_parts")
        copies = u_up.join(self.up_nodes_small, on="node").withColumn(
            "_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))).drop("_parts")
        return parts.join(copies, on=["node", "_part"])

    def S(self, v: DataFrame, sys_keys, col: str) -> DataFrame:
        """(S v) per (system, node) from v per (system, bottom)."""
        bottom = v.select(*sys_keys, F.col("bottom").alias("node"), col)
        upper = (v.select(*sys_keys, "bottom", col).join(self.up, on="bottom")
                  .groupBy(*sys_keys, "node").agg(F.sum(col).alias(col)))      # partial aggregation first
        return bottom.unionByName(upper)

    def St(self, u: DataFrame, sys_keys, col: str) -> DataFrame:
        """(S' u) per (system, bottom) from u per (system, node) carrying the
        ``up`` flag."""
        u = u.select(*sys_keys, "node", col, "up")
        u_up = u.where(F.col("up")).drop("up")
        u_bot = u.where(~F.col("up")).drop("up").withColumnRenamed("node", "bottom")
        contrib = (self._to_bottoms(u_up)
                       .groupBy(*sys_keys, "bottom").agg(F.sum(col).alias(col)))
        return (u_bot.unionByName(contrib.select(*sys_keys, "bottom", col))
                     .groupBy(*sys_keys, "bottom").agg(F.sum(col).alias(col)))

    def A(self, v: DataFrame, w: DataFrame, sys_keys, col: str) -> DataFrame:
        """(S' W S v) per (system, bottom)."""
        sv = self.S(v, sys_keys, col)
        wsv = sv.join(w, on=[*sys_keys, "node"]).select(*sys_keys, "node", (F.col(col) * F.col("w")).alias(col),
                                                          "up")
        return self.St(wsv, sys_keys, col)


class _Store:
    """Materialise iteration state.  Frames are persisted (memory + disk);
    loop-carried frames are also written with a reliable ``checkpoint`` to
    the shared folder -- read back from the cached rows, so nothing is
    computed twice -- which keeps every step's plan the same size and lets a
    lost executor's work be recovered from the last step."""

    def __init__(self):
        self.live: list[DataFrame] = []

    def keep(self, df: DataFrame, checkpoint: bool) -> DataFrame:
        from pyspark import StorageLevel
        df = df.persist(StorageLevel.MEMORY_AND_DISK)
        if checkpoint:
            out = df.checkpoint(eager=True)
        else:
            df.count()
            out = df
        self.live.append(df)
        return out

    def release_older_than(self, n: int) -> None:
        while len(self.live) > n:
            self.live.pop(0).unpersist()

    def release_all(self) -> None:
        self.release_older_than(0)


def _solve_entries(i: np.ndarray, j: np.ndarray, g: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Solve the symmetric positive definite system given by its entries
    (duplicates add up, only one of (i, j) and (j, i) is given)."""
    m = len(e)
    off = i != j
    i, j, g = np.concatenate([i, j[off]]), np.concatenate([j, i[off]]), np.concatenate([g, g[off]])
    if m <= DENSE_NODES:
        a = np.zeros((m, m))
        np.add.at(a, (i, j), g)
        return np.linalg.solve(a, e)
    d = np.bincount(i[i == j], g[i == j], m)
    x, r = np.zeros(m), e.copy()
    z = r / d
    p, rz, goal = z, r @ z, 1e-12 * np.linalg.norm(e)
    for _ in range(10 * m):
        if np.linalg.norm(r) <= goal:
            return x
        ap = np.bincount(i, g * p[j], m)
        alpha = rz / (p @ ap)
        x, r = x + alpha * p, r - alpha * ap
        z = r / d
        rz, before = r @ z, rz
        p = z + rz / before * p
    raise RuntimeError(f"a system of {m} upper nodes did not converge")


def _upper_systems(node_fc: DataFrame, membership: DataFrame, sys_keys: list[str], weights: DataFrame,
                   struct: _Structure, task_entries: int) -> DataFrame | None:
    """The upper-node form; None where a system has more than ``task_entries``
    matrix entries.  A null base forecast counts as 0."""
    nodes = node_fc.select(*sys_keys, "node", F.coalesce("fcast", F.lit(0.0)).alias("y")).join(
        weights, on=[*sys_keys, "node"]).select(*sys_keys, "node", "y", (1.0 / F.col("w")).alias("iw"), "up")
    bottoms = (nodes.where(~F.col("up")).drop("up").withColumnRenamed("node", "bottom"))
    # a series lies under at most one upper node per key and the total: the list is bounded by the keys
    above = struct.up.groupBy("bottom").agg(F.sort_array(F.collect_list("node")).alias("above"))
    under = bottoms.join(above, on="bottom").select(*sys_keys, "y", "iw", F.posexplode("above").alias("_k", "node"),
                                                    "above")
    n_above = F.size("above") - F.col("_k")
    pairs = (under.select(*sys_keys, "node", "y", "iw", F.posexplode(F.slice("above", F.col("_k") + 1, n_above))
                          .alias("_at", "other"))
                  .groupBy(*sys_keys, "node", "other")
                  .agg(F.sum("iw").alias("g"), F.sum(F.when(F.col("_at") == 0, F.col("y"))).alias("e")))
    upper = nodes.where(F.col("up")).select(*sys_keys, "node", F.col("node").alias("other"), F.col("iw").alias("g"),
                                            (-F.col("y")).alias("e"))
    # entries of V^-1 + U D^-1 U' with U yb - yu on the diagonal rows
    entries = materialize(pairs.unionByName(upper).groupBy(*sys_keys, "node", "other")
                               .agg(F.sum("g").alias("g"), F.sum("e").alias("e")), "entries")
    largest = entries.groupBy(*sys_keys).count().agg(F.max("count")).first()[0] or 0
    if largest > task_entries:
        return None
    schema = entries.select(*sys_keys, "node", F.col("g").alias("mu")).schema

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        names, at = np.unique(np.concatenate([pdf["node"], pdf["other"]]).astype(object), return_inverse=True)
        i, j = at[:len(pdf)], at[len(pdf):]
        e = np.bincount(i, -pdf["e"].fillna(0.0).to_numpy(), len(names))
        out = pd.DataFrame({"node": names, "mu": _solve_entries(i, j, pdf["g"].to_numpy(), e)})
        for c in sys_keys:
            out[c] = pdf[c].iloc[0]
        return out[[*sys_keys, "node", "mu"]]

    mu = entries.groupBy(*sys_keys).applyInPandas(solve, schema)
    shift = struct._to_bottoms(mu).groupBy(*sys_keys, "bottom").agg(F.sum("mu").alias("mu"))
    return (bottoms.join(shift, on=[*sys_keys, "bottom"], how="left")
                   .select(*sys_keys, "bottom", (F.col("y") + F.col("iw") * F.coalesce("mu", F.lit(0.0))).alias("fcast")))


def combine(node_fc: DataFrame, membership: DataFrame, sys_keys: Sequence[str], weights: DataFrame,
            tol: float = 1e-8, max_iter: int = 200, x0: DataFrame | None = None,
            inputs_stored: bool = False, broadcast_bytes: int = 64 << 20,
            task_entries: int = TASK_ENTRIES) -> DataFrame:
    """Reconciled bottom forecasts ``(sys_keys..., bottom, fcast)``.

    Every node of ``membership`` has a base forecast and a positive weight.
    Systems of at most ``task_entries`` matrix entries between upper nodes are
    solved exactly, one task each (see the module text); larger ones by
    preconditioned conjugate gradient (Jacobi: the diagonal of S'WS is the
    summed weight of the nodes above each bottom series), warm-started from
    ``x0`` (the bottom base forecasts; for coherent base forecasts the start
    is already the solution).  Stops when every system's residual norm is
    below ``tol`` times the norm of its right-hand side; raises if
    ``max_iter`` steps do not get there."""
    sys_keys = list(sys_keys)
    spark = node_fc.sparkSession
    checkpoint_dir(spark)
    k = [*sys_keys, "bottom"]
    store = _Store()
    # Inputs of the loop stored once, so no step re-plans or recomputes the
    # forecasting lineage above them (skipped when the caller already derives
    # them from stored frames by cheap projections).
    if not inputs_stored:
        membership = store.keep(membership.select("bottom", "node"), True)
        weights = store.keep(weights.select(*sys_keys, "node", "w"), True)
        node_fc = store.keep(node_fc.select(*sys_keys, "node", "fcast"), True)
    n_systems = weights.select(*sys_keys).distinct().count()      # fixed by the parameters
    struct = _Structure(membership, n_systems, broadcast_bytes)
    weights = store.keep(struct.flag(weights), False)
    exact = _upper_systems(node_fc, membership, sys_keys, weights, struct, task_entries)
    if exact is not None:
        out = materialize(exact, "reconciled")
        store.release_all()
        return out
    diag = struct.St(weights.withColumnRenamed("w", "dg"), sys_keys, "dg")
    # right-hand side c = S'W yhat
    wy = node_fc.join(weights, on=[*sys_keys, "node"]).select(
        *sys_keys, "node", (F.col("fcast") * F.col("w")).alias("c"), "up")
    c = struct.St(wy, sys_keys, "c")
    start = c.join(diag, on=k)
    if x0 is not None:
        start = start.join(x0.select(*k, F.col("fcast").alias("x")), on=k, how="left")
    else:
        start = start.withColumn("x", F.lit(None).cast("double"))
    start = store.keep(start.withColumn("x", F.coalesce("x", F.lit(0.0))), False)
    ax = struct.A(start.select(*k, F.col("x").alias("v")), weights, sys_keys, "v")
    state = store.keep(start.join(ax, on=k, how="left").fillna(0.0, subset=["v"])
                            .withColumn("r", F.col("c") - F.col("v"))
                            .withColumn("z", F.col("r") / F.col("dg"))
                            .select(*k, "x", "r", "z", F.col("z").alias("p"), "dg", "c"), True)
    # Per-system scalars: one row per (setting, origin, step) -- a count fixed
    # by the parameters, not by the data -- so they are collected and fed
    # back as a small local table; this also gives the convergence test.
    scal = ["rz", "rr", "cn"]
    key_ddl = ", ".join(f"`{n}` {state.schema[n].dataType.simpleString()}" for n in sys_keys)
    sys_schema = key_ddl + ", rz double, rr double, cn double"
    rows = [tuple(r) for r in
            state.groupBy(*sys_keys)
                 .agg(F.sum(F.col("r") * F.col("z")).alias("rz"), F.sum(F.col("r") * F.col("r")).alias("rr"),
                      F.sqrt(F.sum(F.col("c") * F.col("c"))).alias("cn"))
                 .select(*sys_keys, *scal).collect()]
    nk = len(sys_keys)
    state = state.drop("c")
    worst = None
    try:
        for it in range(1, max_iter + 1):
            worst = max([(r[nk + 1] ** 0.5) / r[nk + 2] if r[nk + 2] else 0.0 for r in rows] or [0.0])
            if worst <= tol:
                SOLVE_LOG.append((it - 1, worst))
                break
            norms = F.broadcast(spark.createDataFrame(rows, sys_schema))
            ap = struct.A(state.select(*k, F.col("p").alias("ap")), weights, sys_keys, "ap")
            st = store.keep(state.join(ap, on=k, how="left").fillna(0.0, subset=["ap"]), False)
            alpha = (st.groupBy(*sys_keys).agg(F.sum(F.col("p") * F.col("ap")).alias("pap"))
                       .join(norms, on=sys_keys)
                       .select(*sys_keys, F.when(F.col("pap") != 0, F.col("rz") / F.col("pap"))
                               .otherwise(0.0).alias("alpha")))
            upd = (st.join(alpha, on=sys_keys)
                     .withColumn("x", F.col("x") + F.col("alpha") * F.col("p"))
                     .withColumn("r", F.col("r") - F.col("alpha") * F.col("ap"))
                     .withColumn("z", F.col("r") / F.col("dg")))
            new = (upd.groupBy(*sys_keys).agg(F.sum(F.col("r") * F.col("z")).alias("rz_new"),
                                              F.sum(F.col("r") * F.col("r")).alias("rr"))
                      .join(norms.select(*sys_keys, "rz", "cn"), on=sys_keys)
                      .select(*sys_keys, F.col("rz_new").alias("rz"), "rr", "cn",
                              F.when(F.col("rz") != 0, F.col("rz_new") / F.col("rz")).otherwise(0.0).alias("beta"))
                      .collect())
            betas = F.broadcast(spark.createDataFrame(
                [tuple(r[c] for c in sys_keys) + (r["beta"],) for r in new], key_ddl + ", beta double"))
            state = store.keep(upd.join(betas, on=sys_keys)
                                  .withColumn("p", F.col("z") + F.col("beta") * F.col("p"))
                                  .select(*k, "x", "r", "z", "p", "dg"), True)
            rows = [tuple(r[c] for c in [*sys_keys, *scal]) for r in new]
            store.release_older_than(8)
        else:
            raise RuntimeError(f"reconciliation did not converge in {max_iter} steps (residual {worst})")
        # ``state`` is a checkpointed frame (it reads the written files), so
        # the result does not depend on the cached frames released below
        return state.select(*k, F.col("x").alias("fcast"))
    finally:
        store.release_all()
