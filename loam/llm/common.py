"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loam.session import scratch_path

#: ASCII white space of the contracts: space, tab, \n, \v, \f, \r.
BLANKS = " \t\n\x0b\f\r"
BLANK_RUN = "[ \\t\\n\\x0B\\f\\r]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: later jobs start
    from the files, whatever executors are lost in between."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def lower_ascii(c: Column) -> Column:
    """A-Z to a-z, every other character as it is."""
    return F.translate(c, UPPER, UPPER.lower())


def word_array(c: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+``; null and blank texts have none."""
    t = F.btrim(F.coalesce(c, F.lit("")), F.lit(BLANKS))
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, BLANK_RUN, -1))


def utf8(value) -> bytes:
    return b"" if value is None else value.encode("utf-8", "surrogatepass")


def in_groups(df: DataFrame, keys: Sequence[str], schema: str,
              fn: Callable[[dict[str, np.ndarray]], Iterator[dict]]) -> DataFrame:
    """Call ``fn`` with the columns of each group (equal ``keys``, none null).

    One exchange and one sort bring groups together; each task then walks its
    sorted rows, so a million small groups cost no call per group into pandas.
    A task holds one group and one batch at a time: callers bound their groups.
    ``fn`` yields dicts of equally long columns.
    """
    from pyspark.sql.types import StructType
    parsed = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    names = [f.name for f in parsed.fields]
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(parsed)

    def walk(batches):
        out: dict[str, list] = {n: [] for n in names}
        rows = 0

        def flush():
            return pa.RecordBatch.from_arrays(
                [pa.concat_arrays([pa.array(x, type=arrow.field(n).type) for x in out[n]]) for n in names], schema=arrow)

        def take(cols):
            nonlocal rows
            for got in fn(cols):
                n = len(got[names[0]])
                if n:
                    rows += n
                    for k in names:
                        out[k].append(got[k])

        rest = None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            if rest is not None:
                t = pa.concat_tables([rest, t])
            if not t.num_rows:
                continue
            cols = {n: _numpy(t.column(n)) for n in t.column_names}
            change = np.zeros(t.num_rows, bool)
            for k in keys:
                v = cols[k]
                change[1:] |= v[1:] != v[:-1]
            starts = np.concatenate([[0], np.flatnonzero(change)])
            for a, b in zip(starts[:-1], starts[1:]):
                take({n: v[a:b] for n, v in cols.items()})
            rest = t.slice(int(starts[-1]))
            if rows >= 20_000:
                yield flush()
                out, rows = {n: [] for n in names}, 0
        if rest is not None:
            take({n: _numpy(rest.column(n)) for n in rest.column_names})
        if rows:
            yield flush()

    return (df.repartition(*[F.col(k) for k in keys])
              .sortWithinPartitions(*keys).mapInArrow(walk, schema))


def _numpy(column) -> np.ndarray:
    c = column.combine_chunks()
    c = c.chunk(0) if isinstance(c, pa.ChunkedArray) else c
    if pa.types.is_list(c.type):
        out = np.empty(len(c), object)
        out[:] = c.to_pylist()
        return out
    return c.to_numpy(zero_copy_only=False)


class Forest:
    """Union-find over 0..n-1; ``edges`` lists the unions that joined two trees."""

    def __init__(self, n: int):
        self.up = list(range(n))
        self.edges: list[tuple[int, int]] = []

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def join(self, a: int, b: int) -> None:
        ra, rb = self.root(a), self.root(b)
        if ra != rb:
            self.up[max(ra, rb)] = min(ra, rb)
            self.edges.append((a, b))


def components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """Connected components of an edge table of longs: rows (node, root), root
    the smallest node reachable; nodes without an edge have no row.

    Alternating large-star and small-star steps: every step is a minimum per
    node and an equi-join, no neighbour list is ever gathered, and the edges of
    each round are written to the shared folder.  Ends when a round changes
    nothing.
    """
    both = edges.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")).where("u <> v")
    e = stored(both.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    seen = None
    for _ in range(rounds):
        mark = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark[0] == 0 or mark == seen:
            break
        seen = mark
        # large star: each neighbour above u links to the least node around u
        sym = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = sym.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = (sym.where("v > u").join(least, "u")
                    .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        # small star: the lower neighbours of u and u itself link to the least of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        small = (small.select(F.col("v").alias("u"), F.col("m").alias("v"))
                      .unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        e = stored(small, "edges")
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    # settled: every edge leads to a root
    return (e.select(F.col("u").alias("node"), F.col("v").alias("root"))
             .unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct())
