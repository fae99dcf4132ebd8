"""SimHash near-dedup with pivot distance tables (operator 2).

A fingerprint has 64 bits; two texts link at ``max_bits`` or fewer differing
bits.  Equal fingerprints collapse first, so copies never meet as pairs.

Routing: 64 bits in ``2 * max_bits`` bands; with at most ``max_bits`` differing
bits, at least half of the bands agree, so two linked fingerprints share the
key of at least one choice of half the bands.  Distances to fixed references
crowd around 32, so they cannot deal out rows by themselves; inside a group of
one key they do the work the method names: a table of Hamming distances to
``PIVOTS`` references is computed once per group, pairs are discarded when any
coordinate differs by more than ``max_bits`` (the triangle inequality), and
the survivors' bits are counted.

Groups above ``TILE`` fingerprints are cut by their first coordinate and a hash
into tiles that meet pairwise, except those whose coordinates are too far
apart; no task holds more than two tiles.  Only the links that join two trees
of a tile leave the task: as many as rows, whatever the number of pairs.

Defined results: null, empty and blank texts have fingerprint zero and link
like any other; a null id is never a component's id unless all ids of it are
null; repeated rows are returned as often as given; an empty table gives none.
"""

from __future__ import annotations

from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loam.llm.common import Forest, components, in_groups, stored, utf8

TILE = 2048
PIVOTS = 16
_LANES = np.uint64(0x0101010101010101)


def shingle_hashes(words: list[bytes], k: int, seed: int) -> list[int]:
    """XXH64 of each k-word shingle (fewer words: of the whole sequence)."""
    h = partial(xxhash.xxh64_intdigest, seed=seed)
    if not words:
        return []
    if len(words) <= k:
        return [h(b" ".join(words))]
    return [h(b" ".join(t)) for t in zip(*(words[i:] for i in range(k)))]


def bit_counts(h: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """How often each of 64 bits is set in each segment of ``h``.

    Eight counters share one word: blocks of up to 255 hashes cannot overflow."""
    ends = np.append(starts[1:], len(h))
    blocks = np.concatenate([np.arange(a, b, 255) for a, b in zip(starts, ends)])
    of = np.searchsorted(starts, blocks, "right") - 1
    first = np.searchsorted(of, np.arange(len(starts)))
    out = np.empty((len(starts), 8, 8), np.int64)
    for bit in range(8):
        lanes = np.add.reduceat((h >> np.uint64(bit)) & _LANES, blocks)
        out[:, :, bit] = np.add.reduceat(lanes.view(np.uint8).reshape(-1, 8).astype(np.int64), first, axis=0)
    return out.reshape(len(starts), 64)


def _fingerprints(ids_texts, k: int, seed: int, chunk: int = 200_000):
    """Fingerprints of a list of texts; hashes are counted in chunks, so a very
    long text needs no more memory than its words."""
    total = np.zeros((len(ids_texts), 64), np.int64)
    n = np.zeros(len(ids_texts), np.int64)
    buf: list[int] = []
    starts: list[int] = []
    docs: list[int] = []

    def count():
        if buf:
            np.add.at(total, docs, bit_counts(np.array(buf, np.uint64), np.array(starts)))
            buf.clear(), starts.clear(), docs.clear()

    for i, text in enumerate(ids_texts):
        h = shingle_hashes(utf8(text).lower().split(), k, seed)
        n[i] = len(h)
        for a in range(0, len(h), chunk):
            part = h[a:a + chunk]
            starts.append(len(buf)), docs.append(i), buf.extend(part)
            if len(buf) >= chunk:
                count()
    count()
    bits = (2 * total > n[:, None]).astype(np.uint8)
    return np.packbits(bits, axis=1, bitorder="little").view("<u8").reshape(-1).astype(np.int64, casting="unsafe")


def fingerprints(df: DataFrame, text: str = "text", shingle_words: int = 3, seed: int = 42,
                 keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and ``fp`` (the fingerprint's bits as a long)."""
    src = df.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], F.col(text).cast("string").alias("t"))

    def run(batches):
        for b in batches:
            for a in range(0, b.num_rows, 512):
                part = b.slice(a, 512)
                fp = _fingerprints(part.column(part.num_columns - 1).to_pylist(), shingle_words, seed)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(fp, pa.int64())],
                                                 names=[*part.schema.names[:-1], "fp"])

    schema = T.StructType([*src.schema.fields[:-1], T.StructField("fp", T.LongType())])
    out = src.mapInArrow(run, schema)
    return out.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], F.col("fp"))


def pivots(n: int = PIVOTS, seed: int = 7) -> np.ndarray:
    """Reference fingerprints: the rows of a seeded hash."""
    return np.array([xxhash.xxh64_intdigest(i.to_bytes(8, "little"), seed) for i in range(n)], np.uint64)


def linked(x: np.ndarray, y: np.ndarray, refs: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (i in x, j in y) at up to ``max_bits`` bits, in blocks of x."""
    dx = np.bitwise_count(x[:, None] ^ refs).astype(np.int8)
    dy = np.bitwise_count(y[:, None] ^ refs).astype(np.int8)
    order = np.argsort(dy[:, 0], kind="stable")
    first = dy[order, 0]
    rows, cols = [], []
    lo = np.searchsorted(first, dx[:, 0] - max_bits, "left")
    hi = np.searchsorted(first, dx[:, 0] + max_bits, "right")
    for i in range(len(x)):
        j = order[lo[i]:hi[i]]
        for p in range(1, len(refs)):
            if len(j) < 16:
                break
            j = j[np.abs(dy[j, p] - dx[i, p]) <= max_bits]
        j = j[np.bitwise_count(y[j] ^ x[i]) <= max_bits]
        rows.append(np.full(len(j), i)), cols.append(j)
    return np.concatenate(rows or [np.empty(0, int)]), np.concatenate(cols or [np.empty(0, int)])


def links(fps: DataFrame, max_bits: int = 2, fp: str = "fp") -> DataFrame:
    """Spanning links (a, b) between distinct fingerprints at up to
    ``max_bits`` bits; every linked pair is connected through them."""
    bands = 2 * max_bits
    width = 64 // bands
    picks = list(combinations(range(bands), max_bits)) if max_bits else [()]
    masks = []
    for p in picks:
        m = 0
        for i in range(bands):
            if i in p:
                top = 64 if i == bands - 1 else (i + 1) * width
                m |= ((1 << top) - 1) ^ ((1 << (i * width)) - 1)
        masks.append(m - (1 << 64) if m >= 1 << 63 else m)
    refs = pivots()
    r0 = int(refs[0].astype(np.int64))
    keys = fps.select(F.col(fp).alias("x"), F.posexplode(F.array(*[F.col(fp).bitwiseAND(F.lit(m)) for m in masks]))
                      .alias("pick", "part"))
    sizes = (keys.groupBy("pick", "part").agg(F.count("*").alias("n")).where("n > 1")
                 .withColumn("whole", F.col("n") <= TILE)
                 .withColumn("cuts", F.ceil(F.col("n") / (4 * TILE)).cast("int")))
    rows = keys.join(sizes, ["pick", "part"])
    # large groups: tiles by (first coordinate, hash), dealt to the tiles they can link with
    d0 = F.bit_count(F.col("x").bitwiseXOR(F.lit(r0)))
    tile = (d0 * F.col("cuts") + F.pmod(F.xxhash64("x"), F.col("cuts"))).cast("int")
    small = rows.where("whole").select("pick", "part", F.lit(0).alias("ta"), F.lit(0).alias("tb"),
                                          F.lit(0).alias("side"), "x")
    big = rows.where("not whole").withColumn("t", tile).withColumn("d0", d0)
    near = F.transform(F.sequence(F.greatest(F.lit(0), F.col("d0") - max_bits) * F.col("cuts"),
                                  (F.col("d0") + max_bits + 1) * F.col("cuts") - 1), lambda o: o.cast("int"))
    big = big.select("pick", "part", "x", "t", F.explode(near).alias("o")).select(
        "pick", "part", F.least("t", "o").alias("ta"), F.greatest("t", "o").alias("tb"),
        (F.col("t") > F.col("o")).cast("int").alias("side"), "x")

    def compare(g):
        x = g["x"].view(np.uint64)
        if g["ta"][0] == g["tb"][0]:
            i, j = linked(x, x, refs, max_bits)
            a, b, nodes = i[i < j], j[i < j], x
        else:
            p, q = x[g["side"] == 0], x[g["side"] == 1]
            a, b = linked(p, q, refs, max_bits)
            b, nodes = b + len(p), np.concatenate([p, q])
        f = Forest(len(nodes))
        for s, t in zip(a.tolist(), b.tolist()):
            f.join(s, t)
        if f.edges:
            e = np.array(f.edges)
            yield {"a": nodes[e[:, 0]].view(np.int64), "b": nodes[e[:, 1]].view(np.int64)}

    return in_groups(small.unionByName(big), ["pick", "part", "ta", "tb"], "a long, b long", compare)


def simhash_groups(df: DataFrame, id_col: str = "doc_id", text: str = "text", shingle_words: int = 3,
                   max_bits: int = 2) -> DataFrame:
    """One row per input row: (``id_col``, fp, component_id)."""
    fp = stored(fingerprints(df, text, shingle_words, keep=(id_col,)), "fingerprints")
    return fp.join(component_ids(fp, id_col, max_bits), "fp").select(id_col, "fp", "component_id")


def component_ids(fp: DataFrame, id_col: str, max_bits: int) -> DataFrame:
    """(fp, root, component_id) of each distinct fingerprint."""
    reps = stored(fp.groupBy("fp").agg(F.min(id_col).alias("rep")), "reps")
    roots = components(links(reps, max_bits))
    named = reps.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "rep", F.coalesce("root", "fp").alias("root"))
    return stored(named.join(named.groupBy("root").agg(F.min("rep").alias("component_id")), "root")
                  .select("fp", "root", "component_id"), "components")


def hex16(c: Column) -> Column:
    return F.lpad(F.lower(F.hex(c)), 16, "0")


def keep_one(df: DataFrame, id_col: str = "doc_id", text: str = "text", shingle_words: int = 3,
             max_bits: int = 2) -> DataFrame:
    """``df`` without near copies: of each component the row with the smallest
    id stays (nulls last; equal ids: the smaller fingerprint; equal in both:
    any one of them).

    The documents are written once with their fingerprints; the winners, one
    small row a component, find them there by (fingerprint, id)."""
    names = [f"c{i}" for i in range(len(df.columns))]
    src = df.select(*[F.col(c).alias(n) for c, n in zip(df.columns, names)])
    key = names[df.columns.index(id_col)]
    full = stored(fingerprints(src, names[df.columns.index(text)], shingle_words, keep=tuple(names)), "documents")
    fp = full.select("fp", key)
    comp = component_ids(fp, key, max_bits)
    order = F.struct(F.col(key).isNull(), F.col(key), F.col("fp"))
    # the id as two plain columns: join and the last step then share one exchange of the texts, spread by id
    ids = {"k": F.coalesce(F.col(key).cast("string"), F.lit("")), "absent": F.col(key).isNull()}
    best = (fp.join(comp, "fp").groupBy("root").agg(F.min(order).alias("w"))
              .select("w.fp", F.col(f"w.{key}").alias(key)).withColumns(ids).select("fp", "k", "absent"))
    won = full.withColumns(ids).join(best, ["fp", "k", "absent"])
    return (won.dropDuplicates(["fp", "k", "absent"])
               .select(*[F.col(n).alias(c) for c, n in zip(df.columns, names)]))
