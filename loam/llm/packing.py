"""Best-fit packing with certified bin counts (operator 5).

Token ids of a document are cut into pieces of ``CAPACITY`` only if there are
more; full pieces are sequences by themselves.  The other pieces are dealt into
partitions of about ``ITEMS`` and packed by best-fit decreasing.  For each
partition dual feasible functions give a lower bound on its sequences; where
the bound is met the packing is certified.  Partitions with a gap release the
pieces of all sequences with free room, certified ones those of their emptiest
sequence; the released pieces are dealt anew into fewer partitions and packed
again, and the result is taken if it needs fewer sequences.  This ends when one
partition holds all released pieces, or nothing is gained.

Token ids: white-space chunks of a text are encoded by themselves, which the
tokenizer's pattern allows since no token spans white space, and each worker
remembers the ids of chunks it has met, up to ``REMEMBER``.

Defined results: null and empty texts are the end id alone; repeated rows are
packed each; an empty table gives none.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loam.llm.common import in_groups, stored, utf8
from loam.llm.tokens import tokenizer

CAPACITY = 4096
ITEMS = 50_000
REMEMBER = 1_000_000
_KNOWN: dict[str, dict[bytes, bytes]] = {}
_CLOSES: dict[str, np.ndarray] = {}


def _ends(path: str) -> np.ndarray:
    """Which ids close a piece of the tokenizer's splitting."""
    if path not in _CLOSES:
        t = tokenizer(path)
        _CLOSES[path] = np.array([(t.id_to_token(i) or "").endswith("</w>") for i in range(t.get_vocab_size())])
    return _CLOSES[path]


def _learn(chunks: list[bytes], path: str, known: dict[bytes, bytes]) -> None:
    """Remember the ids of chunks without white space.

    Chunks of letters are one piece each, so many go to the tokenizer as one
    text, whose ids part behind each closing id; where the number of closing
    ids is not that of the chunks, they go one by one.  A full stop or comma
    behind letters is a piece of its own."""
    t, le = tokenizer(path), np.dtype("<u4")
    letters, pointed, other = set(), [], []
    for w in chunks:
        head = w[:-1]
        if w.isalpha() or w.decode("utf-8", "surrogatepass").isalpha():
            letters.add(w)
        elif w[-1:] in (b".", b",") and len(w) > 1 and (head.isalpha() or head.decode("utf-8", "replace").isalpha()):
            pointed.append(w)
            letters.add(head)
        else:
            other.append(w)
    other += [p for p in (b".", b",") if p not in known]
    words = [w for w in letters if w not in known]
    groups = [words[a:a + 256] for a in range(0, len(words), 256)]
    for a in range(0, len(groups), 64):
        part = groups[a:a + 64]
        for g, e in zip(part, t.encode_batch_fast([b" ".join(g).decode("utf-8", "surrogatepass") for g in part],
                                                  add_special_tokens=False)):
            ids = np.array(e.ids, le)
            stops = np.flatnonzero(_ends(path)[ids]) + 1
            if len(stops) == len(g) and stops[-1] == len(ids):
                raw, at = ids.tobytes(), 0
                for w, z in zip(g, (4 * stops).tolist()):
                    known[w] = raw[at:z]
                    at = z
            else:
                other.extend(g)
    for a in range(0, len(other), 4096):
        part = other[a:a + 4096]
        for w, e in zip(part, t.encode_batch_fast([w.decode("utf-8", "surrogatepass") for w in part], add_special_tokens=False)):
            known[w] = np.array(e.ids, le).tobytes()
    for w in pointed:
        known[w] = known[w[:-1]] + known[w[-1:]]


def encode(texts: list[str | None], path: str, end: int) -> list[bytes]:
    """Ids of each text and ``end``, as little-endian unsigned 32-bit numbers."""
    t = tokenizer(path)
    known = _KNOWN.setdefault(path, {})
    if len(known) > REMEMBER:
        known.clear()
    stop = int(end).to_bytes(4, "little")
    out: list = []
    new: set[bytes] = set()
    gaps = []
    for text in texts:
        raw = utf8(text)
        if b"<|" in raw:  # may hold a special string, whose letters' case counts
            out.append(np.array(t.encode(text, add_special_tokens=False).ids, "<u4").tobytes() + stop)
            continue
        words = raw.lower().split()
        ids = list(map(known.get, words))
        if None in ids:
            lack = [(i, words[i]) for i, x in enumerate(ids) if x is None]
            new.update([w for _, w in lack])
            gaps.append((len(out), lack, ids))
            out.append(None)
        else:
            out.append(b"".join(ids) + stop)
    _learn(list(new), path, known)
    for at, lack, ids in gaps:
        for i, w in lack:
            ids[i] = known[w]
        out[at] = b"".join(ids) + stop
    return out


def pieces(df: DataFrame, path: str, text: str = "text", end: int = 1, carry: tuple[str, ...] = ("doc_id",),
           capacity: int = CAPACITY) -> DataFrame:
    """The columns ``carry``, piece, start, length, ids_crc32 of every piece."""
    names = [f"c{i}" for i in range(len(carry))]
    src = df.select(*[F.col(c).alias(n) for c, n in zip(carry, names)], F.col(text).cast("string").alias("t"))

    def run(batches):
        for b in batches:
            for a in range(0, b.num_rows, 512):
                part = b.slice(a, 512)
                of, piece, start, length, crc = [], [], [], [], []
                for i, ids in enumerate(encode(part.column("t").to_pylist(), path, end)):
                    for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                        x = ids[at:at + 4 * capacity]
                        of.append(i), piece.append(k), start.append(at // 4), length.append(len(x) // 4)
                        crc.append(zlib.crc32(x))
                rows = pa.array(of, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(n).take(rows) for n in names), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                     pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                    names=[*names, "piece", "start", "length", "ids_crc32"])

    schema = T.StructType([*src.schema.fields[:-1], T.StructField("piece", T.IntegerType()),
                           T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
                           T.StructField("ids_crc32", T.LongType())])
    return src.mapInArrow(run, schema)


def best_fit(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit decreasing: (bin, offset) of each length, and the fills.

    Open bins stand by their free room; a bit set of the rooms in use gives the
    tightest one that fits."""
    order = np.argsort(-lengths, kind="stable")
    rooms: list[list[int]] = [[] for _ in range(capacity + 1)]
    used, fills = 0, []
    where, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for i, n in zip(order.tolist(), lengths[order].tolist()):
        fit = used >> n
        if fit:
            room = n + ((fit & -fit).bit_length() - 1)
            b = rooms[room].pop()
            if not rooms[room]:
                used &= ~(1 << room)
        else:
            b, room = len(fills), capacity
            fills.append(0)
        where[i], offset[i] = b, fills[b]
        fills[b] += n
        left = room - n
        if left:
            rooms[left].append(b)
            used |= 1 << left
    return where, offset, np.array(fills, np.int64)


def lower_bound(lengths: np.ndarray, capacity: int = CAPACITY) -> int:
    """Bins that any packing needs, by two families of dual feasible functions."""
    if not len(lengths):
        return 0
    count = np.bincount(lengths, minlength=capacity + 1)[:capacity + 1].astype(np.int64)
    size = np.arange(capacity + 1)
    n_upto, s_upto = np.cumsum(count), np.cumsum(count * size)
    # sizes above capacity - a count whole, those under a not at all
    a = np.arange(1, capacity // 2 + 1)
    whole = n_upto[-1] - n_upto[capacity - a]
    mid = s_upto[capacity - a] - s_upto[a - 1]
    best = max(int(-(-s_upto[-1] // capacity)), int(np.max(whole + -(-mid // capacity))))
    # rounding to multiples of 1/k, sizes on the grid of 1/(k+1) as they are
    for k in range(1, 101):
        scaled = (k + 1) * size
        value = np.where(scaled % capacity == 0, size * k, (scaled // capacity) * capacity)
        best = max(best, int(-(-int((value * count).sum()) // (k * capacity))))
    return best


def pack(items: DataFrame, per_partition: int = ITEMS, capacity: int = CAPACITY, rounds: int = 6) -> DataFrame:
    """(uid, sequence_id, offset) of items (uid, length), each shorter than
    ``capacity``; uids are unique."""

    def fill(g):
        b, offset, fills = best_fit(g["length"], capacity)
        bound = lower_bound(g["length"], capacity)
        loose = fills[b] < capacity if len(fills) > bound else b == int(np.argmin(fills))
        part = int(g["part"][0])
        yield {"uid": g["uid"], "length": g["length"], "bin": (part << 24) + b, "offset": offset, "loose": loose}

    schema = "uid long, length long, bin long, offset long, loose boolean"
    kept, rest, n, old = [], items.select("uid", "length"), items.count(), None
    for turn in range(rounds):
        parts = max(1, -(-n // per_partition))
        dealt = rest.withColumn("part", F.pmod(F.xxhash64(F.lit(turn), "uid"), F.lit(parts)))
        out = stored(in_groups(dealt, ["part"], schema, fill), "packed").withColumn("turn", F.lit(turn))
        if old is not None:
            if out.select("bin").distinct().count() >= old[1]:
                kept.append(old[0])
                break
        if parts == 1 or turn == rounds - 1:
            kept.append(out)
            break
        loose = out.where("loose")
        n, bins = loose.count(), loose.select("bin").distinct().count()
        kept.append(out.where("not loose"))
        if n == 0:
            break
        old, rest = (loose, bins), loose.select("uid", "length")
    done = kept[0]
    for k in kept[1:]:
        done = done.unionByName(k)
    return done.select("uid", (F.shiftleft(F.col("turn").cast("long"), 56) + F.col("bin")).alias("sequence_id"), "offset")


def pack_documents(df: DataFrame, path: str, text: str = "text", end: int = 1, carry: tuple[str, ...] = ("doc_id",),
                   capacity: int = CAPACITY, per_partition: int = ITEMS) -> DataFrame:
    """One row per piece: the columns ``carry``, piece, start, length,
    ids_crc32, sequence_id, offset."""
    names = [f"c{i}" for i in range(len(carry))]
    p = stored(pieces(df, path, text, end, carry, capacity).withColumn("uid", F.monotonically_increasing_id()), "pieces")
    placed = pack(p.where(F.col("length") < capacity).select("uid", "length"), per_partition, capacity)
    out = (p.where(F.col("length") < capacity).join(placed, "uid")
            .unionByName(p.where(F.col("length") == capacity)
                          .withColumns({"sequence_id": -1 - F.col("uid"), "offset": F.lit(0).cast("long")})))
    return out.select(*[F.col(n).alias(c) for n, c in zip(names, carry)], "piece", "start", "length", "ids_crc32",
                      "sequence_id", "offset")
