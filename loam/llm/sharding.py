"""Sharding by minimax contiguous partition (operator 10, DataFrame functions only).

Equal texts form a group that is never parted.  Groups are ordered by a 64-bit
hash of their text; the atomic sizes are those of ``BUCKETS`` equal hash ranges
(on small tables a bucket holds one group, on any table its share of a shard
is about ``n_shards / BUCKETS``).  The smallest shard capacity for which a
greedy walk over the ordered sizes needs at most ``n_shards`` shards is found
by binary search.  Where one size alone sets that capacity it becomes a shard,
and the search is run again on the sizes before and after it with the shards
that remain; elsewhere cuts lie as near to equal parts as the capacity allows.
What reaches the driver are ``BUCKETS`` sums, whatever the input.

Law: ``bytes`` (sizes near equal): the largest shard is as small as any
contiguous cut of the ordered hash ranges allows, and no shard is empty while
there are ranges with rows for all.

Rows get gapless slots without a window over a shard: a bucket's first slot
comes from the sums, rows inside are numbered in ``SALTS`` parts each, so a
group of a third of all rows is numbered in pieces.

Defined results: a null text weighs nothing and groups with the empty text;
null ids, repeated rows and any extra columns are fine, each row gets a slot;
an empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from itertools import accumulate
from math import inf

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loam.llm.common import stored

BUCKETS = 1 << 14
SALTS = 256
OVERHEAD = 16


def cut(sizes: list[int], n_shards: int) -> tuple[int, list[int]]:
    """(capacity, first index of shards 1..n_shards-1) for ordered ``sizes``."""
    upto = [0, *accumulate(sizes)]
    filled = [0, *accumulate(int(x > 0) for x in sizes)]

    def needed(a: int, z: int, capacity: int, most: int) -> int:
        """Shards of a greedy walk over sizes[a:z], at most ``most`` + 1."""
        n = 0
        while a < z and n <= most:
            a = min(z, bisect_right(upto, upto[a] + capacity) - 1)
            n += 1
        return n

    def least(a: int, z: int, n: int) -> float:
        """The smallest capacity for sizes[a:z] in n shards."""
        total = upto[z] - upto[a]
        if not n or not total:
            return inf if total else 0
        low, high = max(*sizes[a:z], -(-total // n)), total
        while low < high:
            mid = (low + high) // 2
            if needed(a, z, mid, n) <= n:
                high = mid
            else:
                low = mid + 1
        return low

    def even(a: int, z: int, n: int, capacity: int) -> list[int]:
        """n - 1 borders near equal parts, none above ``capacity``, none empty if the sizes allow."""
        borders = []
        for left in range(n - 1, 0, -1):  # shards after this one
            low, high = a, min(z, bisect_right(upto, upto[a] + capacity) - 1)
            first = bisect_left(filled, filled[a] + 1, a, high) if filled[z] > filled[a] else a
            last = max(first, min(high, bisect_right(filled, max(filled[z] - left, filled[a]), a, z + 1) - 1))
            while low < high:  # the least place after which ``left`` shards are enough
                mid = (low + high) // 2
                if needed(mid, z, capacity, left) <= left:
                    high = mid
                else:
                    low = mid + 1
            goal = upto[a] + (upto[z] - upto[a]) / (left + 1)
            at = bisect_left(upto, goal, a, z)
            if at > a and goal - upto[at - 1] < upto[at] - goal:
                at -= 1
            a = min(max(at, low, first), max(low, last))
            borders.append(a)
        return borders

    def split(a: int, z: int, n: int) -> list[int]:
        if n < 2:
            return []
        if upto[z] == upto[a]:
            return [z] * (n - 1)
        capacity = least(a, z, n)
        hot = max(range(a, z), key=sizes.__getitem__)
        if sizes[hot] < capacity:
            return even(a, z, n, capacity)
        # one size alone sets the capacity: it has a shard of its own, the others share the rest
        # shards before it, no more than sizes there or after it
        most = filled[hot] - filled[a]
        start = low = min(most, max(0, n - 1 - (filled[z] - filled[hot + 1])))
        high = max(low, min(n - 1, most))
        while low < high:
            mid = (low + high) // 2
            if least(a, hot, mid) <= least(hot + 1, z, n - 1 - mid):
                high = mid
            else:
                low = mid + 1
        k = min((low, max(low - 1, start)), key=lambda k: max(least(a, hot, k), least(hot + 1, z, n - 1 - k)))
        after = n - 1 - k
        return (split(a, hot, k) + [hot] * (k > 0) + [hot + 1] * (after > 0) + split(hot + 1, z, after))

    if not upto[-1]:
        return 0, [len(sizes)] * (n_shards - 1)
    return least(0, len(sizes), n_shards), split(0, len(sizes), n_shards)


def bucket_of(text: Column) -> Column:
    """0..BUCKETS-1 in the order of the text's hash; equal texts share one."""
    bits = BUCKETS.bit_length() - 1
    return F.shiftrightunsigned(F.xxhash64(F.coalesce(text, F.lit(""))), 64 - bits).cast("int")


def place(df: DataFrame, text: str = "text", n_shards: int = 40, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Per row: the columns ``carry``, size, text_crc32, shard, slot."""
    t = F.col(text).cast("string")
    keys = [f"c{i}" for i in range(len(carry))]
    rows = stored(df.select(
        *[F.col(c).alias(k) for c, k in zip(carry, keys)],
        (F.coalesce(F.octet_length(t), F.lit(0)) + OVERHEAD).cast("long").alias("size"),
        F.crc32(F.coalesce(t, F.lit("")).cast("binary")).alias("text_crc32"),
        bucket_of(t).alias("b"),
        F.pmod(F.xxhash64(*[F.col(c) for c in carry], F.monotonically_increasing_id()), F.lit(SALTS)).cast("int").alias("s")),
        "sizes")
    parts = stored(rows.groupBy("b", "s").agg(F.count("*").alias("n"), F.sum("size").alias("bytes")), "parts")
    sums = {r.b: (r.bytes, r.n) for r in parts.groupBy("b").agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n"))
            .collect()}  # at most BUCKETS rows
    _, borders = cut([sums.get(b, (0, 0))[0] for b in range(BUCKETS)], n_shards)
    shard = F.lit(0)
    for at in borders:
        shard = shard + (F.col("b") >= at).cast("int")
    # the first slot of each (bucket, salt) part: buckets before it in its shard, then salts before it in its bucket
    before = Window.partitionBy("shard").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    first = (parts.groupBy("b").agg(F.sum("n").alias("n")).withColumn("shard", shard)
                  .select("b", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")))
    w = Window.partitionBy("b").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (parts.withColumn("skip", F.coalesce(F.sum("n").over(w), F.lit(0)))
                    .join(first, "b").select("b", "s", (F.col("first") + F.col("skip")).alias("at")))
    inside = Window.partitionBy("b", "s").orderBy(*keys)
    return (rows.join(offsets, ["b", "s"])
                .withColumn("slot", F.col("at") + F.row_number().over(inside) - 1)
                .select(*[F.col(k).alias(c) for c, k in zip(carry, keys)], "size", "text_crc32",
                        shard.cast("int").alias("shard"), F.col("slot").cast("long").alias("slot")))


def write_shards(df: DataFrame, path: str, text: str = "text", n_shards: int = 40) -> None:
    """Write the rows of ``df`` into ``path/__shard=K/``; a shard may have
    several files, since no task gathers one."""
    t = F.col(text).cast("string")
    size = (F.coalesce(F.octet_length(t), F.lit(0)) + OVERHEAD).cast("long")
    sums = {r.b: r.n for r in df.groupBy(bucket_of(t).alias("b")).agg(F.sum(size).alias("n")).collect()}
    _, borders = cut([sums.get(b, 0) for b in range(BUCKETS)], n_shards)
    shard = F.lit(0)
    for at in borders:
        shard = shard + (bucket_of(t) >= at).cast("int")
    df.withColumn("__shard", shard).write.partitionBy("__shard").parquet(path)
