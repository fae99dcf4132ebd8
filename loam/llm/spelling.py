"""Spelling variants grouped by asymmetric q-chunks (operator 12).

Two words are near when they differ by exactly one inserted, deleted or replaced
character (code point).  The smaller word of a pair (by length, then text) gives
two disjoint chunks: its first and its last ``length // 2`` characters.  The
larger one gives its positional grams of that length.  One edit touches at most
one of the chunks, and moves the other by at most one place, so an equi-join on
(length of the smaller word, chunk's place, gram), with one gram row for every
position within shift one of that place, meets every near pair; Levenshtein
distance 1 verifies it.  Words are read in both parts.

A chunk shared by many words would pair them all.  Keys with more than
``HOT_PAIRS`` candidates are counted out beforehand and their words meet on
deletion keys instead: (place, word less that character) for a replacement, and
the whole smaller word against the larger one less a character.  Words with an
equal deletion key are near, so these groups make no pair that is not a result
and are as large as the alphabet allows.

``variants`` then gives each word its form (the near word of largest count, ties
to the smallest in code-point order, if that is at least ``RATIO`` times its
own) and its root: forms are followed by doubling steps; counts grow
``RATIO``-fold along them, so there are few steps.

Defined results: null and blank texts have no words; a null id reads as an empty
one; repeated rows count again; words are told apart by code points, unnormalised;
an empty table gives no rows; columns beside the two named are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loam.llm.common import stored

MIN_LENGTH, MIN_COUNT = 6, 5
RATIO = 5
HOT_PAIRS = 4096
EVERY = 199
SLICE_BYTES = 8 << 20
FLUSH_WORDS = 400_000

#: ASCII letters, lowered; 0 for all others.  U+00C0 to U+00FF is the byte C3 and one more.
_LETTER = np.zeros(256, np.uint8)
for _b in range(26):
    _LETTER[65 + _b] = _LETTER[97 + _b] = 97 + _b
_LETTER[0xC3] = 0xC3


def runs(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """Maximal runs of ``[A-Za-z\\u00C0-\\u00FF]`` with A-Z lowered, dictionary
    coded, and the number of the text that each stands in."""
    texts = texts.cast(pa.string()).fill_null("")
    ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1]
    raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0]:ends[-1]]
    cuts = (ends - ends[0]).astype(np.int64)
    low = _LETTER[raw]
    after = np.flatnonzero(raw[:-1] == 0xC3) + 1
    low[after] = raw[after]
    mask = low != 0
    begins = mask.copy()
    begins[1:] &= ~mask[:-1]
    at = cuts[:-1][cuts[:-1] < len(raw)]
    begins[at] = mask[at]
    first = np.flatnonzero(begins)
    data = low[mask]
    offsets = np.append(np.flatnonzero(begins[mask]), len(data)).astype(np.int32)
    col = pa.Array.from_buffers(pa.string(), len(first), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes())])
    return col.dictionary_encode(), np.searchsorted(cuts, first, "right") - 1


class Crc:
    """crc32 of a joined text from the crc32 of its two parts."""

    def __init__(self):
        self.tables: dict[int, np.ndarray] = {}

    def table(self, size: int) -> np.ndarray:
        """What ``size`` zero bytes make of each byte of a crc (they act on it
        bit by bit, so crcs of single bits give all)."""
        if size not in self.tables:
            none = zlib.crc32(b"\0" * size)
            # crc32(data, start) is linear in start: the constant part is that of start 0
            bits = np.array([zlib.crc32(b"\0" * size, 1 << i) ^ none for i in range(32)], np.uint32)
            t = np.zeros((4, 256), np.uint32)
            for k in range(4):
                for i in range(8):
                    t[k] ^= np.where(np.arange(256) >> i & 1, bits[8 * k + i], 0).astype(np.uint32)
            self.tables[size] = t
        return self.tables[size]

    def joined(self, head: np.ndarray, tail: np.ndarray, size: np.ndarray) -> np.ndarray:
        """crc32 of head + tail, elementwise; size: bytes of the tail."""
        out = tail.copy()
        for n in np.unique(size):
            m = size == n
            t, h = self.table(int(n)), head[m]
            out[m] ^= t[0][h & 255] ^ t[1][h >> 8 & 255] ^ t[2][h >> 16 & 255] ^ t[3][h >> 24]
        return out


def misspelt_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", every: int = EVERY) -> DataFrame:
    """Rows (word, n) over whole texts.  A run whose crc32 of ``<id>:<run>`` is a
    multiple of ``every`` loses the character at that number modulo its length,
    wherever it stands in that document."""
    def walk(batches):
        crc, counts = Crc(), {}

        def flush():
            batch = pa.RecordBatch.from_arrays([pa.array(list(counts), type=pa.string()),
                                                pa.array(list(counts.values()), type=pa.int64())], names=["word", "n"])
            counts.clear()
            return batch

        def add(ids, texts):
            coded, doc = runs(texts)
            if not len(coded):
                return
            words = coded.dictionary.to_pylist()
            raw = [w.encode() for w in words]
            pair, n = np.unique((doc << 32) | coded.indices.to_numpy(), return_counts=True)
            d, w = pair >> 32, pair & 0xFFFFFFFF
            head = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids], np.uint32)
            tail = np.array([zlib.crc32(r) for r in raw], np.uint32)
            size = np.array([len(r) for r in raw], np.int64)
            h = crc.joined(head[d], tail[w], size[w])
            changed = h % every == 0
            total = np.bincount(w[~changed], weights=n[~changed], minlength=len(words)).astype(np.int64)
            for k in np.flatnonzero(total).tolist():
                counts[words[k]] = counts.get(words[k], 0) + int(total[k])
            for k in np.flatnonzero(changed).tolist():
                word = words[w[k]]
                at = int(h[k]) % len(word)
                word = word[:at] + word[at + 1:]
                counts[word] = counts.get(word, 0) + int(n[k])

        for b in batches:
            ids, texts = b.column(0).to_pylist(), b.column(1)
            size = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
            a = 0
            while a < b.num_rows:
                z = max(a + 1, int(np.searchsorted(size, (size[a - 1] if a else 0) + SLICE_BYTES, "right")))
                add(ids[a:z], texts.slice(a, z - a))
                a = z
                if len(counts) >= FLUSH_WORDS:
                    yield flush()
        if counts:
            yield flush()

    parts = docs.select(F.col(id_col).cast("string"), F.col(text_col).cast("string")).mapInArrow(walk, "word string, n long")
    return parts.where(F.char_length("word") > 0).groupBy("word").agg(F.sum("n").alias("n"))


def sorted_on(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that sorts both: the planner knows stored rows by
    their packed size, and exploded ones by the rows before, and would send tables
    to the driver that are many times larger there."""
    return df.hint("merge")


def near_pairs(words: DataFrame, col: str = "word", hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """Rows (a, b): every unordered pair of near words once; ``a`` is the smaller
    (by length, then text).  Words are distinct, of 2 characters at least."""
    w = words.select(F.col(col).alias("w"), F.char_length(col).alias("len"))
    q = F.expr("len div 2")
    chunks = w.select("w", F.col("len").alias("size"), F.explode(F.array(F.lit(0), F.col("len") - q)).alias("place")).select(
        F.col("w").alias("a"), "size", "place", F.expr("substring(a, place + 1, size div 2)").alias("gram"))
    # the smaller word's length is this word's or one less; its chunks stand at 0 and size - size div 2;
    # this word's grams of that length at those places and, where it is longer, one place on
    grams = (w.select("w", "len", F.explode(F.array(F.col("len"), F.col("len") - 1)).alias("size"))
              .where("size >= 2")
              .select("w", "len", "size", F.explode(F.expr("array(0, size - size div 2)")).alias("place"))
              .select(F.col("w").alias("b"), "len", "size", "place",
                      F.explode(F.expr("sequence(place, place + len - size)")).alias("at"))
              .select("b", "size", "place", F.expr("substring(b, at + 1, size div 2)").alias("gram")))
    key = ["size", "place", "gram"]
    chunks, grams = stored(chunks, "chunks"), stored(grams, "grams")
    hot = stored(chunks.groupBy(*key).agg(F.count("*").alias("n")).join(
        sorted_on(grams.groupBy(*key).agg(F.count("*").alias("m"))), key).where(F.col("n") * F.col("m") > hot_pairs).select(*key), "hot")
    smaller = "(char_length(a) < char_length(b) or a < b) and levenshtein(a, b, 1) = 1"
    usual = (chunks.join(sorted_on(hot), key, "left_anti").join(sorted_on(grams.join(sorted_on(hot), key, "left_anti")), key)
                   .where(smaller).select("a", "b"))
    # words of hot keys, each once
    left = chunks.join(sorted_on(hot), key, "left_semi").select("a").distinct()
    right = grams.join(sorted_on(hot), key, "left_semi").select("b").distinct()

    def less(c):
        return F.expr(f"explode(transform(sequence(1, char_length({c})), i -> "
                      f"named_struct('at', i, 'rest', concat(substring({c}, 1, i - 1), substring({c}, i + 1)))))").alias("d")

    replaced = (left.select("a", less("a")).select("a", "d.*")
                    .join(sorted_on(right.select("b", less("b")).select("b", "d.*")), ["at", "rest"]).where("a < b"))
    inserted = left.join(sorted_on(right.select("b", less("b")).select("b", F.col("d.rest").alias("a")).distinct()), "a")
    return usual.unionByName(replaced.select("a", "b")).unionByName(inserted.select("a", "b")).distinct()


def variants(counts: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, ratio: int = RATIO) -> DataFrame:
    """Rows (word, form, root, n, n_near, form_n) of the words of at least
    ``min_length`` (2 or more) characters and ``min_count`` occurrences."""
    words = stored(counts.where((F.char_length("word") >= min_length) & (F.col("n") >= min_count)).select("word", "n"), "words")
    pairs = stored(near_pairs(words), "near")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("other")))
    best = (both.join(sorted_on(words.select(F.col("word").alias("other"), F.col("n").alias("m"))), "other")
                .groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "other")).alias("top")))
    first = words.join(sorted_on(best), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(-F.col("top.m") >= ratio * F.col("n"), F.struct(F.col("top.other").alias("form"), (-F.col("top.m")).alias("m"))).alias("f"))
    first = stored(first.select("word", F.col("f.form").alias("form"), "n", "n_near", F.col("f.m").alias("form_n")), "forms")
    # word -> where its forms lead so far; only words that have a form have a row
    steps = first.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        on = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        longer = stored(steps.join(sorted_on(on), "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                              F.col("next").isNotNull().alias("moved")), "roots")
        steps = longer.select("word", "root")
        if longer.where("moved").isEmpty():
            break
    return (first.join(sorted_on(steps), "word", "left")
                 .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
