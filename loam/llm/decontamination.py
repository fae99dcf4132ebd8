"""Benchmark decontamination over a distributed positional inverted index (operator 11).

``build`` writes the index of the training texts: blocks of about
``BLOCK_BYTES`` of text, each with the postings of every term in it (positions
as gaps, 1 to 5 bytes each) and the place of its documents.  Texts are read once
and never shuffled; a position is skipped between documents, so no phrase runs
on into the next one.

``search`` takes the test items in chunks of at most about ``CHUNK_BYTES`` of
text (one id in one chunk; a test set of any size is so many chunks, and only one's windows are
sent to the tasks at a time).  For each chunk:

1. the corpus counts of its terms are summed from the index; a window with a
   term that never occurs is done;
2. the lists of each window's rarest terms alone (``RAREST`` distinct ones, and
   the two rarest places) meet in one task per block.  Places of the rarest term,
   moved back by its offset, are intersected with the others' in turn.  The same
   lists give proximity matches: the rarest distinct terms of a window within
   ``near`` words of a place of the rarest, in any order;
3. only for (block, term) pairs of windows that are still alive the remaining
   lists are fetched, and places that hold every word are exact phrases.

A task holds one block's lists, which the block size bounds (a single longer
text is a block of its own).  A frequent term is spread over all blocks.

Defined results: null and blank texts have no words and no hits; an item without
words finds nothing; an item of fewer words than a window is one window; equal
items (or repeated rows) are each counted by their id, once; an item with a null
id hits words but is not counted or listed; repeated documents get a row each;
columns beside the two named are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from loam.llm.common import in_groups, stored

WINDOW = 10
NEAR = 15
RAREST = 3
BLOCK_BYTES = 8 << 20
CHUNK_BYTES = 4 << 20
SLICE = 1 << 20

DOCUMENT, POSTINGS, BLOCK = 0, 1, 2

#: Bytes of words, A-Z lowered; 0 for all others.
_WORD_BYTES = np.zeros(256, np.uint8)
for _b in range(256):
    if _b >= 0x80 or chr(_b).isalnum():
        _WORD_BYTES[_b] = _b + 32 if 65 <= _b <= 90 else _b


def words(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """All words of the texts in order, dictionary-coded, and where each text's
    words begin (one more entry than texts)."""
    texts = texts.cast(pa.string()).fill_null("")
    ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1]
    raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0]:ends[-1]]
    cuts = (ends - ends[0]).astype(np.int64)
    low = _WORD_BYTES[raw]
    mask = low != 0
    begins = mask.copy()
    begins[1:] &= ~mask[:-1]
    at = cuts[:-1][cuts[:-1] < len(raw)]
    begins[at] = mask[at]
    first = np.flatnonzero(begins)
    data = low[mask]
    offsets = np.append(np.flatnonzero(begins[mask]), len(data)).astype(np.int32)
    col = pa.Array.from_buffers(pa.string(), len(first), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes())])
    return col.dictionary_encode(), np.searchsorted(first, cuts)


def pack(gaps: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """Lists of non-negative numbers below 2 ** 35, seven bits a byte (the high
    bit: more follow); list ``i`` is ``gaps[cuts[i]:cuts[i + 1]]``."""
    size = np.ones(len(gaps), np.int64)
    for k in range(1, 5):
        size += gaps >= (1 << 7 * k)
    to = np.concatenate([[0], np.cumsum(size)])
    out = np.zeros(to[-1], np.uint8)
    for k in range(5):
        has = size > k
        out[to[:-1][has] + k] = ((gaps[has] >> 7 * k) & 127) | np.where(size[has] > k + 1, 128, 0)
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [
        None, pa.py_buffer(to[cuts].astype(np.int32).tobytes()), pa.py_buffer(out.tobytes())])


def unpack(lists: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all lists one after the other, and where each list begins."""
    b = np.frombuffer(b"".join(lists), np.uint8)
    if not len(b):
        return np.zeros(0, np.int64), np.zeros(len(lists) + 1, np.int64)
    last = b < 128
    begins = np.concatenate([[0], np.flatnonzero(last)[:-1] + 1])
    number = np.cumsum(last) - last
    gaps = np.add.reduceat((b & 127).astype(np.int64) << 7 * (np.arange(len(b)) - begins[number]), begins)
    ends = np.cumsum([len(x) for x in lists])
    cuts = np.concatenate([[0], np.cumsum(last)[ends - 1]])
    run = np.cumsum(gaps)
    before = np.concatenate([[0], run])[cuts[:-1]]
    return run - np.repeat(before, np.diff(cuts)), cuts


def build(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The stored index: rows of documents (block, ord, doc, n_words), of
    postings (block, term, n, data) and one a block with its documents' places."""
    kind = docs.schema[id_col].dataType
    schema = StructType([*StructType.fromDDL("kind int, block long, ord int").fields, StructField("doc", kind),
                         *StructType.fromDDL("n_words long, term string, n int, data binary").fields])
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(schema)

    def table(rows: int, **columns) -> pa.RecordBatch:
        full = [columns.get(f.name) for f in arrow]
        return pa.RecordBatch.from_arrays(
            [pa.nulls(rows, f.type) if c is None else c.cast(f.type) for c, f in zip(full, arrow)], schema=arrow)

    def block(ids: pa.Array, texts: pa.Array, number: int) -> Iterator[pa.RecordBatch]:
        coded, cuts = words(texts)
        n = len(ids)
        name = pa.array(np.full(n, number))
        base = cuts[:-1] + np.arange(n)
        yield table(n, kind=pa.array(np.full(n, DOCUMENT)), block=name, ord=pa.array(np.arange(n)), doc=ids,
                    n_words=pa.array(np.diff(cuts)))
        yield table(1, kind=pa.array([BLOCK]), block=name[:1], data=pack(np.diff(base, prepend=0), np.array([0, n])))
        codes = coded.indices.to_numpy()
        order = np.argsort(codes, kind="stable")
        places = (np.arange(len(codes)) + np.repeat(np.arange(n), np.diff(cuts)))[order]
        counts = np.bincount(codes, minlength=len(coded.dictionary))
        lists = np.concatenate([[0], np.cumsum(counts)])
        gaps = np.diff(places, prepend=0)
        gaps[lists[:-1]] = places[lists[:-1]]
        data = pack(gaps, lists)
        for a in range(0, len(counts), 20_000):
            m = len(counts[a:a + 20_000])
            yield table(m, kind=pa.array(np.full(m, POSTINGS)), block=pa.array(np.full(m, number)),
                        term=coded.dictionary.slice(a, m), n=pa.array(counts[a:a + m]), data=data.slice(a, m))

    def walk(batches):
        number = TaskContext.get().partitionId() << 32
        for b in batches:
            ids, texts = b.column(0), b.column(1)
            size = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
            a = 0
            while a < b.num_rows:
                upto = (size[a - 1] if a else 0) + BLOCK_BYTES
                z = max(a + 1, int(np.searchsorted(size, upto, "right")))
                yield from block(ids.slice(a, z - a), texts.slice(a, z - a), number)
                number, a = number + 1, z

    return stored(docs.select(id_col, F.col(text_col).cast("string")).mapInArrow(walk, schema), "index")


class Windows:
    """The distinct windows of one chunk of items, as arrays."""

    def __init__(self, items: list[tuple], window: int):
        coded, cuts = words(pa.array([t for _, t in items], type=pa.string()))
        codes = coded.indices.to_numpy()
        self.terms = coded.dictionary.to_pylist()
        self.ids = sorted({i for i, _ in items if i is not None})
        number = {i: k for k, i in enumerate(self.ids)}
        size = np.diff(cuts)
        rows, owner = [], []
        for (i, _), a, m in zip(items, cuts, size):
            if m:
                at = np.arange(a, a + max(m - window, 0) + 1)[:, None] + np.arange(min(window, m))
                rows.append(np.pad(codes[at], ((0, 0), (0, window - min(window, m))), constant_values=-1))
                owner += [number.get(i, -1)] * len(at)
        grid = np.concatenate(rows) if rows else np.zeros((0, window), np.int32)
        self.grid, which = np.unique(grid, axis=0, return_inverse=True)
        pairs = np.unique(np.stack([which.ravel(), np.array(owner, np.int64)], 1), axis=0) if len(grid) else np.zeros((0, 2), np.int64)
        self.items = pairs[:, 1]
        self.item_cuts = np.searchsorted(pairs[:, 0], np.arange(len(self.grid) + 1))

    def rank(self, counts: np.ndarray) -> None:
        """Drop windows with a term that never occurs; order the places of the
        others by their term's count; choose the lists to begin with."""
        padded = np.append(counts, np.iinfo(np.int64).max)
        cost = padded[self.grid]
        alive = np.flatnonzero(cost.min(axis=1) > 0) if len(cost) else np.zeros(0, np.int64)
        self.items = np.concatenate([self.items[self.item_cuts[w]:self.item_cuts[w + 1]] for w in alive] or [self.items[:0]])
        self.item_cuts = np.concatenate([[0], np.cumsum(np.diff(self.item_cuts)[alive])])
        self.grid = self.grid[alive]
        self.order = np.argsort(cost[alive], axis=1, kind="stable")
        self.size = (self.grid >= 0).sum(axis=1)
        self.rare = np.full((len(alive), RAREST), -1, np.int64)
        for w, (row, order) in enumerate(zip(self.grid.tolist(), self.order.tolist())):
            distinct = list(dict.fromkeys(row[o] for o in order if row[o] >= 0))[:RAREST]
            self.rare[w, :len(distinct)] = distinct
        first = np.take_along_axis(self.grid, self.order[:, :2], axis=1)
        wanted = np.unique(np.concatenate([self.rare.ravel(), first.ravel()]))
        self.first = wanted[wanted >= 0]


def ranges(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """begin[0] .. begin[0] + size[0] - 1, begin[1] .., one after the other."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - size - begin, size)


def slices(size: np.ndarray, most: int = SLICE) -> Iterator[slice]:
    """Runs of entries whose sizes add up to about ``most``."""
    upto, a = np.cumsum(size), 0
    while a < len(size):
        z = max(a + 1, int(np.searchsorted(upto, (upto[a - 1] if a else 0) + most, "right")))
        yield slice(a, z)
        a = z


class Lists:
    """Posting lists of one block by term code."""

    def __init__(self, codes: list[int], data: list[bytes], terms: int):
        order = np.argsort(codes, kind="stable")
        self.places, cuts = unpack([data[i] for i in order])
        self.begin, self.count = np.zeros(terms, np.int64), np.zeros(terms, np.int64)
        known = np.array(codes, np.int64)[order]
        self.begin[known], self.count[known] = cuts[:-1], np.diff(cuts)
        self.keys = (np.repeat(known, np.diff(cuts)) << 36) | self.places
        self.at = np.full(int(self.places.max(initial=0)) + 1, -1, np.int64)
        self.at[self.places] = np.repeat(known, np.diff(cuts))

    def holds(self, code: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Whether the lists of ``code`` have ``place``."""
        ok = (place >= 0) & (place < len(self.at))
        return ok & (self.at[np.where(ok, place, 0)] == code)

    def next_to(self, code: np.ndarray, place: np.ndarray, near: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Whether the list of ``code`` has a place at most ``near`` off, in [low, high)."""
        a = np.searchsorted(self.keys, (code << 36) | np.maximum(place - near, low))
        z = np.searchsorted(self.keys, (code << 36) | np.minimum(place + near + 1, high))
        return z > a


def begin_block(w: Windows, lists: Lists, base: np.ndarray, near: int):
    """Places (window, start) that all lists at hand allow, and the documents
    with proximity matches: (ord, number of items)."""
    fetched = np.zeros(len(w.terms) + 1, bool)
    fetched[w.first] = True
    alive = np.flatnonzero((lists.count[w.rare] > 0)[:, 0] if len(w.rare) else np.zeros(0, bool))
    for k in range(1, RAREST):
        alive = alive[(w.rare[alive, k] < 0) | (lists.count[w.rare[alive, k]] > 0)]
    code = w.rare[alive, 0]
    found, starts = [], []
    for s in slices(lists.count[code]):
        win, size = alive[s], lists.count[code[s]]
        place = lists.places[ranges(lists.begin[code[s]], size)]
        win = np.repeat(win, size)
        start = place - w.order[win, 0]
        for k in range(1, w.grid.shape[1]):
            o = w.order[win, k]
            c = w.grid[win, o]
            ok = ~fetched[c] | lists.holds(c, start + o)
            win, start = win[ok], start[ok]
        found.append(win)
        starts.append(start)
    # proximity: once for each set of rarest terms
    sets, which = np.unique(w.rare[alive], axis=0, return_inverse=True) if len(alive) else (w.rare[:0], np.zeros(0, np.int64))
    pairs = np.unique(np.stack([
        np.repeat(which.ravel(), np.diff(w.item_cuts)[alive]),
        w.items[ranges(w.item_cuts[alive], np.diff(w.item_cuts)[alive])]], 1), axis=0)
    pairs = pairs[pairs[:, 1] >= 0]
    owner = np.searchsorted(pairs[:, 0], np.arange(len(sets) + 1))
    ends = np.append(base[1:], np.iinfo(np.int32).max)
    seen = np.zeros(0, np.int64)
    for s in slices(lists.count[sets[:, 0]] if len(sets) else np.zeros(0, np.int64)):
        k = np.arange(len(sets))[s]
        size = lists.count[sets[k, 0]]
        place = lists.places[ranges(lists.begin[sets[k, 0]], size)]
        k = np.repeat(k, size)
        doc = np.searchsorted(base, place, "right") - 1
        for r in range(1, RAREST):
            c = sets[k, r]
            ok = (c < 0) | lists.next_to(np.maximum(c, 0), place, near, base[doc], ends[doc])
            place, k, doc = place[ok], k[ok], doc[ok]
        hit = np.unique((doc << 32) | k)
        doc, k = hit >> 32, hit & 0xFFFFFFFF
        items = pairs[:, 1][ranges(owner[k], np.diff(owner)[k])]
        seen = np.unique(np.concatenate([seen, (np.repeat(doc, np.diff(owner)[k]) << 32) | items]))
    docs, n = np.unique(seen >> 32, return_counts=True)
    return np.concatenate(found or [alive]), np.concatenate(starts or [alive]), docs, n


def search(index: DataFrame, items: DataFrame, id_col: str = "item_id", text_col: str = "text",
           window: int = WINDOW, near: int = NEAR) -> DataFrame:
    """Documents with matches, by chunk: (block, ord, items, spans, n_near);
    spans are word ranges [begin, end) of exact phrases, joined where they touch."""
    spark = index.sparkSession
    kind = items.schema[id_col].dataType
    schema = StructType([*StructType.fromDDL("block long, ord int").fields, StructField("items", ArrayType(kind)),
                         *StructType.fromDDL("spans array<struct<begin: int, end: int>>, n_near long").fields])
    test = items.select(F.col(id_col).alias("i"), F.col(text_col).cast("string").alias("t"))
    size = test.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    chunks = -(-size // CHUNK_BYTES)
    out = None
    for c in range(chunks):
        part = test.where(F.pmod(F.when(F.col("i").isNull(), F.xxhash64("t")).otherwise(F.xxhash64("i")), F.lit(chunks)) == c)
        found = search_chunk(index, Windows([(r.i, r.t) for r in part.collect()], window), near, schema)
        if found is not None:
            out = found if out is None else out.unionByName(found)
    return spark.createDataFrame([], schema) if out is None else out


def search_chunk(index: DataFrame, w: Windows, near: int, schema: StructType) -> DataFrame | None:
    spark = index.sparkSession
    if not w.terms:
        return None
    # at most one chunk's words
    terms = F.broadcast(spark.createDataFrame(list(enumerate(w.terms)), "code int, term string"))
    postings = index.where(F.col("kind") == POSTINGS).join(terms, "term")
    counts = np.zeros(len(w.terms), np.int64)
    for r in postings.groupBy("code").agg(F.sum("n").alias("n")).collect():
        counts[r.code] = r.n
    w.rank(counts)
    if not len(w.grid):
        return None
    sent = spark.sparkContext.broadcast(w)
    n_terms = len(w.terms)
    wanted = F.broadcast(spark.createDataFrame([(int(c),) for c in w.first], "code int"))
    lists = postings.join(wanted, "code").select("block", "code", "data")
    bases = index.where(F.col("kind") == BLOCK).select("block", F.lit(-1).alias("code"), "data")

    def begin(cols):
        codes = cols["code"]
        mine = codes >= 0
        if not mine.any():
            return
        w = sent.value
        base, _ = unpack([d for c, d in zip(codes, cols["data"]) if c < 0])
        got = Lists(codes[mine].tolist(), list(cols["data"][mine]), n_terms)
        win, start, docs, n = begin_block(w, got, base, near)
        open_terms = np.setdiff1d(np.unique(w.grid[np.unique(win)]), np.append(w.first, -1))
        yield {"block": cols["block"][:1], "win": [win.astype("<i4").tobytes()], "start": [start.astype("<i4").tobytes()],
               "needs": [open_terms.tolist()], "docs": [docs.tolist()], "n": [n.tolist()]}

    first = stored(in_groups(lists.unionByName(bases), ["block"],
                             "block long, win binary, start binary, needs array<int>, docs array<int>, n array<long>", begin), "phrases")
    needs = first.select("block", F.explode("needs").alias("code"))
    rest = postings.join(needs, ["block", "code"]).select("block", "code", "data", F.lit(b"").alias("start"))
    alive = F.octet_length("win") > 0
    places = first.where(alive).select("block", F.lit(-2).alias("code"), F.col("win").alias("data"), "start")
    docs = bases.join(first.where(alive).select("block"), "block", "left_semi").withColumn("start", F.lit(b""))

    def finish(cols):
        codes = cols["code"]
        if not (codes == -2).any():
            return
        w = sent.value
        row = int(np.flatnonzero(codes == -2)[0])
        win, start = np.frombuffer(cols["data"][row], "<i4").astype(np.int64), np.frombuffer(cols["start"][row], "<i4").astype(np.int64)
        base, _ = unpack([cols["data"][int(np.flatnonzero(codes == -1)[0])]])
        mine = codes >= 0
        if mine.any():
            got = Lists(codes[mine].tolist(), list(cols["data"][mine]), n_terms)
            known = np.zeros(n_terms + 1, bool)
            known[w.first] = True
            for k in range(w.grid.shape[1]):
                o = w.order[win, k]
                c = w.grid[win, o]
                ok = (c < 0) | known[c] | got.holds(c, start + o)
                win, start = win[ok], start[ok]
        doc = np.searchsorted(base, start, "right") - 1
        order = np.lexsort((start, doc))
        win, start, doc = win[order], start[order], doc[order]
        cuts = np.flatnonzero(np.diff(doc, prepend=-1, append=-1)) if len(doc) else np.zeros(0, np.int64)
        n = len(cuts) - 1
        if n < 1:
            return
        ords, lists_of, spans = [], [], []
        for a, z in zip(cuts[:-1], cuts[1:]):
            d = int(doc[a])
            seen = np.unique(w.items[ranges(w.item_cuts[win[a:z]], np.diff(w.item_cuts)[win[a:z]])])
            s = start[a:z] - base[d]
            e = np.maximum.accumulate(s + w.size[win[a:z]])
            new = np.flatnonzero(np.append(True, s[1:] > e[:-1]))
            ords.append(d)
            lists_of.append([w.ids[i] for i in seen if i >= 0])
            spans.append([{"begin": x, "end": y} for x, y in zip(s[new].tolist(), e[np.append(new[1:] - 1, len(e) - 1)].tolist())])
        yield {"block": np.repeat(cols["block"][:1], n), "ord": ords, "items": lists_of, "spans": spans, "n_near": [0] * n}

    exact = in_groups(rest.unionByName(places).unionByName(docs), ["block"], schema, finish)
    close = (first.select("block", F.explode(F.arrays_zip("docs", "n")).alias("d"))
                  .select("block", F.col("d.docs").alias("ord"), F.array().cast(schema["items"].dataType).alias("items"),
                          F.array().cast(schema["spans"].dataType).alias("spans"), F.col("d.n").alias("n_near")))
    return exact.unionByName(close)


def matches(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, near: int = NEAR) -> DataFrame:
    """Per document: (doc, n_words, items, spans, n_near): the ids of items with
    an exact phrase, the word ranges [begin, end) that they cover (sorted; those of
    two chunks of items may overlap) and the number of items with a proximity match."""
    index = build(docs, id_col, text_col)
    found = stored(search(index, items, item_col, item_text_col, window, near), "matches")
    # a document has at most one row of each form a chunk
    per_doc = found.groupBy("block", "ord").agg(
        F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"), F.sum("n_near").alias("n_near"))
    listed = index.where(F.col("kind") == DOCUMENT).select("block", "ord", "doc", "n_words")
    kinds = found.schema
    return listed.join(per_doc, ["block", "ord"], "left").select(
        "doc", "n_words", F.coalesce("items", F.array().cast(kinds["items"].dataType)).alias("items"),
        F.coalesce("spans", F.array().cast(kinds["spans"].dataType)).alias("spans"),
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"))


def covered(spans):
    """Number of words in ranges that are sorted and may overlap."""
    def add(sofar, s):
        return F.struct((sofar["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(sofar["upto"], s["begin"]))).alias("n"),
                        F.greatest(sofar["upto"], s["end"]).alias("upto"))
    return F.aggregate(spans, F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("upto")), add, lambda x: x["n"])


def clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """The documents without an exact phrase of an item, columns as they came.
    Documents are told apart by id; one with a null id stays."""
    hit = matches(docs, items, id_col, text_col, **kw).where(F.size("spans") > 0)
    return docs.join(hit.select(F.col("doc").alias(id_col)).distinct(), id_col, "left_anti").select(docs.columns)
