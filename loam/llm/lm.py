"""LM scoring with a hashed maximum-entropy model (operator 4).

Tokens are words ``[^\\x20\\x09-\\x0D]+`` of the text in lower-case ASCII, then
one end.  Training tokens are counted in full: c per word, N in all, V words.

Model: every word has a leaf.  The ``SINGLES`` most frequent words have one
each, all others share the remaining leaves by a hash of their last two
letters; a leaf is one of ``MEMBERS`` members of one of ``CLASSES`` classes.

    P(w | context) = P(class | context) P(member | class, context) (c + 0.5) / S(leaf)

S(leaf) sums c + 0.5 over the leaf's words and one unknown word, so the three
factors add up to 1.  Class and member are softmaxes over hashed features of the
context: the previous word, the pair of previous leaves, and two skips (second
and third word back).  Biases start at the leaves' own frequencies, so an
untrained model is the unigram model.

Codes: once the lexicon is fixed, every text is read once more and its token
codes are written; training and scoring start from these numbers.

Training: the training documents of a round are dealt by a hash of id and codes
to blocks of about ``BLOCK_TOKENS`` tokens and sorted by another hash, so a
block is the same however the rows lie in files or tasks.  A block runs AdaGrad
from the round's weights.  The blocks' updates are averaged row by row of the
tables, each weighted by the tokens of the block that touched the row: a row
that few blocks touch is not diluted by the others.  Sums go up a tree of
``FAN`` blocks a step, in the order of the blocks.  Each document is used in one
round.  Equal rows (id and text) of more than two blocks' tokens are dealt one
by one.  The tables have a fixed size; counts, codes, updates and rare words
grow with the corpus and stay in Spark.

Scoring: the ``HOT`` most frequent words' counts go to the tasks (bounded by
that parameter); all other words leave as (row, word, times) and meet the whole
count table in an equi-join, so every count is exact.

Defined results: null and empty texts are the end alone; null ids train;
repeated rows train and are scored each; with no training rows all counts are 0
and the model stays at its start; an empty table gives none.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loam.llm.common import stored, utf8

CLASSES = MEMBERS = 16
LEAVES = CLASSES * MEMBERS
SINGLES = 128
FEATURES = 1 << 12  # rows of either table are numbered in 16 bits
TEMPLATES = 4
HOT = 200_000
ROUNDS = 2
BATCH = 1 << 15
RATE = 0.25
BLOCK_TOKENS = 1 << 21
PIECES = 16  # that an update travels in
FAN = 16
CLIP = 60.0  # of logits: no exponential overflows or vanishes
_TRIM = b".,;:!?\"')"


def tail_leaf(word: bytes) -> int:
    """Leaf of a word without one of its own."""
    return SINGLES + zlib.crc32(word.rstrip(_TRIM)[-2:]) % (LEAVES - SINGLES)


def words_of(text: str | None) -> list[bytes]:
    return utf8(text).lower().split()


class Lexicon:
    """Ids of the hot words, their leaves and their log10(c + 0.5)."""

    def __init__(self, hot: list[tuple[str, int]]):
        self.ids = {w.encode("utf-8", "surrogatepass"): i for i, (w, _) in enumerate(hot)}
        self.logs = np.array([math.log10(c + 0.5) for _, c in hot])
        self.leaf = np.array([i if i < SINGLES else tail_leaf(w) for w, i in self.ids.items()], np.int64)
        self.size = len(hot)

    def read(self, words: list[bytes]) -> np.ndarray:
        """Code of each word: hot id, or ``size`` + leaf."""
        out = np.fromiter(map(self.ids.get, words, repeat(-1)), np.int64, len(words))
        for i in np.flatnonzero(out < 0).tolist():
            out[i] = self.size + tail_leaf(words[i])
        return out

    def leaves(self, codes: np.ndarray) -> np.ndarray:
        if not self.size:
            return codes - self.size
        return np.where(codes < self.size, self.leaf[np.minimum(codes, self.size - 1)], codes - self.size)


def _mix(x: np.ndarray, salt: int) -> np.ndarray:
    x = (x.astype(np.uint64) + np.uint64(salt * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x94D049BB133111EB)
    return (x >> np.uint64(64 - FEATURES.bit_length() + 1)).astype(np.int64)


def features(codes: np.ndarray, leaves: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Hashed context features of tokens in running text, a row per template;
    ``places``: each token's place in its document (contexts do not cross a document's start)."""
    def back(x, k):
        out = np.full(len(x), -1, np.int64)
        out[k:] = x[:-k] if len(x) > k else x[:0]
        out[places < k] = -1
        return out + 1

    return np.stack([_mix(back(codes, 1), 1), _mix(back(leaves, 1) * 4096 + back(leaves, 2), 2),
                     _mix(back(codes, 2), 3), _mix(back(codes, 3), 4)])


class Model:
    """Weights of the two softmaxes, in one flat vector."""

    def __init__(self, mass: np.ndarray, flat: np.ndarray | None = None):
        by = np.log(mass / mass.sum()).reshape(CLASSES, MEMBERS)
        of_class = np.logaddexp.reduce(by, axis=1, keepdims=True)
        self.bias_m = (by - of_class).astype(np.float32)
        self.bias_c = of_class.ravel().astype(np.float32)
        n = FEATURES * CLASSES
        self.flat = np.zeros(n + n * MEMBERS, np.float32) if flat is None else flat.copy()
        self.w_c = self.flat[:n].reshape(FEATURES, CLASSES)
        self.w_m = self.flat[n:].reshape(n, MEMBERS)
        self.g2: np.ndarray | None = None
        self.touch = np.zeros(FEATURES * (CLASSES + 1))  # tokens a row of either table met

    def logits(self, feats: np.ndarray, leaves: np.ndarray):
        """Class and member logits of each token, and the member table's rows."""
        cls, mem = leaves // MEMBERS, leaves % MEMBERS
        rows = feats * CLASSES + cls
        z, y = self.bias_c + np.take(self.w_c, feats[0], axis=0), np.take(self.bias_m, cls, axis=0)
        y += np.take(self.w_m, rows[0], axis=0)
        for k in range(1, TEMPLATES):
            z += np.take(self.w_c, feats[k], axis=0)
            y += np.take(self.w_m, rows[k], axis=0)
        return cls, mem, rows, np.clip(z, -CLIP, CLIP, out=z), np.clip(y, -CLIP, CLIP, out=y)

    def logp(self, feats: np.ndarray, leaves: np.ndarray) -> np.ndarray:
        """log10 P(leaf | context) of each token."""
        cls, mem, _, z, y = self.logits(feats, leaves)
        at = np.arange(len(leaves))
        picked = z[at, cls].astype(np.float64) + y[at, mem]
        ones = np.ones(CLASSES, np.float32)
        return (picked - np.log((np.exp(z, out=z) @ ones) * (np.exp(y, out=y) @ ones).astype(np.float64))) / math.log(10)

    def learn(self, feats: np.ndarray, leaves: np.ndarray) -> None:
        """One AdaGrad step on the gradient of a batch of tokens."""
        cls, mem, rows, z, y = self.logits(feats, leaves)
        at = np.arange(len(leaves))
        if self.g2 is None:
            self.g2 = np.full_like(self.flat, 1.0)
        n = FEATURES * CLASSES
        for x, target, part, index, touch in ((z, cls, slice(0, n), feats, self.touch[:FEATURES]),
                                              (y, mem, slice(n, None), rows, self.touch[FEATURES:])):
            np.exp(x, out=x)
            x /= (x @ np.ones(x.shape[1], np.float32))[:, None]
            x[at, target] -= 1
            # gradients of the tokens that share a row are added up in the order of the rows
            index = index.ravel().astype(np.uint16)
            order = np.argsort(index, kind="stable")
            index = index[order]
            first = np.flatnonzero(np.concatenate([[True], index[1:] != index[:-1]]))
            g = np.add.reduceat(np.take(x, order % len(leaves), axis=0), first, axis=0)
            row = index[first].astype(np.int64)
            touch[row] += np.diff(first, append=len(index))
            w, g2 = self.flat[part].reshape(-1, x.shape[1]), self.g2[part].reshape(-1, x.shape[1])
            s = g2[row] + g * g
            g2[row] = s
            w[row] -= RATE * g / np.sqrt(s)


def count_words(train: DataFrame, most: int = 1_000_000) -> DataFrame:
    """(word, n) over all tokens of the column t; the end is the empty word."""
    def run(batches):
        seen: Counter = Counter()

        def out():
            words = list(seen)
            return pa.RecordBatch.from_arrays([pa.array([w.decode("utf-8", "surrogatepass") for w in words], pa.string()),
                                               pa.array(list(seen.values()), pa.int64())], names=["word", "n"])
        for b in batches:
            for text in b.column("t").to_pylist():
                seen.update(words_of(text))
                seen[b""] += 1
                if len(seen) > most:
                    yield out()
                    seen.clear()
        yield out()

    return train.select("t").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def hot_words(counts: DataFrame, most: int) -> list[tuple[str, int]]:
    """The most frequent words, at most ``most``, by a count threshold read from
    a sketch of the counts (its buckets keep seven leading bits: bounded)."""
    low = F.expr("shiftleft(shiftright(n, greatest(length(bin(n)) - 7, 0)), greatest(length(bin(n)) - 7, 0))")
    least, got = None, 0
    for r in sorted(counts.groupBy(low.alias("lo")).agg(F.count("*").alias("k")).collect(), key=lambda r: -r.lo):
        if got + r.k > most:
            break
        least, got = r.lo, got + r.k
    if least is None:
        return []
    return sorted(((r.word, r.n) for r in counts.where(F.col("n") >= least).collect()), key=lambda x: (-x[1], x[0]))


def leaf_mass(counts: DataFrame, lexicon: Lexicon) -> np.ndarray:
    """S(leaf): c + 0.5 over its words, and 0.5 for the unknown."""
    def run(batches):
        out = np.zeros(LEAVES)
        for b in batches:
            if b.num_rows:
                words = [utf8(w) for w in b.column("word").to_pylist()]
                out += np.bincount(lexicon.leaves(lexicon.read(words)), b.column("n").to_numpy() + 0.5, LEAVES)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(LEAVES)), pa.array(out)], names=["leaf", "s"])

    mass = np.full(LEAVES, 0.5)
    for r in counts.mapInArrow(run, "leaf long, s double").groupBy("leaf").agg(F.sum("s").alias("s")).collect():
        mass[r.leaf] += r.s
    return mass


def encode(src: DataFrame, lexicon: Lexicon) -> DataFrame:
    """Rows (id, t, held_out) as uid, id, held_out, n_tokens, known (hot tokens),
    logs (sum of their log10(c + 0.5)), codes (32 bits a token), rare and times
    (the other words), key (a hash of id and codes)."""
    shared = src.sparkSession.sparkContext.broadcast(lexicon)  # size fixed by HOT

    def run(batches):
        lex = shared.value
        for b in batches:
            for a in range(0, b.num_rows, 256):
                part = b.slice(a, 256)
                n, hot, logs, codes, rare, times = [], [], [], [], [], []
                for text in part.column("t").to_pylist():
                    w = [*words_of(text), b""]
                    x = lex.read(w)
                    known = x < lex.size
                    left = Counter([w[i] for i in np.flatnonzero(~known).tolist()])
                    n.append(len(x))
                    hot.append(int(known.sum()))
                    logs.append(float(lex.logs[x[known]].sum()))
                    codes.append(x.astype(np.int32).tobytes())
                    rare.append([y.decode("utf-8", "surrogatepass") for y in left])
                    times.append(list(left.values()))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:3], pa.array(n, pa.int64()), pa.array(hot, pa.int64()), pa.array(logs, pa.float64()),
                     pa.array(codes, pa.binary()), pa.array(rare, pa.list_(pa.string())), pa.array(times, pa.list_(pa.int32()))],
                    names=[*part.schema.names[:3], "n_tokens", "known", "logs", "codes", "rare", "times"])

    src = src.withColumn("uid", F.monotonically_increasing_id()).select("uid", "id", "held_out", "t")
    schema = T.StructType([*src.schema.fields[:3], *(T.StructField(n, k) for n, k in (
        ("n_tokens", T.LongType()), ("known", T.LongType()), ("logs", T.DoubleType()), ("codes", T.BinaryType()),
        ("rare", T.ArrayType(T.StringType())), ("times", T.ArrayType(T.IntegerType()))))])
    return src.mapInArrow(run, schema).withColumn("key", F.xxhash64("id", "codes"))


def learn_block(model: Model, lexicon: Lexicon, docs: list[np.ndarray]) -> None:
    """Steps over the codes of some documents, in batches."""
    codes = np.concatenate(docs).astype(np.int64)
    leaves = lexicon.leaves(codes)
    f = features(codes, leaves, np.concatenate([np.arange(len(d)) for d in docs]))
    for a in range(0, len(codes), BATCH):
        model.learn(f[:, a:a + BATCH], leaves[a:a + BATCH])


_UPDATE = "piece int, block int, touch binary, delta binary"


def _pieces(block: int, touch: np.ndarray, delta: np.ndarray) -> pa.RecordBatch:
    """An update as rows; ``delta`` is already multiplied by ``touch``."""
    return pa.RecordBatch.from_arrays(
        [pa.array(np.arange(PIECES), pa.int32()), pa.array([block] * PIECES, pa.int32()),
         pa.array([x.tobytes() for x in touch.reshape(PIECES, -1)], pa.binary()),
         pa.array([x.astype(np.float32).tobytes() for x in delta.reshape(PIECES, -1)], pa.binary())],
        names=["piece", "block", "touch", "delta"])


def deal(encoded: DataFrame, tokens: int, rounds: int, block_tokens: int) -> tuple[DataFrame, int]:
    """(turn, block, place, codes) of the training documents, and the blocks of a round."""
    blocks = max(1, -(-tokens // (rounds * block_tokens)))
    train = encoded.where("not held_out").select("key", "uid", "n_tokens", "codes")
    hot = (train.groupBy("key").agg(F.sum("n_tokens").alias("n"), F.count("*").alias("k"))
                .where((F.col("k") > 1) & (F.col("n") > 2 * block_tokens)).select("key", F.lit(True).alias("hot")))
    by = train.join(stored(hot, "hot_keys"), "key", "left").withColumn(
        "by", F.when(F.col("hot"), F.xxhash64("key", "uid")).otherwise(F.col("key")))
    return by.select(F.pmod(F.xxhash64("by", F.lit(3)), F.lit(rounds)).cast("int").alias("turn"),
                     F.pmod(F.xxhash64("by", F.lit(5)), F.lit(blocks)).cast("int").alias("block"),
                     F.xxhash64("by", F.lit(7)).alias("place"), "codes"), blocks


def train_round(docs: DataFrame, blocks: int, lexicon: Lexicon, mass: np.ndarray, flat: np.ndarray) -> np.ndarray:
    """Weights after one round: the start plus, row by row, the mean update of the blocks."""
    sc = docs.sparkSession.sparkContext
    shared = sc.broadcast((lexicon, flat))  # sizes fixed by HOT and FEATURES

    def run(batches):
        lex, start = shared.value
        model, held, waiting, now = None, [], 0, None

        def flush():
            if held:
                learn_block(model, lex, held)
                held.clear()

        def update():
            delta = (model.flat - start).reshape(len(model.touch), -1) * model.touch[:, None]
            return _pieces(now, model.touch, delta)

        for b in batches:
            for block, codes in zip(b.column("block").to_pylist(), b.column("codes")):
                if block != now:
                    if now is not None:
                        flush()
                        yield update()
                    model, waiting, now = Model(mass, start), 0, block
                held.append(np.frombuffer(codes.as_buffer(), np.int32))
                waiting += len(held[-1])
                if waiting >= BATCH:
                    flush()
                    waiting = 0
        if now is not None:
            flush()
            yield update()

    def add(batches):
        piece = None
        for b in batches:
            for at, block, t, d in zip(*(c.to_pylist() for c in b.columns)):
                if (at, block // FAN) != piece:
                    if piece is not None:
                        yield out(piece, touch, delta)
                    piece, touch, delta = (at, block // FAN), 0.0, 0.0
                touch = touch + np.frombuffer(t)
                delta = delta + np.frombuffer(d, np.float32).astype(np.float64)
        if piece is not None:
            yield out(piece, touch, delta)

    def out(piece, touch, delta):
        return pa.RecordBatch.from_arrays(
            [pa.array([piece[0]], pa.int32()), pa.array([piece[1]], pa.int32()), pa.array([touch.tobytes()], pa.binary()),
             pa.array([delta.astype(np.float32).tobytes()], pa.binary())], names=["piece", "block", "touch", "delta"])

    parts = (docs.repartitionById(blocks, "block").sortWithinPartitions("block", "place")
                 .select("block", "codes").mapInArrow(run, _UPDATE))
    while True:
        blocks = -(-blocks // FAN)  # a task adds up at most FAN rows
        group = (F.floor(F.col("block") / FAN) * PIECES + F.col("piece")).cast("int")
        parts = (parts.repartitionById(blocks * PIECES, group).sortWithinPartitions("piece", "block").mapInArrow(add, _UPDATE))
        if blocks == 1:
            break
    result = flat.reshape(PIECES, -1).copy()
    for r in parts.collect():  # PIECES rows, the model's size
        touch = np.maximum(np.frombuffer(r.touch), 1.0)
        mean = np.frombuffer(r.delta, np.float32).reshape(len(touch), -1) / touch[:, None]
        result[r.piece] += mean.astype(np.float32).ravel()
    shared.unpersist()
    return result.ravel()


def score(df: DataFrame, id_col: str = "doc_id", text: str = "text", folds: int = 5, held_fold: int = 1,
          hot: int = HOT, rounds: int = ROUNDS, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """One row per row of ``df``: ``id_col``, held_out, n_tokens, n_known,
    train_tokens, base_score, score."""
    sc = df.sparkSession.sparkContext
    fold = F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds, F.lit(held_fold + 1))
    src = df.select(F.col(id_col).alias("id"), F.col(text).cast("string").alias("t"), (fold == held_fold).alias("held_out"))
    counts = stored(count_words(src.where("not held_out")), "counts")
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.when(F.col("n") > 0, 1))).first()
    lexicon = Lexicon(hot_words(counts.where("n > 0"), hot))
    mass = leaf_mass(counts.where("n > 0"), lexicon)
    encoded = stored(encode(src, lexicon), "codes")
    flat = Model(mass).flat
    docs, blocks = deal(encoded, int(total), rounds, block_tokens)
    for r in range(rounds if total else 0):
        flat = train_round(docs.where(F.col("turn") == r), blocks, lexicon, mass, flat)
    shared = sc.broadcast((lexicon, mass, flat))

    def run(batches):
        lex, s, weights = shared.value
        m = Model(s, weights)
        logs_s = np.log10(s)
        for b in batches:
            for a in range(0, b.num_rows, 256):
                part = b.slice(a, 256)
                docs = [np.frombuffer(x.as_buffer(), np.int32) for x in part.column("codes")]
                codes = np.concatenate(docs).astype(np.int64)
                leaves = lex.leaves(codes)
                f = features(codes, leaves, np.concatenate([np.arange(len(d)) for d in docs]))
                ctx = np.concatenate([m.logp(f[:, k:k + BATCH], leaves[k:k + BATCH]) for k in range(0, len(codes), BATCH)])
                ctx -= logs_s[leaves]
                at = np.concatenate([[0], np.cumsum([len(d) for d in docs])[:-1]])
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(np.add.reduceat(ctx, at))],
                                                 names=[*part.schema.names[:-1], "ctx"])

    kept = encoded.select("uid", "id", "held_out", "n_tokens", "known", "logs", "codes")
    scored = kept.mapInArrow(run, T.StructType([*kept.schema.fields[:-1], T.StructField("ctx", T.DoubleType())]))
    rare = encoded.select("uid", F.explode(F.arrays_zip("rare", "times")).alias("x")).select(
        "uid", F.col("x.rare").alias("w"), F.col("x.times").alias("k"))
    c = F.coalesce(F.col("n"), F.lit(0))
    rare = (rare.join(counts, F.col("w") == F.col("word"), "left").groupBy("uid")
                .agg(F.sum(F.col("k") * F.log10(c + 0.5)).alias("rare_logs"),
                     F.sum(F.when(c > 0, F.col("k")).otherwise(0)).alias("rare_known")))
    out = scored.join(rare, "uid", "left")
    logs = F.col("logs") + F.coalesce("rare_logs", F.lit(0.0))
    return out.select(
        F.col("id").alias(id_col), "held_out", "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(int(total)).cast("long").alias("train_tokens"),
        (logs - F.col("n_tokens") * math.log10(total + 0.5 * (distinct + 1))).alias("base_score"),
        (logs + F.col("ctx")).alias("score"))

