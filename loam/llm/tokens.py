"""Token counts (operator 9): batch encoding in Arrow functions.

Only lengths leave the function.  Texts go to the tokenizer in batches of
about ``BATCH_BYTES``; a longer text is first cut where its tokens cannot
change: before a single space that stands between two ASCII letters, where the
tokenizer's own splitting always starts a new piece and no special string can
lie.  A text without such a place stays whole.

Defined results: null and empty texts have 0 bytes and 0 tokens; repeated rows
are counted each; an empty table gives none.
"""

from __future__ import annotations

import os
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BATCH_BYTES = 256 * 1024
_SAFE = re.compile(r"(?<=[A-Za-z]) (?=[A-Za-z])")
_LOADED: dict[str, object] = {}


def tokenizer(path: str):
    """The tokenizer of a file, once per worker."""
    if path not in _LOADED:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        t = Tokenizer.from_file(path)
        t.no_truncation()
        t.no_padding()
        _LOADED[path] = t
    return _LOADED[path]


def pieces(text: str, most: int = BATCH_BYTES) -> list[str]:
    """``text`` cut at safe places into pieces of about ``most`` characters."""
    if len(text) <= most:
        return [text]
    out, at = [], 0
    while len(text) - at > most:
        cut = _SAFE.search(text, at + most)
        if cut is None:
            break
        out.append(text[at:cut.start()])
        at = cut.start()
    return [*out, text[at:]]


def lengths(texts: list[str], path: str, batch_bytes: int = BATCH_BYTES) -> list[int]:
    """Token count of each text."""
    t = tokenizer(path)
    out = [0] * len(texts)
    batch, of, held = [], [], 0

    def encode():
        for i, e in zip(of, t.encode_batch_fast(batch, add_special_tokens=False)):
            out[i] += len(e)
        batch.clear(), of.clear()

    for i, text in enumerate(texts):
        for p in pieces(text or "", batch_bytes):
            batch.append(p), of.append(i)
            held += len(p)
            if held >= batch_bytes:
                encode()
                held = 0
    encode()
    return out


def token_counts(df: DataFrame, path: str, text: str = "text", limit: int = 512,
                 keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep``, n_bytes, n_tokens, over_limit of every row."""
    names = [f"k{i}" for i in range(len(keep))]
    src = df.select(*[F.col(c).alias(n) for c, n in zip(keep, names)],
                    F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t"))
    src = src.withColumn("b", F.octet_length("t").cast("long"))

    def run(batches):
        for b in batches:
            for a in range(0, b.num_rows, 256):
                part = b.slice(a, 256)
                n = lengths(part.column("t").to_pylist(), path)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in names), part.column("b"), pa.array(n, pa.int64())],
                    names=[*names, "b", "n"])

    from pyspark.sql import types as T
    schema = T.StructType([*(f for f in src.schema.fields if f.name != "t"), T.StructField("n", T.LongType())])
    return src.mapInArrow(run, schema).select(
        *[F.col(n).alias(c) for c, n in zip(keep, names)], F.col("b").alias("n_bytes"), F.col("n").alias("n_tokens"),
        (F.col("n") > limit).alias("over_limit"))
