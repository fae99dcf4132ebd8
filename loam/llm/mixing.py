"""Mixing sources to target weights by iterative proportional fitting (operator 3).

The corpus becomes a table of token sums per (source, language, topic) cell.
Sources beyond the ``levels`` heaviest share the level ``OTHER``, so the cells
are at most ``(levels + 2) * (languages + 2) * topics`` (languages are levelled
likewise) and fit the driver by parameter.  The sums are raked: scaled to the
source, language and topic marginals in turn until all three hold.  A cell's
calibrated weight is raked tokens over tokens; a document is kept with
probability ``min(1, c * weight)``, ``c`` set so that the expected tokens are
``keep`` of the corpus.  The draw is a hash of the document, so the same
documents are kept on every run and after every retry.

Targets: shares per level, or by default the corpus' shares raised to
``flatten`` and normalised, which lifts small sources and languages.

Defined results: null source or language is a level of its own; null and blank
texts have 0 tokens and topic ``empty``, weigh 1 and are drawn with ``keep``; targets of
levels that the corpus lacks are spread over the others; repeated rows share
one draw; an empty table gives none.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loam.llm.common import BLANK_RUN, BLANKS, stored

OTHER, NONE = "\x00other", "\x00null"
LEVELS = 1000
#: Ordered topic rules over the whole text: the first with any of its strings names the topic.
TOPICS = [
    ("legal", ("icense", "ICENSE", "opyright", "OPYRIGHT", "rights reserved")),
    ("contact", ("@", "+1-", "+44", "Tel")),
    ("web", ("http://", "https://", "www.")),
    ("table", (" | ", "\t")),
    ("markup", ("**", "##", "$$", "%%", "&&", "<<", ">>")),
]


def n_words(text: Column) -> Column:
    """Words between ASCII white space."""
    t = F.btrim(text, F.lit(BLANKS))
    return F.when(t == "", 0).otherwise(F.size(F.split(t, BLANK_RUN, -1))).cast("long")


def topic(text: Column) -> Column:
    """Topic by the first rule that holds, else by length."""
    out = F.when(F.btrim(text, F.lit(BLANKS)) == "", "empty")
    for name, strings in TOPICS:
        found = F.lit(False)
        for x in strings:
            found = found | F.contains(text, F.lit(x))
        out = out.when(found, name)
    return out.when(F.octet_length(text) < 1000, "short").when(F.octet_length(text) < 5000, "medium").otherwise("long")


def rake(cells: np.ndarray, targets: list[np.ndarray], rounds: int = 200, tol: float = 1e-9) -> np.ndarray:
    """Scale ``cells`` until its sums along each axis are ``targets``
    (normalised to one total over the levels that have cells)."""
    out = cells.astype(float)
    total = out.sum()
    if total <= 0:
        return out
    goals = []
    for axis, t in enumerate(targets):
        have = out.sum(axis=tuple(i for i in range(out.ndim) if i != axis)) > 0
        goal = np.where(have, t, 0.0)
        goal = goal if goal.sum() > 0 else have.astype(float)
        goals.append(goal / goal.sum() * total)
    for _ in range(rounds):
        worst = 0.0
        for axis, goal in enumerate(goals):
            other = tuple(i for i in range(out.ndim) if i != axis)
            now = out.sum(axis=other)
            scale = np.divide(goal, now, out=np.ones_like(goal), where=now > 0)
            worst = max(worst, float(np.max(np.abs(now - goal)) / total))
            out = out * scale.reshape([-1 if i == axis else 1 for i in range(out.ndim)])
        if worst < tol:
            break
    return out


def probabilities(tokens: np.ndarray, raked: np.ndarray, keep: float) -> np.ndarray:
    """``min(1, c * raked / tokens)`` with expected tokens ``keep`` of all.

    Cells reach 1 in the order of their weight; between two of them the
    expectation is linear in ``c``, so ``c`` is found exactly."""
    weight = np.divide(raked, tokens, out=np.zeros_like(raked), where=tokens > 0).ravel()
    t = tokens.ravel().astype(float)
    goal = keep * t.sum()
    order = np.argsort(-weight, kind="stable")
    w, m = weight[order], t[order]
    full = np.concatenate([[0.0], np.cumsum(m)])
    rest = np.concatenate([np.cumsum((w * m)[::-1])[::-1], [0.0]])
    c = math.inf
    for k in range(len(w)):
        if rest[k] <= 0:
            break
        c = (goal - full[k]) / rest[k]
        if c * w[k] <= 1:
            break
        c = math.inf
    p = np.where(weight > 0, np.minimum(1.0, c * weight if math.isfinite(c) else 1.0), 1.0 if not math.isfinite(c) else 0.0)
    return p.reshape(tokens.shape)


def _levels(cells: DataFrame, col: str, levels: int) -> list[str]:
    """The ``levels`` heaviest values of ``col``: a bounded list."""
    top = cells.groupBy(col).agg(F.sum("tokens").alias("t")).orderBy(F.desc("t"), col).limit(levels)
    return [r[0] for r in top.collect()]


def draw(*cols: Column, seed: int) -> Column:
    """A number in [0, 1) that only the values decide."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *cols), 11) / F.lit(float(1 << 53))


def calibrate(described: DataFrame, keep: float, flatten: float = 0.7, targets: dict[str, dict[str, float]] | None = None,
              levels: int = LEVELS) -> tuple[DataFrame, dict[str, list[str]]]:
    """(s, l, topic, weight, prob) of every cell and the named levels, from rows
    with g_source, g_lang, topic and tokens."""
    spark = described.sparkSession
    sums = stored(described.groupBy("g_source", "g_lang", "topic").agg(F.sum("tokens").alias("tokens"),
                                                                       F.count("*").alias("docs")), "cells")
    axes = {"g_source": _levels(sums, "g_source", levels), "g_lang": _levels(sums, "g_lang", levels)}
    cells = [(r.s, r.l, r.topic, r.tokens) for r in _level(sums, axes).groupBy("s", "l", "topic")
             .agg(F.sum("tokens").alias("tokens")).collect()]  # bounded by levels
    names = [sorted({c[i] for c in cells}) for i in range(3)]
    at = [{v: i for i, v in enumerate(n)} for n in names]
    table = np.zeros([max(1, len(n)) for n in names])
    for s, lang, t, n in cells:
        table[at[0][s], at[1][lang], at[2][t]] = n
    goals = []
    for axis, key in enumerate(("source", "lang", "topic")):
        own = table.sum(axis=tuple(i for i in range(3) if i != axis))
        share = np.power(own, flatten)
        given = (targets or {}).get(key)
        goals.append(np.array([given.get(n, 0.0) for n in names[axis]]) if given else share / max(share.sum(), 1e-300))
    raked = rake(table, goals)
    prob = probabilities(table, raked, keep)
    rows = []
    for s, lang, t, n in cells:
        i = at[0][s], at[1][lang], at[2][t]
        rows.append((s, lang, t, float(raked[i] / n), float(prob[i])) if n else (s, lang, t, 1.0, float(keep)))
    out = spark.createDataFrame(rows, "s string, l string, topic string, weight double, prob double")
    return out, axes


def _level(df: DataFrame, axes: dict[str, list[str]]) -> DataFrame:
    return df.withColumns({n: F.when(F.col(c).isin(axes[c]) if axes[c] else F.lit(False), F.col(c)).otherwise(F.lit(OTHER))
                           for n, c in (("s", "g_source"), ("l", "g_lang"))})


def describe(df: DataFrame, text: str, lang: str, source: str, carry: tuple[str, ...]) -> DataFrame:
    """Carried columns as c0.., g_source, g_lang (null: a level), topic, tokens."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return df.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(carry)],
                     F.coalesce(F.col(source).cast("string"), F.lit(NONE)).alias("g_source"),
                     F.coalesce(F.col(lang).cast("string"), F.lit(NONE)).alias("g_lang"),
                     topic(t).alias("topic"), n_words(t).alias("tokens"))


def mix(df: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", id_col: str = "doc_id",
        keep: float = 0.7, seed: int = 11, carry: tuple[str, ...] = ("doc_id",), **fit) -> DataFrame:
    """Per row: the columns ``carry``, topic, tokens, weight, prob, kept.

    The draw hashes the id (null: the text); the calibrated cells are joined as
    a table whose size ``levels`` bounds."""
    names = [f"c{i}" for i in range(len(carry))]
    t = F.col(text).cast("string")
    key = F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("\x00"), F.coalesce(t, F.lit(""))))
    src = df.withColumn("__u", draw(key, seed=seed))
    d = stored(describe(src, text, lang, source, (*carry, "__u")), "described")
    cells, axes = calibrate(d, keep, **fit)
    cells = cells.withColumnsRenamed({"s": "s2", "l": "l2", "topic": "t2"})
    j = _level(d, axes).join(F.broadcast(cells), (F.col("s") == F.col("s2")) & (F.col("l") == F.col("l2"))
                             & (F.col("topic") == F.col("t2")))  # at most (levels + 2)^2 * topics rows
    return j.select(*[F.col(n).alias(c) for n, c in zip(names, carry)], "topic", "tokens", "weight", "prob",
                    (F.col(f"c{len(carry)}") < F.col("prob")).alias("kept"))


def sample(df: DataFrame, text: str = "text", **options) -> DataFrame:
    """The kept rows of ``df`` with its columns."""
    cols = df.columns
    safe = [f"x{i}" for i in range(len(cols))]
    at = dict(zip(cols, safe))
    pick = {k: at[options.pop(k, k if k != "id_col" else "doc_id")] for k in ("lang", "source", "id_col")}
    out = mix(df.toDF(*safe), text=at[text], carry=tuple(safe), **pick, **options)
    return out.where("kept").select(*[F.col(n).alias(c) for n, c in zip(safe, cols)])
