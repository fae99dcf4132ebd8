"""Quality rules with adaptive thresholds (operator 7, DataFrame functions only).

Per text the rules measure symbols per word character, repeated lines,
words in repeated 8-word windows, and mean word length, all as integers.  Each
measure of each (language, source) goes into a mergeable quantile sketch: a
count per bucket, buckets keeping the seven leading bits of the value, so a
quantile read from it is at most 1/64 below the true one and sketches merge by
adding counts, in any order, with the same result.

Sketches hold the texts that pass the base rule.  A group's fence is
``q75 + FENCE * (q75 - q25)``, and on the lower side ``q25 - FENCE * (q75 - q25)``.
No rate is fixed.  A source's fence is never wider than its language's and, but
for word length, a language's never wider than the corpus', so a source full of
junk does not lift its own limit (junk in over a quarter of a whole language
does).  A text is rejected by a rule if its count exceeds what the fence allows
for its size by at least the rule's smallest count plus the square root of the
size (of words, characters or lines): short texts need a larger rate.  Groups
under ``MIN_DOCS`` such texts use their language's sketch, languages under it
the whole corpus'.

Two texts with one word array have one result; windows are compared by a
64-bit hash within one text.  Defined results: null, empty and blank texts have
no words and fail the base rule; null language or source is a group of its
own; a group without a text that passes the base rule has no fence, and keeps
none; repeated rows count and are returned each; an empty table gives none.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loam.llm.common import BLANKS, stored, word_array

SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
FENCE = 3
MIN_DOCS = 200


class Rule(NamedTuple):
    count: str     # measure whose rate is bounded
    size: str      # per this measure
    unit: int      # rate: ``unit`` times count per size
    smallest: int  # least excess of the count that rejects, beside the root of the size
    both: bool     # has a lower fence too
    by_corpus: bool  # fences of languages stay within the corpus'


RULES = {
    "symbol_rate": Rule("n_symbols", "word_chars", 10_000, 10, False, True),
    "dup_line_rate": Rule("n_dup_lines", "n_lines", 10_000, 2, False, True),
    "repeat_rate": Rule("n_repeat_words", "n_words", 10_000, 2 * WINDOW, False, True),
    "word_length": Rule("word_chars", "n_words", 100, 50, True, False),
}


def _removed(c: Column, chars: str) -> Column:
    """How many characters of ``c`` are in ``chars``."""
    return F.length(c) - F.length(F.translate(c, chars, ""))


def measures(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` plus struct column ``m``: n_words, word_chars, n_symbols, n_lines,
    n_dup_lines, n_repeat_words (longs) and the rates of ``RULES``."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    lines = F.filter(F.split(t, "\n", -1), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    base = df.withColumns({"__w": word_array(t), "__l": lines, "__t": t})
    n = F.size("__w")
    hashes = F.expr(f"if(size(__w) < {WINDOW}, cast(array() as array<bigint>), "
                    f"transform(sequence(1, size(__w) - {WINDOW - 1}), i -> xxhash64(slice(__w, i, {WINDOW}))))")
    a = base.select(*df.columns, n.cast("long").alias("__n"),
                    (F.length("__t") - _removed(F.col("__t"), BLANKS)).cast("long").alias("__chars"),
                    _removed(F.col("__t"), SYMBOLS).cast("long").alias("__sym"),
                    F.size("__l").cast("long").alias("__lines"),
                    (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long").alias("__dup"),
                    hashes.alias("__h"))
    # only texts with an equal pair of windows go on: windows sorted by (hash, place)
    pairs = F.expr("if(size(array_distinct(__h)) = size(__h), null, "
                   "array_sort(transform(__h, (h, i) -> named_struct('h', h, 'i', i))))")
    b = a.withColumn("__s", pairs).drop("__h")
    places = F.expr("""if(__s is null, cast(array() as array<int>), array_sort(transform(filter(
        transform(sequence(0, size(__s) - 1), k -> named_struct('i', __s[k].i, 'd',
            (k > 0 and __s[greatest(k - 1, 0)].h = __s[k].h)
            or (k < size(__s) - 1 and __s[least(k + 1, size(__s) - 1)].h = __s[k].h))),
        x -> x.d), x -> x.i)))""")
    c = b.withColumn("__p", places).drop("__s")
    covered = F.expr(f"""if(size(__p) = 0, 0L, aggregate(sequence(0, size(__p) - 1), 0L, (s, k) -> s + if(
        k = size(__p) - 1, {WINDOW}, least({WINDOW}, __p[least(k + 1, size(__p) - 1)] - __p[k]))))""")
    d = c.withColumn("__rep", covered).drop("__p")
    words, chars, many = F.greatest("__n", F.lit(1)), F.greatest("__chars", F.lit(1)), F.greatest("__lines", F.lit(1))
    rate = lambda x, of, k=10_000: F.floor(F.col(x) * k / of)
    m = F.struct(F.col("__n").alias("n_words"), F.col("__chars").alias("word_chars"),
                 F.col("__sym").alias("n_symbols"), F.col("__lines").alias("n_lines"),
                 F.col("__dup").alias("n_dup_lines"), F.col("__rep").alias("n_repeat_words"),
                 rate("__sym", chars).alias("symbol_rate"), rate("__dup", many).alias("dup_line_rate"),
                 rate("__rep", words).alias("repeat_rate"), rate("__chars", words, 100).alias("word_length"))
    return d.select(*df.columns, m.alias("m"))


def base_failed(m: str = "m") -> Column:
    return (F.col(f"{m}.n_words") < MIN_WORDS) | (100 * F.col(f"{m}.n_repeat_words") > 30 * F.col(f"{m}.n_words"))


def sketch(measured: DataFrame, lang: str, source: str) -> DataFrame:
    """Bucket counts of the texts that pass the base rule: (lang, source, rule,
    lo, n); ``lo`` is the bucket's least value.  Merging two sketches is adding
    ``n`` per bucket."""
    # inside the generator, not a filter: pushed below ``measures`` it would repeat its nested expressions
    values = F.array(*[F.struct(F.lit(r).alias("rule"), F.col(f"m.{r}").alias("v")) for r in RULES])
    long = measured.select(F.col(lang).alias("lang"), F.col(source).alias("source"),
                           F.explode(F.when(~base_failed(), values)).alias("x"))
    lo = F.expr("shiftleft(shiftright(x.v, greatest(length(bin(x.v)) - 7, 0)), greatest(length(bin(x.v)) - 7, 0))")
    return long.groupBy("lang", "source", F.col("x.rule").alias("rule"), lo.alias("lo")).agg(F.count("*").alias("n"))


def _fences(s: DataFrame, keys: list[str]) -> DataFrame:
    """Fences of each group of ``keys`` from merged sketches, one row a group.

    A sketch has at most 128 + 64 * 57 buckets, so cumulating one is bounded."""
    merged = s.groupBy(*keys, "rule", "lo").agg(F.sum("n").alias("n"))
    packed = merged.groupBy(*keys, "rule").agg(F.array_sort(F.collect_list(F.struct("lo", "n"))).alias("b"),
                                               F.sum("n").alias("docs"))

    def quantile(num: int, den: int) -> Column:
        # the least bucket up to which num/den of the documents lie
        return F.expr(f"""aggregate(b, named_struct('c', 0L, 'q', cast(null as bigint)), (s, x) ->
            named_struct('c', s.c + x.n, 'q', if(s.q is null and (s.c + x.n) * {den} >= docs * {num}, x.lo, s.q))).q""")

    q = packed.withColumns({"q1": quantile(1, 4), "q3": quantile(3, 4)})
    spread = FENCE * (F.col("q3") - F.col("q1"))
    cols = [F.max("docs").alias("docs")]
    for r, rule in RULES.items():
        cols.append(F.max(F.when(F.col("rule") == r, F.col("q3") + spread)).alias(f"{r}_hi"))
        if rule.both:
            cols.append(F.max(F.when(F.col("rule") == r, F.col("q1") - spread)).alias(f"{r}_lo"))
    return q.groupBy(*keys).agg(*cols)


def thresholds(measured: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """One row per (lang, source): the fences that hold for it."""
    s = stored(sketch(measured, lang, source), "sketch")
    g = _fences(s, ["lang", "source"]).alias("g")
    by_lang = _fences(s, ["lang"]).alias("l")
    whole = _fences(s.withColumn("__all", F.lit(1)), ["__all"]).alias("a")
    own, known = F.col("g.docs") >= MIN_DOCS, F.col("l.docs") >= MIN_DOCS

    def pick(n: str, rule: Rule, narrow) -> Column:
        of_lang = narrow(F.col(f"l.{n}"), F.col(f"a.{n}")) if rule.by_corpus else F.col(f"l.{n}")
        outer = F.when(known, of_lang).otherwise(F.col(f"a.{n}"))
        return F.when(own, narrow(F.col(f"g.{n}"), outer)).otherwise(outer).alias(n)

    names = [pick(f"{r}_hi", x, F.least) for r, x in RULES.items()]
    names += [pick(f"{r}_lo", x, F.greatest) for r, x in RULES.items() if x.both]
    out = (g.join(by_lang, F.col("g.lang").eqNullSafe(F.col("l.lang")))
            .withColumn("__one", F.lit(1)).join(F.broadcast(whole), F.col("__one") == F.col("a.__all"))  # one row
            .select(F.col("g.lang").alias("lang"), F.col("g.source").alias("source"), *names))
    return stored(out, "fences")


def rejects(rule: str, m: str = "m", fences: str = "__f") -> Column:
    """The count lies beyond what the fence allows by the smallest count and the root of the size."""
    x = RULES[rule]
    count, size = F.col(f"{m}.{x.count}") * x.unit, F.col(f"{m}.{x.size}")
    margin = x.unit * (x.smallest + F.ceil(F.sqrt(size.cast("double"))))
    out = count - F.col(f"{fences}.{rule}_hi") * size >= margin
    return out | (F.col(f"{fences}.{rule}_lo") * size - count >= margin) if x.both else out


def verdicts(measured: DataFrame, fences: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """``measured`` plus base_failed and kept.  The fences are a written table;
    Spark joins them by their measured size (and splits a hot source if it
    must shuffle)."""
    ok = ~base_failed()
    for r in RULES:
        ok = ok & ~rejects(r)
    cols = measured.columns
    f = fences.select(F.col("lang").alias("__lang"), F.col("source").alias("__source"),
                      F.struct(*[c for c in fences.columns if c not in ("lang", "source")]).alias("__f"))
    j = measured.join(f, F.col(lang).eqNullSafe(F.col("__lang")) & F.col(source).eqNullSafe(F.col("__source")), "left")
    return j.select(*cols, base_failed().alias("base_failed"), F.coalesce(ok, F.lit(False)).alias("kept"))


def _short(df: DataFrame) -> tuple[DataFrame, list[str]]:
    names = [f"c{i}" for i in range(len(df.columns))]
    return df.toDF(*names), names


def judge(df: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
          carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``carry``, the measures ``m``, base_failed and kept per row."""
    src = df.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(carry)], F.col(lang).alias("g_lang"),
                    F.col(source).alias("g_source"), F.col(text).alias("g_text"))
    m = stored(measures(src, "g_text").drop("g_text"), "measures")
    v = verdicts(m, thresholds(m, "g_lang", "g_source"), "g_lang", "g_source")
    return v.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(carry)], "m", "base_failed", "kept")


def keep_good(df: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The rows of ``df`` that are kept, with its columns.  Texts are measured
    once and written with their measures; they are never dealt out."""
    src, names = _short(df)
    at = dict(zip(df.columns, names))
    m = stored(measures(src, at[text]), "measured")
    v = verdicts(m, thresholds(m, at[lang], at[source]), at[lang], at[source])
    return v.where("kept").select(*[F.col(n).alias(c) for c, n in at.items()])
