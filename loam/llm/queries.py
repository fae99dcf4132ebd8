"""Registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loam.llm import (decontamination, licenses, lm, mixing, packing, quality, sharding, simhash, spelling, tokens, vectors, warc,
                      whitening)
from loam.session import read_table, scratch_path

#: The token id that ends a packed document.
PACK_END = 1


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = licenses.scan(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return s.select("doc_id", *[F.col(f"scan.{c}").alias(c) for c in ("n_words", "n_base", "first_word", "last_word")],
                    licenses.joined(F.col("scan.base_labels")).alias("base_labels"),
                    licenses.joined(F.col("scan.labels")).alias("labels"), F.col("scan.score").alias("score"))


def op2_simhash_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = simhash.simhash_groups(read_table(spark, sf_dir, "documents"))
    return g.select("doc_id", simhash.hex16(F.col("fp")).alias("fingerprint"), "component_id")


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents"), carry=("doc_id", "source", "lang"))


def op4_maxent_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(read_table(spark, sf_dir, "documents"))


def op5_certified_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), end=PACK_END)


def op6_embedding_pca_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(read_table(spark, sf_dir, "embeddings"))


def op7_adaptive_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = quality.judge(read_table(spark, sf_dir, "documents"))
    return j.select("doc_id", *[F.col(f"m.{c}").alias(c) for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")], "base_failed", "kept")


def op8_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "warc")
    index = warc.write(read_table(spark, sf_dir, "pages"), folder)
    return warc.read(index, folder, payloads=False).drop("payload")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(read_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op10_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = sharding.place(read_table(spark, sf_dir, "documents"))
    return p.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                    F.lit(None).cast("int").alias("grown_shard"))


def op11_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = decontamination.matches(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    ids = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return m.select(
        F.col("doc").alias("doc_id"), "n_words", decontamination.covered(F.col("spans")).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"), "n_near")


def op12_spelling_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.misspelt_counts(read_table(spark, sf_dir, "documents")))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_license_scan, op2_simhash_pivots, op3_source_mixing, op4_maxent_scoring, op5_certified_packing,
    op6_embedding_pca_tiles, op7_adaptive_quality, op8_warc_index, op9_token_counts, op10_minimax_shards,
    op11_benchmark_decontamination, op12_spelling_chunks, op13_embedding_whitening)}

# -- SQL of the queries that SQL can express ------------------------------------------------------------------

_OP6 = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
), good AS (
  SELECT * FROM v WHERE e IS NOT NULL AND list_count(e) = len(e) AND len(e) > 0
    AND len(list_filter(e, lambda x: NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0
), link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a, good b
  WHERE a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.95
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a
), comp AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
deg AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM v JOIN comp ON comp.a = vec_id LEFT JOIN deg ON deg.a = vec_id
"""

_RATES = ("symbol_rate", "dup_line_rate", "repeat_rate", "word_length")


def _op7() -> str:
    spread = f"{quality.FENCE} * (q3 - q1)"
    fence, picks, bad = [], [], []
    for r, x in quality.RULES.items():
        for side, at, narrow in (("hi", f"q3 + {spread}", "least"), ("lo", f"q1 - {spread}", "greatest")):
            if side == "lo" and not x.both:
                continue
            n = f"{r}_{side}"
            fence.append(f"max(CASE WHEN rule = '{r}' THEN {at} END) AS {n}")
            of_lang = f"{narrow}(l.{n}, a.{n})" if x.by_corpus else f"l.{n}"
            outer = f"CASE WHEN l.docs >= {quality.MIN_DOCS} THEN {of_lang} ELSE a.{n} END"
            picks.append(f"CASE WHEN g.docs >= {quality.MIN_DOCS} THEN {narrow}(g.{n}, {outer}) ELSE {outer} END AS {n}")
            over = f"{x.count} * {x.unit} - {n} * {x.size}" if side == "hi" else f"{n} * {x.size} - {x.count} * {x.unit}"
            bad.append(f"{over} >= {x.unit} * ({x.smallest} + ceil(sqrt({x.size})))")
    pick, ok = ", ".join(picks), " AND ".join(f"NOT ({x})" for x in bad)

    def level(name: str, lang: str, source: str) -> str:
        return f"""{name}_s AS (SELECT {lang} AS lang, {source} AS source, rule, lo, sum(n) AS n FROM sk GROUP BY ALL),
{name}_c AS (SELECT *, sum(n) OVER (PARTITION BY lang, source, rule ORDER BY lo) AS upto,
             sum(n) OVER (PARTITION BY lang, source, rule) AS docs FROM {name}_s),
{name}_q AS (SELECT lang, source, rule, max(docs) AS docs, min(CASE WHEN upto * 4 >= docs THEN lo END) AS q1,
             min(CASE WHEN upto * 4 >= docs * 3 THEN lo END) AS q3 FROM {name}_c GROUP BY ALL),
{name} AS (SELECT lang, source, max(docs) AS docs, {", ".join(fence)} FROM {name}_q GROUP BY lang, source)"""

    longs = " UNION ALL ".join(f"SELECT lang, source, '{r}' AS rule, {r} AS v FROM mb WHERE NOT base_failed" for r in _RATES)
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), win AS (
  SELECT rid, i, array_to_string(w[i:i + 7], ' ') AS g FROM (SELECT rid, w, unnest(range(1, len(w) - 6)) AS i FROM d)
), twice AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM win) WHERE c > 1
), rep AS (
  SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(i, i + 8)) AS p FROM twice) GROUP BY rid
), line AS (
  SELECT rid, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d
), b AS (
  SELECT d.rid, doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(l) AS BIGINT) AS n_lines, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words
  FROM d JOIN line USING (rid) LEFT JOIN rep USING (rid)
), m AS (
  SELECT *, n_symbols * 10000 // greatest(word_chars, 1) AS symbol_rate,
         n_dup_lines * 10000 // greatest(n_lines, 1) AS dup_line_rate,
         n_repeat_words * 10000 // greatest(n_words, 1) AS repeat_rate,
         word_chars * 100 // greatest(n_words, 1) AS word_length FROM b
), mb AS (SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m),
x AS ({longs}),
sk AS (
  SELECT lang, source, rule, (v >> greatest(length(bin(v)) - 7, 0)) << greatest(length(bin(v)) - 7, 0) AS lo,
         count(*) AS n FROM x GROUP BY ALL
), {level("g", "lang", "source")},
{level("l", "lang", "NULL")},
{level("a", "NULL", "NULL")},
f AS (SELECT g.lang, g.source, {pick} FROM g JOIN l ON g.lang IS NOT DISTINCT FROM l.lang CROSS JOIN a)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       coalesce(NOT base_failed AND {ok}, false) AS kept
FROM mb LEFT JOIN f ON mb.lang IS NOT DISTINCT FROM f.lang AND mb.source IS NOT DISTINCT FROM f.source
"""


_BIT = "CAST(substr(bits, CAST(5 * i + {k} AS BIGINT), 1) AS BIGINT)"
_OP8 = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
s AS (SELECT *, sha1(h) AS x, min(page_id) OVER (PARTITION BY h) AS first FROM p),
t AS (SELECT *, array_to_string(list_transform(range(1, 41), lambda i: substr('0000000100100011010001010110011110001001101010111100110111101111',
        CAST(4 * (strpos('0123456789abcdef', substr(x, CAST(i AS BIGINT), 1)) - 1) + 1 AS BIGINT), 4)), '') AS bits FROM s)
SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + {" + ".join(f"{16 >> k} * " + _BIT.format(k=k + 1) for k in range(5))}, 1)), '') AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM t
"""

_WORDS = ("regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')")
_OP11 = f"""
WITH b AS (SELECT item_id, w, least(len(w), {decontamination.WINDOW}) AS k FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, k, w[i:i + k - 1] AS g FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS i FROM b)),
d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS w FROM documents),
dw AS (SELECT rid, k, i, w[i:i + k - 1] AS g FROM (SELECT rid, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM win))),
hit AS (SELECT rid, item_id, i, dw.k FROM dw JOIN win ON dw.g = win.g AND dw.k = win.k),
cov AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(i, i + k)) AS p FROM hit) GROUP BY rid),
it AS (SELECT rid, count(DISTINCT item_id) AS n, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS s
       FROM hit GROUP BY rid),
-- proximity: the rarest distinct words of a window all of whose words occur, near a place of the rarest
place AS (SELECT rid, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS t FROM d),
freq AS (SELECT t, count(*) AS c FROM place GROUP BY t),
grid AS (SELECT g, unnest(range(1, len(g) + 1)) AS o, unnest(g) AS t FROM (SELECT DISTINCT g FROM win)),
term AS (SELECT grid.g, grid.t, min(grid.o) AS o, any_value(c) AS c FROM grid LEFT JOIN freq USING (t) GROUP BY grid.g, grid.t),
full_ AS (SELECT g FROM term GROUP BY g HAVING count(*) = count(c)),
rare AS (SELECT g, t, row_number() OVER (PARTITION BY g ORDER BY c, o) AS r FROM term JOIN full_ USING (g)),
trio AS (SELECT g, max(CASE WHEN r = 1 THEN t END) AS t1, max(CASE WHEN r = 2 THEN t END) AS t2, max(CASE WHEN r = 3 THEN t END) AS t3
         FROM rare GROUP BY g),
sets AS (SELECT DISTINCT t1, t2, t3 FROM trio),
p1 AS (SELECT DISTINCT rid, p, t1, t2, t3 FROM place JOIN sets ON t = t1),
p2 AS (SELECT DISTINCT p1.* FROM p1 JOIN place x ON x.rid = p1.rid AND x.t = t2 AND abs(x.p - p1.p) <= {decontamination.NEAR}
       UNION SELECT * FROM p1 WHERE t2 IS NULL),
p3 AS (SELECT DISTINCT p2.* FROM p2 JOIN place x ON x.rid = p2.rid AND x.t = t3 AND abs(x.p - p2.p) <= {decontamination.NEAR}
       UNION SELECT * FROM p2 WHERE t3 IS NULL),
near AS (SELECT rid, count(DISTINCT item_id) AS n FROM (SELECT DISTINCT rid, t1, t2, t3 FROM p3) q
         JOIN trio ON trio.t1 = q.t1 AND trio.t2 IS NOT DISTINCT FROM q.t2 AND trio.t3 IS NOT DISTINCT FROM q.t3
         JOIN win ON win.g = trio.g GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(cov.n, 0) AS n_hit, coalesce(it.n, 0) AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, cov.n IS NOT NULL AS contaminated, coalesce(near.n, 0) AS n_near
FROM d LEFT JOIN cov USING (rid) LEFT JOIN it USING (rid) LEFT JOIN near USING (rid)
"""

ORACLE: dict[str, str] = {"op6_embedding_pca_tiles": _OP6, "op7_adaptive_quality": _op7(), "op8_warc_index": _OP8,
                          "op11_benchmark_decontamination": _OP11}
