"""Brute-force versions of the operators that work on one text at a time."""

from __future__ import annotations

import math
import re
from collections import Counter
from itertools import product

import pytest
from pyspark.sql import functions as F

from loam.llm import licenses, quality, tokens
from loam.llm.queries import tokenizer_path

BLANK = re.compile(r"[^\x20\x09-\x0D]+")


def by_text(rows):
    out = {}
    for text, got in rows:
        out.setdefault(text, []).append(got)
    return out


# -- licenses -------------------------------------------------------------------------------------------------

def scan_text(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    base = [(i, label) for phrase, label in licenses.BASE.items() for i in range(len(words))
            if words[i:i + len(phrase.split())] == phrase.split()]
    line = " " + " ".join(words) + " "
    hits = []
    if words:
        for n, (_, label, key, priority, weight, pattern) in enumerate(licenses.rules()):
            if f" {key} " in line:
                for x in re.finditer(f" (?:{pattern})(?= )", line):
                    first = line[:x.start()].count(" ")
                    hits.append((first, first + x.group().count(" ") - 1, priority, n, label, weight))
    kept = [h for h in hits if not any(
        e is not h and e[0] <= h[0] and h[1] <= e[1] and e[2] <= h[2]
        and (e[2] < h[2] or e[:2] != h[:2] or e[3] < h[3]) for e in hits)]
    gated = any(g in line.strip() for g in licenses.GATE)
    kept = kept if gated else []
    labels = sorted({h[4] for h in kept} | {x for _, x in base})
    score = max([h[5] for h in kept] + ([0.5] if base else []) + [0.0])
    return (len(words), len(base), min((i for i, _ in base), default=None), max((i for i, _ in base), default=None),
            sorted({x for _, x in base}), labels, score)


@pytest.mark.parametrize("which", ["docs", "real_docs"])
def test_license_scan(which, request):
    df = request.getfixturevalue(which)
    rows = licenses.scan(df, carry=("text",)).select("text", F.col("scan").alias("s")).collect()
    assert len(rows) == df.count()
    for text, s in rows:
        want = scan_text(text)
        assert (s.n_words, s.n_base, s.first_word, s.last_word, s.base_labels, s.labels, pytest.approx(s.score)) == want, text


def test_license_rules_are_many_and_distinct():
    r = licenses.rules()
    assert len(r) > 300 and len({x[0] for x in r}) == len(r)
    assert all(0 <= x[3] < licenses.LEVELS for x in r)


def shortest(parsed):
    """All texts a parsed pattern matches with every optional part left out."""
    out = [""]
    for op, of in parsed:
        name = str(op)
        if name == "LITERAL":
            more = [chr(of)]
        elif name == "IN":
            more = ["0"] if str(of[0][0]) == "CATEGORY" else [chr(c) for k, c in of if str(k) == "LITERAL"] or [chr(of[0][1][0])]
        elif name == "MAX_REPEAT":
            more = ["".join(x) for x in product(*[shortest(of[2])] * of[0])]
        elif name == "BRANCH":
            more = [x for branch in of[1] for x in shortest(branch)]
        else:
            assert name == "SUBPATTERN"
            more = shortest(of[3])
        out = [a + b for a in out for b in more]
    return out


def test_license_gates_lose_no_match():
    for _, label, key, _, _, pattern in licenses.rules():
        for text in shortest(re._parser.parse(pattern)):
            assert re.fullmatch(pattern, text)
            assert f" {key} " in f" {text} " and any(g in text for g in licenses.GATE), (label, text)


def test_license_texts_without_the_word_license(spark):
    want = {"Distributed under Apache 2.0": "apache-2.0", "released under the MPL 2.0": "mpl", "available under MIT": "mit",
            "BSD 3-Clause": "bsd-3-clause", "WTFPL": "wtfpl", "Beerware": "beerware", "CDDL 1.1": "cddl-1.0",
            "EUPL 1.2": "eupl-1.2", "SSPL": "sspl-1.0", "0BSD": "0bsd", "zero clause BSD": "0bsd", "FreeBSD": "bsd-2-clause",
            "you can redistribute it and/or modify it under the terms of the GNU": "gpl", "without warranties": "no-warranty",
            "altered source versions must be plainly marked as such": "zlib", "come without any warranty": "no-warranty",
            "Permission is hereby granted, free of charge, to any person obtaining a copy": "mit"}
    df = spark.createDataFrame([(f"It is {t} here.",) for t in want], "text string")
    got = {r.text[6:-6]: r.scan.labels for r in licenses.scan(df, carry=("text",)).collect()}
    assert {t: x for t, x in got.items() if want[t] not in x} == {}


def test_license_containment(spark):
    df = spark.createDataFrame([("licensed under the Apache License, Version 2.0 for all",)], "text string")
    hits = licenses.scan(df, carry=()).select(F.explode("scan.hits").alias("h")).select("h.*").collect()
    assert {h.label for h in hits} == {"apache-2.0"} and hits[0].first_word == 0


def test_license_many_hits(spark):
    df = spark.createDataFrame([("MIT license. " * 3000,)], "text string")
    s = licenses.scan(df, carry=()).first().scan
    assert (s.n_base, s.first_word, s.last_word) == (3000, 0, 5998)


# -- quality --------------------------------------------------------------------------------------------------

def measure(text):
    text = text or ""
    words = BLANK.findall(text)
    lines = [x for x in text.split("\n") if BLANK.search(x)]
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1 for j in range(i, i + 8)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines),
            len(lines) - len(set(lines)), len(covered))


def quality_row(text, lang, source):
    n, chars, sym, lines, dup, rep = measure(text)
    return {"lang": lang, "source": source, "n_words": n, "word_chars": chars, "n_symbols": sym, "n_lines": lines,
            "n_dup_lines": dup, "n_repeat_words": rep, "base_failed": n < 20 or 100 * rep > 30 * n,
            "symbol_rate": sym * 10000 // max(chars, 1), "dup_line_rate": dup * 10000 // max(lines, 1),
            "repeat_rate": rep * 10000 // max(n, 1), "word_length": chars * 100 // max(n, 1)}


def fences(rows):
    """Fences of each row's (lang, source) from sorted values of the texts that
    pass the base rule, floored to seven leading bits; None: no such text."""
    def low(v):
        s = max(v.bit_length() - 7, 0)
        return v >> s << s

    def of(group):
        out = {}
        for rule in quality.RULES:
            v = sorted(low(r[rule]) for r in group)
            q1, q3 = v[-(-len(v) // 4) - 1], v[-(-3 * len(v) // 4) - 1]
            out[rule] = (q3 + 3 * (q3 - q1), q1 - 3 * (q3 - q1))
        return out

    def within(inner, outer, rules):
        return {k: (min(inner[k][0], outer[k][0]), max(inner[k][1], outer[k][1])) if k in rules else inner[k] for k in inner}

    good = [x for x in rows if not x["base_failed"]]
    cache = {}

    def pick(lang, source):
        own = [x for x in good if (x["lang"], x["source"]) == (lang, source)]
        if not own:
            return None
        of_lang = [x for x in good if x["lang"] == lang]
        outer = of(good)
        if len(of_lang) >= quality.MIN_DOCS:
            outer = within(of(of_lang), outer, ("symbol_rate", "dup_line_rate", "repeat_rate"))
        return within(of(own), outer, quality.RULES) if len(own) >= quality.MIN_DOCS else outer

    for r in rows:
        k = r["lang"], r["source"]
        if k not in cache:
            cache[k] = pick(*k)
    return [cache[r["lang"], r["source"]] for r in rows]


def broken(x, f):
    """Rules that a row breaks, each by its count against what its fence allows."""
    out = set()
    for rule, (count, size, unit, least) in {
            "symbol_rate": ("n_symbols", "word_chars", 10000, 10), "dup_line_rate": ("n_dup_lines", "n_lines", 10000, 2),
            "repeat_rate": ("n_repeat_words", "n_words", 10000, 16), "word_length": ("word_chars", "n_words", 100, 50)}.items():
        margin = least + math.ceil(math.sqrt(x[size]))
        if x[count] * unit - f[rule][0] * x[size] >= unit * margin or (
                rule == "word_length" and f[rule][1] * x[size] - x[count] * unit >= unit * margin):
            out.add(rule)
    return out


def quality_verdicts(rows):
    return [not x["base_failed"] and not broken(x, f) for x, f in zip(rows, fences(rows))]


@pytest.mark.parametrize("which", ["docs", "real_docs", "sf01"])
def test_quality(which, request, spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet") if which == "sf01" else request.getfixturevalue(which)
    got = quality.judge(df, carry=("text", "lang", "source")).collect()
    assert len(got) == df.count()
    rows = [quality_row(r.text, r.lang, r.source) for r in got]
    for r, x, kept in zip(got, rows, quality_verdicts(rows)):
        assert all(r.m[c] == x[c] for c in ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")), r.text
        assert r.base_failed == x["base_failed"]
        assert r.kept == kept


def plain(i, words=120):
    return "\n".join(" ".join(f"w{(i * 131 + j * 17 + j * j) % 9973:04d}" for j in range(a, a + 12)) for a in range(0, words, 12))


def test_quality_each_rule_alone(spark):
    base = plain(7, 240)
    lines = base.split("\n")
    odd = {"symbol_rate": base.replace("w", "#", 120), "dup_line_rate": "\n".join(lines + ["short"] * 12),
           "repeat_rate": base + "\n" + " ".join(" ".join(lines[:3]).split()) + " end",
           "word_length": base.replace("w", "wwwwww")}
    rows = [(plain(i), "en", f"s{i % 2}") for i in range(500)] + [(t, "en", "s0") for t in odd.values()]
    df = spark.createDataFrame(rows, "text string, lang string, source string")
    got = quality.judge(df, carry=("text", "lang", "source")).collect()
    kept = {r.text: r.kept for r in got}
    measured = [quality_row(*r) for r in rows]
    alone = dict(zip([r[0] for r in rows], (broken(x, f) for x, f in zip(measured, fences(measured)))))
    for rule, t in odd.items():
        assert alone[t] == {rule} and not kept[t], rule
        assert not {r.text: r.base_failed for r in got}[t]
    assert all(kept[t] for t, _, _ in rows[:500])


def test_quality_junk_does_not_lift_its_fence(spark):
    """Half of one source is symbol spam: its own quartiles would let all of it pass."""
    spam = [plain(i).replace("w", "#", 60) for i in range(250)]
    rows = [(t, "en", "junk") for t in spam] + [(plain(1000 + i), "en", "junk") for i in range(250)]
    rows += [(plain(2000 + i), "en", f"s{i % 4}") for i in range(1200)]
    df = spark.createDataFrame(rows, "text string, lang string, source string")
    got = quality.judge(df, carry=("text",)).collect()
    assert not any(r.kept for r in got if r.text in set(spam))
    assert all(r.kept for r in got if r.text not in set(spam))


def test_quality_fence_follows_the_data(spark):
    """The same text is ordinary where a quarter of the texts hold as many symbols, and spam elsewhere."""
    code = [plain(i).replace("w", "#", 20 + i % 30) for i in range(300)]
    rows = [(t, "code", "git") for t in code] + [(plain(3000 + i), "en", "web") for i in range(300)] + [(code[29], "en", "web")]
    rows += [(plain(5000 + i).replace("w", "#", 20 + i % 30), "code", "git2") for i in range(300)]
    df = spark.createDataFrame(rows, "text string, lang string, source string")
    got = quality.judge(df, carry=("text", "lang")).collect()
    assert not [r for r in got if r.text == code[29] and r.lang == "en"][0].kept
    assert all(r.kept for r in got if r.lang == "code")


def test_quality_group_without_a_good_text(spark):
    rows = [("two words", "en", "a"), (None, "en", "a"), (plain(1), "en", "b")]
    got = quality.judge(spark.createDataFrame(rows, "text string, lang string, source string"), carry=("source",)).collect()
    assert sorted((r.source, r.kept) for r in got) == [("a", False), ("a", False), ("b", True)]


def test_quality_stage_keeps_columns(docs):
    out = quality.keep_good(docs)
    assert out.columns == docs.columns and 0 < out.count() < docs.count()


def test_sketches_merge(real_docs):
    m = quality.measures(real_docs)
    whole = quality.sketch(m, "lang", "source")
    parts = quality.sketch(m.where("doc_id % 3 = 0"), "lang", "source").unionByName(
        quality.sketch(m.where("doc_id % 3 <> 0"), "lang", "source"))
    merged = parts.groupBy("lang", "source", "rule", "lo").agg(F.sum("n").alias("n"))
    assert merged.exceptAll(whole).count() == 0 and whole.exceptAll(merged).count() == 0


# -- token counts ---------------------------------------------------------------------------------------------

@pytest.mark.parametrize("which", ["docs", "real_docs"])
def test_token_counts(which, request):
    from tokenizers import Tokenizer
    df = request.getfixturevalue(which)
    path = tokenizer_path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    rows = tokens.token_counts(df, path, keep=("text", "kept" if which == "docs" else "lang")).collect()
    assert len(rows) == df.count()
    for r in rows:
        n = len(t.encode(r.text or "", add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((r.text or "").encode()), n, n > 512)


def test_token_pieces_are_safe(texts):
    path = tokenizer_path("byte_bpe_50k.json")
    for text in [*texts, "ab <|endoftext|> cd 12 x  yy\n zz " * 40]:
        if text:
            assert "".join(tokens.pieces(text, 17)) == text
            assert tokens.lengths([text], path, 17) == tokens.lengths([text], path)


def test_empty_tables(no_docs):
    assert licenses.scan(no_docs).count() == 0
    assert quality.judge(no_docs).count() == 0
    assert quality.keep_good(no_docs).count() == 0
    assert tokens.token_counts(no_docs, tokenizer_path("byte_bpe_50k.json")).count() == 0
