"""License scans (operator 1, DataFrame functions only).

A text becomes its words in one line, each after one space.  Rules are ordered
signatures: hand-written name patterns of license families, each in the
hand-written forms of ``FORMS`` (SPDX tag, grant, notice, title, bare name),
plus rules for whole phrases.  Gates: a text without any of ``GATE`` is done;
a rule's pattern runs only where its keyword stands, a word of
every match of it.  Every hit is an interval
of words with its form's priority; a hit contained in one of at least its own
priority is dropped (equal intervals and priorities: the first rule stays), so
``apache license version 2 0`` is one detection and not four.

All of it happens inside the row: nothing is shuffled, joined or exploded, and
the sweep over a text's sorted hits keeps one farthest end per priority.

Defined results: null, empty and wordless texts have no words, hits or labels;
each repeated row gets its own result; extra columns are not read; an empty
table gives none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loam.llm.common import lower_ascii

#: Fixed values of the contract: phrases and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: Words between runs of other ASCII characters; upper case is folded later.
_GAP = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
#: Every match of a rule holds one of these (any case), so a text with none of them is done; the tests prove it rule by rule.
GATE = ("licen", "released under", "distributed under", "available under", "provided under", "published under", "apache",
        "gpl", "bsd", "cddl", "eupl", "wtfpl", "beerware", "cc0", "cc by", "pddl", "sspl", "copyright", "public domain",
        "all rights reserved", "hereby granted", "permission to use", "redistribution", "can redistribute", "altered source",
        "unencumbered", "warrant")

_V = "(?: version| v)?"
#: (label, keyword, name pattern over words, standing alone it still means the license)
FAMILIES = [
    ("mit", "mit", "(?:the )?mit(?: x11| expat)?", False),
    ("x11", "x11", "x11", False),
    ("expat", "expat", "expat", False),
    ("apache-1.0", "apache", f"apache(?: software)?(?: license)?{_V} 1 0", True),
    ("apache-1.1", "apache", f"apache(?: software)?(?: license)?{_V} 1 1", True),
    ("apache-2.0", "apache", f"apache(?: software)?(?: license)?{_V} 2(?: 0)?", True),
    ("apache", "apache", "apache(?: software)?", False),
    ("gpl-1.0", "general", f"(?:gnu )?general public license{_V} 1(?: 0)?", True),
    ("gpl-2.0", "general", f"(?:gnu )?general public license{_V} 2(?: 0)?", True),
    ("gpl-3.0", "general", f"(?:gnu )?general public license{_V} 3(?: 0)?", True),
    ("gpl-2.0", "gplv2", "(?:gnu )?gplv2", True),
    ("gpl-3.0", "gplv3", "(?:gnu )?gplv3", True),
    ("gpl-2.0", "gpl", f"(?:gnu )?gpl{_V} 2(?: 0)?", True),
    ("gpl-3.0", "gpl", f"(?:gnu )?gpl{_V} 3(?: 0)?", True),
    ("gpl", "gpl", "(?:gnu )?gpl", True),
    ("gpl", "general", "(?:gnu )?general public", False),
    ("lgpl-2.1", "lesser", f"(?:gnu )?lesser general public license{_V} 2 1", True),
    ("lgpl-3.0", "lesser", f"(?:gnu )?lesser general public license{_V} 3(?: 0)?", True),
    ("lgpl-2.0", "library", f"(?:gnu )?library general public license{_V} 2(?: 0)?", True),
    ("lgpl", "lgpl", f"(?:gnu )?lgpl(?:{_V} [23](?: [01])?)?", True),
    ("lgpl", "lesser", "(?:gnu )?lesser general public", False),
    ("agpl-3.0", "affero", f"(?:gnu )?affero general public license{_V} 3(?: 0)?", True),
    ("agpl", "agpl", f"(?:gnu )?agpl(?:{_V} 3(?: 0)?)?", True),
    ("agpl", "affero", "(?:gnu )?affero general public", False),
    ("gfdl", "documentation", f"(?:gnu )?free documentation license(?:{_V} 1 [123])?", True),
    ("bsd-2-clause", "bsd", "(?:simplified bsd|bsd 2 clause|2 clause bsd)", True),
    ("bsd-3-clause", "bsd", "(?:new bsd|modified bsd|revised bsd|bsd 3 clause|3 clause bsd)", True),
    ("bsd-4-clause", "bsd", "(?:original bsd|bsd 4 clause|4 clause bsd)", True),
    ("0bsd", "0bsd", "0bsd", True),
    ("bsd", "bsd", "bsd", False),
    ("isc", "isc", "isc", False),
    ("mpl-1.0", "mozilla", f"mozilla public license{_V} 1 0", True),
    ("mpl-1.1", "mozilla", f"mozilla public license{_V} 1 1", True),
    ("mpl-2.0", "mozilla", f"mozilla public license{_V} 2(?: 0)?", True),
    ("mpl", "mpl", f"mpl(?:{_V} [12](?: [01])?)?", False),
    ("mpl", "mozilla", "mozilla public", False),
    ("epl-1.0", "eclipse", f"eclipse public license{_V} 1(?: 0)?", True),
    ("epl-2.0", "eclipse", f"eclipse public license{_V} 2(?: 0)?", True),
    ("epl", "eclipse", "eclipse public", False),
    ("edl-1.0", "eclipse", "eclipse distribution", False),
    ("cddl-1.0", "cddl", f"cddl(?:{_V} 1 [01])?", True),
    ("cddl-1.0", "development", "common development and distribution", False),
    ("cpl-1.0", "common", "common public", False),
    ("cpal-1.0", "attribution", "common public attribution", False),
    ("eupl-1.2", "eupl", f"eupl(?:{_V} 1 2)?", True),
    ("eupl-1.2", "european", "european union public", False),
    ("artistic-1.0", "artistic", f"artistic license{_V} 1(?: 0)?", True),
    ("artistic-2.0", "artistic", f"artistic license{_V} 2(?: 0)?", True),
    ("artistic", "artistic", "artistic", False),
    ("zlib", "zlib", "zlib(?: libpng)?", False),
    ("libpng", "libpng", "libpng", False),
    ("boost-1.0", "boost", "boost software", False),
    ("python-2.0", "python", "python(?: software foundation)?", False),
    ("php-3.01", "php", "php", False),
    ("ruby", "ruby", "ruby", False),
    ("perl", "perl", "perl", False),
    ("openssl", "openssl", "openssl", False),
    ("postgresql", "postgresql", "postgresql", False),
    ("ms-pl", "microsoft", "microsoft public", False),
    ("ms-rl", "microsoft", "microsoft reciprocal", False),
    ("ofl-1.1", "ofl", "(?:sil )?ofl(?: 1 [01])?", False),
    ("ofl-1.1", "font", "(?:sil )?open font", False),
    ("unlicense", "unlicense", "(?:the )?unlicense", True),
    ("wtfpl", "wtfpl", "wtfpl", True),
    ("beerware", "beerware", "beerware", True),
    ("cc0-1.0", "cc0", "cc0(?: 1 0)?", True),
    ("cc-by", "cc", "cc by(?: [1234] [05])?", True),
    ("cc-by-sa", "cc", "cc by sa(?: [1234] [05])?", True),
    ("cc-by-nd", "cc", "cc by nd(?: [1234] [05])?", True),
    ("cc-by-nc", "cc", "cc by nc(?: [1234] [05])?", True),
    ("cc-by-nc-sa", "cc", "cc by nc sa(?: [1234] [05])?", True),
    ("cc-by-nc-nd", "cc", "cc by nc nd(?: [1234] [05])?", True),
    ("cc-by", "creative", "creative commons attribution", False),
    ("cc-by-sa", "creative", "creative commons attribution share ?alike", False),
    ("cc-by-nd", "creative", "creative commons attribution no ?deriv(?:ative)?s", False),
    ("cc-by-nc", "creative", "creative commons attribution non ?commercial", False),
    ("cc-by-nc-sa", "creative", "creative commons attribution non ?commercial share ?alike", False),
    ("odbl-1.0", "database", "open (?:data commons open )?database", False),
    ("pddl-1.0", "pddl", "pddl", True),
    ("upl-1.0", "upl", "upl", False),
    ("ecl-2.0", "educational", "educational community", False),
    ("ncsa", "ncsa", "(?:university of illinois )?ncsa(?: open source)?", False),
    ("wxwindows", "wxwindows", "wxwindows(?: library)?", False),
    ("qpl-1.0", "q", "q public", False),
    ("sspl-1.0", "sspl", "sspl", True),
    ("busl-1.1", "business", "business source", False),
    ("proprietary", "proprietary", "proprietary", False),
    ("bsd-2-clause", "freebsd", "freebsd", True),
    ("0bsd", "zero", "zero clause bsd", True),
]
_LIC = "licen[cs]es?"
#: (form, priority: smaller wins, weight, pattern around the family's {name})
FORMS = [
    ("tag", 0, 1.0, "spdx license identifier {name}(?: or later| only)?"),
    ("grant", 1, 0.95, "(?:is |are )?(?:dual )?licensed (?:to you )?under (?:the )?(?:terms of (?:the )?)?{name}"
                       "(?: public)?(?: " + _LIC + ")?(?:" + _V + " \\d+(?: \\d+)?)?(?: or later)?"),
    ("release", 2, 0.9, "(?:released|distributed|available|provided|published) under (?:the )?(?:terms of (?:the )?)?"
                        "{name}(?: public)?(?: " + _LIC + ")?(?:" + _V + " \\d+(?: \\d+)?)?"),
    ("title", 3, 0.8, "{name} " + _LIC + "(?:" + _V + " \\d+(?: \\d+)?)?"),
]
#: (label, keyword, priority, weight, pattern): texts that name no family.
PHRASES = [
    ("mit", "hereby", 1, 0.95, "permission is hereby granted free of charge to any person obtaining a copy"),
    ("isc", "permission", 1, 0.9, "permission to use copy modify and or distribute this software for any purpose"),
    ("bsd", "redistribution", 1, 0.9, "redistribution and use in source and binary forms with or without modification"),
    ("apache-2.0", "compliance", 1, 0.9, "you may not use this file except in compliance with the license"),
    ("gpl", "redistribute", 2, 0.85, "you can redistribute it and or modify it under the terms of the gnu"),
    ("cc0-1.0", "waived", 1, 0.9, "waived all copyright and related or neighboring rights"),
    ("zlib", "altered", 1, 0.9, "altered source versions must be plainly marked as such"),
    ("unlicense", "unencumbered", 1, 0.95, "free and unencumbered software released into the public domain"),
    ("public-domain", "domain", 4, 0.7, "(?:released into|placed in|in|dedicated to) the public domain"),
    ("proprietary", "reserved", 4, 0.6, "all rights reserved"),
    ("no-warranty", "warranty", 5, 0.3, "without (?:any )?warranty(?: of any kind)?"),
    ("copyright", "copyright", 5, 0.3, "copyright(?: c)? \\d\\d\\d\\d(?: \\d\\d\\d\\d)?"),
    ("license-notice", "license", 5, 0.4, "(?:see|under|to) the license"),
    ("no-warranty", "warranties", 5, 0.3, "without (?:any )?warranties(?: of any kind)?"),
]


def rules() -> list[tuple[str, str, str, int, float, str]]:
    """(rule id, label, keyword, priority, weight, pattern) in order."""
    out = []
    for form, priority, weight, around in FORMS:
        for i, (label, keyword, name, _) in enumerate(FAMILIES):
            out.append((f"{form}-{label}-{i}", label, keyword, priority, weight, around.replace("{name}", f"(?:{name})")))
    for i, (label, keyword, name, alone) in enumerate(FAMILIES):
        if alone:
            out.append((f"name-{label}-{i}", label, keyword, 4, 0.7, name))
    for i, (label, keyword, priority, weight, pattern) in enumerate(PHRASES):
        out.append((f"phrase-{label}-{i}", label, keyword, priority, weight, pattern))
    return out


LEVELS = 6


def _spans(pattern: str, extra: str = "") -> str:
    """SQL for the word intervals of a pattern (an expression) in ``__n``: hits
    and the pieces between them are counted in words, each after one space."""
    words = lambda x: f"(octet_length({x}) - octet_length(replace({x}, ' ', '')))"
    hits, gaps = f"regexp_extract_all(__n, {pattern}, 0)", f"split(__n, {pattern}, -1)"
    return f"""if(not regexp_like(__n, {pattern}), {_NONE}, aggregate(
        zip_with({gaps}, {hits}, (g, h) -> named_struct('g', g, 'h', h)), named_struct('at', 0, 'out', {_NONE}),
        (s, x) -> if(x.h is null, s, named_struct('at', s.at + {words('x.g')} + {words('x.h')}, 'out',
            concat(s.out, array(named_struct('a', s.at + {words('x.g')}, 'z', -(s.at + {words('x.g')} + {words('x.h')} - 1)
                {extra})))))).out)"""


_NONE = "cast(array() as array<struct<a:int,z:int>>)"


def scan(df: DataFrame, text: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``carry`` and struct ``scan``: n_words, n_base, first_word, last_word,
    base_labels, labels (arrays), score, and ``hits``: the surviving detections
    (first and last word, rule, label, weight)."""
    cols = [f"c{i}" for i in range(len(carry))]
    df = df.select(*[F.col(c).alias(n) for c, n in zip(carry, cols)], F.col(text).alias("text"))
    text = "text"
    raw = F.btrim(F.regexp_replace(F.coalesce(F.col(text).cast("string"), F.lit("")), _GAP, " "))
    a = df.select(*cols, raw.alias("__r"))
    n_words = F.when(F.col("__r") == "", 0).otherwise(
        F.octet_length("__r") - F.octet_length(F.replace(F.col("__r"), F.lit(" "), F.lit(""))) + 1)
    low = F.lower("__r")
    gate = F.lit(False)
    for g in GATE:
        gate = gate | F.contains(F.col("__low"), F.lit(g))
    b = (a.select(*cols, n_words.cast("long").alias("__words"), low.alias("__low"), "__r")
          .select(*cols, "__words", F.when(gate, F.concat(F.lit(" "), lower_ascii(F.col("__r")), F.lit(" "))).alias("__n")))
    # base phrases: words standing consecutively
    base = []
    for phrase, label in BASE.items():
        base.append(f"if(contains(__n, ' {phrase} '), transform({_spans(f_quote(' ' + phrase + '(?= )'))}, "
                    f"x -> named_struct('a', x.a, 'l', '{label}')), cast(array() as array<struct<a:int,l:string>>))")
    c = b.withColumn("__b", F.when(F.col("__n").isNotNull(), F.expr(f"concat({', '.join(base)})")))
    # rules: keyword first, then the pattern; hits sort by (start, longest, priority, rule)
    table = ", ".join(f"named_struct('r', {i}, 'k', ' {k} ', 'p', {p}, 'x', {f_quote(' (?:' + x + ')(?= )')})"
                      for i, (_, _, k, p, _, x) in enumerate(rules()))
    found = f"""array_sort(flatten(transform(filter(array({table}), q -> contains(__n, q.k)), q ->
        transform({_spans('q.x')}, h -> named_struct('a', h.a, 'z', h.z, 'p', q.p, 'r', q.r)))))"""
    d = c.withColumn("__h", F.when(F.col("__n").isNotNull(), F.expr(found)))
    ends = ", ".join(["-1"] * LEVELS)
    kept = "cast(array() as array<struct<first:int,last:int,r:int>>)"
    reach = ", ".join(f"if(h.p <= {p}, greatest(s.e[{p}], -h.z), s.e[{p}])" for p in range(LEVELS))
    # e[p]: farthest end so far among hits of priority up to p
    sweep = f"""aggregate(__h, named_struct('e', array({ends}), 'out', {kept}), (s, h) -> named_struct(
        'e', array({reach}), 'out', if(s.e[h.p] >= -h.z, s.out,
            concat(s.out, array(named_struct('first', h.a, 'last', -h.z, 'r', h.r)))))).out"""
    e = d.withColumn("__k", F.when(F.size("__h") > 0, F.expr(sweep)))
    label = "array(" + ", ".join(f"'{r[1]}'" for r in rules()) + ")"
    weight = "array(" + ", ".join(f"cast({r[4]} as double)" for r in rules()) + ")"
    name = "array(" + ", ".join(f"'{r[0]}'" for r in rules()) + ")"
    hits = F.expr(f"transform(__k, k -> named_struct('first_word', k.first, 'last_word', k.last, 'rule', {name}[k.r], "
                  f"'label', {label}[k.r], 'weight', {weight}[k.r]))")
    f = e.withColumn("__hits", F.when(F.size("__k") > 0, hits))
    none = F.array().cast("array<string>")
    base_labels = F.coalesce(F.expr("array_sort(array_distinct(transform(__b, x -> x.l)))"), none)
    labels = F.array_sort(F.array_union(base_labels, F.coalesce(F.expr("transform(__hits, h -> h.label)"), none)))
    score = F.greatest(F.coalesce(F.expr("array_max(transform(__hits, h -> h.weight))"), F.lit(0.0)),
                       F.when(F.size("__b") > 0, F.lit(0.5)).otherwise(F.lit(0.0)))
    return f.select(*[F.col(n).alias(c) for n, c in zip(cols, carry)], F.struct(
        F.col("__words").alias("n_words"), F.when(F.col("__b").isNotNull(), F.size("__b")).otherwise(0).cast("long").alias("n_base"),
        F.expr("array_min(transform(__b, x -> x.a))").cast("long").alias("first_word"),
        F.expr("array_max(transform(__b, x -> x.a))").cast("long").alias("last_word"),
        base_labels.alias("base_labels"), labels.alias("labels"), score.alias("score"),
        F.col("__hits").alias("hits")).alias("scan"))


def f_quote(pattern: str) -> str:
    """A SQL string literal of a pattern."""
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def joined(c: Column) -> Column:
    return F.array_join(c, ",")
