import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"

DOCS = ("doc_id long, text string, lang string, source string, n_chars long, "
        "shard int, slot string, m string, scan string, uid long, t string, fp long, g_lang string, c0 string, kept int, __w int")


@pytest.fixture(scope="session")
def texts():
    """Hand-made texts: null, empty, blank, one word, ties, copies, a very long
    one, repeated windows, other scripts, odd white space, special strings."""
    prose = "It was a plain day and the people of the town went about their work as they had always done before. "
    long = " ".join(f"w{i % 977}x{i % 31}" for i in range(60_000))
    story = ("Once the river had gone down, people from both banks met at the old mill to count what was left. "
             "Some brought bread, others carried tools, and a few children kept a list of every broken fence. "
             "By evening most gates stood again, though nobody could say where the ferry now lay.")
    rep = "one two three four five six seven eight nine ten " * 3
    return [
        None, "", " \t\n\x0b\f\r ", "word", story, story, story + " Then it rained hard.", long, rep,
        rep + prose, "a\nb\na\n \na\n\nB", "École à l'été déjà vu naïve çà et là — 東京 東京 tower 🙂 end",
        "x\x1cy z w \x85 v", "<|endoftext|> and <|ENDOFTEXT|> or <|startoftext|>x, y. Z.",
        "Released under the MIT License. MIT license MIT LICENSE; mit-license", "Apache License, Version 2.0 applies",
        "SPDX-License-Identifier: GPL-3.0 or the GNU General Public License, version 3. All rights reserved",
        "### $$$ %%% ||| &&& <b> *** " * 9, "a" * 5000, "\r\n".join(["same line here"] * 30), "word", "WORD",
    ]


@pytest.fixture(scope="session")
def docs(spark, texts):
    rows = []
    for i, t in enumerate(texts):
        rows.append((i * 3 if i % 7 != 5 else None, t, [None, "en", "de"][i % 3], ["src", None, "src2", "src"][i % 4], 0,
                     1, "s", "m", "x", 5, "t", 7, "g", "c", 0, 2))
    rows += rows[3:6]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def real_docs(spark):
    return spark.read.parquet(f"{SF001}/documents.parquet")
