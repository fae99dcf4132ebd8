"""The registered queries: SQL where there is some, and the pipeline stage by stage."""

from __future__ import annotations

import sys
from collections import Counter
from pathlib import Path
from types import SimpleNamespace

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
import corpus_pipeline  # noqa: E402
from loam.llm import mixing  # noqa: E402
from loam.llm.queries import ORACLE, QUERIES, tokenizer_path  # noqa: E402
from oracle import compare, duck  # noqa: E402

SF001, SF01 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql(spark, name):
    ok, said = compare(spark, name, QUERIES[name], ORACLE[name], SF01, duck(SF01))
    assert ok, said


def test_thirteen_queries():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_registered():
    import __spark_entry__ as e
    assert {*QUERIES, "pipeline"} <= set(e.queries())


def test_columns(spark):
    want = {
        "op1": "doc_id n_words n_base first_word last_word base_labels labels score", "op2": "doc_id fingerprint component_id",
        "op4": "doc_id held_out n_tokens n_known train_tokens base_score score",
        "op5": "doc_id piece start length ids_crc32 sequence_id offset", "op6": "vec_id n_links component_id kept",
        "op7": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
        "op8": "page_id payload_bytes payload_digest record_type refers_to", "op9": "doc_id n_bytes n_tokens over_limit",
        "op10": "doc_id size text_crc32 law shard slot grown_shard",
        "op11": "doc_id n_words n_hit n_items items_sha256 contaminated", "op12": "word form root n n_near form_n",
        "op13": "vec_id component n deviation whitened explained identity_error"}
    for name, fn in QUERIES.items():
        if name.split("_")[0] in want:
            df = fn(spark, SF001)
            assert set(want[name.split("_")[0]].split()) <= set(df.columns)


def test_pipeline(spark):
    from test_corpus_operators import check_packing, fingerprint, roots
    from test_text_operators import quality_row, quality_verdicts
    from tokenizers import Tokenizer
    docs = spark.read.parquet(f"{SF01}/documents.parquet").collect()
    good = [r for r, kept in zip(docs, quality_verdicts([quality_row(r.text, r.lang, r.source) for r in docs])) if kept]
    fps = [fingerprint(r.text) for r in good]
    g = roots(len(fps), [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 2])
    best = {}
    for r, k in zip(good, g):
        if k not in best or r.doc_id < best[k].doc_id:
            best[k] = r
    left = spark.createDataFrame(list(best.values()), spark.read.parquet(f"{SF01}/documents.parquet").schema)
    kept = {r.doc_id: r.text for r in mixing.mix(left, carry=("doc_id", "text")).where("kept").collect()}
    got = corpus_pipeline.run(spark, SF01).collect()
    assert {r.doc_id for r in got} == set(kept)
    out = [SimpleNamespace(text=kept[r.doc_id], **r.asDict()) for r in got]
    n = check_packing(out, list(kept.values()), Tokenizer.from_file(tokenizer_path("word_bpe_49k.json")), 4096)
    assert n <= -(-sum(r.length for r in got) // 4096) + 1


def test_stages_return_documents(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    df = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        df = stage(spark, df, SF001)
        assert df.columns == docs.columns and df.dtypes == docs.dtypes
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_copies", "mixing", "packing"]
    assert max(Counter(r.doc_id for r in df.collect()).values()) == 1
