"""The corpus pipeline: quality rules, SimHash near-dedup, mixing, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loam.llm import mixing, packing, quality, simhash
from loam.llm.common import stored
from loam.llm.queries import PACK_END, tokenizer_path
from loam.session import read_table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the adaptive quality rules keep."""
    return quality.keep_good(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn with probabilities raked to the target marginals."""
    return mixing.sample(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents in sequences of 4096 tokens."""
    return packing.pack_documents(docs, tokenizer_path("word_bpe_49k.json"), end=PACK_END)


STAGES = [("quality", keep_good), ("near_copies", drop_near_copies), ("mixing", mix_sources), ("packing", pack)]

#: Fingerprints, sampling weights and token ids have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
