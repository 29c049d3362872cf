"""Corpus pipeline: toxic documents and copies go, sources are mixed, the rest is packed.

STAGES lists (name, function).  A function takes (spark, docs, sf_dir) and
returns a DataFrame; run() writes it as Parquet in the shared folder and reads
it back as the next stage's docs, so a lost executor repeats one stage at most.
All stages but the last return the columns of docs as they came.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from demandlake.llm import exact_dedup, mixing, packing, simhash, toxicity
from demandlake.llm.common import documents, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the pattern grammar does not call toxic; learned from the labels in sf_dir."""
    return toxicity.clean(spark, docs, sf_dir)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of SimHash fingerprints, 3-word shingles and 3 bits."""
    return simhash.dedup(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once, sources repeated up to twice by temperature weights."""
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens, each a sequence of its own."""
    return packing.packed(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("simhash_neardup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack),
]

#: SQL expresses neither the learned grammar nor the tokenizer; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply STAGES to the documents table."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
