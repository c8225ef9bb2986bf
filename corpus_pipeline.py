"""The corpus pipeline: each stage's result is written and read again as the next one's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from saldo.llm import exact_dedup, language_id, mixing, packing, simhash
from saldo.llm.queries import MIX_SEED, MIX_WEIGHTS, documents, mix_levels
from saldo.session import materialize


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is rejected go."""
    return language_id.keep_identified(docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest id stays."""
    return exact_dedup.drop_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies the document with the smallest id stays."""
    return simhash.keep_one(docs, simhash.SHINGLE)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One epoch, so that no document is repeated."""
    mixed = mixing.mix(docs, mix_levels(), MIX_WEIGHTS, share_of_supply=MIXED_SHARE, epochs=1, seed=MIX_SEED)
    return mixing.take(docs, mixed)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document, with its place in a sequence."""
    return packing.pack(docs, packing.CAPACITY)


#: Share of the tokens that the mix takes.
MIXED_SHARE = 0.9

STAGES = [
    ("language ID", identify_language),
    ("exact dedup", drop_exact_copies),
    ("SimHash near-dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: No SQL: some stages train a model or group by fingerprints.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
