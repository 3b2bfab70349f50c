"""A training corpus from raw documents, stage by stage.

Each stage calls one operator of `campaignlake.llm` on everything its predecessor kept, and its decisions
take effect: rejected documents and copies go, personal data is replaced, sources are mixed to their
weights, and the rest is packed into sequences. Every stage's rows are written to the shared folder and
read again, so a lost executor costs one stage at most.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from campaignlake.llm import minhash_bbit, mixing, packing, pii_disclosure, quality_ledger
from campaignlake.llm.common import materialize, table
from campaignlake.llm.queries import MIX_WEIGHTS, mix_levels, token_file


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule of the standard policy rejects."""
    return quality_ledger.quality_filter(docs, quality_ledger.STANDARD)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, similarity 0.8 or more."""
    return minhash_bbit.deduplicated(docs, shingle=5, percent=80)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and the terms that disclose it replaced in the texts."""
    clean = pii_disclosure.sanitised(docs)
    if "n_chars" not in clean.columns:
        return clean
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents chosen to the target weights, up to twice each."""
    return mixing.mixed_documents(docs, mix_levels(), MIX_WEIGHTS, budget_share=0.8, max_epochs=2)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all documents in sequences of 4096 tokens."""
    return packing.pack(docs, token_file("word_bpe_49k.json"), capacity=4096)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("personal_data", personal_data),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]

# Packing has no SQL form; tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
