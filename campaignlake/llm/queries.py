"""Registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from . import chat_parts, minhash_bbit, mixing, nn_descent, packing, phrases, pii_disclosure, quality_ledger, sharding, spelling, superkmer, toxicity_pu, unigram_count
from .common import table


def token_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), token_file("word_bpe_49k.json"))


def op2_quality_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_ledger.ledger(table(spark, sf_dir, "documents"))
    kept = quality_ledger.apply_policies(rows, [quality_ledger.BASE, quality_ledger.STANDARD])
    return kept.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~F.col("kept_base_v1")).alias("base_failed"), F.col("kept_standard_v1").alias("kept"), "failed_bits",
    )


def op3_minhash_bbit(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash_bbit.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, percent=80)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op4_pii_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_disclosure.report(table(spark, sf_dir, "documents"))


def op5_chat_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame(
        [(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return chat_parts.digests(chat_parts.format_conversations(rows.union(extra)))


def op6_unigram_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unigram_count.count_tokens(table(spark, sf_dir, "documents"), token_file("piece_bpe_32k.model"))


def op7_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nn_descent.near_vectors(table(spark, sf_dir, "embeddings"), threshold=0.93)


def op8_super_kmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return superkmer.remove_repeats(table(spark, sf_dir, "documents"), window=50)


# The corpus mix: three domains by the last digit of the source, then languages, then sources alike.
def mix_levels() -> dict[str, Column]:
    domain = F.expr(
        "CASE WHEN source IS NULL THEN 'other' WHEN right(source, 1) IN ('0', '1') THEN 'bulk' "
        "WHEN right(source, 1) IN ('2', '3', '4', '5') THEN 'web' ELSE 'curated' END")
    return {"domain": domain, "lang": F.col("lang"), "source": F.col("source")}


MIX_WEIGHTS = {
    ("bulk",): 20, ("web",): 45, ("curated",): 35, ("other",): 1,
    **{(d, x): w for d in ("bulk", "web", "curated") for x, w in (("en", 40), ("de", 25), ("fr", 20), ("es", 15))},
}


def op9_hierarchical_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = mixing.mix(table(spark, sf_dir, "documents"), mix_levels(), MIX_WEIGHTS, budget_share=0.6, max_epochs=3)
    return chosen.select(F.col("key_id").alias("doc_id"), "domain", "lang", "source", "n_tokens", "epoch")


def op10_toxicity_pu(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity_pu.score(docs, toxicity_pu.fit(docs, table(spark, sf_dir, "labels")))


def op11_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.report(table(spark, sf_dir, "documents"), shards=16)


def op12_debruijn_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mine(table(spark, sf_dir, "documents"), least=100, longest=5, keep=2000)


def op13_spelling_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"), shortest=7, least=2, ratio=10)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_quality_ledger": op2_quality_ledger,
    "op3_minhash_bbit": op3_minhash_bbit,
    "op4_pii_disclosure": op4_pii_disclosure,
    "op5_chat_parts": op5_chat_parts,
    "op6_unigram_counts": op6_unigram_counts,
    "op7_nn_descent": op7_nn_descent,
    "op8_super_kmers": op8_super_kmers,
    "op9_hierarchical_mix": op9_hierarchical_mix,
    "op10_toxicity_pu": op10_toxicity_pu,
    "op11_feistel_shards": op11_feistel_shards,
    "op12_debruijn_phrases": op12_debruijn_phrases,
    "op13_spelling_trie": op13_spelling_trie,
}
