"""Registered queries of this subpackage: each applies an operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.bpe import read_ranks, token_digests
from ledgerlake.llm.common import remainder, table
from ledgerlake.llm.conversations import repair_digests
from ledgerlake.llm.decision_list import judge
from ledgerlake.llm.fuzzy_hash import edit_fingerprints
from ledgerlake.llm.lm import score_documents
from ledgerlake.llm.mixing import mix_sources
from ledgerlake.llm.neardup import near_duplicates
from ledgerlake.llm.periodic import run_digests
from ledgerlake.llm.pii import KINDS, pseudonymise
from ledgerlake.llm.sharding import shard_documents
from ledgerlake.llm.substrings import without_repeats
from ledgerlake.llm.toxicity import toxicity
from ledgerlake.llm.twins import CONVERSATIONS, SUBSTRINGS
from ledgerlake.llm.url_filter import filter_urls


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"))


def op2_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))[0]


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return token_digests(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(remainder(F.col("doc_id"), 4) == 2, F.lit(False))
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), held_out)


#: In production a secret from the job's configuration; fixed here, so that results can be compared.
PSEUDONYM_KEY = "ledgerlake-query-key"


def op8_fuzzy_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_fingerprints(table(spark, sf_dir, "documents"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    hidden = pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), PSEUDONYM_KEY)
    counts = [(F.size("pii_kinds") - F.size(F.array_remove("pii_kinds", k))).alias(f"n_{k}") for k in KINDS]
    return hidden.select("doc_id", "text", F.size("pii_kinds").alias("n_found"), *counts)


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"), 16).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_digests(table(spark, sf_dir, "conversations"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digests(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_url_filter, op2_lm_scores, op3_mix_sources, op4_quality_rules, op5_minhash_near_dedup, op6_byte_bpe, op7_toxicity, op8_fuzzy_fingerprints,
        op9_pii, op10_sharding, op11_substring_dedup, op12_conversation_repair, op13_periodic_runs,
    )
}

#: SQL of the queries that SQL can express.
TWINS: dict[str, str] = {"op11_substring_dedup": SUBSTRINGS, "op12_conversation_repair": CONVERSATIONS}
