"""The queries opN_<name>: each applies its operator to the whole of its table. ``ORACLE_SQL`` is for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.llm import (
    byte_bpe,
    contamination,
    edit_counts,
    jaccard_join,
    line_repeats,
    line_rules,
    manifest,
    pii,
    prefix_trie,
    repeated_bytes,
    sharding,
    tokens_out,
    toxicity,
)
from ledgermill.llm.common import table
from ledgermill.session import scratch_path

WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
EDIT_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
BYTE_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "tokens")
    tokens_out.write_tokens(table(spark, sf_dir, "documents"), folder, WORD_TOKENIZER)
    return tokens_out.read_tokens(spark, folder)


def own_edits(text: Column, doc_id: Column, edits: int = 4) -> Column:
    """Edits that follow from a document: at hashed places some characters go and a passage of the same text comes in."""
    draw = lambda below, *salt: F.pmod(F.xxhash64(doc_id, *map(F.lit, salt)), below).cast("int")
    length = F.length(text)
    return F.array(*(
        F.struct(
            draw(length + 1, k, 0).alias("position"),
            draw(F.lit(30), k, 1).alias("deleted"),
            F.substring(text, draw(length + 1, k, 2) + 1, draw(F.lit(60), k, 3)).alias("inserted"),
        )
        for k in range(edits)
    ))


def near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_groups(table(spark, sf_dir, "documents"))


def edited_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.withColumn("edits", own_edits(F.col("text"), F.col("doc_id")))
    return edit_counts.recounted(docs, EDIT_RANKS, public_tokenizers.PATTERN)


def shared_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.quality(table(spark, sf_dir, "documents"))


def benchmark_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.find(docs, pii.train(docs))


def repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_bytes.without_repeats(table(spark, sf_dir, "documents"))


def shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


def byte_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"), BYTE_RANKS, public_tokenizers.PATTERN)


def lines_in_many_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_repeats.digests(line_repeats.without_common_lines(table(spark, sf_dir, "documents")))


def merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose crc32(doc_id) is divisible by 7 are checked as if n_chars had been raised by 1."""
    tampered = F.crc32(F.col("doc_id").cast("long").cast("string")) % 7 == 0
    raised = F.col("n_chars").cast("decimal(20,0)") + 1
    return manifest.checked(table(spark, sf_dir, "documents"), tampered, n_chars=raised)


def conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_files": token_files,
    "op2_count_vector_join": near_copies,
    "op3_edited_token_counts": edited_counts,
    "op4_minimax_shards": shards,
    "op5_shared_line_rules": shared_line_rules,
    "op6_byte_bpe": byte_bpe_round_trip,
    "op7_toxicity": toxicity_scores,
    "op8_personal_data": personal_data,
    "op9_suffix_merge": repeated,
    "op10_benchmark_containment": benchmark_items,
    "op11_line_repeats": lines_in_many_documents,
    "op12_merkle_manifest": merkle_manifest,
    "op13_prefix_trie": conversation_trie,
}

ORACLE_SQL: dict[str, str] = {
    "op5_shared_line_rules": line_rules.ORACLE,
    "op10_benchmark_containment": contamination.ORACLE,
    "op11_line_repeats": line_repeats.ORACLE,
    "op12_merkle_manifest": manifest.ORACLE,
    "op13_prefix_trie": prefix_trie.ORACLE,
}
