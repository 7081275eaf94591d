"""The corpus pipeline over ``documents``: five stages, each written as Parquet and read again by the next.

Toxic documents go; of each group of near copies the document with the smallest id stays; documents that contain a
benchmark item go; personal data is replaced by its kind; what is left is encoded, and decoded again as a check. Null and
empty texts are clean, their own group, and have no tokens; rows without an id are never dropped as copies; an empty table
gives an empty result; columns beside doc_id and text pass through the first four stages, and n_chars follows the text.
Each stage sets the size of the session's Arrow batches where it is unset (``common.small_batches``).
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.llm import byte_bpe, contamination, jaccard_join, pii, toxicity
from ledgermill.llm.common import small_batches, stage, table
from ledgermill.llm.queries import BYTE_RANKS


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return toxicity.without_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return jaccard_join.one_of_each(docs, width=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return contamination.without_items(docs, table(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    masked = pii.masked(docs, pii.train(docs))
    if "n_chars" not in docs.columns:
        return masked
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return byte_bpe.round_trip(docs, BYTE_RANKS, public_tokenizers.PATTERN, with_ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("personal_data", mask_personal_data),
    ("byte_bpe", encode_tokens),
]

#: The classifier, the tagger and the tokenizer are not SQL; tests hold the stages to plain versions of them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
