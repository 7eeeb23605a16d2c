"""The corpus pipeline: from raw documents to packed training sequences.

Toxic documents go, then all but one of each group of near-duplicates, then passages that
repeat an earlier document's; secrets are replaced by a mark; what is left is packed into
sequences. Each stage works on all that the one before it kept and, but for the last, returns
the columns of documents; a text that a stage changes has its n_chars changed with it. Rows
without a doc_id or a text pass through.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattledger.llm import near_dedup, packing, secret_scan, substring_dedup, toxicity
from wattledger.llm.stored import stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a classifier learned from `labels` doesn't take for toxic."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    return toxicity.drop_toxic(docs, toxicity.train(docs, labels))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near-duplicates; rows of one doc_id
    are one document."""
    groups = near_dedup.group_documents(docs.select("doc_id", "text"))
    dropped = stored(groups.where(~F.col("kept")).select("doc_id").distinct(), "dropped")
    return docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without words of passages that a document with a smaller id has."""
    return substring_dedup.drop_repeats(docs, "n_chars")


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a mark in place of each secret."""
    return secret_scan.redact_texts(docs, secret_scan.common_words(docs), "n_chars")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document stands in which sequence, with its ids."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack_documents(docs, path, public_tokenizers.PATTERN, with_ids=True)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("substring_dedup", drop_repeated_passages),
    ("secret_scan", mask_secrets),
    ("packing", pack),
]

#: A classifier, passages by word windows and a tokenizer are beyond SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written and read again."""
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        rows = stored(stage(spark, rows, sf_dir), name)
    return rows
