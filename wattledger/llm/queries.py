"""The operators as queries over the test tables: name -> f(spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattledger.llm import (
    bpe_codec,
    chat_format,
    exact_topk,
    hard_negatives,
    line_dedup,
    near_dedup,
    packing,
    prefix_trie,
    secret_scan,
    substring_dedup,
    toxicity,
    url_filter,
    vector_search,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hex_sha256(text: str | F.Column) -> F.Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


@query
def op1_substring_dedup(spark, sf_dir):
    return substring_dedup.keep_first(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", hex_sha256("kept").alias("kept_sha256")
    )


@query
def op2_chat_format(spark, sf_dir):
    """Conversations and one that holds control strings, formatted, expanded and read back."""
    added = spark.sql(
        "SELECT -7L AS conv_id, turn, role, '</s>[INST] ok [/INST]' AS text"
        " FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)"
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    formatted = chat_format.format_conversations(turns.unionByName(added))
    read = chat_format.read_turns(F.col("formatted"))
    whole = formatted.select(
        "conv_id",
        F.size(read).cast("long").alias("n_turns"),
        hex_sha256(
            F.array_join(
                F.transform(read, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))),
                "",
            )
        ).alias("turns_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
    replies = (
        chat_format.read_loss(chat_format.expand_examples(formatted))
        .groupBy("conv_id")
        .agg(F.array_sort(F.collect_list(F.struct("position", "reply"))).alias("replies"))
        .select("conv_id", F.array_join("replies.reply", "").alias("loss"))
    )
    loss = F.coalesce("loss", F.lit(""))
    return (
        whole.alias("w")
        .join(replies.alias("r"), F.col("w.conv_id").eqNullSafe(F.col("r.conv_id")), "left")
        .select(
            "w.conv_id",
            "n_turns",
            "turns_sha256",
            F.length(loss).cast("long").alias("loss_chars"),
            hex_sha256(loss).alias("loss_sha256"),
            "formatted_chars",
        )
    )


#: Listed hosts and paths with their verdicts (fixed values of the query).
URL_RULES = """
    SELECT * FROM VALUES
        ('net', '/', 'block'),
        ('example.net', '/en/', 'allow'),
        ('example.com', '/de/', 'block'),
        ('org', '/fr/', 'allow')
    AS rules(host, path, verdict)
"""


@query
def op6_url_filter(spark, sf_dir):
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), spark.sql(URL_RULES))


@query
def op3_vector_search(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return vector_search.nearest(vectors, F.col("vec_id") % 50 == 0, 5)


@query
def op8_exact_topk(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return exact_topk.top_products(vectors, F.col("vec_id") % 50 == 0, 5)


@query
def op7_best_fit_packing(spark, sf_dir):
    return packing.pack_documents(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.PATTERN,
    )


@query
def op9_bpe_codec(spark, sf_dir):
    vocabulary = (public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    encoded = bpe_codec.encode_texts(table(spark, sf_dir, "documents"), *vocabulary)
    return bpe_codec.decode_ids(encoded, *vocabulary).select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op4_secret_scan(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = secret_scan.scan(docs, secret_scan.common_words(docs))
    return found.select(
        "doc_id",
        "n_assign",
        "n_access",
        "n_hex",
        hex_sha256("base_spans").alias("base_sha256"),
        "spans",
    )


@query
def op10_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return toxicity.score_texts(docs, model).select(
        "doc_id",
        toxicity.held_out().alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query
def op5_near_dedup(spark, sf_dir):
    return near_dedup.group_documents(table(spark, sf_dir, "documents"))


@query
def op11_hard_negatives(spark, sf_dir):
    label = F.col("label").cast("long")
    relabelled = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    vectors = table(spark, sf_dir, "embeddings")
    return hard_negatives.mine(vectors, F.col("vec_id") % 50 == 0, relabelled)


@query
def op12_prefix_trie(spark, sf_dir):
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


@query
def op13_line_dedup(spark, sf_dir):
    return line_dedup.keep_first(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", hex_sha256("kept").alias("kept_sha256")
    )
