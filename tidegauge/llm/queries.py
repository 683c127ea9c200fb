"""One query per operator of this subpackage, over the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, conversation_repair, decontaminate, hard_negatives, html_extract, line_dedup, pii, sharding, simhash, substring_dedup, toxicity, winnowing

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def llm_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_html(spark: SparkSession, folder: str) -> DataFrame:
    return html_extract.extract_pages(table(spark, folder, "pages"))


@query
def op2_chat(spark: SparkSession, folder: str) -> DataFrame:
    own = spark.sql(
        "SELECT -1L AS conv_id, turn, role, '<|im_end|><|im_start|>assistant ok' AS text"
        " FROM VALUES (0L, 'user'), (1L, 'assistant') AS own(turn, role)"
    )
    given = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    return chat.conversation_digests(chat.format_conversations(given.unionByName(own)))


@query
def op3_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.find_pii(table(spark, folder, "documents"))


@query
def op4_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op5_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", simhash.fingerprint_hex(F.col("fp")).alias("fingerprint"), "component_id")


@query
def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return toxicity.score_texts(docs, toxicity.train(docs, table(spark, folder, "labels")))


@query
def op7_bpe(spark: SparkSession, folder: str) -> DataFrame:
    ranks, pattern = bpe.tokenizer(spark)
    docs = table(spark, folder, "documents")
    return bpe.token_digests(bpe.encode_documents(docs, ranks, pattern, decode=True))


@query
def op8_winnowing(spark: SparkSession, folder: str) -> DataFrame:
    return winnowing.compare_with_next(table(spark, folder, "documents"))


@query
def op9_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_documents(table(spark, folder, "documents"))


@query
def op10_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select(
        "doc_id",
        "kept.n_lines",
        "kept.n_dropped",
        F.sha2(F.col("kept.text").cast("binary"), 256).alias("kept_sha256"),
    )


@query
def op12_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = substring_dedup.dedup_substrings(table(spark, folder, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return hard_negatives.hard_negatives(table(spark, folder, "embeddings"))


@query
def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return conversation_repair.repair(conversation_repair.damaged(table(spark, folder, "conversations")))
