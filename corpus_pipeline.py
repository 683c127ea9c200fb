"""The corpus pipeline: each stage reads all that its predecessor kept.

Toxic documents go, lines that many documents share stay in one of them, one document of each group of
near-duplicates stays, documents with a passage of the benchmark go, and the rest is encoded.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm import bpe, filters, toxicity
from tidegauge.plans.skew import use_checkpoint_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose score is below a half. A null text is scored as an empty one, repeated rows and rows without
    an id are scored like others, and an empty table, or one without labels, loses no row."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return filters.without_toxic(docs, toxicity.train(docs, labels))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows; lines of 40 characters or more that five documents share stay in the one with the largest id.
    A text that loses no line, a null one included, is passed on unchanged."""
    return filters.without_repeated_lines(docs)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of the SimHash links (three-word shingles, three bits): its smallest id.
    Texts without words, nulls among them, are one group; rows without an id stay only
    where their group has no other; repeated rows are copies of each other."""
    return filters.one_of_each_group(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows in which no item of the benchmark is found. A null or empty text holds none and stays, and so
    does every row where the benchmark is empty."""
    return filters.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``ids`` (packed, see ``bpe``), their number and digest, and the digest of the decoded bytes."""
    ranks, pattern = bpe.tokenizer(spark)
    decoded = bpe.encode_documents(docs, ranks, pattern, decode=True)
    return decoded.select(
        "doc_id",
        "ids",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("simhash_dedup", dedup_near),
    ("decontamination", decontaminate),
    ("bpe", encode),
]

#: SQL can express neither the classifier nor the merges; tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. What the others keep is written to the cluster's shared folder and reread."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    home = f"{use_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{home}/{name}")
        docs = spark.read.parquet(f"{home}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
