"""Sources of raw messages: Kafka, JSON-lines or text files, Parquet; bounded or unbounded."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import KafkaConfig
from ..functions.parsing import decode_utf8

FORMATS = ("kafka", "json", "text", "parquet")


def kafka_options(
    cfg: KafkaConfig, streaming: bool = True, fixed_group: bool = False
) -> dict[str, str]:
    """Reader options. Offsets are committed by the checkpoint, never by the consumer.

    The group id is only a prefix, so that each query has a group of its own and reads all data;
    ``fixed_group`` uses it as it is, for brokers that admit named groups alone.
    """
    options = {
        "kafka.bootstrap.servers": cfg.bootstrap_servers,
        "subscribe": cfg.topic,
        "startingOffsets": cfg.auto_offset_reset,
        "kafka.session.timeout.ms": str(cfg.session_timeout_ms),
        "kafka.max.poll.records": str(cfg.max_poll_records),
        "kafka.group.id" if fixed_group else "groupIdPrefix": cfg.group_id,
        "failOnDataLoss": "true",
    }
    if not streaming:
        options["startingOffsets"] = "earliest"
        options["endingOffsets"] = "latest"
    elif cfg.max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(cfg.max_offsets_per_trigger)
    return options


def open_source(
    spark: SparkSession,
    fmt: str,
    path: str | None = None,
    kafka: KafkaConfig = KafkaConfig(),
    streaming: bool = False,
    schema: T.StructType | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Rows with a ``raw`` text column, ready for ``parse``.

    "json" and "text" read one message per line; lines are kept whole, so malformed ones reach
    the dead letters. "parquet" needs a ``raw`` or a binary ``value`` column and, for streams, a
    ``schema``. Kafka rows keep topic, partition, offset and timestamp.
    """
    if fmt not in FORMATS:
        raise ValueError(f"format is one of {', '.join(FORMATS)}")
    reader = spark.readStream if streaming else spark.read
    reader = reader.options(**(options or {}))
    if fmt == "kafka":
        rows = reader.format("kafka").options(**kafka_options(kafka, streaming)).load()
        return from_kafka(rows)
    if path is None:
        raise ValueError(f"{fmt} needs a path")
    if fmt in ("json", "text"):
        return reader.format("text").load(path).withColumnRenamed("value", "raw")
    rows = (reader.schema(schema) if schema is not None else reader).parquet(path)
    if "raw" not in rows.columns and "value" in rows.columns:
        return rows.withColumn("raw", decode_utf8(F.col("value"))).drop("value")
    return rows


def from_kafka(rows: DataFrame) -> DataFrame:
    """Kafka rows with the value decoded; a missing value becomes a malformed message."""
    kept = [c for c in ("topic", "partition", "offset", "timestamp") if c in rows.columns]
    return rows.select(decode_utf8(F.col("value")).alias("raw"), *kept)
