"""Views that give the supplied ``events`` table the shape of sensor readings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def readings(events: DataFrame, message_id: str = "event_id") -> DataFrame:
    """Validated readings: 10 sensors x event types. ``message_id`` names the id column."""
    return events.select(
        F.col(message_id).cast("string").alias("message_id"),
        (F.col("user_id") % 10).cast("string").alias("sensor_id"),
        F.col("event_type").alias("metric_name"),
        F.col("value"),
        F.lit("u").alias("unit"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.col("event_id"),
    )


def raw_messages(events: DataFrame, message_id: str = "event_id") -> DataFrame:
    """JSON texts of the readings, with a fault or a spelling variant by ``event_id % 25``."""
    time = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    number = F.format_string("%.2f", "value")
    case = F.col("event_id") % 25
    value = (
        F.when(case == 2, F.lit('"COMM_ERROR"'))
        .when(case == 3, F.lit("null"))
        .when(case == 5, F.lit('"nan"'))
        .when(case == 7, F.concat(F.lit('"'), number, F.lit('"')))
        .when(case == 9, F.lit("true"))
        .when(case == 14, F.lit('"-Infinity"'))
        .otherwise(number)
    )
    stamp = (
        F.when(case == 4, F.lit('"not-a-date"'))
        .when(case == 6, F.unix_seconds(F.col("ts").cast("timestamp")).cast("string"))
        .when(case == 10, F.concat(F.lit('"'), time, F.lit('Z"')))
        .when(case == 11, F.concat(F.lit('"'), time, F.lit('+05:30"')))
        .otherwise(F.concat(F.lit('"'), time, F.lit('"')))
    )
    unit = F.when(case == 12, F.lit("")).otherwise(F.lit('"unit":"u",'))
    body = F.concat(
        F.lit('{"message_id":"'),
        F.col(message_id).cast("string"),
        F.lit('","sensor_id":"'),
        (F.col("user_id") % 10).cast("string"),
        F.lit('","metric_name":"'),
        F.col("event_type"),
        F.lit('","value":'),
        value,
        F.lit(","),
        unit,
        F.lit('"timestamp":'),
        stamp,
        F.lit(',"tags":'),
        F.col("props"),
        F.lit("}"),
    )
    text = (
        F.when(case == 0, F.lit("this is not json at all }{"))
        .when(case == 1, F.lit("{}"))
        .when(case == 8, F.lit("[1, 2]"))
        .when(case == 13, F.concat(body, F.lit(" tail")))
        .otherwise(body)
    )
    return events.select(text.alias("raw"), "event_id", F.col("ts").cast("timestamp").alias("received_at"))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
