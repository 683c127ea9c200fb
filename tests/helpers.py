"""Fixed inputs. Times are seconds after 2024-01-01 00:00:00 UTC."""

from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

START = datetime(2024, 1, 1, tzinfo=timezone.utc)
SCHEMA = (
    "message_id string, sensor_id string, metric_name string, value double, unit string, "
    "timestamp timestamp, seq bigint"
)


def at(seconds: float) -> datetime:
    return START + timedelta(seconds=seconds)


def record(seq, value=10.0, seconds=0.0, message_id=None, sensor="PUMP_A7_INLET", metric="pressure_bar"):
    return (
        message_id or f"id-{seq:06d}", sensor, metric, float(value), "bar", at(seconds), seq
    )


def records(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def series(spark, values, step=1.0, **kwargs):
    return records(
        spark, [record(i, v, i * step, **kwargs) for i, v in enumerate(values)]
    )


def rows_of(df, *columns):
    """Sorted plain tuples; times as microseconds."""
    chosen = [
        F.unix_micros(c).alias(c) if dict(df.dtypes)[c] == "timestamp" else F.col(c)
        for c in (columns or df.columns)
    ]
    return sorted((tuple(r) for r in df.select(*chosen).collect()), key=repr)
