"""Table shapes of every stage."""

from pyspark.sql import types as T

KEYS = ["sensor_id", "metric_name"]
ORDER = ["timestamp", "message_id"]

RECORD = T.StructType(
    [
        T.StructField("message_id", T.StringType()),
        T.StructField("sensor_id", T.StringType()),
        T.StructField("metric_name", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("unit", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("tags", T.VariantType()),
        T.StructField("tags_map", T.MapType(T.StringType(), T.StringType())),
    ]
)

DEAD_LETTER = T.StructType(
    [
        T.StructField("raw_payload", T.StringType()),
        T.StructField("reason", T.StringType()),
        T.StructField("reason_code", T.StringType()),
        T.StructField("received_at", T.TimestampType()),
    ]
)

WINDOW = T.StructType(
    [
        T.StructField("sensor_id", T.StringType()),
        T.StructField("metric_name", T.StringType()),
        T.StructField("window_start", T.TimestampType()),
        T.StructField("window_end", T.TimestampType()),
        T.StructField("sample_count", T.LongType()),
        T.StructField("mean", T.DoubleType()),
        T.StructField("minimum", T.DoubleType()),
        T.StructField("maximum", T.DoubleType()),
        T.StructField("std_dev", T.DoubleType()),
        T.StructField("p95", T.DoubleType()),
    ]
)

ALERT = T.StructType(
    [
        T.StructField("sensor_id", T.StringType()),
        T.StructField("metric_name", T.StringType()),
        T.StructField("anomaly_type", T.StringType()),
        T.StructField("detected_at", T.TimestampType()),
        T.StructField("observed_value", T.DoubleType()),
        T.StructField("baseline_mean", T.DoubleType()),
        T.StructField("baseline_std", T.DoubleType()),
        T.StructField("zscore", T.DoubleType()),
        T.StructField("message", T.StringType()),
        T.StructField("severity", T.StringType()),
    ]
)
