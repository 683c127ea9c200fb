"""Streaming counterparts of the batch operators.

Each takes and returns a streaming DataFrame. The input needs a watermark where the docstring
says so; see ``watermarked``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from ..config import DedupConfig, DetectConfig, WindowConfig
from ..operators.detect import (
    is_record_anomaly,
    is_window_anomaly,
    record_alert_columns,
    window_alert_columns,
)
from ..operators.windows import basic_stats, interpolated_percentile
from ..schema import KEYS, ORDER
from .processors import AnchoredWindows, TrailingBaseline, TtlDedup, WallClockWindows

_BASELINE = [
    T.StructField("baseline_n", T.LongType()),
    T.StructField("baseline_mean", T.DoubleType()),
    T.StructField("baseline_std", T.DoubleType()),
]


def use_state_store(spark: SparkSession) -> None:
    """State that spills to disk and keeps change logs in the checkpoint folder."""
    spark.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def watermarked(df: DataFrame, delay_seconds: int = 0) -> DataFrame:
    """Rows older than the newest event time minus the delay are late: dropped and counted."""
    return df.withWatermark("timestamp", f"{delay_seconds} seconds")


def dedup_ttl(
    df: DataFrame,
    cfg: DedupConfig = DedupConfig(),
    tie_break: list[str] | None = None,
    expire: bool = True,
) -> DataFrame:
    """Add ``is_duplicate``: exact, as in the batch operator, and across restarts.

    With ``expire`` (needs a watermark) an id is forgotten once the watermark has passed its
    time-to-live; without it the state grows with the number of ids.
    """
    use_state_store(df.sparkSession)
    order = ["__t", *(tie_break or [])]
    processor = TtlDedup(cfg.ttl_us, df.columns, order, expire)
    schema = T.StructType([*df.schema.fields, T.StructField("is_duplicate", T.BooleanType())])
    rows = df.withColumn("__t", F.unix_micros("timestamp"))
    return rows.groupBy("message_id").transformWithState(
        processor, schema, "append", "eventTime" if expire else "none"
    )


def dedup_within_watermark(df: DataFrame, cfg: DedupConfig = DedupConfig()) -> DataFrame:
    """Cheap and approximate: the built-in operator, all in the JVM.

    It drops every repeat inside one trigger, also one after the time-to-live, and needs the
    time-to-live as watermark delay.
    """
    use_state_store(df.sparkSession)
    return watermarked(df, cfg.ttl_seconds).dropDuplicatesWithinWatermark(["message_id"])


def _with_baseline(df: DataFrame, depth: int, value: str, order: list[str]) -> DataFrame:
    use_state_store(df.sparkSession)
    schema = T.StructType([*df.schema.fields, *_BASELINE])
    processor = TrailingBaseline(depth, value, df.columns, order)
    scored = df.groupBy(*KEYS).transformWithState(processor, schema, "append", "none")
    return scored.withColumn(
        "z", (F.col(value) - F.col("baseline_mean")) / F.nullif("baseline_std", F.lit(0.0))
    )


def score_records(
    df: DataFrame, cfg: DetectConfig = DetectConfig(), order: list[str] | None = None
) -> DataFrame:
    """Baseline columns and z of each reading; rows of one trigger are taken in ``order``."""
    return _with_baseline(df, cfg.baseline_rows, "value", order or ORDER)


def record_alerts(
    df: DataFrame, cfg: DetectConfig = DetectConfig(), order: list[str] | None = None
) -> DataFrame:
    columns = list(dict.fromkeys([*KEYS, "timestamp", "value", *(order or ORDER)]))
    scored = score_records(df.select(*columns), cfg, order)
    return scored.filter(is_record_anomaly(cfg)).select(*record_alert_columns(cfg))


def window_stats(df: DataFrame, cfg: WindowConfig = WindowConfig()) -> DataFrame:
    """Epoch-aligned windows, each emitted once the watermark has passed its end.

    The exact percentile keeps the distinct values of an open window in one state row, which each trigger reads and
    writes; ``triggers.WindowStage`` keeps them as a table and splits hot windows.
    """
    use_state_store(df.sparkSession)
    bounds = F.window("timestamp", f"{cfg.window_seconds} seconds").alias("w")
    stats = df.groupBy(*KEYS, bounds).agg(
        *basic_stats(), interpolated_percentile("value", cfg.percentile).alias("p95")
    )
    return stats.filter(F.col("sample_count") >= cfg.min_samples).select(
        *KEYS,
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        "sample_count",
        "mean",
        "minimum",
        "maximum",
        "std_dev",
        "p95",
    )


def score_windows(windows: DataFrame, cfg: DetectConfig = DetectConfig()) -> DataFrame:
    """Closed windows with the baseline of the window means before them."""
    return _with_baseline(windows, cfg.baseline_windows, "mean", ["window_start"])


def window_alerts(windows: DataFrame, cfg: DetectConfig = DetectConfig()) -> DataFrame:
    return spikes(score_windows(windows, cfg), cfg)


def spikes(scored: DataFrame, cfg: DetectConfig = DetectConfig()) -> DataFrame:
    return scored.filter(is_window_anomaly(cfg)).select(*window_alert_columns(cfg))


def _closing_windows(df: DataFrame, cfg: WindowConfig, processor: type, mode: str) -> DataFrame:
    use_state_store(df.sparkSession)
    bigint = T.LongType()
    schema = T.StructType(
        [
            *[T.StructField(k, T.StringType()) for k in KEYS],
            *[T.StructField(n, bigint) for n in ("start", "end", "closed", "sample_count")],
            *[
                T.StructField(n, T.DoubleType())
                for n in ("mean", "minimum", "maximum", "std_dev", "p95")
            ],
        ]
    )
    made = processor(cfg.window_us, cfg.min_samples, cfg.percentile, schema.names)
    rows = df.select(*KEYS, "timestamp", "value", F.unix_micros("timestamp").alias("__t"))
    closed = rows.groupBy(*KEYS).transformWithState(made, schema, "append", mode)
    return closed.select(
        *KEYS,
        F.timestamp_micros("start").alias("window_start"),
        F.timestamp_micros("end").alias("window_end"),
        F.timestamp_micros("closed").alias("closed_at"),
        "sample_count",
        "mean",
        "minimum",
        "maximum",
        "std_dev",
        "p95",
    )


def anchored_window_stats(df: DataFrame, cfg: WindowConfig = WindowConfig()) -> DataFrame:
    """Series-anchored windows with ``closed_at``; needs a watermark."""
    return _closing_windows(df, cfg, AnchoredWindows, "eventTime")


def wall_clock_window_stats(df: DataFrame, cfg: WindowConfig = WindowConfig()) -> DataFrame:
    """Windows that close by the wall clock, with ``closed_at``; without a watermark. Run it with a processing-time
    trigger: each trigger looks for windows that are due, at most one per series."""
    return _closing_windows(df, cfg, WallClockWindows, "processingTime")


# What the watermark drops


def _add(totals: dict[str, int], progress) -> None:
    """Rows that stateful operators dropped as late, and observed counts, of one trigger."""
    for operator in progress.stateOperators:
        name = f"dropped_{operator.operatorName}"
        totals[name] = totals.get(name, 0) + operator.numRowsDroppedByWatermark
    for watch, row in (progress.observedMetrics or {}).items():
        for name, value in row.asDict().items():
            totals[f"{watch}_{name}"] = totals.get(f"{watch}_{name}", 0) + (value or 0)


class DroppedRows(StreamingQueryListener):
    """Adds up, by query name, what the watermark made operators drop, and the counts of ``observed``.

    An operator that combines rows before its state counts what is combined (windows), others count rows.
    """

    def __init__(self):
        self.totals: dict[str, dict[str, int]] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        _add(self.totals.setdefault(event.progress.name or str(event.progress.id), {}), event.progress)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def observed(df: DataFrame, name: str = "input") -> DataFrame:
    """Count the rows of a stream on their way, under ``name`` in each trigger's progress."""
    return df.observe(name, F.count(F.lit(1)).alias("rows"))


def totals_of(query: StreamingQuery) -> dict[str, int]:
    """The same sums as ``DroppedRows`` for the triggers that a query still remembers."""
    totals: dict[str, int] = {}
    for progress in query.recentProgress:
        _add(totals, progress)
    return totals
