"""Z-score alerts on single readings and on whole windows.

Both compare a value with the rows before it in its series, never with itself; values that
raised an alert stay in the baseline.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from ..config import DetectConfig, SkewConfig
from ..functions.text import Z_DIGITS, record_message, round_stat, window_message
from ..plans.trailing import with_trailing
from ..schema import ALERT, KEYS, ORDER

# Names of the alert kinds and severities.
RECORD_ALERT = "zscore"
WINDOW_ALERT = "value_spike"
WARNING = "WARNING"
CRITICAL = "CRITICAL"


def _baseline(value: str):
    def measures(frame: WindowSpec) -> dict[str, Column]:
        return {
            "baseline_n": F.count(value).over(frame),
            "baseline_mean": F.avg(value).over(frame),
            # One earlier row has no spread; this also keeps the guard below simple.
            "baseline_std": F.coalesce(F.stddev_samp(value).over(frame), F.lit(0.0)),
        }

    return measures


def _z(value: str) -> Column:
    return (F.col(value) - F.col("baseline_mean")) / F.nullif("baseline_std", F.lit(0.0))


def severity(z: Column, threshold: float, critical_factor: float) -> Column:
    return F.when(F.abs(z) > threshold * critical_factor, F.lit(CRITICAL)).otherwise(
        F.lit(WARNING)
    )


def score_records(
    df: DataFrame,
    cfg: DetectConfig = DetectConfig(),
    order: list[str] | None = None,
    skew: SkewConfig = SkewConfig(),
) -> DataFrame:
    """Add baseline_n, baseline_mean, baseline_std and z, unrounded.

    ``order`` is the arrival order: (timestamp, message_id) unless given, for instance
    ["partition", "offset"] when a topic is replayed.
    """
    scored = with_trailing(
        df, KEYS, order or ORDER, "value", cfg.baseline_rows, _baseline("value"), skew
    )
    return scored.withColumn("z", _z("value"))


def score_windows(
    windows: DataFrame,
    cfg: DetectConfig = DetectConfig(),
    skew: SkewConfig = SkewConfig(),
    order: list[str] | None = None,
) -> DataFrame:
    """The same columns for window means, against the windows before."""
    scored = with_trailing(
        windows,
        KEYS,
        order or ["window_start"],
        "mean",
        cfg.baseline_windows,
        _baseline("mean"),
        skew,
    )
    return scored.withColumn("z", _z("mean"))


def is_record_anomaly(cfg: DetectConfig) -> Column:
    return (
        (F.col("baseline_n") >= cfg.min_baseline_rows)
        & (F.col("baseline_std") > cfg.min_sigma)
        & (F.abs("z") > cfg.z_threshold)
    )


def is_window_anomaly(cfg: DetectConfig) -> Column:
    return (
        (F.col("baseline_n") >= cfg.min_baseline_windows)
        & (F.col("baseline_std") >= cfg.min_sigma)
        & (F.abs("z") > cfg.z_threshold)
    )


def record_alert_columns(cfg: DetectConfig) -> list[Column]:
    z = F.col("z")
    return [
        F.col("sensor_id"),
        F.col("metric_name"),
        F.lit(RECORD_ALERT).alias("anomaly_type"),
        F.col("timestamp").alias("detected_at"),
        F.col("value").alias("observed_value"),
        round_stat("baseline_mean").alias("baseline_mean"),
        round_stat("baseline_std").alias("baseline_std"),
        round_stat("z", Z_DIGITS).alias("zscore"),
        record_message("value", "z", "baseline_mean", "baseline_std").alias("message"),
        severity(z, cfg.z_threshold, cfg.record_critical_factor).alias("severity"),
    ]


def window_alert_columns(cfg: DetectConfig) -> list[Column]:
    z = F.col("z")
    return [
        F.col("sensor_id"),
        F.col("metric_name"),
        F.lit(WINDOW_ALERT).alias("anomaly_type"),
        F.col("window_end").alias("detected_at"),
        round_stat("mean").alias("observed_value"),
        round_stat("baseline_mean").alias("baseline_mean"),
        round_stat("baseline_std").alias("baseline_std"),
        round_stat("z", Z_DIGITS).alias("zscore"),
        window_message("mean", "z", "baseline_n", "baseline_mean").alias("message"),
        severity(z, cfg.z_threshold, cfg.window_critical_factor).alias("severity"),
    ]


def record_alerts(
    df: DataFrame,
    cfg: DetectConfig = DetectConfig(),
    order: list[str] | None = None,
    skew: SkewConfig = SkewConfig(),
) -> DataFrame:
    """Readings further than the threshold from the rows before them in their series."""
    columns = list(dict.fromkeys([*KEYS, "timestamp", "value", *(order or ORDER)]))
    scored = score_records(df.select(*columns), cfg, order, skew)
    return scored.filter(is_record_anomaly(cfg)).select(*record_alert_columns(cfg))


def window_alerts(
    windows: DataFrame, cfg: DetectConfig = DetectConfig(), skew: SkewConfig = SkewConfig()
) -> DataFrame:
    """Windows whose mean is further than the threshold from the window means before."""
    scored = score_windows(
        windows.select(*KEYS, "window_start", "window_end", "mean"), cfg, skew
    )
    return scored.filter(is_window_anomaly(cfg)).select(*window_alert_columns(cfg))


def all_alerts(records: DataFrame, windows: DataFrame) -> DataFrame:
    """Alerts of both detectors."""
    names = ALERT.fieldNames()
    return records.select(*names).unionByName(windows.select(*names))
