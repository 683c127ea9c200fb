"""Statistics of each stage, each a single aggregation."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DedupConfig, WindowConfig
from ..functions.text import PERCENT_DIGITS, round_exact, window_key
from ..schema import KEYS
from .windows import assign_windows


def percent(part: str, whole: str) -> Column:
    return round_exact(f"100D * {part} / greatest({whole}, 1L)", PERCENT_DIGITS)


def dedup_stats(
    flagged: DataFrame,
    cfg: DedupConfig = DedupConfig(),
    now: datetime | str | None = None,
    rows: DataFrame | None = None,
) -> DataFrame:
    """total_seen, total_dupes, dupe_rate_pct and cache_size (ids accepted within the last
    time-to-live before ``now``; by default the newest row's time). ``rows``, what was deduplicated,
    saves a second deduplication for that time."""
    seen, dupes = F.count(F.lit(1)), F.count_if("is_duplicate")
    if now is None:
        now = (flagged if rows is None else rows).agg(F.max(F.unix_micros("timestamp"))).first()[0]
        at = F.timestamp_micros(F.lit(now).cast("bigint"))
    else:
        at = F.lit(now).cast("timestamp")
    age = F.unix_micros(at) - F.unix_micros("timestamp")
    # Accepted rows of an id lie more than a time-to-live apart, so this counts ids.
    live = ~F.col("is_duplicate") & (age >= 0) & (age <= cfg.ttl_us)
    return flagged.agg(
        seen.alias("total_seen"),
        dupes.alias("total_dupes"),
        percent("count_if(is_duplicate)", "count(1)").alias("dupe_rate_pct"),
        F.count_if(live).alias("cache_size"),
    )


def one_row(*parts: DataFrame) -> DataFrame:
    """Single-row tables with different columns, side by side."""
    together = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return together.agg(*[F.max(c).alias(c) for c in together.columns])


def _count(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def _series_count(df: DataFrame, name: str) -> DataFrame:
    return _count(df.select(*KEYS).distinct(), name)


def aggregator_stats(rows: DataFrame, windows: DataFrame) -> DataFrame:
    """active_keys and total_windows_flushed."""
    return one_row(
        _series_count(rows, "active_keys"), _count(windows, "total_windows_flushed")
    )


def buffer_sizes(
    rows: DataFrame, as_of: datetime | str, cfg: WindowConfig = WindowConfig()
) -> DataFrame:
    """Rows of each series whose window is still open at ``as_of``, keyed ``sensor::metric``.

    A closed window has used up its rows, also when they were too few for a result.
    """
    open_ = F.col("window_end") > F.lit(as_of).cast("timestamp")
    placed = assign_windows(rows.select(*KEYS, "timestamp"), cfg)
    counts = placed.groupBy(*KEYS).agg(F.count_if(open_).alias("buffer_size"))
    return counts.select(
        window_key(F.col("sensor_id"), F.col("metric_name")).alias("window_key"), "buffer_size"
    )


def detector_stats(rows: DataFrame, windows: DataFrame, record_alerts: DataFrame) -> DataFrame:
    """Series tracked by each detector and the number of record alerts."""
    return one_row(
        _series_count(rows, "tracked_keys"),
        _series_count(windows, "window_tracked_keys"),
        _count(record_alerts, "total_alerts"),
    )


def run_counters(parsed: DataFrame, flagged: DataFrame, alerts: DataFrame) -> DataFrame:
    """received, malformed, dupes, processed and alerts with percentages, as one row.

    received = malformed + dupes + processed.
    """
    gate = parsed.agg(
        F.count(F.lit(1)).alias("received"),
        F.count_if(F.col("reason_code").isNotNull()).alias("malformed"),
    )
    dedup = flagged.agg(
        F.count_if("is_duplicate").alias("dupes"),
        F.count_if(~F.col("is_duplicate")).alias("processed"),
    )
    counts = one_row(gate, dedup, _count(alerts, "alerts"))
    return counts.withColumns(
        {
            "malformed_pct": percent("malformed", "received"),
            "dupes_pct": percent("dupes", "received"),
        }
    )
