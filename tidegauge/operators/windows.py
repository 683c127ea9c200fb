"""Tumbling-window statistics per series."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import SkewConfig, WindowConfig
from ..functions.text import round_stat
from ..plans.selection import selected_percentiles
from ..plans.skew import materialize, split_hot, union_parts
from ..schema import KEYS

_WINDOW_KEYS = [*KEYS, "window_start", "window_end"]
STATS = ["mean", "minimum", "maximum", "std_dev", "p95"]


def interpolated_percentile(value: str, pct: float) -> Column:
    """Exact linear interpolation; 0.0 when there are no values."""
    return F.coalesce(F.percentile(value, pct / 100.0), F.lit(0.0))


def rank_error(size: int) -> float:
    """How far the rank of a sketch's percentile may be from the wanted one, as a share of the values, with 99 %
    certainty: the published error of KLL sketches with ``size`` values on their top level."""
    return 2.296 / size**0.9723


def sketched_percentile(value: str, cfg: WindowConfig) -> Column:
    """Of a mergeable sketch of bounded size: combined before the shuffle, so a hot window needs no splitting."""
    sketch = F.kll_sketch_agg_double(value, F.lit(cfg.sketch_size))
    return F.coalesce(F.kll_sketch_get_quantile_double(sketch, F.lit(cfg.percentile / 100.0)), F.lit(0.0))


def sample_std(value: str) -> Column:
    """Sample standard deviation; 0.0 for fewer than two values."""
    return F.coalesce(F.stddev_samp(value), F.lit(0.0))


def basic_stats(value: str = "value") -> list[Column]:
    return [
        F.count(value).alias("sample_count"),
        F.avg(value).alias("mean"),
        F.min(value).alias("minimum"),
        F.max(value).alias("maximum"),
        sample_std(value).alias("std_dev"),
    ]


def series_anchor(df: DataFrame) -> DataFrame:
    """First record time of each series; combined before the shuffle."""
    return df.groupBy(*KEYS).agg(F.min("timestamp").alias("__anchor"))


def assign_windows(
    df: DataFrame, cfg: WindowConfig, skew: SkewConfig = SkewConfig()
) -> DataFrame:
    """Add ``window_start`` and ``window_end``.

    "epoch": half-open windows on multiples of the width. "series": the first window
    starts at the series' first record and each window includes its upper bound; the first
    record times are found by an aggregation and broadcast if their counted number is small.
    Rows without a time are in no window.
    """
    if cfg.alignment == "epoch":
        bounds = F.window("timestamp", f"{cfg.window_seconds} seconds")
        return (
            df.withColumn("__w", bounds)
            .withColumns({"window_start": F.col("__w.start"), "window_end": F.col("__w.end")})
            .drop("__w")
        )
    return anchored_windows(df, materialize(series_anchor(df)), cfg, skew)


def anchored_windows(
    df: DataFrame,
    anchors: DataFrame,
    cfg: WindowConfig,
    skew: SkewConfig = SkewConfig(),
    closed_until: int | None = None,
) -> DataFrame:
    """Windows from given ``anchors`` (keys and ``__anchor``). Rows whose window ended by
    ``closed_until`` (microseconds) go into the window of their series that is open then."""
    width = F.lit(cfg.window_us)
    anchors = anchors.select(*[F.col(k).alias(f"__{k}") for k in KEYS], "__anchor")
    if anchors.count() <= skew.broadcast_rows:
        anchors = F.broadcast(anchors)
    on = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in KEYS]
    since = F.unix_micros("timestamp") - F.unix_micros("__anchor")
    index = F.greatest(F.ceil(since / width).cast("bigint") - 1, F.lit(0).cast("bigint"))
    if closed_until is not None:
        ended = (F.lit(closed_until) - F.unix_micros("__anchor")) / width
        index = F.greatest(index, F.floor(ended).cast("bigint"))
    return (
        df.filter(F.col("timestamp").isNotNull())
        .join(anchors, on)
        .withColumn("__start", F.unix_micros("__anchor") + index * width)
        .withColumns(
            {
                "window_start": F.timestamp_micros("__start"),
                "window_end": F.timestamp_micros(F.col("__start") + width),
            }
        )
        .drop("__start", "__anchor", *[f"__{k}" for k in KEYS])
    )


def window_stats(
    df: DataFrame,
    cfg: WindowConfig = WindowConfig(),
    as_of: datetime | str | None = None,
    skew: SkewConfig = SkewConfig(),
) -> DataFrame:
    """Count, mean, min, max, sample std and percentile per series and window.

    Windows with fewer than ``min_samples`` rows are left out. With ``as_of`` only windows
    closed by then are returned. Values are not rounded; see ``rounded``.

    Everything but the percentile is combined before the shuffle. The exact percentile
    holds the distinct values of a window in memory, so the windows of hot series that are
    themselves hot take the distributed selection instead.
    """
    columns = [*KEYS, "timestamp", "value"]
    rows = assign_windows(df.select(*columns), cfg, skew)
    return closed_windows(assigned_stats(rows, cfg, skew), cfg, as_of)


def assigned_stats(
    rows: DataFrame, cfg: WindowConfig, skew: SkewConfig = SkewConfig()
) -> DataFrame:
    """Statistics of all windows of rows that have their window."""
    if cfg.percentile_method == "sketch":
        return rows.groupBy(*_WINDOW_KEYS).agg(*basic_stats(), sketched_percentile("value", cfg).alias("p95"))
    # Counting series is cheaper than counting windows, and only a hot series has hot windows.
    ordinary, hot, _ = split_hot(rows, KEYS, skew.max_group_rows, skew)
    parts = []
    if ordinary is not None:
        parts.append(_plain_stats(ordinary, cfg))
    if hot is not None:
        small, large, _ = split_hot(hot, _WINDOW_KEYS, skew.max_group_rows, skew)
        if small is not None:
            parts.append(_plain_stats(small, cfg))
        if large is not None:
            parts.append(_selected_stats(large, cfg, skew))
    return union_parts(parts)


def _plain_stats(rows: DataFrame, cfg: WindowConfig) -> DataFrame:
    p95 = interpolated_percentile("value", cfg.percentile).alias("p95")
    return rows.groupBy(*_WINDOW_KEYS).agg(*basic_stats(), p95)


def _selected_stats(rows: DataFrame, cfg: WindowConfig, skew: SkewConfig) -> DataFrame:
    basics = rows.groupBy(*_WINDOW_KEYS).agg(*basic_stats())
    selected = selected_percentiles(rows, _WINDOW_KEYS, "value", {"p95": cfg.percentile}, skew)
    on = [F.col(f"b.{k}").eqNullSafe(F.col(f"s.{k}")) for k in _WINDOW_KEYS]
    return basics.alias("b").join(selected.alias("s"), on, "left").select(
        "b.*", F.coalesce("s.p95", F.lit(0.0)).alias("p95")
    )


def closed_windows(
    stats: DataFrame, cfg: WindowConfig, as_of: datetime | str | None = None
) -> DataFrame:
    kept = stats.filter(F.col("sample_count") >= cfg.min_samples)
    if as_of is not None:
        kept = kept.filter(F.col("window_end") <= F.lit(as_of).cast("timestamp"))
    return kept


def rounded(stats: DataFrame) -> DataFrame:
    """Statistics as shown to people: half-even, four digits."""
    return stats.withColumns({name: round_stat(name) for name in STATS})


def series_stats(df: DataFrame) -> DataFrame:
    """Whole-series count, mean, variance and standard deviation."""
    return df.groupBy(*KEYS).agg(
        F.count("value").alias("n"),
        F.avg("value").alias("mean"),
        F.coalesce(F.var_samp("value"), F.lit(0.0)).alias("variance"),
        sample_std("value").alias("std"),
    )


def percentiles(
    df: DataFrame, keys: list[str], pcts: dict[str, float], skew: SkewConfig = SkewConfig()
) -> DataFrame:
    """Exact interpolated percentiles of ``value`` for any grouping; 0.0 without values."""
    ordinary, hot, _ = split_hot(df.select(*keys, "value"), keys, skew.max_group_rows, skew)
    parts = []
    if ordinary is not None:
        parts.append(
            ordinary.groupBy(*keys).agg(
                *[interpolated_percentile("value", p).alias(n) for n, p in pcts.items()]
            )
        )
    if hot is not None:
        selected = selected_percentiles(hot, keys, "value", pcts, skew).alias("s")
        groups = hot.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows")).alias("g")
        on = [F.col(f"g.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys]
        named = [F.coalesce(F.col(f"s.{n}"), F.lit(0.0)).alias(n) for n in pcts]
        parts.append(groups.join(selected, on, "left").select(*[f"g.{k}" for k in keys], *named))
    return union_parts(parts)
