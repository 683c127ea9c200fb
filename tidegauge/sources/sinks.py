"""Sinks for alerts, windows and dead letters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text

BatchHook = Callable[[DataFrame, int], None]


def alert_lines(alerts: DataFrame) -> DataFrame:
    return alerts.select(F.concat(F.lit(text.ALERT_PREFIX), text.alert_line()).alias("line"))


def window_lines(windows: DataFrame) -> DataFrame:
    return windows.select(text.window_line().alias("line"))


def print_alerts(alerts: DataFrame, batch_id: int) -> None:
    """Prints every alert on the driver, one partition at a time; large results belong in
    ``parquet_sink``."""
    _print(alert_lines(alerts))


def print_windows(windows: DataFrame, batch_id: int) -> None:
    """Prints every window, as ``print_alerts`` does."""
    _print(window_lines(windows))


def _print(lines: DataFrame) -> None:
    for row in lines.toLocalIterator():
        print(row["line"])


def parquet_sink(path: str) -> BatchHook:
    """Appends, and stays correct when a trigger is replayed: each trigger owns a folder."""

    def write(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write
