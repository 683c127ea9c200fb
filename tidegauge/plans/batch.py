"""All stages composed on a bounded table of raw messages."""

from __future__ import annotations

from collections.abc import Collection
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import EngineConfig
from ..functions.parsing import PAYLOAD_CHARS
from ..operators import detect, metrics, parse as parsing
from ..operators.dedup import accepted, dedup_ttl, duplicates
from ..operators.windows import window_stats
from ..schema import KEYS
from .skew import decided, store_table


def run_batch(
    raw: DataFrame,
    cfg: EngineConfig = EngineConfig(),
    as_of: datetime | str | None = None,
    tie_break: list[str] | None = None,
    store: bool = True,
    order: list[str] | None = None,
    wanted: Collection[str] | None = None,
) -> dict[str, DataFrame]:
    """Parse, deduplicate, score readings, aggregate windows, score windows.

    Returns the tables records, dead_letters, duplicates, windows, record_alerts,
    window_alerts, alerts and counters. ``tie_break`` names columns of ``raw`` that order
    copies of one message with the same time; by default partition and offset, where there are such.
    ``order`` is the order of arrival in a series, see ``detect.score_records``.

    Several tables read the parsed messages, the flagged records and the windows, so with ``store``
    they are written once to the checkpoint folder, and neither the parse nor the shuffle by id is
    repeated.
    """
    parsed = parsing.parse(raw)
    failed = F.col("reason_code").isNotNull()
    # Only failed messages show their text, and of it no more than the dead letters keep.
    parsed = parsed.withColumn("raw", F.when(failed, F.substring("raw", 1, PAYLOAD_CHARS)))
    if store:
        parsed = store_table(parsed)
    if tie_break is None:
        tie_break = [c for c in ("partition", "offset") if c in raw.columns]
    flagged = dedup_ttl(parsing.valid_records(parsed), cfg.dedup, tie_break, cfg.skew)
    if store:
        flagged = store_table(flagged)
    records = accepted(flagged)

    # A window belongs to one series, so one count answers for all.
    skew = decided(records, KEYS, cfg.skew)
    record_alerts = detect.record_alerts(records, cfg.detect, order, skew)
    windows = window_stats(records, cfg.windows, as_of, skew)
    readers = ("windows", "window_alerts", "alerts", "counters")
    if store and (wanted is None or sum(name in wanted for name in readers) > 1):
        windows = store_table(windows)
    window_alerts = detect.window_alerts(windows, cfg.detect, skew)
    alerts = detect.all_alerts(record_alerts, window_alerts)
    return {
        "records": records,
        "dead_letters": parsing.dead_letters(parsed),
        "duplicates": duplicates(flagged),
        "windows": windows,
        "record_alerts": record_alerts,
        "window_alerts": window_alerts,
        "alerts": alerts,
        "counters": metrics.run_counters(parsed, flagged, alerts),
    }
