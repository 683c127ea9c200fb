"""The whole stream: clean, detect, aggregate, publish."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import EngineConfig
from ..functions.parsing import PAYLOAD_CHARS
from ..operators import detect
from ..operators.parse import dead_letters, parse, valid_records
from ..plans.skew import decided, spread
from ..schema import KEYS, WINDOW
from ..sources.sinks import BatchHook
from .ledger import Turn, commits, run_by_trigger
from .triggers import Clock, DedupStage, LiveIds, ScoreStage, WindowStage

COUNTS = ["received", "malformed", "dupes", "processed", "alerts", "windows", "late"]
#: Totals of a running stream, as the batch operators of ``operators.metrics`` give them for the rows so far.
STATISTICS = [
    "total_seen", "total_dupes", "cache_size", "active_keys", "waiting_rows", "total_windows_flushed",
    "tracked_keys", "window_tracked_keys", "total_alerts",
]


@dataclass
class Counters:
    """Counters of all published triggers; they are part of the triggers' manifests.

    received = malformed + dupes + processed; late rows are processed, only their window had closed.
    """

    spark: SparkSession
    folder: str

    def rows(self) -> DataFrame:
        """One row per trigger, with ``batch_id``."""
        return commits(self.spark, self.folder, COUNTS).drop("attempt")

    def totals(self) -> dict[str, float]:
        """Totals since the folder was first used, whatever was restarted in between."""
        try:
            row = self.rows().agg(*[F.sum(c).alias(c) for c in COUNTS]).first().asDict()
        except AnalysisException:  # no trigger has ended yet
            row = {}
        totals = {c: row.get(c) or 0 for c in COUNTS}
        received = max(totals["received"], 1)
        return totals | {
            "malformed_pct": round(100 * totals["malformed"] / received, 2),
            "dupes_pct": round(100 * totals["dupes"] / received, 2),
        }

    def statistics(self) -> DataFrame:
        """What deduplication, aggregation and detection had seen and held after each trigger, one row for each."""
        fields = ", ".join(f"{c}: bigint" for c in STATISTICS)
        rows = commits(self.spark, self.folder, values=f"statistics: struct<{fields}>")
        rate = 100 * F.col("total_dupes") / F.greatest("total_seen", F.lit(1))
        return rows.select("batch_id", "statistics.*").withColumn("dupe_rate_pct", F.round(rate, 2))


@dataclass
class Streams:
    queries: list[StreamingQuery]
    counters: Counters
    spark: SparkSession

    def wait(self, seconds: float | None = None) -> None:
        """Until every query has ended (backfills) or the time is over."""
        deadline = None if seconds is None else time.monotonic() + seconds
        for query in self.queries:
            left = None if deadline is None else max(deadline - time.monotonic(), 0.001)
            query.awaitTermination(left) if left is not None else query.awaitTermination()

    def stop(self, seconds: float = 60.0) -> None:
        """Stop between triggers where possible; open windows resume from the folder."""
        deadline = time.monotonic() + seconds
        for query in self.queries:
            while query.isActive and query.status["isTriggerActive"]:
                if time.monotonic() > deadline:
                    break
                time.sleep(0.05)
            query.stop()


class Engine:
    """All stages for one trigger's raw messages; see ``start_streams``."""

    def __init__(
        self,
        cfg: EngineConfig,
        on_alert: BatchHook | None = None,
        on_window: BatchHook | None = None,
        on_window_alert: BatchHook | None = None,
        on_dead_letter: BatchHook | None = None,
        tie_break: list[str] | None = None,
        order: list[str] | None = None,
    ):
        self.cfg, self.order = cfg, order
        self.on_alert, self.on_window, self.on_dead_letter = on_alert, on_window, on_dead_letter
        self.on_window_alert = on_window_alert or on_alert
        self.dedup = DedupStage(cfg.dedup, tie_break, cfg.skew)
        self.live = LiveIds(cfg.dedup)
        self.windows = WindowStage(cfg.windows, Clock(cfg.clock), cfg.skew)
        self.means = ScoreStage.of_windows(cfg.detect, cfg.skew)

    def step(self, raw: DataFrame, turn: Turn) -> None:
        detecting, one = self.cfg.detect, F.count(F.lit(1))
        failed = F.col("reason_code").isNotNull()
        parsed = parse(spread(raw), received_at=F.col("received_at") if "received_at" in raw.columns else None)
        # one pass parses the messages, keeps the readings and, of the others, what dead letters show
        parsed = parsed.withColumn("raw", F.when(failed, F.substring("raw", 1, PAYLOAD_CHARS)))
        parsed = parsed.withColumn("tags", F.col("tags").cast("string"))  # tables keep the tags as JSON text
        parsed = turn.write("parsed", parsed, received=one, malformed=F.count_if(failed))
        self._hand(self.on_dead_letter, turn.write("dead_letters", dead_letters(parsed)), turn)
        if self.dedup.ties is None:
            self.dedup.ties = [c for c in ("partition", "offset") if c in raw.columns]
        flagged = self.dedup.step(valid_records(parsed), turn)
        records = flagged.filter(~F.col("is_duplicate")).drop("is_duplicate")

        skew = decided(records, KEYS, self.cfg.skew)
        scoring = ScoreStage.of_readings(detecting, self.order, skew)
        scored = scoring.step(records, turn).filter(detect.is_record_anomaly(detecting))
        alerts = turn.write("alerts/kind=record", scored.select(*detect.record_alert_columns(detecting)), record_alerts=one)
        self._hand(self.on_alert, alerts, turn)

        before = turn.values.get("clock", {}).get("low")
        closed, late = self.windows.step(records, turn)
        spikes = self.means.step(closed, turn).filter(detect.is_window_anomaly(detecting))
        spikes = turn.write("alerts/kind=window", spikes.select(*detect.window_alert_columns(detecting)), window_alerts=one)
        self._hand(self.on_window_alert, spikes, turn)
        windows = turn.write("windows", closed.select(*WINDOW.fieldNames()))
        self._hand(self.on_window, windows, turn)

        turn.counts["alerts"] = turn.counts["record_alerts"] + turn.counts["window_alerts"]
        self._total(records, turn, before)

    @staticmethod
    def _hand(hook: BatchHook | None, rows: DataFrame, turn: Turn) -> None:
        if hook is not None:
            hook(rows, turn.n)

    def _total(self, records: DataFrame, turn: Turn, before: int | None) -> None:
        """Carry the statistics on by what this trigger has changed; nothing is counted again."""
        live = self.live.step(records, turn, before, turn.values["clock"]["low"])
        counts, timed = turn.counts, records.where("timestamp IS NOT NULL").count()
        old = turn.values.get("statistics", dict.fromkeys(STATISTICS, 0))
        change = {
            "total_seen": counts["dupes"] + counts["processed"],
            "total_dupes": counts["dupes"],
            "active_keys": counts["new_readings"],
            "waiting_rows": timed - counts["late"] - counts["ended_rows"],
            "total_windows_flushed": counts["windows"],
            "tracked_keys": counts["new_readings"],
            "window_tracked_keys": counts["new_means"],
            "total_alerts": counts["record_alerts"],
        }
        turn.values["statistics"] = {k: old[k] + change.get(k, 0) for k in STATISTICS} | {"cache_size": live}


def start_streams(
    raw: DataFrame,
    folder: str,
    cfg: EngineConfig = EngineConfig(),
    on_alert: BatchHook | None = None,
    on_window: BatchHook | None = None,
    on_window_alert: BatchHook | None = None,
    on_dead_letter: BatchHook | None = None,
    tie_break: list[str] | None = None,
    trigger: dict | None = None,
    order: list[str] | None = None,
) -> Streams:
    """Start everything on a streaming table of raw messages, as one query that reads and parses each
    message once.

    ``folder`` is on shared storage; it holds the checkpoint, the state and the tables flagged, late, alerts, windows and
    dead_letters, to be read by ``ledger.published``: of each trigger it shows all tables or none. A restart with the
    same folder goes on where the last run ended; a trigger that was stopped within is done again.

    Readings are deduplicated and scored in the order of arrival, however late they are: trigger by
    trigger, and within one by time or by ``order``. Copies of one message at one time are ordered by
    ``tie_break``, by default by partition and offset, where there are such. Hooks get the rows of a trigger as well,
    window alerts before the windows, and again if the trigger is done again. A hook that writes by trigger
    number needs one place per kind of alert: give ``on_window_alert`` as well (by default it is ``on_alert``).
    """
    trigger = trigger or {"processingTime": f"{cfg.flush_interval_seconds} seconds"}
    engine = Engine(cfg, on_alert, on_window, on_window_alert, on_dead_letter, tie_break, order)
    query = run_by_trigger(raw, folder, engine.step, trigger, "tidegauge")
    return Streams([query], Counters(raw.sparkSession, folder), raw.sparkSession)
