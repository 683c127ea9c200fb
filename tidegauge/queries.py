"""Named queries over the supplied tables, one or more per operator."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import DedupConfig, DetectConfig, EngineConfig, SkewConfig, WindowConfig
from .functions import text
from .operators import detect, metrics
from .operators.dedup import accepted, dedup_ttl, duplicates
from .operators.parse import dead_letters, parse, valid_records
from .operators.windows import (
    assign_windows,
    percentiles,
    rank_error,
    rounded,
    series_stats,
    window_stats,
)
from .plans.batch import run_batch
from .plans.skew import decided, spread, use_checkpoint_dir
from .plans.trailing import with_running_moments
from .schema import KEYS, ORDER
from .sources.readers import from_kafka, open_source
from .sources.sinks import parquet_sink
from .sources.views import raw_messages, readings, table
from .streaming import operators as streaming
from .streaming.batchwise import score_by_trigger
from .streaming.ledger import published, run_by_trigger
from .streaming.run import Counters, start_streams
from .streaming.triggers import Clock, DedupStage, MomentStage, WindowStage

SIX_HOURS = WindowConfig(window_seconds=6 * 3600)
ONE_DAY = WindowConfig(window_seconds=24 * 3600)
ANCHORED = WindowConfig(window_seconds=24 * 3600, alignment="series")
DAY_TTL = DedupConfig(ttl_seconds=24 * 3600)
AS_OF = "2024-01-15 00:00:00"
MID_WINDOW = "2024-01-15 05:30:00"

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return fn(spark, folder)

    _QUERIES[fn.__name__] = run
    return fn


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _readings(spark: SparkSession, folder: str, message_id: str = "event_id") -> DataFrame:
    return readings(table(spark, folder, "events"), message_id)


def _raw(spark: SparkSession, folder: str, message_id: str = "event_id") -> DataFrame:
    return raw_messages(table(spark, folder, "events"), message_id)


def _forced(spark: SparkSession, folder: str) -> SkewConfig:
    """Every group treated as hot, in slices that are a share of the events."""
    rows = table(spark, folder, "events").count()
    return SkewConfig(mode="on", rows_per_slice=max(2_000, rows // 16))


def _cents(df: DataFrame) -> DataFrame:
    """Whole numbers, whose sums do not depend on the order, for texts with rounded digits."""
    return df.withColumn("value", F.rint(F.col("value") * 100))


def _r6(name: str, source: str | None = None) -> Column:
    return F.round(F.col(source or name), 6).alias(name)


def _ntz(name: str, source: str | None = None) -> Column:
    return F.col(source or name).cast("timestamp_ntz").alias(name)


# Scores and alerts of single readings


def _scored(df: DataFrame) -> DataFrame:
    return df.select(
        "message_id",
        *KEYS,
        _ntz("timestamp"),
        "value",
        "baseline_n",
        _r6("baseline_mean"),
        _r6("baseline_std"),
        _r6("z"),
    )


@query
def zscore_baseline(spark, folder):
    return _scored(detect.score_records(_readings(spark, folder)))


@query
def zscore_baseline_sliced(spark, folder):
    """The same with every series treated as hot."""
    return _scored(detect.score_records(_readings(spark, folder), skew=_forced(spark, folder)))


def _anomalies(spark, folder, cfg=DetectConfig()):
    scored = detect.score_records(_readings(spark, folder), cfg)
    return scored.filter(detect.is_record_anomaly(cfg)).select(
        *KEYS,
        _ntz("detected_at", "timestamp"),
        F.col("value").alias("observed_value"),
        _r6("baseline_mean"),
        _r6("baseline_std"),
        _r6("zscore", "z"),
        detect.severity(F.col("z"), cfg.z_threshold, cfg.record_critical_factor).alias("severity"),
    )


@query
def zscore_alerts(spark, folder):
    return _anomalies(spark, folder)


@query
def zscore_alerts_tuned(spark, folder):
    return _anomalies(
        spark, folder, DetectConfig(z_threshold=2.0, baseline_rows=30, min_baseline_rows=5)
    )


@query
def record_alert_rows(spark, folder):
    """Alert rows as published: rounded fields, message and severity."""
    alerts = detect.record_alerts(_cents(_readings(spark, folder)))
    return alerts.withColumn("detected_at", F.col("detected_at").cast("timestamp_ntz"))


@query
def record_alert_lines(spark, folder):
    alerts = detect.record_alerts(_cents(_readings(spark, folder)))
    return alerts.select(F.concat(F.lit(text.ALERT_PREFIX), text.alert_line()).alias("line"))


# Windows


def _windows(df: DataFrame) -> DataFrame:
    return df.select(
        *KEYS,
        _ntz("window_start"),
        _ntz("window_end"),
        "sample_count",
        _r6("mean"),
        "minimum",
        "maximum",
        _r6("std_dev"),
        _r6("p95"),
    )


@query
def window_stats_six_hours(spark, folder):
    return _windows(window_stats(_readings(spark, folder), SIX_HOURS))


@query
def window_stats_daily(spark, folder):
    return _windows(window_stats(_readings(spark, folder), ONE_DAY))


@query
def window_stats_minute(spark, folder):
    """The default width; a single row is enough here, its deviation is 0."""
    cfg = WindowConfig(min_samples=1)
    return _windows(window_stats(_readings(spark, folder), cfg))


@query
def window_stats_anchored(spark, folder):
    return _windows(window_stats(_readings(spark, folder), ANCHORED))


@query
def window_stats_as_of(spark, folder):
    return _windows(window_stats(_readings(spark, folder), ANCHORED, as_of=AS_OF))


@query
def window_stats_sliced(spark, folder):
    """Daily windows with every window treated as hot."""
    return _windows(window_stats(_readings(spark, folder), ONE_DAY, skew=_forced(spark, folder)))


@query
def window_assignment(spark, folder):
    rows = assign_windows(_readings(spark, folder), SIX_HOURS)
    return rows.select(
        "message_id",
        text.window_key(F.col("sensor_id"), F.col("metric_name")).alias("window_key"),
        _ntz("window_start"),
        _ntz("window_end"),
    )


@query
def window_lines(spark, folder):
    windows = rounded(window_stats(_cents(_readings(spark, folder)), ONE_DAY))
    return windows.select(
        "sensor_id", "metric_name", _ntz("window_start"), text.window_line().alias("line")
    )


@query
def series_percentiles(spark, folder):
    pcts = {"p05": 5.0, "p50": 50.0, "p95": 95.0, "p99": 99.0}
    rows = percentiles(_readings(spark, folder), KEYS, pcts)
    return rows.select(*KEYS, *[_r6(name) for name in pcts])


@query
def series_percentiles_sliced(spark, folder):
    pcts = {"p05": 5.0, "p50": 50.0, "p95": 95.0, "p99": 99.0}
    rows = percentiles(_readings(spark, folder), KEYS, pcts, _forced(spark, folder))
    return rows.select(*KEYS, *[_r6(name) for name in pcts])


@query
def price_percentiles(spark, folder):
    """The percentile operator on another table and grouping."""
    lines = table(spark, folder, "lineitem").withColumnRenamed("l_extendedprice", "value")
    pcts = {"p50": 50.0, "p95": 95.0}
    rows = percentiles(lines, ["l_returnflag", "l_linestatus"], pcts)
    return rows.select("l_returnflag", "l_linestatus", *[_r6(name) for name in pcts])


@query
def whole_series_stats(spark, folder):
    rows = series_stats(_readings(spark, folder))
    return rows.select(*KEYS, "n", _r6("mean"), _r6("variance"), _r6("std"))


def _running(spark, folder, skew=SkewConfig()):
    return _moments(with_running_moments(_readings(spark, folder), KEYS, ORDER, "value", skew))


def _moments(rows):
    return rows.select(
        "message_id",
        "running_n",
        # The mean as a sum: whole cents, so there is no tie to round.
        F.round(F.col("running_mean") * F.col("running_n"), 4).alias("running_sum"),
        # Root first: its digits have no ties, those of the variance do.
        F.round(F.sqrt("running_var"), 6).alias("running_std"),
    )


@query
def running_moments(spark, folder):
    return _running(spark, folder)


@query
def running_moments_sliced(spark, folder):
    return _running(spark, folder, _forced(spark, folder))


# Spikes of window means


def _spikes(spark, folder, windows, cfg=DetectConfig()):
    rows = _readings(spark, folder)
    skew = decided(rows, KEYS, SkewConfig())
    scored = detect.score_windows(window_stats(rows, windows, skew=skew), cfg, skew)
    return scored.filter(detect.is_window_anomaly(cfg)).select(
        *KEYS,
        _ntz("detected_at", "window_end"),
        _r6("observed_value", "mean"),
        "baseline_n",
        _r6("baseline_mean"),
        _r6("baseline_std"),
        _r6("zscore", "z"),
        detect.severity(F.col("z"), cfg.z_threshold, cfg.window_critical_factor).alias("severity"),
    )


@query
def window_spikes_six_hours(spark, folder):
    return _spikes(spark, folder, SIX_HOURS)


@query
def window_spikes_daily(spark, folder):
    return _spikes(spark, folder, ONE_DAY)


def _published(alerts: DataFrame) -> DataFrame:
    return alerts.select(
        *KEYS,
        "anomaly_type",
        _ntz("detected_at"),
        _r6("observed_value"),
        "zscore",
        "severity",
    )


@query
def all_alerts(spark, folder):
    rows = _readings(spark, folder)
    skew = decided(rows, KEYS, SkewConfig())
    windows = detect.window_alerts(window_stats(rows, SIX_HOURS, skew=skew), skew=skew)
    return _published(detect.all_alerts(detect.record_alerts(rows, skew=skew), windows))


@query
def window_alert_rows(spark, folder):
    """Alert rows of windows as published, with the message."""
    rows = _cents(_readings(spark, folder))
    skew = decided(rows, KEYS, SkewConfig())
    alerts = detect.window_alerts(window_stats(rows, SIX_HOURS, skew=skew), skew=skew)
    return alerts.withColumn("detected_at", F.col("detected_at").cast("timestamp_ntz"))


# Deduplication: user ids stand in for message ids that come back


def _flagged(spark, folder, skew=SkewConfig()):
    return dedup_ttl(_readings(spark, folder, "user_id"), DAY_TTL, ["event_id"], skew)


@query
def dedup_flagged(spark, folder):
    return _flagged(spark, folder).select("event_id", "message_id", "is_duplicate")


@query
def dedup_flagged_chain(spark, folder):
    """The same with every id treated as hot."""
    return _flagged(spark, folder, _forced(spark, folder)).select("event_id", "message_id", "is_duplicate")


@query
def dedup_accepted(spark, folder):
    rows = accepted(_flagged(spark, folder))
    return rows.select("event_id", "message_id", *KEYS, "value", _ntz("timestamp"))


@query
def dedup_duplicates(spark, folder):
    rows = duplicates(_flagged(spark, folder))
    return rows.select("event_id", "message_id", *KEYS, "value", _ntz("timestamp"))


@query
def dedup_short_ttl(spark, folder):
    rows = _readings(spark, folder, "user_id")
    flagged = dedup_ttl(rows, DedupConfig(ttl_seconds=3600), ["event_id"])
    return flagged.select("event_id", "message_id", "is_duplicate")


@query
def dedup_statistics(spark, folder):
    rows = _readings(spark, folder, "user_id")
    return metrics.dedup_stats(_flagged(spark, folder), DAY_TTL, rows=rows)


# Parsing


@query
def parse_valid(spark, folder):
    rows = valid_records(parse(_raw(spark, folder), received_at=F.col("received_at")))
    return rows.select(
        "event_id", "message_id", *KEYS, "value", "unit", _ntz("timestamp")
    )


@query
def parse_tags(spark, folder):
    rows = valid_records(parse(_raw(spark, folder), received_at=F.col("received_at")))
    return rows.select(
        "event_id",
        F.col("tags_map")["k"].alias("k"),
        F.try_variant_get("tags", "$.k", "bigint").alias("k_number"),
    )


@query
def parse_dead_letters(spark, folder):
    parsed = parse(_raw(spark, folder), received_at=F.col("received_at"))
    return dead_letters(parsed).select(
        "raw_payload", "reason", "reason_code", _ntz("received_at")
    )


@query
def parse_outcomes(spark, folder):
    parsed = parse(_raw(spark, folder), received_at=F.col("received_at"))
    return parsed.groupBy(F.coalesce("reason_code", F.lit("VALID")).alias("outcome")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query
def parse_page_markup(spark, folder):
    """Whole texts that are not messages: every page goes to the dead letters."""
    pages = table(spark, folder, "pages").select("page_id", F.col("html").alias("raw"))
    parsed = parse(pages)
    return parsed.select(
        "page_id", "reason_code", F.substring("raw", 1, 500).alias("raw_payload")
    )


@query
def source_decoded_rows(spark, folder):
    """Rows as a broker hands them over: bytes with their coordinates."""
    sent = _raw(spark, folder).select(
        F.encode("raw", "UTF-8").alias("value"),
        F.lit("telemetry.raw").alias("topic"),
        (F.col("event_id") % 3).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
    )
    return valid_records(parse(from_kafka(sent))).select(
        "partition", "offset", "message_id", *KEYS, "value", _ntz("timestamp")
    )


@query
def source_text_outcomes(spark, folder):
    """Messages written as text lines and read back as a source of lines."""
    path = f"{_stream_folder(spark)}/lines"
    _raw(spark, folder).select("raw").write.text(path)
    parsed = parse(open_source(spark, "json", path))
    return parsed.groupBy(F.coalesce("reason_code", F.lit("VALID")).alias("outcome")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query
def source_parquet_outcomes(spark, folder):
    """Messages of a Parquet source, with the columns that go beside them."""
    path = f"{_stream_folder(spark)}/messages"
    _raw(spark, folder).write.parquet(path)
    parsed = parse(open_source(spark, "parquet", path))
    return parsed.groupBy(F.coalesce("reason_code", F.lit("VALID")).alias("outcome")).agg(
        F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_event")
    )


@query
def record_ages(spark, folder):
    now = F.lit("2024-02-01 00:00:00").cast("timestamp")
    rows = _readings(spark, folder)
    return rows.select("message_id", F.round(text.age_seconds(F.col("timestamp"), now), 6).alias("age_seconds"))


# Statistics of the stages


@query
def aggregator_statistics(spark, folder):
    rows = _readings(spark, folder)
    return metrics.aggregator_stats(rows, window_stats(rows, ONE_DAY))


@query
def aggregator_buffers(spark, folder):
    rows = _readings(spark, folder).filter(F.col("timestamp") <= F.lit(MID_WINDOW).cast("timestamp"))
    return metrics.buffer_sizes(rows, MID_WINDOW, SIX_HOURS)


@query
def detector_statistics(spark, folder):
    rows = _readings(spark, folder)
    return metrics.detector_stats(
        rows, window_stats(rows, SIX_HOURS), detect.record_alerts(rows)
    )


# Everything composed, from JSON text to alerts


def _end_to_end(spark, folder, name):
    cfg = replace(EngineConfig(), dedup=DAY_TTL, windows=ONE_DAY)
    return run_batch(_raw(spark, folder, "user_id"), cfg, tie_break=["event_id"], wanted=[name])[name]


@query
def end_to_end_alerts(spark, folder):
    return _published(_end_to_end(spark, folder, "alerts"))


@query
def end_to_end_windows(spark, folder):
    return _windows(_end_to_end(spark, folder, "windows"))


@query
def end_to_end_records(spark, folder):
    rows = _end_to_end(spark, folder, "records")
    return rows.select("event_id", "message_id", *KEYS, "value", _ntz("timestamp"))


@query
def end_to_end_counters(spark, folder):
    return _end_to_end(spark, folder, "counters")


# Streams: the events file is read as a stream and drained


def _event_stream(spark, folder):
    schema = table(spark, folder, "events").schema
    # A pattern, since a stream reads a single file only through one; it fits a folder as well.
    return spark.readStream.schema(schema).parquet(f"{folder}/{{events}}.parquet")


def _stream_folder(spark):
    return f"{use_checkpoint_dir(spark)}/stream-{uuid.uuid4().hex}"


def _drain(rows: DataFrame) -> DataFrame:
    """Run a stream over what is there now and read back what it wrote."""
    spark = rows.sparkSession
    folder = _stream_folder(spark)
    run = (
        rows.writeStream.format("parquet")
        .option("path", f"{folder}/out")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{folder}/out")


def _five_times(spark, folder, part, run):
    """Append the events in five parts to a folder and drain it after each; ``part`` tells the trigger of a row, from
    0 to 4. ``run`` starts a stream on the folder's rows."""
    events, path = table(spark, folder, "events"), f"{_stream_folder(spark)}/events"
    for n in range(5):
        spread(events.filter(part == n)).write.mode("append").parquet(path)
        run(spark.readStream.schema(events.schema).parquet(path))


@query
def stream_restart_records(spark, folder):
    """A second run on the same folder goes on where the first has ended."""
    events, out = table(spark, folder, "events"), _stream_folder(spark)
    half = F.col("event_id") % 2
    for n in range(2):
        events.filter(half == n).write.mode("append").parquet(f"{out}/events")
        rows = spark.readStream.schema(events.schema).parquet(f"{out}/events")
        _whole_stream(spark, raw_messages(rows), f"{out}/state", EngineConfig())
    flagged = published(spark, f"{out}/state", "flagged").filter(~F.col("is_duplicate"))
    return flagged.select("event_id", "message_id", *KEYS, "value", _ntz("timestamp"))


def _fifth(spark, folder, time):
    """The fifth of the span of ``time``, a timestamp of the events, that a row is in."""
    first, last = table(spark, folder, "events").agg(F.unix_micros(F.min(time)), F.unix_micros(F.max(time))).first()
    share = (F.unix_micros(time) - F.lit(first)) / F.lit(max(1, last - first))
    return F.least(F.floor(share * 5), F.lit(4))


def _by_time(spark, folder):
    return _fifth(spark, folder, F.col("ts").cast("timestamp"))


def _by_message_time(spark, folder):
    """As the messages tell it: some give their time with an offset, some in whole seconds (see ``raw_messages``)."""
    time, case = F.col("ts").cast("timestamp"), F.col("event_id") % 25
    told = F.when(case == 11, time - F.expr("INTERVAL 330 MINUTES")).when(case == 6, F.date_trunc("second", time))
    return _fifth(spark, folder, told.otherwise(time))


def _run(rows: DataFrame, out: str, step) -> None:
    run_by_trigger(rows, out, step, {"availableNow": True}).awaitTermination()


def _flags(spark, out):
    return published(spark, out, "flagged").select("event_id", "message_id", "is_duplicate")


@query
def stream_dedup(spark, folder):
    out = _stream_folder(spark)
    _run(readings(_event_stream(spark, folder), "user_id"), out, DedupStage(DAY_TTL, ["event_id"]).step)
    return _flags(spark, out)


def _dedup_five_times(spark, folder, part):
    out = _stream_folder(spark)
    stage = DedupStage(DAY_TTL, ["event_id"], keep_seconds=366 * 24 * 3600, clock=Clock())
    _five_times(spark, folder, part, lambda rows: _run(readings(rows, "user_id"), out, stage.step))
    return _flags(spark, out)


@query
def stream_dedup_five_triggers(spark, folder):
    """The ids of earlier triggers count."""
    return _dedup_five_times(spark, folder, _by_time(spark, folder))


@query
def stream_dedup_out_of_order(spark, folder):
    """Every trigger holds a fifth of all times; a copy counts as one if an accepted row is close to it in time."""
    return _dedup_five_times(spark, folder, F.col("event_id") % 5)


@query
def stream_dedup_keyed_state(spark, folder):
    """The same with state kept by Spark."""
    rows = streaming.watermarked(readings(_event_stream(spark, folder), "user_id"))
    flagged = streaming.dedup_ttl(rows, DAY_TTL, ["event_id"])
    return _drain(flagged).select("event_id", "message_id", "is_duplicate")


@query
def stream_dedup_within_watermark(spark, folder):
    """In one trigger the built-in operator keeps one row per id."""
    rows = readings(_event_stream(spark, folder), "user_id")
    return _drain(streaming.dedup_within_watermark(rows, DAY_TTL)).select("message_id")


@query
def stream_watermark_drops(spark, folder):
    """Rows read and rows dropped behind the watermark, where every trigger holds a fifth of all times."""
    out, seen = _stream_folder(spark), []

    def run(rows):
        rows = streaming.observed(readings(rows))
        kept = streaming.dedup_within_watermark(rows, DAY_TTL)
        writer = kept.writeStream.format("parquet").option("path", f"{out}/out")
        run = writer.option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start()
        run.awaitTermination()
        seen.append(streaming.totals_of(run))

    _five_times(spark, folder, F.col("event_id") % 5, run)
    counts = [sum(t.get(n, 0) for t in seen) for n in ("input_rows", "dropped_dedupeWithinWatermark")]
    kept = spark.read.parquet(f"{out}/out").agg(F.count(F.lit(1)).alias("kept"))
    return kept.select(F.lit(counts[0]).cast("bigint").alias("received"), F.lit(counts[1]).cast("bigint").alias("dropped"), "kept")


def _scores_by_trigger(spark, rows, out, skew=SkewConfig()):
    now = {"availableNow": True}
    score_by_trigger(rows, out, parquet_sink(f"{out}/scored"), skew=skew, trigger=now).awaitTermination()


def _scores(spark, out):
    return _scored(spark.read.parquet(f"{out}/scored"))


@query
def stream_zscore_baseline(spark, folder):
    out = _stream_folder(spark)
    _scores_by_trigger(spark, readings(_event_stream(spark, folder)), out)
    return _scores(spark, out)


@query
def stream_zscore_five_triggers(spark, folder):
    out = _stream_folder(spark)
    part = _by_time(spark, folder)
    _five_times(spark, folder, part, lambda rows: _scores_by_trigger(spark, readings(rows), out))
    return _scores(spark, out)


@query
def stream_running_moments(spark, folder):
    """Count, sum and deviation of the series so far, merged over five triggers."""
    out, stage = _stream_folder(spark), MomentStage()
    _five_times(spark, folder, _by_time(spark, folder), lambda rows: _run(readings(rows), out, stage.step))
    return _moments(published(spark, out, "moments"))


@query
def stream_zscore_keyed_state(spark, folder):
    return _scored(_drain(streaming.score_records(readings(_event_stream(spark, folder)))))


@query
def stream_zscore_by_trigger(spark, folder):
    """The same scores by the batch operator, with every series treated as hot."""
    out = _stream_folder(spark)
    _scores_by_trigger(spark, readings(_event_stream(spark, folder)), out, _forced(spark, folder))
    return _scores(spark, out)


@query
def window_stats_sketched(spark, folder):
    """Percentiles of sketches, and whether their rank is as near to the wanted one as a sketch of this size promises."""
    rows = _readings(spark, folder)
    cfg = replace(ONE_DAY, percentile_method="sketch")
    placed = assign_windows(rows.select(*KEYS, "timestamp", "value"), cfg)
    stats = window_stats(rows, cfg).select(*KEYS, "window_start", "sample_count", "minimum", "maximum", "p95")
    both = placed.drop("window_end").join(stats, [*KEYS, "window_start"])
    ranks = both.groupBy(*KEYS, "window_start").agg(
        F.first("sample_count").alias("sample_count"),
        (F.count_if(F.col("value") < F.col("p95")) / F.count("value")).alias("below"),
        (F.count_if(F.col("value") <= F.col("p95")) / F.count("value")).alias("upto"),
    )
    bound = F.lit(rank_error(cfg.sketch_size)) + 1 / F.col("sample_count")
    near = (F.col("below") <= 0.95 + bound) & (F.col("upto") >= 0.95 - bound)
    return ranks.select(*KEYS, _ntz("window_start"), "sample_count", near.alias("within_bound"))


@query
def stream_window_stats(spark, folder):
    rows = streaming.watermarked(readings(_event_stream(spark, folder)))
    return _windows(_drain(streaming.window_stats(rows, ONE_DAY)))


@query
def stream_window_spikes(spark, folder):
    rows = streaming.watermarked(readings(_event_stream(spark, folder)))
    return _published(_drain(streaming.window_alerts(streaming.window_stats(rows, ONE_DAY))))


def _windows_by_trigger(spark, folder, cfg, part=None, view=readings):
    out, stage = _stream_folder(spark), WindowStage(cfg)
    if part is None:
        _run(view(_event_stream(spark, folder)), out, stage.step)
    else:
        _five_times(spark, folder, part, lambda rows: _run(view(rows), out, stage.step))
    return _windows(published(spark, out, "closed"))


@query
def stream_windows_five_triggers(spark, folder):
    return _windows_by_trigger(spark, folder, ONE_DAY, _by_time(spark, folder))


@query
def stream_windows_future_reading(spark, folder):
    """One reading of the first trigger is dated 2099. It moves no clock, and no other reading is late for it."""
    first = table(spark, folder, "events").agg(F.min("event_id")).first()[0]

    def view(events):
        ahead = F.when(F.col("event_id") == first, F.lit("2099-01-01").cast("timestamp_ntz"))
        return readings(events.withColumn("ts", F.coalesce(ahead, F.col("ts").cast("timestamp_ntz"))))

    part = F.when(F.col("event_id") == first, 0).otherwise(_by_time(spark, folder))
    return _windows_by_trigger(spark, folder, ONE_DAY, part, view)


@query
def stream_anchored_windows(spark, folder):
    return _windows_by_trigger(spark, folder, ANCHORED)


@query
def stream_anchored_five_triggers(spark, folder):
    return _windows_by_trigger(spark, folder, ANCHORED, _by_time(spark, folder))


@query
def stream_anchored_keyed_state(spark, folder):
    rows = streaming.watermarked(readings(_event_stream(spark, folder)))
    return _windows(_drain(streaming.anchored_window_stats(rows, ONE_DAY)))


def _whole_stream(spark, raw, out, cfg=replace(EngineConfig(), dedup=DAY_TTL, windows=ONE_DAY)):
    streams = start_streams(raw, out, cfg, tie_break=["event_id"], trigger={"availableNow": True})
    streams.wait()
    streams.stop()
    return streams.counters


def _stream_alerts(spark, out):
    return _published(published(spark, out, "alerts"))


@query
def stream_end_to_end_alerts(spark, folder):
    out = _stream_folder(spark)
    _whole_stream(spark, raw_messages(_event_stream(spark, folder), "user_id"), out)
    return _stream_alerts(spark, out)


def _alerts_five_times(spark, folder, part):
    out = _stream_folder(spark)
    _five_times(spark, folder, part, lambda rows: _whole_stream(spark, raw_messages(rows, "user_id"), out))
    return _stream_alerts(spark, out)


@query
def stream_end_to_end_five_triggers(spark, folder):
    """Messages in the order of the times they tell."""
    return _alerts_five_times(spark, folder, _by_message_time(spark, folder))


@query
def stream_end_to_end_arrival_order(spark, folder):
    """Messages with an offset arrive a trigger late; all is decided in the order of arrival."""
    return _alerts_five_times(spark, folder, _by_time(spark, folder))


@query
def stream_end_to_end_windows(spark, folder):
    """The table of windows that the stream publishes."""
    out = _stream_folder(spark)
    part = _by_message_time(spark, folder)
    _five_times(spark, folder, part, lambda rows: _whole_stream(spark, raw_messages(rows, "user_id"), out))
    return _windows(published(spark, out, "windows"))


def _out_of_order(spark, folder):
    """Every trigger holds a fifth of all times, so all but the first bring late readings."""
    out = _stream_folder(spark)
    _five_times(spark, folder, F.col("event_id") % 5, lambda rows: _whole_stream(spark, raw_messages(rows), out))
    return out


@query
def stream_late_records(spark, folder):
    """Late readings are processed like others."""
    rows = published(spark, _out_of_order(spark, folder), "flagged").filter(~F.col("is_duplicate"))
    return rows.select("event_id", "message_id", *KEYS, "value", _ntz("timestamp"))


@query
def stream_late_counters(spark, folder):
    """received = malformed + dupes + processed; the late ones had their window closed."""
    rows = Counters(spark, _out_of_order(spark, folder)).rows()
    names = ("received", "malformed", "dupes", "processed", "late")
    return rows.agg(*[F.sum(c).alias(c) for c in names])


@query
def stream_statistics_five_triggers(spark, folder):
    """What deduplication, aggregation and detection hold after each trigger."""
    out = _stream_folder(spark)
    part = _by_message_time(spark, folder)
    _five_times(spark, folder, part, lambda rows: _whole_stream(spark, raw_messages(rows, "user_id"), out))
    return Counters(spark, out).statistics()
