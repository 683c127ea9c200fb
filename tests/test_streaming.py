import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import SCHEMA, START, at, record, records, rows_of, series
from tidegauge.config import (
    DedupConfig,
    DetectConfig,
    EngineConfig,
    KafkaConfig,
    SkewConfig,
    WindowConfig,
)
from tidegauge.operators import dedup, detect, windows
from tidegauge.plans.batch import run_batch
from tidegauge.sources.readers import kafka_options, open_source
from tidegauge.sources.sinks import parquet_sink, print_alerts, print_windows
from tidegauge.streaming import operators as ops
from tidegauge.streaming.batchwise import score_by_trigger
from tidegauge.streaming.ledger import KeyedState, published, run_by_trigger
from tidegauge.streaming.run import start_streams
from tidegauge.streaming.triggers import DedupStage, ScoreStage, WindowStage

NOW = {"availableNow": True}

SCORED = ["message_id", "baseline_n", "baseline_mean", "baseline_std"]


def write_parts(spark, rows, folder, parts):
    """The rows in time order as that many files, one per trigger."""
    ordered = sorted(rows, key=lambda r: (r[5], r[6]))
    size = -(-len(ordered) // parts)
    for i in range(parts):
        chunk = records(spark, ordered[i * size : (i + 1) * size])
        chunk.coalesce(1).write.mode("append").parquet(str(folder))
        time.sleep(0.05)


def stream_of(spark, folder):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(folder))


def drain(df, folder):
    query = (
        df.writeStream.format("parquet")
        .option("path", f"{folder}/out")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/out")


@pytest.fixture(scope="module")
def data():
    rng = random.Random(11)
    return [
        record(i, round(rng.gauss(10, 2), 2), i * 7 + rng.random(), message_id=f"m{rng.randint(0, 40)}",
               sensor=f"s{i % 3}")
        for i in range(300)
    ]


@pytest.mark.parametrize("expire", [True, False])
def test_dedup_equals_batch_over_triggers(spark, tmp_path, data, expire):
    write_parts(spark, data, tmp_path / "in", 3)
    cfg = DedupConfig(ttl_seconds=200)
    rows = stream_of(spark, tmp_path / "in")
    rows = ops.watermarked(rows) if expire else rows
    got = drain(ops.dedup_ttl(rows, cfg, ["seq"], expire), tmp_path)
    want = dedup.dedup_ttl(records(spark, data), cfg, ["seq"])
    assert rows_of(got, "seq", "is_duplicate") == rows_of(want, "seq", "is_duplicate")
    assert 0 < got.filter("is_duplicate").count() < 300


def test_dedup_within_watermark_keeps_at_least_the_first(spark, tmp_path, data):
    write_parts(spark, data, tmp_path / "in", 3)
    cfg = DedupConfig(ttl_seconds=200)
    got = drain(ops.dedup_within_watermark(stream_of(spark, tmp_path / "in"), cfg), tmp_path)
    exact = dedup.accepted(dedup.dedup_ttl(records(spark, data), cfg, ["seq"])).count()
    assert 41 <= got.count() <= exact


def test_scores_equal_batch_over_triggers(spark, tmp_path, data):
    unique = [(f"u{r[6]:04d}",) + r[1:] for r in data]
    write_parts(spark, unique, tmp_path / "in", 3)
    got = {r[0]: tuple(r)[1:] for r in drain(ops.score_records(stream_of(spark, tmp_path / "in")), tmp_path).select(*SCORED).collect()}
    want = {r[0]: tuple(r)[1:] for r in detect.score_records(records(spark, unique)).select(*SCORED).collect()}
    assert got.keys() == want.keys()
    for key, row in want.items():
        assert got[key] == pytest.approx(row, nan_ok=True)


@pytest.mark.parametrize("skew", [SkewConfig(), SkewConfig(mode="on", rows_per_slice=20)])
def test_scores_by_trigger_equal_batch(spark, tmp_path, data, skew):
    unique = [(f"u{r[6]:04d}",) + r[1:] for r in data]
    write_parts(spark, unique, tmp_path / "in", 3)
    query = score_by_trigger(
        stream_of(spark, tmp_path / "in"), str(tmp_path), parquet_sink(f"{tmp_path}/scored"),
        skew=skew, trigger={"availableNow": True},
    )
    query.awaitTermination()
    got = {r[0]: tuple(r)[1:] for r in spark.read.parquet(f"{tmp_path}/scored").select(*SCORED).collect()}
    want = {r[0]: tuple(r)[1:] for r in detect.score_records(records(spark, unique)).select(*SCORED).collect()}
    assert got.keys() == want.keys()
    for key, row in want.items():
        assert got[key] == pytest.approx(row, nan_ok=True)


def test_windows_and_spikes_equal_batch(spark, tmp_path, data):
    write_parts(spark, data, tmp_path / "in", 3)
    cfg = WindowConfig(window_seconds=100)
    loose = DetectConfig(z_threshold=1.0)
    newest = max(r[5] for r in data)
    as_of = START.replace(tzinfo=None) + (newest - START)
    want = windows.window_stats(records(spark, data), cfg, as_of=as_of.isoformat(sep=" "))
    rows = ops.watermarked(stream_of(spark, tmp_path / "in"))
    got = drain(ops.window_stats(rows, cfg), tmp_path / "w")
    assert rows_of(windows.rounded(got)) == rows_of(windows.rounded(want))
    spikes = drain(ops.window_alerts(ops.window_stats(rows, cfg), loose), tmp_path / "s")
    expected = detect.window_alerts(want, loose)
    columns = ["sensor_id", "detected_at", "severity"]
    assert rows_of(spikes, *columns) == rows_of(expected, *columns) and expected.count() > 0


@pytest.mark.parametrize("parts", [1, 4])
def test_anchored_windows_equal_batch(spark, tmp_path, parts):
    """Sparse stretches leave windows out and never move the grid, whatever the triggers."""
    rng = random.Random(4)
    rows, t = [], 0.0
    for i in range(240):
        t += 50 if i in (80, 150) else rng.randint(0, 4)
        rows.append(record(i, i % 13, t, sensor=f"s{i % 2}"))
    write_parts(spark, rows, tmp_path / "in", parts)
    cfg = WindowConfig(window_seconds=20, min_samples=3, alignment="series")
    newest = max(r[5] for r in rows).replace(tzinfo=None).isoformat(sep=" ")
    want = rows_of(windows.rounded(windows.window_stats(records(spark, rows), cfg, as_of=newest)))
    stream = ops.watermarked(stream_of(spark, tmp_path / "in"))
    keyed = drain(ops.anchored_window_stats(stream, cfg), tmp_path / "keyed").drop("closed_at")
    assert rows_of(windows.rounded(keyed)) == want and len(want) > 5
    folder = str(tmp_path / "stage")
    run_by_trigger(stream_of(spark, tmp_path / "in"), folder, WindowStage(cfg).step, NOW).awaitTermination()
    assert rows_of(windows.rounded(published(spark, folder, "closed").drop("batch_id"))) == want


def late_chunks():
    """Times in four triggers, many of them far behind."""
    rng = random.Random(9)
    rows = [record(i, round(rng.gauss(10, 2), 2), i * 5, message_id=f"m{rng.randint(0, 150)}", sensor=f"s{i % 2}") for i in range(200)]
    rng.shuffle(rows)
    return [rows[i::4] for i in range(4)]


@pytest.mark.parametrize("every, slots", [(8, 32), (2, 2)])
def test_late_rows_by_hand(spark, tmp_path, monkeypatch, every, slots):
    monkeypatch.setattr(KeyedState, "EVERY", every)
    chunks, folder = late_chunks(), str(tmp_path)
    for chunk in chunks:
        records(spark, chunk).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        time.sleep(0.05)
    dedup_cfg, cfg = DedupConfig(ttl_seconds=100), WindowConfig(window_seconds=50, min_samples=1)
    first = DedupStage(dedup_cfg, ["seq"], keep_seconds=100_000, slots=slots)
    scores, by_window = ScoreStage.of_readings(), WindowStage(cfg, slots=slots)
    scores.state.slots = slots

    def step(batch, turn):
        kept = first.step(batch, turn).filter("not is_duplicate")
        turn.write("scored", scores.step(kept, turn))
        by_window.step(kept, turn)

    run_by_trigger(stream_of(spark, f"{folder}/in"), folder, step, NOW).awaitTermination()

    accepted, series, clock = {}, {}, None
    flags, scored, late, waiting, closed = {}, {}, set(), {}, {}
    for chunk in chunks:
        kept = []
        for r in sorted(chunk, key=lambda r: (r[5], r[6])):
            t = (r[5] - START).total_seconds()
            flags[r[6]] = any(abs(t - a) <= 100 for a in accepted.get(r[0], []))
            if not flags[r[6]]:
                accepted.setdefault(r[0], []).append(t)
                kept.append((t, r))
        for t, r in sorted(kept, key=lambda x: (x[1][5], x[1][0])):
            before = series.setdefault(r[1], [])[-20:]
            scored[r[6]] = (len(before), round(float(np.mean(before)), 6) if before else None)
            series[r[1]].append(r[3])
        for t, r in kept:
            end = (t // 50 + 1) * 50
            if clock is not None and end <= clock:
                late.add((r[1], t))
            else:
                waiting.setdefault((r[1], end), []).append(r[3])
        clock = max([t for t, _ in kept] + ([] if clock is None else [clock]))
        for key in [k for k in waiting if k[1] <= clock]:
            values = waiting.pop(key)
            closed[key] = (len(values), round(float(np.mean(values)), 6))
    got = published(spark, folder, "flagged").select("seq", "is_duplicate").collect()
    assert dict(map(tuple, got)) == flags and 0 < sum(flags.values()) < 200
    got = published(spark, folder, "scored").select("seq", "baseline_n", F.round("baseline_mean", 6)).collect()
    assert {r[0]: (r[1], r[2]) for r in got} == scored
    base = START.timestamp()
    got = published(spark, folder, "late").select("sensor_id", F.unix_micros("timestamp") / 1e6 - base).collect()
    assert {(s, round(t, 6)) for s, t in got} == late and len(late) > 20
    got = published(spark, folder, "closed").select("sensor_id", F.unix_micros("window_end") / 1e6 - base, "sample_count", F.round("mean", 6)).collect()
    assert {(s, t): (n, m) for s, t, n, m in got} == closed


def test_console_sinks_print_every_row(spark, capsys):
    rows = series(spark, [10.0, 10.1] * 10 + [500.0, 10.0] * 30)
    alerts = detect.record_alerts(rows, DetectConfig(z_threshold=0.1))
    print_alerts(alerts, 0)
    assert len(capsys.readouterr().out.splitlines()) == alerts.count() > 40


def raw_rows(n=200):
    rng = random.Random(8)
    rows = []
    for i in range(n):
        time_text = at(i * 5).isoformat()
        text = (
            f'{{"message_id":"m{rng.randint(0, n)}","sensor_id":"s{i % 2}","metric_name":"p",'
            f'"value":{500 if i == 150 else round(rng.gauss(10, 1), 2)},"unit":"bar",'
            f'"timestamp":"{time_text}","tags":{{"plant":"A7"}}}}'
        )
        rows.append((i, "oops" if i % 20 == 3 else text))
    return rows


def test_whole_stream_equals_batch_and_restarts(spark, tmp_path):
    """Two runs on the same folder: the second goes on where the first ended."""
    schema = "seq int, raw string"
    rows = raw_rows()
    cfg = EngineConfig(dedup=DedupConfig(ttl_seconds=200), windows=WindowConfig(window_seconds=60))
    source, folder = str(tmp_path / "in"), str(tmp_path / "state")
    totals = []
    for part in (rows[:120], rows[120:]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(source)
        raw = open_source(spark, "parquet", source, streaming=True, schema=spark.createDataFrame(part, schema).schema)
        streams = start_streams(
            raw, folder, cfg, tie_break=["seq"], trigger={"availableNow": True}
        )
        streams.wait(120)
        totals.append(streams.counters.totals())
        streams.stop()

    batch = run_batch(spark.createDataFrame(rows, schema), cfg, tie_break=["seq"])
    flagged = published(spark, folder, "flagged")
    assert rows_of(flagged.filter("not is_duplicate"), "seq", "value") == rows_of(batch["records"], "seq", "value")
    assert published(spark, folder, "dead_letters").count() == batch["dead_letters"].count() == 10
    columns = ["sensor_id", "detected_at", "zscore", "severity"]
    assert rows_of(published(spark, folder, "alerts").filter("kind = 'record'"), *columns) == rows_of(batch["record_alerts"], *columns)
    newest = batch["records"].agg(F.max("timestamp")).first()[0]
    closed = batch["windows"].filter(F.col("window_end") <= F.lit(newest))
    got = published(spark, folder, "windows").drop("batch_id")
    assert rows_of(windows.rounded(got)) == rows_of(windows.rounded(closed))

    counted = batch["counters"].first()
    assert counted["received"] == counted["malformed"] + counted["dupes"] + counted["processed"]
    for name in ("received", "malformed", "dupes", "processed"):
        assert totals[1][name] == counted[name] > totals[0][name]
    assert totals[1]["alerts"] >= 1 and totals[1]["windows"] == got.count()


def test_late_rows_are_processed_and_counted(spark, tmp_path):
    source, folder = str(tmp_path / "in"), str(tmp_path / "state")
    totals = []
    for seconds in ([0, 500], [1000, 100], [1500]):  # 100 comes after the watermark has passed 500
        lines = [
            f'{{"message_id":"m{s}","sensor_id":"s","metric_name":"p","value":1,"unit":"u",'
            f'"timestamp":"{at(s).isoformat()}"}}'
            for s in seconds
        ]
        spark.createDataFrame([(t,) for t in lines], "raw string").coalesce(1).write.mode("append").text(source)
        raw = open_source(spark, "text", source, streaming=True)
        streams = start_streams(raw, folder, trigger={"availableNow": True}, on_window=print_windows)
        streams.wait(120)
        totals.append(streams.counters.totals())
        streams.stop()
    assert totals[2]["received"] == totals[2]["processed"] == 5
    assert totals[2]["late"] == 1 and totals[1]["received"] == 4
    assert published(spark, folder, "late").count() == 1


def test_stop_and_file_sources(spark, tmp_path):
    lines = [text for _, text in raw_rows(30)]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text("\n".join(lines))
    batch = open_source(spark, "json", str(tmp_path / "in"))
    assert batch.columns == ["raw"] and batch.count() == 30
    raw = open_source(spark, "json", str(tmp_path / "in"), streaming=True)
    cfg = EngineConfig(flush_interval_seconds=1)
    seen = []
    streams = start_streams(
        raw, str(tmp_path / "state"), cfg,
        on_alert=lambda rows, n: None, on_window=lambda rows, n: seen.append(n),
    )
    deadline = time.time() + 120
    while time.time() < deadline and streams.counters.totals()["processed"] == 0:
        time.sleep(0.5)
    streams.stop()
    assert not any(q.isActive for q in streams.queries)
    assert streams.counters.totals()["received"] == 30


def test_kafka_options():
    options = kafka_options(KafkaConfig(max_offsets_per_trigger=1000))
    assert options["kafka.bootstrap.servers"] == "localhost:9092"
    assert options["subscribe"] == "telemetry.raw"
    assert options["startingOffsets"] == "earliest"
    assert options["groupIdPrefix"] and "kafka.group.id" not in options
    assert "kafka.group.id" in kafka_options(KafkaConfig(), fixed_group=True)
    assert options["kafka.session.timeout.ms"] == "30000"
    assert options["kafka.max.poll.records"] == "500"
    assert options["maxOffsetsPerTrigger"] == "1000"
    assert "enable.auto.commit" not in " ".join(options)
    bounded = kafka_options(KafkaConfig(max_offsets_per_trigger=1000), streaming=False)
    assert bounded["endingOffsets"] == "latest" and "maxOffsetsPerTrigger" not in bounded
    with pytest.raises(ValueError):
        open_source(None, "csv")
