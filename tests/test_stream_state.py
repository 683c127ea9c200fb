"""What a stream keeps between its triggers, and what readers see of it."""

import math
import random
import shutil
import time
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from helpers import SCHEMA, START, at, record, records, rows_of
from tidegauge.config import ClockConfig, DedupConfig, EngineConfig, SkewConfig, WindowConfig
from tidegauge.operators import dedup, metrics, windows
from tidegauge.plans.batch import run_batch
from tidegauge.plans.trailing import with_running_moments
from tidegauge.queries import all_queries
from tidegauge.schema import KEYS, ORDER
from tidegauge.streaming import operators as ops
from tidegauge.streaming.ledger import KeyedState, Turn, begin, manifest, published
from tidegauge.streaming.run import Counters, Engine
from tidegauge.streaming.triggers import Clock, DedupStage, LiveIds, MomentStage, WindowStage


def turns(spark, folder, chunks, step, make=records):
    """``step`` on one trigger per chunk, each published."""
    for n, chunk in enumerate(chunks):
        turn = begin(spark, str(folder), n)
        step(make(spark, chunk), turn)
        turn.publish()


def flags(spark, folder):
    return dict(map(tuple, published(spark, str(folder), "flagged").select("seq", "is_duplicate").collect()))


HOUR = 3600


def test_late_copies_are_judged_by_what_was_accepted_near_them(spark, tmp_path):
    chunks = [
        [record(0, seconds=10 * HOUR, message_id="a")],
        [record(1, seconds=8 * HOUR, message_id="a")],  # far before: another message
        [record(2, seconds=10 * HOUR - 120, message_id="a"), record(3, seconds=8 * HOUR + 300, message_id="a")],
        [record(4, seconds=8 * HOUR + 301, message_id="a"), record(5, seconds=8 * HOUR - 300, message_id="a")],
        [record(6, seconds=8 * HOUR + 301, message_id="b"), record(7, seconds=0, message_id="a")],
    ]
    stage = DedupStage(DedupConfig(ttl_seconds=300), ["seq"], keep_seconds=24 * HOUR)
    turns(spark, tmp_path, chunks, stage.step)
    assert flags(spark, tmp_path) == {0: False, 1: False, 2: True, 3: True, 4: False, 5: True, 6: False, 7: False}


@pytest.mark.parametrize("hot", [False, True])
def test_joins_of_the_deduplication_send_no_rows_through_the_driver(spark, tmp_path, hot):
    """Compressed tables are under the limit for broadcasts however many rows they hold."""
    plans = []
    skew = SkewConfig(mode="on") if hot else SkewConfig()
    stage = DedupStage(DedupConfig(ttl_seconds=300), ["seq"], skew, keep_seconds=24 * HOUR)

    def step(rows, turn):
        write = turn.write

        def watched(table, rows, **counts):
            plans.append(rows._jdf.queryExecution().executedPlan().toString())
            return write(table, rows, **counts)

        turn.write = watched
        stage.step(rows, turn)

    chunks = [[record(10 * n + i, seconds=100 * i + n, message_id="a") for i in range(8)] for n in range(2)]
    turns(spark, tmp_path, chunks, step)
    assert len(plans) == 2 and not any("BroadcastHashJoin" in p or "BroadcastExchange" in p for p in plans)
    assert sorted(n for n, again in flags(spark, tmp_path).items() if not again) == [0, 4, 17]


@pytest.mark.parametrize("name", ["stream_dedup_five_triggers", "stream_dedup_out_of_order"])
def test_deduplication_queries_broadcast_no_flagged_rows(spark, monkeypatch, name):
    plans, write = [], Turn.write

    def watched(turn, table, rows, **counts):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return write(turn, table, rows, **counts)

    monkeypatch.setattr(Turn, "write", watched)
    assert all_queries()[name](spark, "/root/testdata/sf0.001").count() == 1000
    assert len(plans) == 5 and not any("BroadcastExchange" in p for p in plans)


@pytest.mark.parametrize("every", [8, 2])
def test_shuffled_triggers_equal_batch_where_no_copies_conflict(spark, tmp_path, monkeypatch, every):
    """Copies are at one time exactly, so their order does not matter."""
    monkeypatch.setattr(KeyedState, "EVERY", every)
    rng = random.Random(5)
    rows = [record(i, seconds=rng.randrange(40) * 500, message_id=rng.choice(["x", "y", f"m{i % 9}"])) for i in range(150)]
    rows += [(None, *r[1:6], 1000 + i) for i, r in enumerate(rows[:10])]  # rows without an id
    rows += [(*r[:5], None, 2000 + i) for i, r in enumerate(rows[:10])]  # rows without a time
    want = dedup.dedup_ttl(records(spark, rows), DedupConfig(ttl_seconds=300))
    rng.shuffle(rows)
    stage = DedupStage(DedupConfig(ttl_seconds=300), keep_seconds=10**6, slots=4)
    turns(spark, tmp_path, [rows[i::6] for i in range(6)], stage.step)
    got = published(spark, str(tmp_path), "flagged")
    columns = ["message_id", "timestamp"]
    assert rows_of(got.where("not is_duplicate"), *columns) == rows_of(want.where("not is_duplicate"), *columns)
    assert got.where("is_duplicate").count() > 20


def test_ids_behind_the_clock_are_forgotten_but_not_for_a_wrong_clock(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(KeyedState, "EVERY", 1)
    cfg = DedupConfig(ttl_seconds=10)
    chunks = [
        [record(0, seconds=0, message_id="a"), *[record(10 + i, seconds=5 + i) for i in range(3)]],
        [record(1, seconds=4e9, message_id="z"), record(2, seconds=8, message_id="a"), record(3, seconds=9), record(4, seconds=9)],
        [record(5, seconds=1000, message_id="b"), record(6, seconds=1001, message_id="c")],
        [record(7, seconds=7, message_id="a")],  # long forgotten
    ]
    stage = DedupStage(cfg, ["seq"], clock=Clock(), slots=1)
    turns(spark, tmp_path, chunks, stage.step)
    got = flags(spark, tmp_path)
    assert got[2] and not got[7]


def test_one_future_reading_moves_no_clock(spark, tmp_path):
    ahead = [record(i, i, 10 * i, sensor="s") for i in range(20)] + [record(99, 1.0, 75 * 365 * 86400, sensor="s")]
    chunks = [ahead, [record(100 + i, i, 200 + 10 * i, sensor="s") for i in range(49)]]
    turns(spark, tmp_path, chunks, WindowStage(WindowConfig(window_seconds=60)).step)
    assert published(spark, str(tmp_path), "late").count() == 0
    closed = published(spark, str(tmp_path), "closed")
    good = records(spark, [r for c in chunks for r in c if r[6] != 99])
    want = windows.window_stats(good, WindowConfig(window_seconds=60), as_of=at(200 + 480).replace(tzinfo=None))
    assert rows_of(windows.rounded(closed.drop("batch_id"))) == rows_of(windows.rounded(want))
    assert closed.count() > 8


def stamped(spark, rows):
    """(partition, time, receive time) in seconds."""
    times = [(p, at(t), None if r is None else at(r)) for p, t, r in rows]
    return spark.createDataFrame(times, "partition int, timestamp timestamp, received_at timestamp")


def micros(seconds):
    return int((START.timestamp() + seconds) * 1e6)


def test_clock(spark, tmp_path):
    clock = Clock(ClockConfig(ahead_seconds=100, idle_seconds=50))
    steps = [
        ([(0, 10, 10), (1, 30, 30)], 10),  # the slower partition
        ([(0, 25, 35), (0, 5, 35)], 25),
        ([(1, 60, 60)], 25),
        ([(1, 500, 90), (1, 55, 90)], 60),  # ahead of its receipt by too much; partition 0 has been silent for too long
        ([(1, 95, 95), (None, 90, 95)], 90),  # rows without a partition are one
        ([(1, 20, 96), (None, 20, 96)], 90),  # never back
        ([], 90),
        ([(1, 150, 150), (None, 140, 150)], 140),
        ([(1, 1000, 1000), (None, 1001, 1001), (1, 160, 1000)], 1000),  # most rows are beyond the gap
        ([(1, 5000, 5001), (1, 1010, 5001), (1, 1011, 5001)], 1011),  # few are; the other one is silent
    ]
    for n, (rows, want) in enumerate(steps):
        turn = begin(spark, str(tmp_path), n)
        clock.step(stamped(spark, rows), turn)
        assert turn.values["clock"]["low"] == micros(want), n
        turn.publish()


def test_state_is_read_by_the_slots_of_the_keys(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(KeyedState, "EVERY", 3)
    state = KeyedState("numbers", "k bigint, v bigint", 8)
    slot = state.slot("k")

    def newest(rows):
        return rows.groupBy("k").agg(F.max_by("v", "__n").alias("v"), F.max("__n").alias("__n"))

    known, folder = {}, str(tmp_path)
    rng = random.Random(1)
    for n in range(12):
        turn = begin(spark, folder, n)
        keys = rng.sample(range(40), 2)
        rows = spark.createDataFrame([(k, 100 * n + k) for k in keys], "k bigint, v bigint")
        slots = state.touched(rows, slot)
        assert sorted({r[0] for r in rows.select(slot).collect()}) == slots and len(slots) <= 2
        held = state.read(turn, slots)
        if held is not None:
            read = {p.split("slot=")[1].split("/")[0] for p in held.inputFiles()}
            assert len(read) <= 8  # listed; what is scanned is told by the plan
            assert "PartitionFilters: [" in held._jdf.queryExecution().toString()
            got = {r["k"]: r["v"] for r in newest(held).collect()}
            place = dict(map(tuple, spark.range(40).withColumnRenamed("id", "k").select("k", slot).collect()))
            assert got == {k: v for k, v in known.items() if place[k] in slots}
        known |= {k: 100 * n + k for k in keys}
        state.merge(turn, rows, slot, slots, newest)
        turn.publish()
    turn = begin(spark, folder, 12)
    assert {r["k"]: r["v"] for r in newest(state.read(turn, range(8))).collect()} == known
    pieces = manifest(spark, folder, 11)["pieces"]["numbers"]
    assert all(len(p) <= 4 for p in pieces.values())
    used = {t.split("/")[0] for p in pieces.values() for t in p}
    stale = {t.split("/")[0] for _, t in manifest(spark, folder, 11)["stale"]}
    kept = {p.name.split("=")[1] for p in (tmp_path / "state/numbers").iterdir() if any(p.iterdir())}
    assert kept == used | stale


def lines(chunk):
    return [
        (i, f'{{"message_id":"{m}","sensor_id":"s{i % 2}","metric_name":"p","value":{v},"unit":"u","timestamp":"{at(t).isoformat()}"}}')
        for i, m, v, t in chunk
    ]


def raw_of(spark, chunk):
    return spark.createDataFrame(chunk, "seq int, raw string")


@pytest.fixture(scope="module")
def messages():
    rng = random.Random(2)
    rows = [(i, f"m{rng.randrange(120)}", 900 if i % 61 == 60 else round(rng.gauss(10, 1), 2), i * 7) for i in range(160)]
    return [lines(rows[i : i + 40]) + [(1000 + i, "no message")] for i in range(0, 160, 40)]


CFG = EngineConfig(dedup=DedupConfig(ttl_seconds=200), windows=WindowConfig(window_seconds=60))


def test_a_trigger_that_was_stopped_within_is_never_seen(spark, tmp_path, messages):
    folder = str(tmp_path)
    names = ["flagged", "alerts", "windows", "dead_letters"]

    def seen():
        return {n: published(spark, folder, n).count() for n in names} | Counters(spark, folder).totals()

    def stop(rows, n):
        if n == 2:
            raise RuntimeError("stopped")

    engine = Engine(CFG, tie_break=["seq"])
    turns(spark, folder, messages[:2], engine.step, raw_of)
    before = seen()
    halting = Engine(CFG, on_window=stop, tie_break=["seq"])
    for _ in range(2):
        with pytest.raises(RuntimeError, match="stopped"):
            halting.step(raw_of(spark, messages[2]), begin(spark, folder, 2))
        assert seen() == before  # alerts and flagged rows of the trigger were written, and are not shown
    # another run does the trigger again; one that was published already is left as it is
    for n in (2, 3):
        turn = begin(spark, folder, n)
        Engine(CFG, tie_break=["seq"]).step(raw_of(spark, messages[n]), turn)
        turn.publish()
    assert begin(spark, folder, 3) is None
    with pytest.raises(RuntimeError, match="published by another run"):
        turn.publish()
    with pytest.raises(RuntimeError, match="never published"):
        begin(spark, folder, 9)
    batch = run_batch(raw_of(spark, [m for c in messages for m in c]), CFG, tie_break=["seq"])
    got = published(spark, folder, "flagged").where("not is_duplicate")
    assert rows_of(got, "seq", "value") == rows_of(batch["records"], "seq", "value")
    columns = ["sensor_id", "detected_at", "zscore", "severity"]
    alerts = published(spark, folder, "alerts").where("kind = 'record'")
    assert rows_of(alerts, *columns) == rows_of(batch["record_alerts"], *columns) and alerts.count() > 0


def test_messages_of_one_split_are_parsed_by_many_tasks(spark, tmp_path, messages):
    chunk = [m for c in messages for m in c]
    turns(spark, str(tmp_path), [chunk], Engine(CFG, tie_break=["seq"]).step, lambda s, c: raw_of(s, c).coalesce(1))
    parsed = spark.read.parquet(str(tmp_path / "parsed"))
    by_task = [r["count"] for r in parsed.groupBy(F.input_file_name()).count().collect()]
    assert sum(by_task) == len(chunk) and max(by_task) <= len(chunk) / 4


def test_statistics_of_a_running_stream(spark, tmp_path, messages):
    folder = str(tmp_path)
    turns(spark, folder, messages, Engine(CFG, tie_break=["seq"]).step, raw_of)
    got = {r["batch_id"]: r for r in Counters(spark, folder).statistics().collect()}
    assert sorted(got) == [0, 1, 2, 3]
    for n in got:
        batch = run_batch(raw_of(spark, [m for c in messages[: n + 1] for m in c]), CFG, tie_break=["seq"])
        records_ = batch["records"]
        now = records_.agg(F.max("timestamp")).first()[0]
        flagged = records_.select("timestamp", F.lit(False).alias("is_duplicate")).unionByName(
            batch["duplicates"].select("timestamp", F.lit(True).alias("is_duplicate"))
        )
        stats = metrics.dedup_stats(flagged, CFG.dedup, now).first()
        for name in ("total_seen", "total_dupes", "dupe_rate_pct", "cache_size"):
            assert got[n][name] == stats[name], (n, name)
        closed = batch["windows"].where(F.col("window_end") <= F.lit(now))
        for name, value in metrics.aggregator_stats(records_, closed).first().asDict().items():
            assert got[n][name] == value, (n, name)
        for name, value in metrics.detector_stats(records_, closed, batch["record_alerts"]).first().asDict().items():
            assert got[n][name] == value, (n, name)
        waiting = metrics.buffer_sizes(records_, now, CFG.windows).agg(F.sum("buffer_size")).first()[0]
        assert got[n]["waiting_rows"] == waiting


def test_live_ids_by_change(spark, tmp_path):
    """Against a count of all accepted rows, with late ones and ones that are ahead of the clock."""
    rng = random.Random(7)
    live, rows, now = LiveIds(DedupConfig(ttl_seconds=40), slots=5), [], None
    for n in range(8):
        chunk = [record(i, seconds=rng.randrange(0, 30 * (n + 1)) + rng.random()) for i in range(12)]
        before, now = now, micros(25 * n + 10)
        rows += [int(r[5].timestamp() * 1e6) for r in chunk]
        turn = begin(spark, str(tmp_path), n)
        got = live.step(records(spark, chunk), turn, before, now)
        turn.publish()
        want = sum(now - 40_000_000 <= t <= now for t in rows)
        assert abs(got - want) <= 0, n


@pytest.mark.parametrize("skew", [SkewConfig(), SkewConfig(mode="on", rows_per_slice=15)])
def test_running_moments_over_triggers(spark, tmp_path, skew):
    rng = random.Random(3)
    rows = [record(i, 1e6 + rng.gauss(0, 3), i, message_id=f"m{i:04d}", sensor=f"s{i % 3 if i < 80 else i % 5}") for i in range(120)]
    rows.append((*rows[0][:3], None, "bar", at(500), 500))
    turns(spark, tmp_path, [rows[:1], rows[1:50], rows[50:52], rows[52:]], MomentStage(skew=skew).step)
    want = {
        r["seq"]: (r["running_n"], r["running_mean"], r["running_var"])
        for r in with_running_moments(records(spark, rows), KEYS, ORDER, "value", SkewConfig(mode="off")).collect()
    }
    got = {r["seq"]: (r["running_n"], r["running_mean"], r["running_var"]) for r in published(spark, str(tmp_path), "moments").collect()}
    assert got.keys() == want.keys()
    for key, (n, mean, variance) in want.items():
        assert got[key][0] == n
        assert math.isclose(got[key][1], mean, rel_tol=1e-12)
        assert math.isclose(got[key][2], variance, rel_tol=1e-6, abs_tol=1e-6)


def test_stages_on_empty_triggers(spark, tmp_path):
    empty = spark.createDataFrame([], SCHEMA)
    chunks = [[], [record(0, seconds=5)], [], [record(1, seconds=700)]]

    def step(rows, turn):
        kept = DedupStage().step(rows, turn).drop("is_duplicate")
        WindowStage(WindowConfig(window_seconds=60, min_samples=1)).step(kept, turn)
        MomentStage().step(kept, turn)

    turns(spark, tmp_path, chunks, step, lambda s, c: records(s, c) if c else empty)
    assert published(spark, str(tmp_path), "closed").count() == 1
    assert published(spark, str(tmp_path), "moments").count() == 2
    shutil.rmtree(tmp_path)


def test_windows_that_close_by_the_wall_clock(spark, tmp_path):
    """Under a processing-time trigger: a sparse window gives nothing and moves the next start to the present, readings that
    came late for a window count in the next one, and the last window closes without new readings."""
    source, width = str(tmp_path / "in"), 20
    cfg = WindowConfig(window_seconds=width, min_samples=3)

    def send(times, sensor):
        rows = [(f"m{time.time_ns()}", sensor, "p", float(i), "bar", t, i) for i, t in enumerate(times)]
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(source)

    begun = datetime.now(timezone.utc)
    near = [begun + timedelta(seconds=s) for s in (0, 0.5, 1, 1.5)]
    send(near, "full")
    send(near[:2], "sparse")
    rows = spark.readStream.schema(SCHEMA).parquet(source)
    query = (
        ops.wall_clock_window_stats(rows, cfg).writeStream.format("parquet").option("path", f"{tmp_path}/out")
        .option("checkpointLocation", f"{tmp_path}/checkpoint").trigger(processingTime="1 second").start()
    )

    def closed():
        try:
            return spark.read.parquet(f"{tmp_path}/out").collect()
        except AnalysisException:
            return []

    def wait_for(n):
        deadline = time.monotonic() + 120
        while len(closed()) < n and time.monotonic() < deadline:
            assert query.isActive
            time.sleep(0.5)
        return closed()

    try:
        first = wait_for(1)
        assert [(r["sensor_id"], r["sample_count"], r["window_start"]) for r in first] == [("full", 4, near[0].replace(tzinfo=None))]
        assert first[0]["closed_at"] >= first[0]["window_end"] == first[0]["window_start"] + timedelta(seconds=width)
        send(near[1:4], "full")  # for the window that has closed
        send([datetime.now(timezone.utc) + timedelta(seconds=s) for s in (0, 0.1, 0.2)], "sparse")
        rows = wait_for(3)
    finally:
        query.stop()
    second = {r["sensor_id"]: r for r in rows if r not in first}
    assert second["full"]["sample_count"] == 3 and second["full"]["window_start"] == first[0]["window_end"]
    # the window started anew when the sparse one was given up, not at a multiple of the width
    assert second["sparse"]["sample_count"] == 3
    assert second["sparse"]["window_start"] > near[0].replace(tzinfo=None) + timedelta(seconds=width)


def test_listener_adds_up_what_was_dropped(spark, tmp_path):
    listener, source = ops.DroppedRows(), str(tmp_path / "in")
    spark.streams.addListener(listener)
    try:
        for name, chunk in (("a", [1000, 2000, 2001]), ("b", [10, 20, 30, 3000]), ("c", [2000, 2999, 5000])):
            records(spark, [record(i, seconds=s, message_id=f"{name}{i}") for i, s in enumerate(chunk)]).coalesce(1).write.mode(
                "append"
            ).parquet(source)
            rows = ops.observed(spark.readStream.schema(SCHEMA).parquet(source))
            kept = ops.dedup_within_watermark(rows, DedupConfig(ttl_seconds=100))
            query = kept.writeStream.queryName("drops").format("parquet").option("path", f"{tmp_path}/out")
            query = query.option("checkpointLocation", f"{tmp_path}/checkpoint").trigger(availableNow=True).start()
            query.awaitTermination()
        deadline = time.monotonic() + 60
        want = {"dropped_dedupeWithinWatermark": 4, "input_rows": 10}
        while listener.totals.get("drops") != want and time.monotonic() < deadline:
            time.sleep(0.2)
        assert listener.totals["drops"] == want
        assert spark.read.parquet(f"{tmp_path}/out").count() == 6
    finally:
        spark.streams.removeListener(listener)


@pytest.mark.parametrize("size", [20, 200])
def test_sketched_percentiles_are_within_their_bound(spark, size):
    rng = random.Random(size)
    rows = [record(i, rng.lognormvariate(0, 2), i * 0.01, sensor=f"s{i % 3}") for i in range(6000)]
    cfg = WindowConfig(window_seconds=3600, percentile_method="sketch", sketch_size=size)
    got = {r["sensor_id"]: r for r in windows.window_stats(records(spark, rows), cfg).collect()}
    exact = {r["sensor_id"]: r for r in windows.window_stats(records(spark, rows), WindowConfig(window_seconds=3600)).collect()}
    for sensor, r in got.items():
        values = [x[3] for x in rows if x[1] == sensor]
        below, upto = (sum(v < r["p95"] for v in values), sum(v <= r["p95"] for v in values))
        bound = windows.rank_error(size) * len(values) + 1
        assert below - bound <= 0.95 * len(values) <= upto + bound
        assert {k: r[k] for k in ("sample_count", "minimum", "maximum")} == {k: exact[sensor][k] for k in ("sample_count", "minimum", "maximum")}
    with pytest.raises(ValueError):
        WindowConfig(percentile_method="guess")
