import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import SCHEMA, at, record, records, rows_of, series
from tidegauge.config import SkewConfig, WindowConfig
from tidegauge.functions.text import round_stat
from tidegauge.operators.metrics import aggregator_stats, buffer_sizes
from tidegauge.operators.windows import (
    interpolated_percentile,
    percentiles,
    rounded,
    sample_std,
    series_stats,
    window_stats,
)
from tidegauge.sources.sinks import window_lines

FIVE = WindowConfig(window_seconds=5, min_samples=2, alignment="series")
SLICED = SkewConfig(mode="on", rows_per_slice=50)


def test_open_window_is_not_returned(spark):
    assert window_stats(series(spark, [10, 20]), FIVE, as_of=at(1)).count() == 0


def test_closed_window(spark):
    row = window_stats(series(spark, [10, 20, 30]), FIVE, as_of=at(6)).first()
    assert (row["mean"], row["minimum"], row["maximum"], row["sample_count"]) == (20, 10, 30, 3)
    assert row["std_dev"] == 10.0


def test_two_sensors(spark):
    rows = [record(1, 11.0, 0, sensor="a"), record(2, 10.8, 1, sensor="a"),
            record(3, 11.5, 0, sensor="b"), record(4, 11.2, 1, sensor="b")]
    got = window_stats(records(spark, rows), FIVE, as_of=at(10)).collect()
    assert sorted(r["sensor_id"] for r in got) == ["a", "b"]


def test_sparse_window_is_skipped(spark):
    cfg = WindowConfig(window_seconds=5, min_samples=5)
    assert window_stats(series(spark, [10]), cfg, as_of=at(10)).count() == 0


def test_helper_maths(spark):
    df = spark.createDataFrame([(2.0,), (4.0,), (6.0,)], "value double")
    assert df.agg(F.avg("value"), sample_std("value")).first() == (4.0, 2.0)
    five = spark.createDataFrame([(float(i),) for i in range(1, 6)], "value double")
    assert five.agg(interpolated_percentile("value", 95)).first()[0] == pytest.approx(4.8)
    assert five.filter("false").agg(interpolated_percentile("value", 95)).first()[0] == 0.0


def test_one_row_window_has_no_deviation(spark):
    cfg = WindowConfig(min_samples=1)
    assert window_stats(series(spark, [7.0]), cfg).first()["std_dev"] == 0.0


def test_bounds(spark):
    """A value exactly at the end: next window when epoch-aligned, this one when anchored."""
    rows = records(spark, [record(i, i, s) for i, s in enumerate([0, 2, 5])])
    epoch = window_stats(rows, WindowConfig(window_seconds=5, min_samples=1))
    assert sorted(r["sample_count"] for r in epoch.collect()) == [1, 2]
    assert [r["sample_count"] for r in window_stats(rows, FIVE).collect()] == [3]


def test_anchor_is_the_first_record(spark):
    rows = records(spark, [record(i, i, s) for i, s in enumerate([3, 4, 8.5, 9])])
    got = rows_of(window_stats(rows, FIVE), "window_start", "sample_count")
    base = int(at(0).timestamp()) * 1_000_000
    assert got == [(base + 3_000_000, 2), (base + 8_000_000, 2)]


@pytest.mark.parametrize("alignment", ["epoch", "series"])
def test_sliced_windows_equal_plain_ones(spark, alignment):
    rng = np.random.default_rng(1)
    values = np.round(rng.normal(10, 3, 900), 1)  # many equal values
    df = series(spark, values.tolist(), step=0.7)
    cfg = WindowConfig(window_seconds=200, alignment=alignment)
    plain = {tuple(r)[:4]: tuple(r)[4:] for r in window_stats(df, cfg).collect()}
    sliced = {tuple(r)[:4]: tuple(r)[4:] for r in window_stats(df, cfg, skew=SLICED).collect()}
    assert plain.keys() == sliced.keys()
    for key, stats in plain.items():
        assert sliced[key] == pytest.approx(stats, abs=1e-9)


def test_hot_window_among_ordinary_ones(spark):
    hot = [record(i, i % 17, i / 100) for i in range(600)]
    cold = [record(1000 + i, i % 5, i, sensor="quiet") for i in range(50)]
    df = records(spark, hot + cold)
    cfg = WindowConfig(window_seconds=60)
    skew = SkewConfig(max_group_rows=100, rows_per_slice=5)
    assert rows_of(rounded(window_stats(df, cfg, skew=skew))) == rows_of(rounded(window_stats(df, cfg)))


def test_percentiles_against_numpy(spark):
    rng = np.random.default_rng(2)
    values = rng.integers(0, 40, 1000).astype(float)
    df = series(spark, values.tolist())
    pcts = {"p0": 0.0, "p33": 33.3, "p95": 95.0, "p100": 100.0}
    for skew in (SkewConfig(), SLICED):
        row = percentiles(df, ["sensor_id", "metric_name"], pcts, skew).first()
        for name, pct in pcts.items():
            assert row[name] == pytest.approx(np.percentile(values, pct))


def test_series_stats(spark):
    row = series_stats(series(spark, [1.0, 2.0, 4.0])).first()
    assert row["variance"] == pytest.approx(7 / 3)
    assert series_stats(series(spark, [1.0])).first()["variance"] == 0.0


def test_statistics_and_buffers(spark):
    df = series(spark, [1, 2, 3, 4], step=2)
    closed = window_stats(df, FIVE, as_of=at(5))
    assert tuple(aggregator_stats(df, closed).first()) == (1, 1)
    row = buffer_sizes(df, at(5), FIVE).first()
    assert tuple(row) == ("PUMP_A7_INLET::pressure_bar", 1)
    # a closed window with too few rows holds none back
    assert buffer_sizes(df, at(10), FIVE).first()["buffer_size"] == 0


@pytest.mark.parametrize("alignment", ["epoch", "series"])
def test_split_groups_treat_nulls_like_others(spark, alignment):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(300):
        key = [None, "a", "b"][rng.integers(3)]
        value = None if key == "b" or rng.random() < 0.2 else float(rng.integers(0, 9))
        time = None if rng.random() < 0.1 else at(int(rng.integers(0, 60)))
        rows.append((f"id{i}", key, "m", value, "u", time, i))
    df = spark.createDataFrame(rows, SCHEMA)
    cfg = WindowConfig(window_seconds=20, min_samples=1, alignment=alignment)
    plain, split = (rows_of(window_stats(df, cfg, skew=s)) for s in (SkewConfig(mode="off"), SLICED))
    assert [r[:5] for r in plain] == [r[:5] for r in split]
    for a, b in zip(plain, split):
        assert a[5:] == pytest.approx(b[5:])
    timed = sum(r[5] is not None and r[3] is not None for r in rows)
    assert sum(r[4] for r in plain) == timed
    pcts = {"p50": 50.0, "p95": 95.0}
    plain, split = (rows_of(percentiles(df, ["sensor_id"], pcts, s)) for s in (SkewConfig(mode="off"), SLICED))
    assert plain == split and ("b", 0.0, 0.0) in plain and len(plain) == 3


def test_rounding_is_exact_around_the_bound(spark):
    rng = np.random.default_rng(6)
    near = [float(x) for e in (1e10, 9.9e10, 1e11, 1.01e11, 1e12) for x in e + rng.integers(-9999, 9999, 300) / 10_000 * 16]
    values = near + [-v for v in near]
    got = spark.createDataFrame([(v,) for v in values], "v double").select(round_stat("v").alias("r"))
    assert [r["r"] for r in got.collect()] == [round(v, 4) for v in values]


def test_window_line(spark):
    line = window_lines(window_stats(series(spark, [10, 20, 30]), FIVE)).first()[0]
    assert line == (
        "WINDOW | PUMP_A7_INLET::pressure_bar n=3 mean=20.0000 p95=29.0000 "
        "[00:00:00–00:00:05]"
    )


def test_config_is_checked():
    with pytest.raises(ValueError):
        WindowConfig(window_seconds=0)
    with pytest.raises(ValueError):
        WindowConfig(alignment="daily")
