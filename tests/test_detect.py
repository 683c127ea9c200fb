import math
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import at, record, records, series
from tidegauge.config import DetectConfig, SkewConfig
from tidegauge.functions.text import round_exact
from tidegauge.operators.detect import all_alerts, record_alerts, score_records, window_alerts
from tidegauge.operators.metrics import detector_stats
from tidegauge.operators.windows import window_stats
from tidegauge.plans.trailing import with_running_moments
from tidegauge.schema import ALERT, KEYS, ORDER
from tidegauge.sources.sinks import alert_lines

NORMAL = [10.0, 10.3, 9.8, 10.1, 9.7, 10.2, 9.9, 10.4, 9.6, 10.0] * 2
SLICED = SkewConfig(mode="on", rows_per_slice=7)


def windows(spark, means):
    rows = [("s1", "p", at(60 * i), at(60 * i + 60), float(m)) for i, m in enumerate(means)]
    return spark.createDataFrame(
        rows,
        "sensor_id string, metric_name string, window_start timestamp, window_end timestamp, mean double",
    )


def test_cold_baseline(spark):
    assert record_alerts(series(spark, [1000.0] * 9)).count() == 0
    assert record_alerts(series(spark, NORMAL[:9] + [1000.0])).count() == 0
    assert record_alerts(series(spark, NORMAL[:10] + [1000.0])).count() == 1


def test_normal_value(spark):
    assert record_alerts(series(spark, NORMAL[:15] + [10.05])).count() == 0


def test_spike(spark):
    alert = record_alerts(series(spark, NORMAL + [500.0])).first()
    assert abs(alert["zscore"]) > 3 and alert["severity"] == "CRITICAL"
    mu, sigma = statistics.mean(NORMAL), statistics.stdev(NORMAL)
    z = (500.0 - mu) / sigma
    assert alert["baseline_mean"] == round(mu, 4)
    assert alert["baseline_std"] == round(sigma, 4)
    assert alert["zscore"] == round(z, 3)
    assert alert["message"] == (
        f"Value 500.0000 deviates {z:+.2f}σ from baseline μ={mu:.4f} σ={sigma:.4f}"
    )
    assert alert["anomaly_type"] == "zscore"


def test_constant_baseline(spark):
    assert record_alerts(series(spark, [5.0] * 20 + [500.0])).count() == 0


def test_anomaly_enters_the_baseline(spark):
    """Each repeat widens the baseline, so the third one is no longer far from it."""
    alerts = record_alerts(series(spark, NORMAL + [500.0, 500.0, 500.0])).collect()
    assert sorted(r["severity"] for r in alerts) == ["CRITICAL", "WARNING"]


def test_threshold_is_strict_and_bands(spark):
    """A baseline of +-1 around 0 with a known deviation."""
    base = [1.0, -1.0] * 10
    sigma = statistics.stdev(base)
    for factor, expected in [(2.99, None), (3.01, "WARNING"), (4.49, "WARNING"), (4.51, "CRITICAL")]:
        got = record_alerts(series(spark, base + [factor * sigma])).collect()
        assert [r["severity"] for r in got] == ([expected] if expected else [])
    exact = score_records(series(spark, base + [3 * sigma])).orderBy(F.col("timestamp").desc()).first()
    cfg = DetectConfig(z_threshold=exact["z"])
    assert record_alerts(series(spark, base + [3 * sigma]), cfg).count() == 0


def test_window_spike(spark):
    rng = random.Random(42)
    means = [10 + rng.gauss(0, 0.5) for _ in range(10)]
    alert = window_alerts(windows(spark, means + [100.0])).filter("observed_value = 100").collect()
    assert len(alert) == 1
    assert alert[0]["anomaly_type"] == "value_spike"
    assert alert[0]["observed_value"] == 100.0
    assert "from 10-window baseline" in alert[0]["message"]
    assert window_alerts(windows(spark, means[:4] + [100.0])).count() == 0


def test_window_bands(spark):
    base = [1.0, -1.0] * 5
    sigma = statistics.stdev(base)
    for factor, expected in [(5.9, "WARNING"), (6.1, "CRITICAL")]:
        got = window_alerts(windows(spark, base + [factor * sigma])).collect()
        assert [r["severity"] for r in got] == [expected]


def test_composite_and_line(spark):
    df = series(spark, NORMAL + [9999.0], step=30)
    records_found = record_alerts(df)
    found = all_alerts(records_found, window_alerts(windows(spark, [10, 11, 9, 10, 11, 9, 80])))
    assert found.columns == ALERT.fieldNames()
    assert sorted(r["anomaly_type"] for r in found.collect()) == ["value_spike", "zscore"]
    line = alert_lines(records_found).first()[0]
    assert line.startswith("ALERT  | [CRITICAL] ZSCORE sensor=PUMP_A7_INLET metric=pressure_bar value=9999.0 z=")
    assert line.endswith("at 2024-01-01T00:10:00")
    missing = records_found.withColumn("zscore", F.lit(None).cast("double"))
    assert " z=n/a " in alert_lines(missing).first()[0]


def skewed(spark):
    """One series with most rows, ties in time, and small ones."""
    rng = random.Random(5)
    rows = [record(i, round(rng.gauss(10, 2), 2), rng.choice([0, 1, 2, i])) for i in range(300)]
    rows += [record(1000 + i, i % 9, i, sensor=f"q{i % 12}") for i in range(60)]
    return records(spark, rows)


@pytest.mark.parametrize("skew", [SLICED, SkewConfig(max_group_rows=50, rows_per_slice=9)])
def test_sliced_scores_equal_plain_ones(spark, skew):
    df = skewed(spark)
    columns = ["message_id", "baseline_n", "baseline_mean", "baseline_std", "z"]
    plain = {r[0]: tuple(r)[1:] for r in score_records(df).select(*columns).collect()}
    sliced = {r[0]: tuple(r)[1:] for r in score_records(df, skew=skew).select(*columns).collect()}
    assert len(plain) == df.count() and plain.keys() == sliced.keys()
    for key, row in plain.items():
        for a, b in zip(row, sliced[key]):
            assert (a is None and b is None) or math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)


def test_running_moments(spark):
    df = skewed(spark)
    for skew in (SkewConfig(), SLICED):
        got = with_running_moments(df, KEYS, ORDER, "value", skew).filter(
            F.col("sensor_id") == "PUMP_A7_INLET"
        )
        rows = sorted(got.collect(), key=lambda r: (r["timestamp"], r["message_id"]))
        for i in (0, 1, 50, len(rows) - 1):
            seen = [r["value"] for r in rows[: i + 1]]
            assert rows[i]["running_n"] == i + 1
            assert rows[i]["running_mean"] == pytest.approx(np.mean(seen))
            want = np.var(seen, ddof=1) if i else 0.0
            assert rows[i]["running_var"] == pytest.approx(want, abs=1e-9)


def test_detector_statistics(spark):
    df = skewed(spark)
    stats = detector_stats(df, window_stats(df), record_alerts(df)).first()
    assert stats["tracked_keys"] == 13
    assert stats["total_alerts"] == record_alerts(df).count()


def test_arrival_order_can_be_given(spark):
    rows = records(spark, [record(i, v, -i) for i, v in enumerate(NORMAL + [500.0])])
    assert record_alerts(rows).count() == 0
    assert record_alerts(rows, order=["seq"]).count() == 1


def test_rounding_matches_exact_decimal_rounding(spark):
    rng = random.Random(3)
    values = [2.675, 1.005, 0.00005, -2.5, 0.5, 46.50375, 1e10 + 0.12345, -0.0, 0.1 + 0.2]
    values += [rng.randint(-10**7, 10**7) / 10**5 for _ in range(2000)]
    values += [rng.randint(-10**6, 10**6) / 2**14 for _ in range(2000)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for digits in (2, 3, 4):
        got = [r[0] for r in df.select(round_exact("v", digits)).collect()]
        assert got == [round(v, digits) for v in values]


def test_config_is_checked():
    with pytest.raises(ValueError):
        DetectConfig(baseline_rows=5)


@pytest.mark.parametrize("digits", [2, 3, 4])
def test_one_rounding_up_to_the_largest_numbers(spark, digits):
    """Around the bounds where digits become coarser than the numbers, and far beyond."""
    rng = random.Random(digits)
    bound = 2.0**53 / 10**digits
    values = [s * x for x in (bound, math.nextafter(bound, 0), 1e11, 99999999999.99995, 1e300, 2.0**53 + 2) for s in (1, -1)]
    values += [rng.uniform(0.9, 1.1) * b for b in (bound, 1e11, bound / 2, 1e9) for _ in range(400)]
    values += [math.floor(bound / 2) + rng.randrange(64) / 64 for _ in range(200)]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v double").select(round_exact("v", digits)).collect()]
    assert got == [round(v, digits) for v in values]
