"""Display and message texts, window keys, rounding and ages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Digits of the rounded outputs and the text formats.
STAT_DIGITS = 4
Z_DIGITS = 3
PERCENT_DIGITS = 2
RECORD_MESSAGE = "Value %.4f deviates %+.2fσ from baseline μ=%.4f σ=%.4f"
WINDOW_MESSAGE = "Window mean %.4f deviates %+.2fσ from %d-window baseline μ=%.4f"
ALERT_LINE = "[%s] %s sensor=%s metric=%s value=%s z=%s at %s"
WINDOW_LINE = "WINDOW | %s n=%d mean=%.4f p95=%.4f [%s–%s]"
ALERT_PREFIX = "ALERT  | "


def window_key(sensor_id: Column, metric_name: Column) -> Column:
    return F.concat_ws("::", sensor_id, metric_name)


def exact_sql(value: str, digits: int) -> str:
    """SQL that rounds the exact binary value, ties to even, as correctly rounded decimal
    text does.

    The built-in functions round the shortest decimal spelling instead, which differs where
    that spelling ends in a 5. Here the scaled fraction is carried with its rounding error
    (the product of two halves of the mantissa), so its distance from one half is exact.
    Each ``transform`` names an intermediate value.
    """
    scale = float(10**digits)
    upper = "(part * 134217729D - (part * 134217729D - part))"
    error = f"({upper} * {scale}D - scaled) + (part - {upper}) * {scale}D"
    beyond = "(scaled - floor(scaled)) - 0.5D"
    up = f"""CASE WHEN {beyond} > 0 OR ({beyond} = 0 AND ({error} > 0
        OR ({error} = 0 AND pmod(floor(scaled), 2) = 1))) THEN 1 ELSE 0 END"""
    steps = f"get(transform(array(part * {scale}D), scaled -> double(floor(scaled) + {up})), 0)"
    size = f"""get(transform(array(abs(v) - floor(abs(v))),
        part -> (floor(abs(v)) * {scale}D + {steps}) / {scale}D), 0)"""
    # From here on neighbouring numbers are further apart than the digits, so a number is its own rounding.
    coarse = 2.0**53 / scale
    return f"""get(transform(array({value}), v -> CASE WHEN abs(v) < {coarse}D
        THEN signum(v) * {size} ELSE v END), 0)"""


def round_exact(value: str, digits: int) -> Column:
    """``exact_sql`` of a column or SQL expression."""
    return F.expr(exact_sql(value, digits))


def round_stat(value: str, digits: int = STAT_DIGITS) -> Column:
    return round_exact(value, digits)


def age_seconds(timestamp: Column, now: Column) -> Column:
    return (F.unix_micros(now) - F.unix_micros(timestamp)) / F.lit(1e6)


def record_message(value: str, z: str, mean: str, std: str) -> Column:
    """%.Nf formats round the decimal spelling, so their operands are rounded beforehand."""
    operands = ", ".join(exact_sql(x, d) for x, d in ((value, 4), (z, 2), (mean, 4), (std, 4)))
    return F.expr(f"format_string('{RECORD_MESSAGE}', {operands})")


def window_message(window_mean: str, z: str, n: str, mean: str) -> Column:
    operands = f"{exact_sql(window_mean, 4)}, {exact_sql(z, 2)}, {n}, {exact_sql(mean, 4)}"
    return F.expr(f"format_string('{WINDOW_MESSAGE}', {operands})")


def iso_text(timestamp: Column) -> Column:
    """ISO text in UTC; the fraction is left out when it is zero."""
    utc = F.to_utc_timestamp(timestamp, F.current_timezone())
    whole = F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(utc, ".SSSSSS")
    return F.when(micros == ".000000", whole).otherwise(F.concat(whole, micros))


def clock_text(timestamp: Column) -> Column:
    return F.date_format(F.to_utc_timestamp(timestamp, F.current_timezone()), "HH:mm:ss")


def alert_line() -> Column:
    """One alert row as a line; a missing z is shown as n/a."""
    z = F.when(F.col("zscore").isNull(), F.lit("n/a")).otherwise(
        F.format_string("%.2f", round_exact("coalesce(zscore, 0D)", 2))
    )
    value = F.coalesce(F.col("observed_value").cast("string"), F.lit("None"))
    return F.format_string(
        ALERT_LINE,
        "severity",
        F.upper("anomaly_type"),
        "sensor_id",
        "metric_name",
        value,
        z,
        iso_text(F.col("detected_at")),
    )


def window_line() -> Column:
    return F.format_string(
        WINDOW_LINE,
        window_key(F.col("sensor_id"), F.col("metric_name")),
        "sample_count",
        round_exact("mean", 4),
        round_exact("p95", 4),
        clock_text(F.col("window_start")),
        clock_text(F.col("window_end")),
    )
