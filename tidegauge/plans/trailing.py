"""Trailing row frames ("the last n rows of the same series"), safe for hot series."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..config import SkewConfig
from .skew import SLICE, ordered_slices, split_hot, union_parts

Measures = Callable[[WindowSpec], dict[str, Column]]

_LEAD_IN = "__lead_in"


def with_trailing(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    value: str,
    depth: int,
    measures: Measures,
    skew: SkewConfig,
) -> DataFrame:
    """Add columns computed over the ``depth`` rows before each row of its series.

    Ordinary series use one window over the series. Hot series are cut into slices of the
    sort order, and each slice is led in by copies of the ``depth`` rows before it, so the
    frame of every row is complete inside its slice.
    """
    ordinary, hot, hot_rows = split_hot(df, keys, skew.max_group_rows, skew)
    parts = []
    if ordinary is not None:
        frame = Window.partitionBy(*keys).orderBy(*order).rowsBetween(-depth, -1)
        parts.append(ordinary.withColumns(measures(frame)))
    if hot is not None:
        parts.append(_sliced(hot, keys, order, value, depth, measures, skew, hot_rows))
    return union_parts(parts)


def _sliced(df, keys, order, value, depth, measures, skew, hot_rows):
    rows = ordered_slices(df, keys, order, skew.rows_per_slice, hot_rows)
    needed = [*order, value]

    # The last `depth` rows of each slice; the group limit runs before the shuffle.
    newest_first = Window.partitionBy(*keys, SLICE).orderBy(*[F.col(c).desc() for c in order])
    tails = (
        rows.select(*keys, SLICE, *needed)
        .withColumn("__rank", F.row_number().over(newest_first))
        .filter(F.col("__rank") <= depth)
        .groupBy(*keys, SLICE)
        .agg(F.sort_array(F.collect_list(F.struct(-F.col("__rank"), *needed))).alias("__tail"))
    )
    # Every slice holds at least one row, so `depth` earlier slices always suffice.
    earlier = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(-depth, -1)
    lead_in = (
        tails.withColumn("__before", F.flatten(F.collect_list("__tail").over(earlier)))
        .withColumn("__keep", F.least(F.size("__before"), F.lit(depth)))
        .filter(F.col("__keep") > 0)
        .withColumn("__before", F.expr("slice(__before, -__keep, __keep)"))
        .select(*keys, SLICE, F.posexplode("__before").alias(_LEAD_IN, "__row"))
        .select(*keys, SLICE, F.col(_LEAD_IN).alias(_LEAD_IN), *[f"__row.{c}" for c in needed])
    )
    everything = rows.withColumn(_LEAD_IN, F.lit(depth)).unionByName(
        lead_in, allowMissingColumns=True
    )
    frame = (
        Window.partitionBy(*keys, SLICE).orderBy(_LEAD_IN, *order).rowsBetween(-depth, -1)
    )
    return (
        everything.withColumns(measures(frame))
        .filter(F.col(_LEAD_IN) == depth)
        .drop(SLICE, _LEAD_IN)
    )


def with_running_moments(
    df: DataFrame, keys: list[str], order: list[str], value: str, skew: SkewConfig
) -> DataFrame:
    """Add running_n, running_mean, running_var: the series up to and including each row.

    The variance of fewer than two rows is 0. Values are shifted by the series mean before
    they are summed, which keeps the sums of squares free of cancellation.
    """
    ordinary, hot, hot_rows = split_hot(df, keys, skew.max_group_rows, skew)
    parts = []
    if ordinary is not None:
        frame = Window.partitionBy(*keys).orderBy(*order).rowsBetween(
            Window.unboundedPreceding, Window.currentRow
        )
        parts.append(
            ordinary.withColumns(
                {
                    "running_n": F.count(value).over(frame),
                    "running_mean": F.avg(value).over(frame),
                    "running_var": F.coalesce(F.var_samp(value).over(frame), F.lit(0.0)),
                }
            )
        )
    if hot is not None:
        parts.append(_sliced_moments(hot, keys, order, value, skew, hot_rows))
    return union_parts(parts)


def _sliced_moments(df, keys, order, value, skew, hot_rows):
    rows = ordered_slices(df, keys, order, skew.rows_per_slice, hot_rows)
    per_slice = rows.groupBy(*keys, SLICE).agg(
        F.count(value).alias("__n"), F.avg(value).alias("__mean"), F.var_pop(value).alias("__var")
    )
    series = Window.partitionBy(*keys)
    earlier = series.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    gap = F.col("__mean") - F.col("__centre")
    offsets = (
        per_slice.withColumn(
            "__centre",
            F.sum(F.col("__n") * F.col("__mean")).over(series) / F.sum("__n").over(series),
        )
        .withColumn("__n0", F.coalesce(F.sum("__n").over(earlier), F.lit(0)))
        .withColumn("__s0", F.coalesce(F.sum(F.col("__n") * gap).over(earlier), F.lit(0.0)))
        .withColumn(
            "__q0",
            F.coalesce(
                F.sum(F.col("__n") * (F.col("__var") + gap * gap)).over(earlier), F.lit(0.0)
            ),
        )
        .select(*keys, SLICE, "__centre", "__n0", "__s0", "__q0")
    )
    frame = Window.partitionBy(*keys, SLICE).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    shifted = F.col(value) - F.col("__centre")
    n, s, q = F.col("running_n"), F.col("__s"), F.col("__q")
    joined = rows.alias("r").join(
        offsets.alias("o"),
        [F.col(f"r.{k}").eqNullSafe(F.col(f"o.{k}")) for k in [*keys, SLICE]],
    )
    return (
        joined.select("r.*", "o.__centre", "o.__n0", "o.__s0", "o.__q0")
        .withColumns(
            {
                "running_n": F.col("__n0") + F.count(value).over(frame),
                "__s": F.col("__s0") + F.sum(shifted).over(frame),
                "__q": F.col("__q0") + F.sum(shifted * shifted).over(frame),
            }
        )
        .withColumns(
            {
                "running_mean": F.col("__centre") + s / n,
                "running_var": F.when(n < 2, F.lit(0.0)).otherwise(
                    F.greatest((q - s * s / n) / F.nullif(n - 1, F.lit(0)), F.lit(0.0))
                ),
            }
        )
        .drop(SLICE, "__centre", "__n0", "__s0", "__q0", "__s", "__q")
    )
