"""Exact interpolated percentiles of groups too large for one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import SkewConfig
from .skew import SLICE, ordered_slices, store_table


def selected_percentiles(
    df: DataFrame, keys: list[str], value: str, percentiles: dict[str, float], skew: SkewConfig
) -> DataFrame:
    """One row per group: keys and, per entry of ``percentiles``, that percentile (0..100).

    Equal values are counted before the shuffle, the distinct ones are cut into slices of
    the sort order, slice totals give each slice its first rank, and only the slices that
    hold a wanted rank are looked into.
    """
    counted = store_table(
        df.filter(F.col(value).isNotNull())
        .groupBy(*keys, value)
        .agg(F.count(F.lit(1)).alias("__n"))
    )
    rows = ordered_slices(counted, keys, [value], skew.rows_per_slice)
    group = Window.partitionBy(*keys)
    before = group.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    wanted = F.array(
        *[
            F.struct(F.lit(name).alias("name"), F.lit(pct / 100.0).alias("share"))
            for name, pct in percentiles.items()
        ]
    )
    position = F.col("__w.share") * (F.col("__total") - 1)
    low = F.floor(position)
    ranks = (
        rows.groupBy(*keys, SLICE)
        .agg(F.sum("__n").alias("__in_slice"))
        .withColumn("__total", F.sum("__in_slice").over(group))
        .withColumn("__first", F.coalesce(F.sum("__in_slice").over(before), F.lit(0)))
        .withColumn("__w", F.explode(wanted))
        .select(
            *keys,
            SLICE,
            "__first",
            "__in_slice",
            F.col("__w.name").alias("__name"),
            (position - low).alias("__weight"),
            F.explode(
                F.array(
                    F.struct(F.lit(0).alias("side"), low.alias("rank")),
                    F.struct(
                        F.lit(1).alias("side"),
                        F.least(low + 1, F.col("__total") - 1).alias("rank"),
                    ),
                )
            ).alias("__t"),
        )
        .filter(
            (F.col("__t.rank") >= F.col("__first"))
            & (F.col("__t.rank") < F.col("__first") + F.col("__in_slice"))
        )
        .groupBy(*keys, SLICE, "__first")
        .agg(F.collect_list(F.struct("__name", "__weight", "__t.side", "__t.rank")).alias("__ask"))
    )
    in_slice = Window.partitionBy(*keys, SLICE).orderBy(value).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    found = (
        rows.alias("r")
        .join(
            ranks.alias("k"),
            [F.col(f"r.{c}").eqNullSafe(F.col(f"k.{c}")) for c in [*keys, SLICE]],
        )
        .select("r.*", "k.__first", "k.__ask")
        .withColumn("__end", F.col("__first") + F.sum("__n").over(in_slice))
        .withColumn("__a", F.explode("__ask"))
        .filter(
            (F.col("__a.rank") < F.col("__end"))
            & (F.col("__a.rank") >= F.col("__end") - F.col("__n"))
        )
    )
    side = F.col("__a.side")
    sides = found.groupBy(*keys, F.col("__a.__name").alias("__name")).agg(
        F.max("__a.__weight").alias("__weight"),
        F.max(F.when(side == 0, F.col(value))).alias("__low"),
        F.max(F.when(side == 1, F.col(value))).alias("__high"),
    )
    result = F.col("__low") + F.col("__weight") * (F.col("__high") - F.col("__low"))
    return sides.groupBy(*keys).agg(
        *[
            F.max(F.when(F.col("__name") == name, result)).alias(name)
            for name in percentiles
        ]
    )
