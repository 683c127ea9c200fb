"""Parallel evaluation of "first point later than the previous accepted one plus a gap".

The chain is sequential by nature. It is made parallel by tabulating, for ever longer
stretches of time, what happens for *every* possible way into the stretch:

* time is cut into slices one gap wide, and a slice holds at most one accepted point;
* a stretch's table maps each point that may be the first accepted one (``entry``) to
  the last accepted one (``exit``); for one slice these are the same point;
* two neighbouring stretches merge with one window pass: the first point of the right one
  later than the left exit plus the gap.

Only points of a stretch's first slice (and one per merge) can be entries, so tables halve
with each merge and the total work is about twice the points. With the tables known, the
accepted points are read off from the top down.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .skew import by_shuffle, materialize

_SHAPE = ["__node", "__entry", "__exit"]


def accepted_chain(points: DataFrame, key: str, time: str, gap: int) -> DataFrame:
    """(key, time) of the accepted points; ``points`` are distinct (key, integer time)."""
    first, last = points.agg(F.min(time), F.max(time)).first()
    if first is None:
        return points
    slices = (last - first) // gap + 1
    table = materialize(
        points.select(
            key,
            F.floor((F.col(time) - F.lit(first)) / F.lit(gap)).cast("bigint").alias("__node"),
            F.col(time).alias("__entry"),
            F.col(time).alias("__exit"),
        )
    )
    levels = []
    while slices > 1:
        table = materialize(_merge(table, key, gap))
        levels.append(table)
        slices = (slices + 1) // 2

    chain = table.groupBy(key, "__node").agg(F.min("__entry").alias("__entry"))
    for level in reversed(levels):
        chain = _descend(chain, level, key)
    return chain.select(key, F.col("__entry").alias(time))


def _merge(table: DataFrame, key: str, gap: int) -> DataFrame:
    """Tables of the stretches twice as long; ``__mid`` is the first accepted point of the
    right half."""
    is_left = F.pmod("__node", F.lit(2)) == 0
    placed = table.select(
        key,
        F.floor(F.col("__node") / 2).cast("bigint").alias("__parent"),
        is_left.alias("__left"),
        F.when(is_left, F.col("__exit") + F.lit(gap)).otherwise(F.col("__entry")).alias("__at"),
        "__entry",
        "__exit",
    )
    # Latest first; at equal times the left rows come first, so they see later points only.
    descending = (
        Window.partitionBy(key, "__parent")
        .orderBy(F.col("__at").desc(), F.col("__left").desc())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    right_point = F.when(~F.col("__left"), F.struct("__entry", "__exit"))
    whole = Window.partitionBy(key, "__parent")
    merged = placed.withColumn(
        "__next", F.last(right_point, ignorenulls=True).over(descending)
    ).withColumn("__right_first", F.min(F.when(~F.col("__left"), F.col("__entry"))).over(whole))
    return merged.filter(
        F.col("__left") | (F.col("__entry") == F.col("__right_first"))
    ).select(
        key,
        F.col("__parent").alias("__node"),
        "__entry",
        F.when(F.col("__left"), F.coalesce("__next.__exit", "__exit"))
        .otherwise(F.col("__exit"))
        .alias("__exit"),
        F.when(F.col("__left"), F.col("__next.__entry"))
        .otherwise(F.col("__entry"))
        .alias("__mid"),
    )


def _descend(chain: DataFrame, level: DataFrame, key: str) -> DataFrame:
    """First accepted points of both halves of each stretch in ``chain``."""
    known = chain.alias("c").join(
        by_shuffle(level.alias("l")),
        F.col(f"c.{key}").eqNullSafe(F.col(f"l.{key}"))
        & (F.col("c.__node") == F.col("l.__node"))
        & (F.col("c.__entry") == F.col("l.__entry")),
    )
    node, entry, mid = F.col("c.__node"), F.col("c.__entry"), F.col("l.__mid")
    left = F.when(
        mid.isNull() | (entry < mid), F.struct((node * 2).alias("__node"), entry.alias("__entry"))
    )
    right = F.when(
        mid.isNotNull(), F.struct((node * 2 + 1).alias("__node"), mid.alias("__entry"))
    )
    return known.select(
        F.col(f"c.{key}").alias(key), F.explode(F.array_compact(F.array(left, right))).alias("__h")
    ).select(key, "__h.__node", "__h.__entry")
