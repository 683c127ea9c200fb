"""Splitting of groups that are too large for one task.

Any one series, message id or window may hold a large share of all rows, and a shuffle
on such a key sends that share to one task. The helpers here find those groups with a
map-side combined count, and give the rows of the hot ones a *slice* number: slices are
ranges of the global sort order (keys, then order columns), so they stay balanced
whatever the distribution, bursts and ties of the time column included.
"""

from __future__ import annotations

import math
import tempfile
import uuid
from dataclasses import replace
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import SkewConfig

SLICE = "__slice"


class HotSplit(NamedTuple):
    """Rows of ordinary groups, rows of hot groups (either may be absent) and their count."""

    ordinary: DataFrame | None
    hot: DataFrame | None
    hot_rows: int | None = None


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the cluster's shared folder."""
    use_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def store_table(df: DataFrame) -> DataFrame:
    """As ``materialize`` for large tables that are read more than once: as Parquet, so that
    each reader scans only the columns and rows it needs."""
    path = f"{use_checkpoint_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def use_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Where it is unset (tests in local mode) a folder of this run is used; on a cluster a
    machine-local folder would lose data, so there the setting is required.
    """
    context = spark.sparkContext
    configured = context.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if context.getCheckpointDir() is None:
        if configured is None:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a shared folder")
            configured = tempfile.mkdtemp(prefix="tidegauge-")
        context.setCheckpointDir(configured)
    return configured or context.getCheckpointDir()


def by_shuffle(df: DataFrame) -> DataFrame:
    """For the side of a join that grows with the input: it is shuffled, never sent through the driver. Left to itself Spark
    goes by the size of the files below, and a few compressed megabytes of them are many times that as rows."""
    return df.hint("merge")


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt out evenly over all cores, for costly work on each of them: a source's splits follow its files and bytes,
    and a few compressed megabytes in one split can be most rows."""
    return df.repartition(2 * df.sparkSession.sparkContext.defaultParallelism)


def null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def split_hot(df: DataFrame, keys: list[str], max_rows: int, skew: SkewConfig) -> HotSplit:
    """Tell the rows of hot groups from the rest.

    A hot group holds more than ``max_rows`` rows, so there are at most rows / max_rows
    of them. That list is broadcast only while its counted rows and bytes are few; beyond that
    the joins shuffle. Without a hot group, the usual case, this costs one scan of the key
    columns with a count that is combined before its shuffle.
    """
    if skew.mode == "off":
        return HotSplit(df, None)
    if skew.mode == "on":
        return HotSplit(None, df)
    hot = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > max_rows)
    if hot.isEmpty():
        return HotSplit(df, None)
    hot = materialize(hot)
    width = reduce(lambda a, b: a + b, [F.coalesce(F.octet_length(F.col(k).cast("string")), F.lit(0)) for k in keys])
    groups, rows, size = hot.agg(F.count(F.lit(1)), F.sum("__n"), F.sum(width)).first()
    hot = hot.drop("__n")
    if groups <= skew.broadcast_rows and size <= skew.broadcast_bytes:
        hot = F.broadcast(hot)
    on = null_safe(df, hot, keys)
    return HotSplit(df.join(hot, on, "left_anti"), df.join(hot, on, "left_semi"), rows)


def decided(df: DataFrame, keys: list[str], skew: SkewConfig) -> SkewConfig:
    """``skew``, or "off" if no group of ``df`` is hot; then no finer group is either, and
    operators that get the answer do not count again."""
    if skew.mode == "auto" and split_hot(df.select(*keys), keys, skew.max_group_rows, skew).hot is None:
        return replace(skew, mode="off")
    return skew


def union_parts(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def ordered_slices(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    rows_per_slice: int,
    total: int | None = None,
) -> DataFrame:
    """Rows with a slice number that grows with (keys, order).

    The range partitioning samples its bounds, so the numbering is stored once and every
    later reader sees the same slices, also after lost executors. ``total`` saves the count.
    """
    slices = max(2, math.ceil((df.count() if total is None else total) / rows_per_slice))
    ranged = df.repartitionByRange(slices, *keys, *order)
    return store_table(ranged.withColumn(SLICE, F.spark_partition_id()))
