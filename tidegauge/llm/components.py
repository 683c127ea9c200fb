"""Connected components of a graph whose edges are a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.skew import materialize


def connected_components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node of its component, for all nodes of ``links``.

    ``links`` has two columns of one type, ``a`` and ``b``; direction, repeats and loops do not
    matter, rows with a null are left out, and an empty table gives no rows.

    Large and small stars alternate: every node tells its larger neighbours, then its smaller ones,
    of the smallest neighbour. The graph stays connected and ends as stars, after about log n rounds.
    Each round is checkpointed in the shared folder; nothing but two totals goes to the driver.
    """
    both = F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")
    edges = materialize(links.select(*both).where("u < v").distinct())
    state = _state(edges)
    while True:
        edges = materialize(_small_star(_large_star(edges)))
        after = _state(edges)
        if after == state:
            break
        state = after
    roots = edges.select(F.col("v").alias("node"), F.col("u").alias("root"))
    return roots.unionByName(edges.select(F.col("u").alias("node"), F.col("u").alias("root"))).distinct()


def _state(edges: DataFrame) -> tuple:
    """Number and order-free checksum of the edges."""
    mark = F.xxhash64("u", "v").bitwiseAND(F.lit(0xFFFFFFFFFFFF)).cast("decimal(38,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(mark)).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Edges (u < v): each node links its larger neighbours to its smallest one or itself."""
    reverse = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
    sides = edges.unionByName(reverse)
    least = sides.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select(F.col("u").alias("centre"), F.least("u", "m").alias("m"))
    grown = edges.join(least, edges["u"] == least["centre"])
    return grown.select(F.col("m").alias("u"), "v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges (u < v): each node links its smaller neighbours and itself to the smallest one."""
    least = edges.groupBy("v").agg(F.min("u").alias("m")).withColumnRenamed("v", "centre")
    joined = edges.join(least, edges["v"] == least["centre"])
    moved = joined.select(F.col("m").alias("u"), F.col("u").alias("v")).where("u < v")
    own = least.select(F.col("m").alias("u"), F.col("centre").alias("v"))
    return moved.unionByName(own).distinct()
