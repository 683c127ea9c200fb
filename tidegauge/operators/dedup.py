"""Keep-first deduplication within a time-to-live, by event time.

A message id is accepted when no *accepted* message of the same id lies within the last
``ttl`` (the bound included). Duplicates do not extend the time-to-live, so this is a
chain per id: each accepted row is the first one later than the previous accepted row
plus the time-to-live. The id alone is the key, whatever the sensor.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import DedupConfig, SkewConfig
from ..plans.chains import accepted_chain
from ..plans.skew import by_shuffle, split_hot, store_table, union_parts

ID = "message_id"


def dedup_ttl(
    df: DataFrame,
    cfg: DedupConfig = DedupConfig(),
    tie_break: list[str] | None = None,
    skew: SkewConfig = SkewConfig(),
) -> DataFrame:
    """Add ``is_duplicate``. ``tie_break`` orders rows of one id at the same time.

    Rows without a time are older than all others: the first one of an id is accepted. Rows
    without an id are copies of one message.
    """
    ties = list(tie_break or [])
    ordinary, hot, _ = split_hot(df, [ID], skew.max_dedup_group_rows, skew)
    parts = []
    if ordinary is not None:
        parts.append(_by_window_and_fold(ordinary, cfg.ttl_us, ties))
    if hot is not None:
        parts.append(_by_chain(hot, cfg.ttl_us, ties))
    return union_parts(parts)


def accepted(flagged: DataFrame) -> DataFrame:
    return flagged.filter(~F.col("is_duplicate")).drop("is_duplicate")


def duplicates(flagged: DataFrame) -> DataFrame:
    return flagged.filter(F.col("is_duplicate")).drop("is_duplicate")


def _micros() -> Column:
    return F.unix_micros("timestamp")


def _by_window_and_fold(df: DataFrame, ttl: int, ties: list[str]) -> DataFrame:
    """One shuffle by id.

    A gap longer than the time-to-live always starts a fresh chain, so the rows of an id
    fall into sessions. Rows within the time-to-live of their session's first row are
    decided at once by the window; only the rows beyond it (rare: an id repeated for longer
    than the time-to-live without such a gap) are folded, session by session.
    """
    by_time = Window.partitionBy(ID).orderBy("timestamp", *ties)
    so_far = by_time.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    fresh = F.col("__previous").isNull() | (F.col("__t") - F.col("__previous") > ttl)
    base = (
        df.withColumn("__t", _micros())
        .withColumn("__previous", F.lag("__t").over(by_time))
        .withColumn("__start", F.max(F.when(fresh, F.col("__t"))).over(so_far))
        .withColumn("__fresh", fresh)
        .withColumn("__nth", F.row_number().over(by_time))
    )
    beyond = F.coalesce(F.col("__t") - F.col("__start") > ttl, F.lit(False))
    columns = df.columns
    untimed = F.col("__t").isNull()
    repeated = F.when(untimed, F.col("__nth") > 1).otherwise(~F.col("__fresh"))
    decided = base.filter(~beyond).select(*columns, repeated.alias("is_duplicate"))

    # Only the distinct times of a session are folded; the rows themselves stay where they are.
    rest = base.filter(beyond)
    times = rest.groupBy(ID, "__start").agg(F.sort_array(F.collect_set("__t")).alias("__times"))
    start = F.struct(F.col("__start").alias("last"), F.array().cast("array<bigint>").alias("kept"))

    def step(state: Column, time: Column) -> Column:
        take = time - state["last"] > ttl
        return F.struct(
            F.when(take, time).otherwise(state["last"]).alias("last"),
            F.when(take, F.concat(state["kept"], F.array(time))).otherwise(state["kept"]).alias("kept"),
        )

    accepted_at = times.select(
        F.col(ID).alias("__id"),
        F.explode(F.aggregate("__times", start, step, lambda s: s["kept"])).alias("__accepted"),
    )
    on = F.col(ID).eqNullSafe(F.col("__id")) & (F.col("__t") == F.col("__accepted"))
    # of several rows at an accepted time the first one counts
    lost = F.col("__accepted").isNull() | (F.col("__previous") == F.col("__t"))
    folded = rest.join(by_shuffle(accepted_at), on, "left").select(*columns, F.coalesce(lost, F.lit(False)).alias("is_duplicate"))
    return decided.unionByName(folded)


def _by_chain(df: DataFrame, ttl: int, ties: list[str]) -> DataFrame:
    """Hot ids: equal times are merged before the shuffle, the chain is found in parallel."""
    numbered = store_table(
        df.withColumn("__t", _micros()).withColumn("__row", F.monotonically_increasing_id())
    )
    earliest = F.min(F.struct(*[F.col(c).alias(f"__tie{i}") for i, c in enumerate(ties)], "__row"))
    points = store_table(numbered.groupBy(ID, "__t").agg(earliest.alias("__first")))
    timed = points.filter(F.col("__t").isNotNull())
    chain = accepted_chain(timed.select(ID, "__t"), ID, "__t", ttl)
    on_chain = timed.alias("p").join(
        by_shuffle(chain.alias("c")),
        F.col(f"p.{ID}").eqNullSafe(F.col(f"c.{ID}")) & (F.col("p.__t") == F.col("c.__t")),
        "left_semi",
    )
    winners = on_chain.unionByName(points.filter(F.col("__t").isNull())).select(
        F.col("__first.__row").alias("__winner")
    )
    return (
        numbered.join(by_shuffle(winners), F.col("__row") == F.col("__winner"), "left")
        .withColumn("is_duplicate", F.col("__winner").isNull())
        .drop("__t", "__row", "__winner")
    )
