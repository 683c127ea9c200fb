"""Sharding by jump consistent hashing, in SQL expressions only.

The published algorithm walks a linear congruential generator that is seeded with the key. A key
jumps from shard to shard while the generator says so, and its last jump below the number of
shards is its shard. Hence no ring table, and one more shard takes rows only into itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.skew import store_table

# Fixed values of the published algorithm: the multiplier of the generator, its increment is 1.
MULTIPLIER = 2862933555777941757
LOW, HIGH = MULTIPLIER & 0xFFFFFFFF, MULTIPLIER >> 32
MASK32, MASK16 = 0xFFFFFFFF, 0xFFFF
#: Steps between two looks at whether a key has jumped past the last shard.
STEPS = 64


def _times(word: Column, factor: int) -> tuple[Column, Column]:
    """Product of a 32-bit word and a 32-bit constant as (upper part, low 32 bits), without an
    overflow of the signed 64-bit type: the word goes in as two halves."""
    low = word.bitwiseAND(F.lit(MASK16)) * F.lit(factor)
    high = F.shiftright(word, 16) * F.lit(factor)
    total = low + F.shiftleft(high.bitwiseAND(F.lit(MASK16)), 16)
    return F.shiftright(total, 32) + F.shiftright(high, 16), total.bitwiseAND(F.lit(MASK32))


def jump_hash(key: Column, shards: int) -> Column:
    """Shard from 0 to ``shards`` - 1 of a whole-number key; a null key goes where 0 goes.

    Each step raises the shard by one at least, so ``shards`` steps are enough for every key. Most keys
    need about ln(``shards``) of them, so the steps come in blocks, and a key that is done skips the rest.
    """
    if shards < 1:
        raise ValueError("there must be at least one shard")
    key = F.coalesce(key.cast("bigint"), F.lit(0).cast("bigint"))
    start = F.struct(
        F.shiftrightunsigned(key, 32).alias("hi"),
        key.bitwiseAND(F.lit(MASK32)).alias("lo"),
        F.lit(-1).cast("bigint").alias("b"),
        F.lit(0).cast("bigint").alias("j"),
    )

    def step(state: Column, _: Column) -> Column:
        carry, low = _times(state["lo"], LOW)
        _, a = _times(state["lo"], HIGH)
        _, b = _times(state["hi"], LOW)
        up = low + F.lit(1)
        lo = up.bitwiseAND(F.lit(MASK32))
        hi = (carry + a + b + F.shiftright(up, 32)).bitwiseAND(F.lit(MASK32))
        jump = F.floor(
            (state["j"] + 1).cast("double")
            * (F.lit(2147483648.0) / (F.shiftright(hi, 1) + 1).cast("double"))
        )
        moved = F.struct(hi.alias("hi"), lo.alias("lo"), state["j"].alias("b"), jump.alias("j"))
        return F.when(state["j"] < shards, moved).otherwise(state)

    if shards <= STEPS:
        return F.aggregate(F.sequence(F.lit(1), F.lit(shards)), start, step, lambda s: s["b"].cast("int"))

    def block(state: Column, _: Column) -> Column:
        steps = F.when(state["j"] < shards, F.sequence(F.lit(1), F.lit(STEPS))).otherwise(F.array().cast("array<int>"))
        return F.aggregate(steps, state, step)

    blocks = F.sequence(F.lit(1), F.lit(-(-shards // STEPS)))
    return F.aggregate(blocks, start, block, lambda s: s["b"].cast("int"))


def assign_shards(rows: DataFrame, key: str, shards: int, name: str = "shard") -> DataFrame:
    """``rows`` with the shard of each; text keys may be hashed with ``xxhash64`` before."""
    return rows.withColumn(name, jump_hash(F.col(key), shards))


def number_within(rows: DataFrame, group: str, name: str = "slot") -> DataFrame:
    """``rows`` numbered without gaps from 0 within each group, in no stated order.

    A group may hold any share of the rows, so no task sees a whole one. The rows are stored
    once with the number of their task and of their place in it. Counts by task and group, which
    are few, are summed up to offsets, and the rows of one task and group are numbered alone.
    No value of a row decides where it goes, so repeated rows and keys do no harm.
    """
    place = F.monotonically_increasing_id()
    held = store_table(rows.select(F.struct("*").alias("row"), F.col(group).alias("g"), place.alias("at")))
    held = held.withColumn("part", F.shiftright("at", 33))
    counts = held.groupBy("g", "part").agg(F.count(F.lit(1)).alias("n")).alias("c")
    counts = counts.selectExpr(
        "g",
        "part",
        "coalesce(sum(n) OVER (PARTITION BY g ORDER BY part"
        " ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before",
    )
    inner = held.selectExpr(
        "row", "g", "part", "row_number() OVER (PARTITION BY g, part ORDER BY at) - 1 AS nth"
    )
    on = inner["g"].eqNullSafe(counts["g"]) & (inner["part"] == counts["part"])
    return inner.join(counts, on).select("row.*", (F.col("nth") + F.col("before")).alias(name))


def shard_documents(docs: DataFrame, shards: int = 16) -> DataFrame:
    """One row per document: its size (UTF-8 bytes and 1), checksum, shard, slot in the shard
    and its shard if there were one more.

    The document's id and the number of shards alone decide. A null text counts as empty, a null
    id as 0, repeated rows are each kept and get slots of their own. Other columns are not read.
    An empty table gives no rows.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    placed = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        jump_hash(F.col("doc_id"), shards).alias("shard"),
        jump_hash(F.col("doc_id"), shards + 1).alias("grown_shard"),
    )
    numbered = number_within(placed, "shard")
    return numbered.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
