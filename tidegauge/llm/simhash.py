"""SimHash near-duplicates: banded candidates, pivot distance tables, exact verification.

Fingerprints that differ in at most three bits agree in at least three of six segments of their bits, so an
equi-join on every three segments (banding) finds all candidates. Each distinct fingerprint also
carries its Hamming distances to eight spread reference fingerprints, computed once and kept in one number:
by the triangle inequality a link's distances to each reference differ by at most three, and the
largest coordinate difference discards a candidate before its bits are counted.

The distances alone cannot propose the candidates: two random fingerprints pass one reference with
probability 0.46, so cells of the distances stay as full as a cross join until there are far too many
neighbouring cells to look into (README, "SimHash").
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.skew import store_table
from .components import connected_components

#: Bits in which linked fingerprints differ at most.
MAX_DISTANCE = 3
SEED = 42
#: Widths of the segments; MAX_DISTANCE of them can differ, the other three agree.
SEGMENTS = (11, 11, 11, 11, 10, 10)
#: The spread references: hashes of their numbers.
REFERENCES = tuple(xxhash.xxh64_intdigest(bytes([i]), SEED) for i in range(8))


def fingerprint(text: str, shingle: int) -> int:
    """64-bit SimHash of the word shingles, repeats included; 0 for a text without words."""
    words = text.encode().lower().split()
    if not words:
        return 0
    data = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    n = max(1, len(words) - shingle + 1)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1
    ends = np.cumsum(sizes)
    starts = (ends - sizes).tolist()
    stops = (ends[min(shingle, len(words)) - 1 :] - 1).tolist()
    hashes = np.fromiter(
        (digest(data[a:b], SEED) for a, b in zip(starts, stops, strict=False)), dtype="<u8", count=n
    )
    totals = np.zeros(64, dtype=np.int64)
    for i in range(0, n, 4096):
        bits = np.unpackbits(hashes[i : i + 4096].view(np.uint8), bitorder="little")
        totals += bits.reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(totals * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int, row: str | None = None) -> DataFrame:
    """``doc_id`` and ``fp``, the fingerprint as a signed number, of each row, and the number ``row`` that
    tells the rows apart, where one is named. No shuffle."""
    kept = ["doc_id", *([row] if row else [])]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fps = np.array([fingerprint(t, shingle) for t in batch["text"]], dtype=np.uint64)
            yield pd.DataFrame({c: batch[c] for c in kept} | {"fp": fps.view(np.int64)})

    columns = docs.select(
        *[F.col(c).cast("bigint").cast("string").alias(c) for c in kept],
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    found = columns.mapInPandas(run, ", ".join(f"{c} string" for c in kept) + ", fp bigint")
    return found.select(*[F.col(c).cast("bigint").alias(c) for c in kept], "fp")


def _distances(fp: Column) -> Column:
    """Distances to the spread references, eight bits each, in one number."""

    def signed(value: int) -> int:
        return value - (1 << 64) if value >> 63 else value

    packed = [
        F.shiftleft(F.bit_count(fp.bitwiseXOR(F.lit(signed(r)))).cast("bigint"), 8 * i)
        for i, r in enumerate(REFERENCES)
    ]
    return reduce(lambda a, b: a.bitwiseOR(b), packed)


def _segment_keys(fp: Column) -> Column:
    """For every three of the segments, their number and their contents as one number."""
    low = list(itertools.accumulate(SEGMENTS, initial=0))
    keep = len(SEGMENTS) - MAX_DISTANCE
    keys = []
    for nth, chosen in enumerate(itertools.combinations(range(len(SEGMENTS)), keep)):
        key = F.lit(nth).cast("bigint")
        for i in chosen:
            part = F.shiftrightunsigned(fp, low[i]).bitwiseAND(F.lit((1 << SEGMENTS[i]) - 1))
            key = F.shiftleft(key, SEGMENTS[i]).bitwiseOR(part)
        keys.append(key)
    return F.array(*keys)


def links(distinct: DataFrame) -> DataFrame:
    """All pairs ``a`` < ``b`` of the distinct fingerprints ``fp`` that are linked, once or more often.

    A fingerprint has at most 43,744 others within three bits, whatever the data, so the pairs
    grow with the fingerprints. A segment key that many share is split by Spark's skew join.
    """
    table = distinct.select("fp", _distances(F.col("fp")).alias("d"))
    keyed = table.select("fp", "d", F.explode(_segment_keys(F.col("fp"))).alias("key"))
    x, y = keyed.alias("x"), keyed.alias("y")
    near = (F.col("x.key") == F.col("y.key")) & (F.col("x.fp") < F.col("y.fp"))
    for i in range(len(REFERENCES)):
        a, b = (F.shiftright(F.col(c), 8 * i).bitwiseAND(F.lit(255)) for c in ("x.d", "y.d"))
        near &= F.abs(a - b) <= MAX_DISTANCE
    differing = F.bit_count(F.col("x.fp").bitwiseXOR(F.col("y.fp")))
    pairs = x.join(y, near & (differing <= MAX_DISTANCE))
    return pairs.select(F.col("x.fp").alias("a"), F.col("y.fp").alias("b"))


def near_duplicates(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``fp`` and ``component_id``, the smallest doc_id that can
    be reached over links.

    A null or empty text has fingerprint zero and is linked like any other. A null doc_id is never
    the smallest unless its component has no other. Repeated rows are each answered, other
    columns not read, and an empty table gives no rows. Copies share one fingerprint and
    are linked through it, not in pairs. The fingerprints are stored once in the shared folder.
    """
    stored = store_table(fingerprints(docs, shingle))
    named = _rooted(stored.groupBy("fp").agg(F.min("doc_id").alias("first")))
    smallest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = named.join(smallest, "root").select(F.col("fp").alias("class_fp"), "component_id")
    joined = stored.join(classes, stored["fp"] == classes["class_fp"])
    return joined.select("doc_id", "fp", "component_id")


def _rooted(distinct: DataFrame) -> DataFrame:
    """``distinct`` fingerprints ``fp`` with ``root``, the smallest fingerprint of their component."""
    roots = connected_components(links(distinct.select("fp")))
    joined = distinct.join(roots, distinct["fp"] == roots["node"], "left")
    return joined.select(*distinct.columns, F.coalesce("root", "fp").alias("root"))


def first_of_each_group(docs: DataFrame, row: str, shingle: int = 3) -> DataFrame:
    """For each component the number ``row`` (unique in ``docs``) of one of its rows: that with the
    smallest doc_id, of several with it that with the smallest number, and a row without an id only where no
    other is. Nulls, repeats and empty tables are as in ``near_duplicates``."""
    stored = store_table(fingerprints(docs, shingle, row))
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.col(row).alias("row"))
    named = _rooted(stored.groupBy("fp").agg(F.min(place).alias("first")))
    return named.groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.row").alias(row))


def fingerprint_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
