"""Hard negatives by segment summaries.

Of each vector the mean and the deviation of its segments are stored, in levels from few long segments to many
short ones. For a segment of n components with means m, k and deviations s, t (root of the sum of squared
differences from the mean) the inner product lies within n * m * k - s * t and n * m * k + s * t, so the sums over
the segments bound a score. A level is asked only about pairs that the level before could not settle, and
the exact score is computed for what is left.

Anchors are a stated set of queries that is held against all rows, in blocks: a task gets blocks of anchors
and blocks of rows, keeps what may still be among the best of each anchor, and sends some rows per
anchor and task. Nothing is grouped by label, so a label may hold any share of the rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.skew import store_table

#: Components are multiplied by SCALE and rounded down.
SCALE = 256
#: Positives of an anchor, negatives of a positive.
POSITIVES = 5
NEGATIVES = 5
#: A negative's score is LOW to HIGH hundredths of its positive's.
LOW, HIGH = 80, 100
#: Segments of the levels, from coarse to fine.
LEVELS = (4, 16)
#: Rows and anchors of a block.
BLOCK_ROWS = 2_048
BLOCK_ANCHORS = 256
#: Scores are exact in double precision up to here; above it whole numbers of any size are used.
_EXACT = 2.0**53
_NO_ID = 2**63 - 1  # a null id comes last
_LONG = 2**63 - 1


class Level(NamedTuple):
    """Means, times the roots of the segments' lengths, and deviations: one row per vector, one column per segment."""

    means: np.ndarray
    deviations: np.ndarray


def summaries(vectors: np.ndarray, segments: int) -> Level:
    """Summaries of the rows of ``vectors``; segments may differ by one in length."""
    width = vectors.shape[1]
    bounds = np.linspace(0, width, min(segments, max(width, 1)) + 1).astype(np.int64)[:-1]
    if not width:
        return Level(np.zeros((len(vectors), 1)), np.zeros((len(vectors), 1)))
    sizes = np.diff(np.r_[bounds, width])
    means = np.add.reduceat(vectors, bounds, axis=1) / sizes
    apart = vectors - np.repeat(means, sizes, axis=1)
    return Level(means * np.sqrt(sizes), np.sqrt(np.add.reduceat(apart * apart, bounds, axis=1)))


class Block:
    """Rows side by side: ids, labels, row numbers, vectors and their summaries."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.ids, self.rows, self.labels, self.vectors = ids, rows, labels, vectors
        self.largest = float(np.abs(vectors).max(initial=0.0))
        self.levels = [summaries(vectors, n) for n in LEVELS]

    @classmethod
    def of(cls, row: dict, prefix: str) -> Block:
        ids, rows, labels = (np.frombuffer(row[f"{prefix}{c}"], "<i8") for c in ("ids", "rows", "labels"))
        vectors = np.frombuffer(row[f"{prefix}vectors"], row[f"{prefix}kind"])
        return cls(ids, rows, labels, vectors.reshape(len(ids), -1).astype(np.float64))


def bounds(a: Level, x: np.ndarray, b: Level, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest score of the pairs (a[x], b[y]), with room for rounding."""
    middle = np.einsum("ij,ij->i", a.means[x], b.means[y])
    reach = np.einsum("ij,ij->i", a.deviations[x], b.deviations[y])
    reach = reach * (1 + 1e-9) + np.abs(middle) * 1e-9 + 1e-6
    return middle - reach, middle + reach


def exact_scores(a: Block, x: np.ndarray, b: Block, y: np.ndarray) -> np.ndarray:
    """Scores of the pairs as whole numbers; beyond 64 bits they end at the largest and smallest number."""
    if a.largest * b.largest * max(1, a.vectors.shape[1]) < _EXACT:
        return np.einsum("ij,ij->i", a.vectors[x], b.vectors[y]).astype(np.int64)
    found = [
        sum(int(p) * int(q) for p, q in zip(a.vectors[i], b.vectors[j], strict=True)) for i, j in zip(x, y, strict=True)
    ]
    return np.array([max(-_LONG, min(_LONG, s)) for s in found], dtype=np.int64)


def candidates(
    a: Block, b: Block, allowed: np.ndarray, floor: np.ndarray, ceiling: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (x, y) and scores of the ``allowed`` pairs whose score is within floor[x] and ceiling[x], give or take
    the rounding of very large numbers. Each level of the summaries discards pairs that its bounds exclude;
    what is left is scored."""
    floor = floor - np.where(np.isfinite(floor), np.abs(floor) * 1e-12, 0)
    ceiling = ceiling + np.where(np.isfinite(ceiling), np.abs(ceiling) * 1e-12, 0)
    first = a.levels[0], b.levels[0]
    middle = first[0].means @ first[1].means.T
    reach = first[0].deviations @ first[1].deviations.T
    reach = reach * (1 + 1e-9) + np.abs(middle) * 1e-9 + 1e-6
    x, y = np.nonzero(allowed & (middle + reach >= floor[:, None]) & (middle - reach <= ceiling[:, None]))
    for p, q in zip(a.levels[1:], b.levels[1:], strict=True):
        least, largest = bounds(p, x, q, y)
        stay = (largest >= floor[x]) & (least <= ceiling[x])
        x, y = x[stay], y[stay]
    scores = exact_scores(a, x, b, y)
    stay = (scores >= floor[x]) & (scores <= ceiling[x])
    return x[stay], y[stay], scores[stay]


class Best:
    """Of each of some groups the ``size`` best rows so far: the highest score, then the smallest id."""

    def __init__(self, size: int):
        self.size = size
        self.group = self.score = self.ids = np.zeros(0, np.int64)

    def add(self, group: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        group, score, ids = (
            np.concatenate(c) for c in ((self.group, group), (self.score, score), (self.ids, ids))
        )
        order = np.lexsort((ids, -score, group))
        group, score, ids = group[order], score[order], ids[order]
        begins = np.flatnonzero(np.r_[True, group[1:] != group[:-1]][: len(group)])
        nth = np.arange(len(group)) - np.repeat(begins, np.diff(np.r_[begins, len(group)]))
        stay = nth < self.size
        self.group, self.score, self.ids = group[stay], score[stay], ids[stay]

    def floors(self, groups: int) -> np.ndarray:
        """The score that another row must reach, for each group."""
        floor = np.full(groups, -np.inf)
        values, begins, counts = np.unique(self.group, return_index=True, return_counts=True)
        full = counts == self.size
        floor[values[full]] = self.score[begins[full] + self.size - 1]
        return floor


def prepared(embeddings: DataFrame) -> DataFrame:
    """The rows that take part: ``vec_id``, ``row`` (a number of its own), ``label`` and ``values``. Stored once, as
    the numbers must not change."""
    value = F.col("embedding")
    usable = (
        F.col("label").isNotNull()
        & value.isNotNull()
        & ~F.exists(value, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    )
    rows = embeddings.select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.col("label").cast("bigint").alias("label"),
        "embedding",
    ).where(usable)
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    number = F.monotonically_increasing_id().alias("row")
    return store_table(rows.select("vec_id", number, moved.alias("label"), value.alias("values")))


def _packed(ids: list[int], rows: list[int], labels: list[int], vectors: list[list[float]], width: int) -> list:
    """Columns ids, rows, labels, vectors and kind of a block: whole components, filled up with zeros to ``width``, in the
    smallest kind of number that holds them."""
    whole = np.zeros((len(ids), width))
    for i, values in enumerate(vectors):
        whole[i, : len(values)] = np.floor(SCALE * np.array(values, dtype=np.float64))
    largest = np.abs(whole).max(initial=0.0)
    kind = "<i2" if largest < 2**15 else "<i4" if largest < 2**31 else "<f8"
    columns = [np.array(c, "<i8").tobytes() for c in (ids, rows, labels)]
    return [*columns, whole.astype(kind).tobytes(), kind]


_COLUMNS = ("ids binary", "rows binary", "labels binary", "vectors binary", "kind string")


def blocks(rows: DataFrame, size: int, width: int, prefix: str, scores: bool = False) -> DataFrame:
    """Blocks of at most ``size`` rows in a row of a partition. With ``scores`` also the number of each row's positives
    and these positives' scores."""
    schema = [f"{prefix}{c}" for c in (*_COLUMNS, *(("counts binary", "scores binary") if scores else ()))]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, size):
                part = batch.slice(low, size).to_pydict()
                ids = [_NO_ID if i is None else i for i in part["vec_id"]]
                packed = _packed(ids, part["row"], part["label"], part["values"], width)
                if scores:
                    flat = [s["score"] for r in part["scores"] for s in r]
                    packed += [np.array(c, "<i8").tobytes() for c in ([len(r) for r in part["scores"]], flat)]
                yield pa.RecordBatch.from_arrays([pa.array([v]) for v in packed], [c.split()[0] for c in schema])

    return rows.mapInArrow(pack, ", ".join(schema))


def _best_of(pairs: DataFrame, search, schema: str) -> DataFrame:
    """``search(anchors, rows, state)`` for all pairs of blocks of a task; ``state`` is kept for each block of
    anchors and sent at the end, and earlier where a task sees very many."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, tuple[Block, object]] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                key = row["a_rows"]
                if key not in held:
                    if len(held) >= 64:
                        yield from map(search.rows, held.values())
                        held.clear()
                    a = Block.of(row, "a_")
                    held[key] = a, search.state(a, row)
                a, state = held[key]
                search(a, Block.of(row, "b_"), state)
        yield from map(search.rows, held.values())

    return pairs.mapInArrow(run, schema)


class _Positives:
    """The first rows of the anchor's label."""

    def __init__(self, size: int):
        self.size = size

    def state(self, a: Block, row: dict) -> Best:
        return Best(self.size)

    def __call__(self, a: Block, b: Block, best: Best) -> None:
        same = (a.labels[:, None] == b.labels) & (a.rows[:, None] != b.rows)
        x, y, scores = candidates(a, b, same, best.floors(len(a.ids)), np.full(len(a.ids), np.inf))
        best.add(x, scores, b.ids[y])

    def rows(self, held: tuple[Block, Best]) -> pa.RecordBatch:
        a, best = held
        columns = a.rows[best.group], best.score, best.ids
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["row", "score", "id"])


class _Negatives:
    """The first rows of other labels within the range of each positive."""

    def __init__(self, size: int, low: int, high: int):
        self.size, self.low, self.high = size, low, high

    def state(self, a: Block, row: dict) -> tuple[np.ndarray, np.ndarray, Best]:
        """The anchor of each positive and the positive's score, by anchor, and the best."""
        counts = np.frombuffer(row["a_counts"], "<i8")
        return np.repeat(np.arange(len(a.ids)), counts), np.frombuffer(row["a_scores"], "<i8"), Best(self.size)

    def __call__(self, a: Block, b: Block, state) -> None:
        anchor, score, best = state
        # a range is empty where the positive's score is below zero
        low = -(-self.low * score.astype(object) // 100).astype(np.float64)
        high = (self.high * score.astype(object) // 100).astype(np.float64)
        floors = np.maximum(low, best.floors(len(anchor)))
        floor, ceiling = np.full(len(a.ids), np.inf), np.full(len(a.ids), -np.inf)
        np.minimum.at(floor, anchor, floors)
        np.maximum.at(ceiling, anchor, high)
        other = a.labels[:, None] != b.labels
        x, y, found = candidates(a, b, other, floor, ceiling)
        # every anchor's pairs against each of its positives
        begin = np.searchsorted(anchor, x)
        runs = np.searchsorted(anchor, x, "right") - begin
        pair = np.repeat(np.arange(len(x)), runs)
        positive = np.repeat(begin - np.cumsum(runs) + runs, runs) + np.arange(len(pair))
        if a.largest * b.largest * max(1, a.vectors.shape[1]) < _EXACT / 100:
            s, p = found[pair], score[positive]
        else:
            s, p = found[pair].astype(object), score[positive].astype(object)
        within = ((self.low * p <= 100 * s) & (100 * s <= self.high * p)).astype(bool)
        best.add(positive[within], found[pair[within]], b.ids[y[pair[within]]])

    def rows(self, held) -> pa.RecordBatch:
        a, (anchor, score, best) = held
        begin = np.searchsorted(anchor, np.arange(len(a.ids)))
        nth = np.arange(len(anchor)) - begin[anchor]
        columns = a.rows[anchor[best.group]], nth[best.group], best.score, best.ids
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["row", "nth", "score", "id"])


def _ranked(rows: DataFrame, keys: list[str], size: int) -> DataFrame:
    """``rank`` from 1 on of the ``size`` best rows of each group; the limit runs before the shuffle."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "id")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size)


def _id(column: str) -> Column:
    return F.when(F.col(column) != _NO_ID, F.col(column))


def hard_negatives(
    embeddings: DataFrame,
    every: int = 100,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
) -> DataFrame:
    """For each anchor (a row whose vec_id is divisible by ``every``) and each of its ``positives`` the ``negatives`` best
    rows of another label with a score of ``low`` to ``high`` hundredths of the positive's: ``anchor_id``,
    ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    Rows with a null label, a null vector, or a null or non-finite component take no part. A row without an id is no
    anchor and comes after all ids in a tie. Repeated rows are rows of their own: each is an anchor, and each can be
    a positive of the other. Shorter vectors end in zeros; an empty vector scores 0 with all. Scores beyond 64 bits
    end at the largest number. Other columns are not read, and an empty table gives no rows.
    """
    rows = prepared(embeddings)
    width = rows.agg(F.max(F.size("values"))).first()[0] or 0
    all_rows = store_table(blocks(rows, BLOCK_ROWS, width, "b_"))
    chosen = rows.where(F.col("vec_id") % every == 0)
    # one block of anchors per partition, so that no task holds more than some of them
    count = chosen.count()
    spread = chosen.repartition(max(1, -(-count // BLOCK_ANCHORS)))
    anchors = blocks(spread, BLOCK_ANCHORS, width, "a_")
    first = _best_of(anchors.crossJoin(all_rows), _Positives(positives), "row bigint, score bigint, id bigint")
    best = store_table(_ranked(first, ["row"], positives).select("row", "score", "id", "rank"))
    listed = best.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("rank", "score"))).alias("scores"))
    asked = chosen.join(listed, "row").repartition(max(1, -(-count // BLOCK_ANCHORS)))
    second = _best_of(
        blocks(asked, BLOCK_ANCHORS, width, "a_", scores=True).crossJoin(all_rows),
        _Negatives(negatives, low, high),
        "row bigint, nth bigint, score bigint, id bigint",
    )
    named = best.join(chosen.select("row", F.col("vec_id").alias("anchor_id")), "row").select(
        "row", (F.col("rank") - 1).cast("bigint").alias("nth"), "anchor_id",
        _id("id").alias("positive_id"), F.col("score").alias("positive_score"),
    )
    return (
        _ranked(second, ["row", "nth"], negatives)
        .join(named, ["row", "nth"])
        .select(
            "anchor_id",
            "positive_id",
            "rank",
            _id("id").alias("negative_id"),
            "positive_score",
            F.col("score").alias("negative_score"),
        )
    )
