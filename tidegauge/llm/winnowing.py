"""Document fingerprints by winnowing.

Every run of GRAM characters has a rolling hash. Of every WINDOW hashes in a row the smallest is chosen,
the rightmost of equal ones, with its position. Two texts that share GRAM + WINDOW - 1 characters
in a row share a chosen hash, wherever the characters are.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: One choice for texts of all lengths: 15 characters in a row that two texts share are seen.
GRAM = 8
WINDOW = 8
#: Rows that a task of ``consecutive`` gets, roughly.
ROWS_PER_RANGE = 4_000
#: Ranges at most, whose bounds (under a megabyte) are sent to the tasks; beyond it the ranges get longer. A task reads
#: its range row by row, so a long one costs time and no memory.
MAX_RANGES = 100_000
_BASE = 0x9E3779B97F4A7C15
_MASK64 = 0xFFFFFFFFFFFFFFFF
#: Stands for a null id, which comes before all others.
_NULL_ID = -(2**63)


class Fingerprint(NamedTuple):
    """Chosen hashes (32 bits) in the order of their positions in the text."""

    hashes: np.ndarray
    positions: np.ndarray


def gram_hashes(codes: np.ndarray, gram: int) -> np.ndarray:
    """Mixed polynomial hash, modulo 2**64, of the ``gram`` codes from every position on.

    A hash of a run comes from the hashes of its two parts, so the work is log(gram) passes.
    """
    span = codes.astype(np.uint64) + np.uint64(1)  # of runs of ``step`` codes
    step, factor = 1, _BASE
    done, size = None, 0  # of runs of ``size`` codes
    left = gram
    while True:
        if left & 1:
            if done is None:
                done, size = span, step
            else:
                n = len(codes) - size - step + 1
                done = done[:n] * np.uint64(factor) + span[size : size + n]
                size += step
        left >>= 1
        if not left:
            break
        n = len(codes) - 2 * step + 1
        span = span[:n] * np.uint64(factor) + span[step : step + n]
        factor = factor * factor & _MASK64
        step *= 2
    mixed = (done ^ (done >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return mixed ^ (mixed >> np.uint64(32))


def window_minima(values: np.ndarray, window: int) -> np.ndarray:
    """Positions of the minima of all windows, the rightmost of equal values, without repeats."""
    at = np.arange(len(values))
    step, width = at, 1
    while 2 * width <= window:
        step = _lower(values, step, width)
        width *= 2
    if width < window:
        step = _lower(values, step, window - width)
    return np.unique(step)


def _lower(values: np.ndarray, best: np.ndarray, apart: int) -> np.ndarray:
    left, right = best[: len(best) - apart], best[apart:]
    return np.where(values[right] <= values[left], right, left)


def winnow(text: str, gram: int = GRAM, window: int = WINDOW) -> Fingerprint:
    """A text shorter than a gram is one gram, one with fewer grams than a window is one window, and an
    empty text has no hashes."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    if not len(codes):
        return Fingerprint(np.zeros(0, np.uint32), np.zeros(0, np.int64))
    hashes = gram_hashes(codes, min(gram, len(codes)))
    chosen = window_minima(hashes, min(window, len(hashes)))
    return Fingerprint((hashes[chosen] >> np.uint64(32)).astype(np.uint32), chosen)


def likeness(a: Fingerprint, b: Fingerprint) -> float:
    """Twice the shared distinct hashes over all distinct hashes of both; 1 for two empty ones."""
    x, y = np.unique(a.hashes), np.unique(b.hashes)
    if not len(x) and not len(y):
        return 1.0
    return 2.0 * len(np.intersect1d(x, y, assume_unique=True)) / (len(x) + len(y))


def as_text(fingerprint: Fingerprint) -> str:
    """The chosen hashes in order, eight hexadecimal digits each."""
    return fingerprint.hashes.astype(">u4").tobytes().hex()


def fingerprints(docs: DataFrame, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """``doc_id``, ``hashes`` and ``positions`` of each row, which are alike in length. No shuffle.

    A null or empty text has none, repeated rows are each answered, null ids passed on, other columns
    not read, and an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                part = batch.slice(low, 512)
                found = [winnow(t, gram, window) for t in part["text"].to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        part["doc_id"],
                        pa.array([f.hashes.astype(np.int64) for f in found], pa.list_(pa.int64())),
                        pa.array([f.positions for f in found], pa.list_(pa.int64())),
                    ],
                    ["doc_id", "hashes", "positions"],
                )

    return _texts(docs).mapInArrow(run, "doc_id bigint, hashes array<bigint>, positions array<bigint>")


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )


def consecutive(docs: DataFrame) -> DataFrame:
    """Rows (``part``, ``guest``, ``id``, ``doc_id``, ``text``) sorted so that every row's next one in the order
    of ids, the first row after the last, comes right after it in its partition.

    Ids are cut into ranges at quantiles. The first row of each range is also a guest at the end of the
    range before, so no range has to see another. Texts are shuffled once. Rows that share an id are
    in one range, ordered by their text; null ids come first.
    """
    texts = _texts(docs).withColumn("id", F.coalesce("doc_id", F.lit(_NULL_ID)))
    total, least = texts.agg(F.count(F.lit(1)), F.min("id")).first()
    ranges = min(MAX_RANGES, max(1, math.ceil(total / ROWS_PER_RANGE)))
    bounds: list[int] = []
    if ranges > 1:
        cuts = [i / ranges for i in range(1, ranges)]
        found = texts.agg(F.percentile_approx("id", cuts, max(10_000, 10 * ranges))).first()[0]
        bounds = sorted({b for b in found if b > least})  # each is an id, so no range is empty
    sent = docs.sparkSession.sparkContext.broadcast((bounds, least))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds, least = sent.value
        limits = np.array(bounds, dtype=np.int64)
        before = {b: i for i, b in enumerate(bounds)} | {least: len(bounds)}
        for batch in batches:
            ids = batch["id"].to_numpy()
            also = np.array([i for i, x in enumerate(ids.tolist()) if x in before], dtype=np.int64)
            rows = batch.take(pa.array(np.concatenate([np.arange(len(ids)), also])))
            parts = [*np.searchsorted(limits, ids, "right").tolist(), *(before[x] for x in ids[also].tolist())]
            guests = np.arange(len(parts)) >= len(ids)
            yield pa.RecordBatch.from_arrays(
                [pa.array(parts, pa.int32()), pa.array(guests), rows["id"], rows["doc_id"], rows["text"]],
                ["part", "guest", "id", "doc_id", "text"],
            )

    placed = texts.select("id", "doc_id", "text").mapInArrow(
        run, "part int, guest boolean, id bigint, doc_id bigint, text string"
    )
    # one range per task; a hash of the range would put several into one
    return placed.repartitionById(ranges, "part").sortWithinPartitions("part", "guest", "id", "text")


def compare_with_next(docs: DataFrame, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """Fingerprints of each text and of its edited text, whose last quarter is replaced by the beginning of
    the next document, how alike its fingerprint is to the edited text's and the next document's, and the
    ``positions`` of its hashes in the text: of any GRAM + WINDOW - 1 characters one starts a chosen gram.

    Nulls, repeats and order are as in ``consecutive`` and ``fingerprints``; a single row is its own next,
    and an empty table gives no rows.
    """

    def answer(doc: tuple[int | None, str, Fingerprint], text: str, after: Fingerprint) -> tuple:
        doc_id, own, fingerprint = doc
        cut = len(own) // 4
        edited = own[: len(own) - cut] + text[:cut]
        changed = winnow(edited, gram, window)
        return (
            doc_id,
            len(own),
            hashlib.sha256(edited.encode()).hexdigest(),
            as_text(fingerprint),
            as_text(changed),
            likeness(fingerprint, changed),
            likeness(fingerprint, after),
            fingerprint.positions.tolist(),
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, part_of_last = None, None
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                rows, out = batch.slice(low, 512).to_pydict(), []
                for part, guest, doc_id, text in zip(
                    rows["part"], rows["guest"], rows["doc_id"], rows["text"], strict=True
                ):
                    if part != part_of_last:
                        last, part_of_last = None, part
                    elif last is None:
                        continue  # a further row with the guest's id
                    fingerprint = winnow(text, gram, window)
                    if last is not None:
                        out.append(answer(last, text, fingerprint))
                    last = None if guest else (doc_id, text, fingerprint)
                if out:
                    columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), _KINDS, strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, _NAMES)

    return consecutive(docs).mapInArrow(run, _RESULT)


_RESULT = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string,"
    " near_edited double, near_next double, positions array<int>"
)
_NAMES = [f.split()[0] for f in _RESULT.split(",")]
_KINDS = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.list_(pa.int32())]
