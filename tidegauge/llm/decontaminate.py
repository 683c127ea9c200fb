"""Benchmark decontamination with spaced seeds.

A seed hashes some of the words in a window and ignores the others, so a substituted word does not
hide a passage whose other words are there. Seeds of the benchmark's items and of the documents
are joined by their hash. Around a hit the item is laid over the document, place by place, and the
longest stretch is looked for in which enough words agree.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words used (1) and ignored (0). Whatever fifth of the words of a stretch of five or more is
#: replaced, one of these seeds still lies on kept words alone.
MASKS = ("1111", "11011", "10111", "11101")
#: Words of a stretch, or of the item if it has fewer.
MIN_WORDS = 13
#: Share of the words of a stretch that agree.
MIN_SHARE = (4, 5)
#: Items of fewer words are found by all their words, as one seed without gaps.
SHORT_MASKS = ("1", "11", "111")
#: Words of the items that are sent to the tasks at once, some 35 MB; a larger benchmark is taken in blocks.
BLOCK_WORDS = 400_000
#: Shifts of an item that are compared at once.
_SHIFTS = 512
#: Pairs of places of one seed from which on they are taken as runs.
_REPEATED = 64
#: Characters of scripts that do without spaces.
_ALONE = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_WORD = re.compile(r"\w+")
_WORD_OR_CHARACTER = re.compile(rf"[{_ALONE}]|[^\W{_ALONE}]+")
_HIGH = re.compile("[\u0e00-\U0010ffff]")
_FILTER_BITS = 22
_KNOWN_WORDS = 200_000


def words_of(text: str) -> list[str]:
    """Runs of letters, digits and underscores, lower-cased; in scripts without spaces every character."""
    text = text.lower()
    if text.isascii() or not _HIGH.search(text):
        return _WORD.findall(text)
    return _WORD_OR_CHARACTER.findall(text)


def _hashes(words: list[str], known: dict[str, int]) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    out = np.empty(len(words), dtype=np.uint64)
    for i, w in enumerate(words):
        h = known.get(w)
        if h is None:
            h = known[w] = digest(w)
        out[i] = h
    return out


_FACTORS = np.array([xxhash.xxh3_64_intdigest(bytes([i])) | 1 for i in range(8)], dtype=np.uint64)


def seeds(hashes: np.ndarray, mask: str, nth: int) -> np.ndarray:
    """The seed at every place where the mask fits."""
    n = len(hashes) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(n, nth + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for i, used in enumerate(mask):
        if used == "1":
            total += hashes[i : i + n] * _FACTORS[i]
    total ^= total >> np.uint64(31)
    total *= np.uint64(0xBF58476D1CE4E5B9)
    return total ^ (total >> np.uint64(29))


class Index(NamedTuple):
    """Seeds of the items of one block, sorted, with the item and place of each."""

    item_ids: list[int | None]
    items: list[np.ndarray]
    seeds: np.ndarray
    item: np.ndarray
    place: np.ndarray
    present: np.ndarray
    masks: list[tuple[int, str]]


def build_index(items: list[tuple[int | None, str]]) -> Index:
    known: dict[str, int] = {}
    ids, hashed = [], []
    for item_id, text in items:
        h = _hashes(words_of(text), known)
        if len(h):
            ids.append(item_id)
            hashed.append(h)
    found, item, place = [np.zeros(0, np.uint64)], [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]
    masks = set()
    for i, h in enumerate(hashed):
        short = len(h) <= len(SHORT_MASKS)
        own = [(len(MASKS) + len(h), SHORT_MASKS[len(h) - 1])] if short else list(enumerate(MASKS))
        masks.update(own)
        for nth, mask in own:
            s = seeds(h, mask, nth)
            found.append(s)
            item.append(np.full(len(s), i, np.int32))
            place.append(np.arange(len(s), dtype=np.int32))
    all_seeds = np.concatenate(found)
    order = np.argsort(all_seeds, kind="stable")
    all_seeds = all_seeds[order]
    present = np.zeros(1 << _FILTER_BITS, dtype=bool)
    present[all_seeds >> np.uint64(64 - _FILTER_BITS)] = True
    item, place = np.concatenate(item)[order], np.concatenate(place)[order]
    return Index(ids, hashed, all_seeds, item, place, present, sorted(masks))


def _runs(at: np.ndarray) -> list[tuple[int, int]]:
    """First and last of the runs of consecutive numbers."""
    breaks = np.flatnonzero(np.diff(at) != 1)
    return list(zip(at[np.r_[0, breaks + 1]].tolist(), at[np.r_[breaks, len(at) - 1]].tolist(), strict=True))


def _hits(index: Index, doc: np.ndarray) -> dict[int, np.ndarray]:
    """For each item with a seed in common the shifts, ascending: the item's word i lies on word i + shift.

    Where a seed is repeated, its places in the item and in the document are taken as runs of consecutive
    ones: two runs give all shifts from the first place less the last one to the last less the first. So long
    repetitions cost their runs and not the product of their places."""
    spans: dict[int, list[tuple[int, int]]] = {}
    pairs = []
    for nth, mask in index.masks:
        s = seeds(doc, mask, nth)
        at = np.flatnonzero(index.present[s >> np.uint64(64 - _FILTER_BITS)])
        if not len(at):
            continue
        low = np.searchsorted(index.seeds, s[at], "left")
        real = index.seeds[np.minimum(low, len(index.seeds) - 1)] == s[at]
        if not real.any():
            continue  # the filter lets some others through
        at = at[real]
        values, back, counts = np.unique(s[at], return_inverse=True, return_counts=True)
        low = np.searchsorted(index.seeds, values, "left")
        n = np.searchsorted(index.seeds, values, "right") - low
        repeated = n * counts > _REPEATED
        single = ~repeated[back]
        places, own, many = at[single], low[back[single]], n[back[single]]
        if total := int(many.sum()):
            stops = np.cumsum(many)
            rows = np.repeat(own - (stops - many), many) + np.arange(total)
            pairs.append(np.stack([index.item[rows], np.repeat(places, many) - index.place[rows]], axis=1))
        for v in np.flatnonzero(repeated).tolist():
            runs = _runs(at[back == v])
            items, where = index.item[low[v] : low[v] + n[v]], index.place[low[v] : low[v] + n[v]].astype(np.int64)
            edges = np.flatnonzero(np.r_[True, items[1:] != items[:-1], True]).tolist()
            for a, b in zip(edges, edges[1:]):
                found = spans.setdefault(int(items[a]), [])
                for first, last in _runs(where[a:b]):
                    found += [(p - last, q - first) for p, q in runs]
    if pairs:
        for item, shift in np.unique(np.concatenate(pairs), axis=0).tolist():
            spans.setdefault(item, []).append((shift, shift))
    return {item: _union(found) for item, found in spans.items()}


def _union(spans: list[tuple[int, int]]) -> np.ndarray:
    """All numbers of the spans (ends included), ascending, once."""
    merged: list[list[int]] = []
    for low, high in sorted(set(spans)):
        if merged and low <= merged[-1][1] + 1:
            merged[-1][1] = max(merged[-1][1], high)
        else:
            merged.append([low, high])
    return np.concatenate([np.arange(low, high + 1) for low, high in merged])


def longest_stretch(equal: np.ndarray, least: int) -> tuple[int, int] | None:
    """Start and end of the longest stretch, the first of equals, with at least ``least`` places and
    enough equal ones."""
    num, den = MIN_SHARE
    if int(equal.sum()) * den < num * least:
        return None
    at = np.concatenate([[0], np.cumsum(np.where(equal, den - num, -num))])
    # candidates for the start are the record lows of the running sum, from the left
    lows = np.flatnonzero(at <= np.minimum.accumulate(at))
    lows = lows[np.concatenate([[True], at[lows[1:]] < at[lows[:-1]]])]
    # for every end, the earliest start whose sum is not larger
    starts = lows[np.searchsorted(-at[lows], -at[1:], "left").clip(max=len(lows) - 1)]
    fits = at[starts] <= at[1:]
    sizes = np.where(fits, np.arange(1, len(at)) - starts, 0)
    best = int(np.argmax(sizes))
    if sizes[best] < least:
        return None
    return int(starts[best]), best + 1


def matches(index: Index, doc: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
    """For each item found in a document: its number, the words of the document from and to, the
    first word of the item, and the words that agree. Of several stretches the one with the most
    agreeing words counts, then the first."""
    for item, shifts in _hits(index, doc).items():
        best = _best_stretch(index.items[item], doc, shifts)
        if best is not None:
            agree, start, end, first = best
            yield item, -start, -end, first, agree


def _best_stretch(words: np.ndarray, doc: np.ndarray, shifts: np.ndarray) -> tuple[int, int, int, int] | None:
    """Agreeing words, minus the first and the last word of the document, and the item's first word."""
    n, best = len(words), None
    least = min(MIN_WORDS, n)
    num, den = MIN_SHARE
    padded = np.concatenate([np.zeros(n, np.uint64), doc, np.zeros(n, np.uint64)])
    step = max(1, _SHIFTS * 512 // n)
    for i in range(0, len(shifts), step):
        some = shifts[i : i + step]
        # how many words agree at all at each shift tells which can still be the best
        agree = np.array([(padded[s + n : s + 2 * n] == words).sum() for s in some.tolist()]) if n > 4_096 else (
            (padded[some[:, None] + n + np.arange(n)] == words).sum(axis=1)
        )
        for shift, most in zip(some.tolist(), agree.tolist(), strict=True):
            low, high = max(0, -shift), min(n, len(doc) - shift)
            if high - low < least or most * den < num * least:
                continue
            if best is not None and (most < best[0] or (most == best[0] and shift + low > -best[1])):
                continue
            equal = words[low:high] == doc[low + shift : high + shift]
            stretch = longest_stretch(equal, least)
            if stretch:
                start = low + stretch[0]
                count = int(equal[stretch[0] : stretch[1]].sum())
                found = (count, -(start + shift), -(low + stretch[1] + shift), start)
                best = found if best is None else max(best, found)
        if best is not None and best[0] == n:
            return best  # nothing later can be better
    return best


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[int | None, str]]]:
    """The items in blocks of bounded size, one on the driver at a time."""
    rows = benchmark.select(
        F.col("item_id").cast("bigint").alias("item_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    block, size = [], 0
    for row in rows.toLocalIterator():
        block.append((row["item_id"], row["text"]))
        size += len(words_of(row["text"])) + 1
        if size >= BLOCK_WORDS:
            yield block
            block, size = [], 0
    if block:
        yield block


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per row of ``docs`` and item found in it: ``doc_id``, ``item_id``, ``first_word`` and
    ``end_word`` of the stretch in the document, ``item_word`` where it starts in the item, ``n_words`` long,
    ``n_equal`` and their share, ``similarity``.

    A stretch has thirteen words, or all of a shorter item, and four fifths of them agree; of an item of fewer
    than five words all do. Words are runs of letters, digits and underscores, in lower case, and single characters
    in scripts without spaces. Documents are read once per block of the benchmark and not shuffled. Null and
    empty texts, and items without words, match nothing. Repeated rows are each answered, repeated items each found, null ids passed on, other
    columns not read. Without documents or items there are no rows.
    """
    columns = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")
    ).where("text IS NOT NULL")
    parts = []
    for index in indexes(benchmark):
        sent = docs.sparkSession.sparkContext.broadcast(index)
        parts.append(columns.mapInArrow(_search(sent), _SCHEMA))
    if not parts:
        return columns.where("false").mapInArrow(lambda batches: iter(()), _SCHEMA)
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found


_SCHEMA = (
    "doc_id bigint, item_id bigint, first_word bigint, end_word bigint, item_word bigint,"
    " n_words bigint, n_equal bigint, similarity double"
)


def _search(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, known = sent.value, {}
        for batch in batches:
            rows = []
            for low in range(0, batch.num_rows, 512):
                part = batch.slice(low, 512)
                for doc_id, text in zip(part["doc_id"].to_pylist(), part["text"].to_pylist(), strict=True):
                    if len(known) > _KNOWN_WORDS:
                        known.clear()
                    doc = _hashes(words_of(text), known)
                    for item, start, end, first, agree in matches(index, doc):
                        size = end - start
                        rows.append(
                            (doc_id, index.item_ids[item], start, end, first, size, agree, agree / size)
                        )
            if rows:
                kinds = [pa.int64()] * 7 + [pa.float64()]
                names = [f.strip().split()[0] for f in _SCHEMA.split(",")]
                columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def indexes(benchmark: DataFrame) -> Iterator[Index]:
    """The seeds of all items, in blocks of bounded size."""
    for block in _blocks(benchmark):
        yield build_index(block)


def has_leak(index: Index, text: str, known: dict[str, int]) -> bool:
    """Whether an item is found in a text; ``known`` keeps hashes of words between calls."""
    if len(known) > _KNOWN_WORDS:
        known.clear()
    return next(matches(index, _hashes(words_of(text), known)), None) is not None
