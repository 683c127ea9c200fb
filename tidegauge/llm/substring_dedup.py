"""Removal of passages that an earlier document has: every run of WINDOW words that also starts in a document
with a smaller id goes.

1. Documents are cut into *fragments*. Every window of words has a minimizer, the run of GRAM words in it with
   the smallest hash; windows in a row with one minimizer are a fragment of at most 2 * WINDOW - GRAM
   words. Equal windows have equal minimizers, so if the minimizer names the shard, all occurrences of
   a window meet in one shard. Before they are sent, a task combines equal fragments of its rows: only those of the
   smallest id go on, the others are already known to be repeated. So a passage that a third of
   all documents share is sent once by each task.
2. A shard leaves out fragments whose minimizer occurs in one document alone, builds a compressed
   FM-index over the words of the others (``fm_index``), and streams them past it. Backward search over
   the wavelet tree yields the matching statistics; where they reach WINDOW words, the interval of suffixes
   tells the smallest document that has the window.
3. The covered intervals come back to the documents, which lose their words.

A shard's size does not grow with the corpus, only the number of shards does. A minimizer that fills shards by itself,
a short phrase in very many different passages, is found on a sample; its fragments are cut into single
windows that are placed by all their words. The sample decides on the balance alone, never on results.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.skew import store_table
from .fm_index import FMIndex, matching_statistics

#: Words of a window, and of the minimizer's grams.
WINDOW = 13
GRAM = 3
#: Bytes of text that a shard gets, roughly.
SHARD_BYTES = 6_000_000
#: Words that are cut at once; longer texts are cut in several goes.
PIECE_WORDS = 200_000
#: Longer words are told apart by their SHA-256 while they are searched.
LONG_WORD = 64
#: One of SAMPLE rows is looked at for hot minimizers, and at most HOT of them are split.
SAMPLE = 64
HOT = 4_096
_SEPARATOR = b"\n"  # never inside a word
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)

#: What goes to a shard: ``words`` of ``n`` fragments, compressed, with the lower half of their minimizers, and ``m`` occurrences;
#: or, without words, ``m`` numbers of intervals of ``n`` rows. ``meta`` holds columns of numbers, compressed.
_PACKED = "shard int, n int, m int, words binary, anchors binary, meta binary, docs binary, keys binary"
_SPANS = "doc_id bigint, row_key bigint, spans array<int>"


class Unit(NamedTuple):
    """Words of one row, from the word number ``first`` on."""

    doc_id: int
    key: int
    first: int
    words: list[bytes]


class _Hashes(dict):
    """Hashes of words, forgotten when there are too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 100_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word, 7)
        return value


class _Numbers(dict):
    """Words numbered as they come."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self)
        return value


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * _MIX
    return values ^ (values >> np.uint64(29))


def _run_hashes(hashes: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words from each place on."""
    found = np.zeros(len(at), dtype=np.uint64)
    for i in range(size):
        found = found * _FACTOR + hashes[at + i]
    return _mixed(found)


def _minima(values: np.ndarray, width: int) -> np.ndarray:
    """For every ``width`` values in a row the place of the smallest."""
    best, span = np.arange(len(values)), 1
    while span < width:
        apart = min(span, width - span)
        left, right = best[: len(best) - apart], best[apart:]
        best = np.where(values[right] < values[left], right, left)
        span += apart
    return best


class Fragments(NamedTuple):
    """Occurrences of fragments, in the order of the units."""

    contents: list[bytes]
    anchors: np.ndarray
    units: np.ndarray
    places: np.ndarray  # word number in the row
    windows: np.ndarray  # how many


def cut(units: list[Unit], hashes: _Hashes, hot: np.ndarray, window: int, gram: int) -> Fragments:
    """The fragments of all windows of the units. Those with a ``hot`` minimizer are cut into single windows."""
    words = [w for u in units for w in u.words]
    n = len(words)
    if n < window:
        none = np.zeros(0, np.int64)
        return Fragments([], np.zeros(0, np.uint64), none, none, none)
    sizes = np.fromiter(map(len, words), np.int64, n)
    if sizes.max() > LONG_WORD:
        words = [w if len(w) <= LONG_WORD else _SEPARATOR + hashlib.sha256(w).hexdigest().encode() for w in words]
        sizes = np.fromiter(map(len, words), np.int64, n)
    stops = np.cumsum(sizes + 1) - 1
    starts = stops - sizes
    data = b" ".join(words)
    codes = np.fromiter(map(hashes.__getitem__, words), np.uint64, n)
    counts = np.array([len(u.words) for u in units])
    unit = np.repeat(np.arange(len(units)), counts)
    begin = np.cumsum(counts) - counts
    grams = _run_hashes(codes, np.arange(n - gram + 1), gram)
    place = _minima(grams, window - gram + 1)
    whole = unit[: n - window + 1] == unit[window - 1 :]
    same = np.r_[False, whole[1:] & whole[:-1] & (place[1:] == place[:-1])]
    first = np.flatnonzero(whole & ~same)
    last = np.flatnonzero(whole & ~np.r_[same[1:], False])
    anchors = grams[place[first]]
    if len(hot) and len(split := np.flatnonzero(np.isin(anchors, hot))):
        runs = last[split] - first[split] + 1
        single = np.repeat(first[split] - np.cumsum(runs) + runs, runs) + np.arange(runs.sum())
        others = np.setdiff1d(np.arange(len(first)), split)
        anchors = np.concatenate([anchors[others], _mixed(_run_hashes(codes, single, window))])
        first, last = np.concatenate([first[others], single]), np.concatenate([last[others], single])
        order = np.argsort(first, kind="stable")
        first, last, anchors = first[order], last[order], anchors[order]
    contents = [
        data[a:b] for a, b in zip(starts[first].tolist(), stops[last + window - 1].tolist(), strict=True)
    ]
    owner = unit[first]
    base = np.array([u.first for u in units])
    return Fragments(contents, anchors, owner, first - begin[owner] + base[owner], last - first + 1)


def merged_spans(docs: np.ndarray, keys: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> pa.RecordBatch:
    """One row per (doc, key) with its intervals [start, stop, start, stop, ...], those that touch joined.
    Of two intervals of a row the one that starts later also stops later, or they are equal."""
    order = np.lexsort((starts, keys, docs))
    docs, keys, starts, stops = docs[order], keys[order], starts[order], stops[order]
    row = np.r_[True, (docs[1:] != docs[:-1]) | (keys[1:] != keys[:-1])][: len(docs)]
    opens = row | np.r_[True, starts[1:] > stops[:-1]][: len(docs)]
    flat = np.empty(2 * int(opens.sum()), dtype=np.int32)
    flat[::2] = starts[opens]
    flat[1::2] = stops[np.r_[opens[1:], True][: len(opens)]]
    first = np.flatnonzero(row)
    offsets = np.r_[2 * (np.cumsum(opens) - 1)[first], len(flat)].astype(np.int32)
    spans = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
    return pa.RecordBatch.from_arrays(
        [pa.array(docs[first], pa.int64()), pa.array(keys[first], pa.int64()), spans], ["doc_id", "row_key", "spans"]
    )


def _units(batches: Iterable[pa.RecordBatch], window: int) -> Iterator[list[Unit]]:
    """Lists of units of some PIECE_WORDS words. Pieces of one text overlap, so that each window is in one."""
    held, size = [], 0
    for batch in batches:
        for low in range(0, batch.num_rows, 64):
            rows = batch.slice(low, 64).to_pydict()
            for doc_id, key, text in zip(rows["doc_id"], rows["row_key"], rows["text"], strict=True):
                words = text.split()
                for first in range(0, max(0, len(words) - window + 1), PIECE_WORDS):
                    held.append(Unit(doc_id, key, first, words[first : first + PIECE_WORDS + window - 1]))
                    size += len(held[-1].words)
                    if size >= PIECE_WORDS:
                        yield held
                        held, size = [], 0
    if held:
        yield held


def _numbered(contents: list[bytes]) -> tuple[dict[bytes, int], np.ndarray]:
    known = _Numbers()
    return known, np.fromiter(map(known.__getitem__, contents), np.int64, len(contents))


def _squeezed(data: bytes) -> bytes:
    return pa.Codec("zstd", compression_level=3).compress(data, asbytes=True)


def _columns(*columns: np.ndarray) -> bytes:
    """Columns of numbers, each as differences, compressed."""
    return _squeezed(b"".join(np.diff(c, prepend=0).astype("<i4").tobytes() for c in columns))


def _uncolumns(data: bytes, *sizes: int) -> list[np.ndarray]:
    flat = np.frombuffer(pa.decompress(data, 4 * sum(sizes), codec="zstd", asbytes=True), "<i4")
    return [np.cumsum(part, dtype=np.int64) for part in np.split(flat, np.cumsum(sizes)[:-1])]


def _pack(units: list[Unit], found: Fragments, shards: int, turn: int, window: int) -> Iterator[tuple]:
    """Rows of ``_PACKED``: for each shard the distinct fragments with their occurrences in the row with the
    smallest id, and one row with the intervals that are known to be repeated."""
    known, code = _numbered(found.contents)
    ids, row_keys = (np.array(c, np.int64) for c in ([u.doc_id for u in units], [u.key for u in units]))
    doc = ids[found.units]
    least = np.full(len(known), np.iinfo(np.int64).max)
    np.minimum.at(least, code, doc)
    late = doc > least[code]
    if late.any():
        stop = found.places + found.windows + window - 1
        spans = merged_spans(doc[late], row_keys[found.units[late]], found.places[late], stop[late])
        flat, n = spans["spans"].values.to_numpy(), spans.num_rows
        meta = _columns(np.diff(spans["spans"].offsets.to_numpy()), flat)
        two = (spans[c].to_numpy().astype("<i8").tobytes() for c in ("doc_id", "row_key"))
        yield turn % shards, n, len(flat), None, None, meta, *two
    anchor = np.zeros(len(known), np.uint64)
    anchor[code] = found.anchors
    shard = (_mixed(anchor) % np.uint64(shards)).astype(np.int64)
    texts = list(known)
    by_shard = np.argsort(shard, kind="stable")
    bounds = np.searchsorted(shard[by_shard], np.arange(shards + 1))
    early = np.flatnonzero(~late)
    early = early[np.argsort(shard[code[early]], kind="stable")]
    edges = np.searchsorted(shard[code[early]], np.arange(shards + 1))
    inside = np.empty(len(known), np.int64)
    for i in range(shards):
        mine, own = by_shard[bounds[i] : bounds[i + 1]], early[edges[i] : edges[i + 1]]
        if not len(mine):
            continue
        inside[mine] = np.arange(len(mine))
        parts = [texts[j] for j in mine.tolist()]
        rows, unit = np.unique(found.units[own], return_inverse=True)
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        yield (
            i,
            len(mine),
            len(own),
            _squeezed(b"".join(parts)),
            anchor[mine].astype("<u4").tobytes(),
            _columns(sizes, inside[code[own]], unit, found.places[own]),
            ids[rows].astype("<i8").tobytes(),
            row_keys[rows].astype("<i8").tobytes(),
        )


_PACKED_TYPES = [*[pa.int32()] * 3, *[pa.binary()] * 5]


def repeated_windows(contents: list[bytes], owners: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """For distinct fragments, whose smallest document is ``owners``: the smallest document that has each of
    their windows, all in a row, and where each fragment's windows begin."""
    number, parts = _Numbers({_SEPARATOR: 0}), []
    for low in range(0, len(contents), 10_000):
        words = (b" " + _SEPARATOR + b" ").join([*contents[low : low + 10_000], b""]).split(b" ")[:-1]
        parts.append(np.fromiter(map(number.__getitem__, words), np.int64, len(words)))
    text = np.concatenate(parts)
    ends = np.flatnonzero(text == 0)
    lengths = np.diff(np.r_[-1, ends]) - 1
    index = FMIndex(text, len(number), window)
    begin = np.cumsum(lengths - window + 1) - (lengths - window + 1)
    least = np.full(int((lengths - window + 1).sum()), np.iinfo(np.int64).max)
    matches = list(matching_statistics(index, text, ends, lengths))
    if matches:
        which, place, low, high = (np.concatenate(c) for c in zip(*matches, strict=True))
        lows, nth, back = np.unique(low, return_index=True, return_inverse=True)
        owner = np.repeat(owners, lengths + 1)[index.order]
        bounds = np.stack([lows, high[nth]], axis=1).ravel()
        smallest = np.minimum.reduceat(np.r_[owner, np.iinfo(np.int64).max], bounds)[::2]
        least[begin[which] + place] = smallest[back]
    return least, begin


def _search(held: list[dict], window: int) -> pa.RecordBatch | None:
    """The intervals of one shard's rows that a smaller document has. Empties ``held``."""
    anchors = np.concatenate([np.frombuffer(r["anchors"], "<u4") for r in held])
    counts = [r["n"] for r in held]
    base = np.cumsum(counts) - counts
    sizes, which, docs, keys, places = [], [], [], [], []
    for r, b in zip(held, base.tolist(), strict=True):
        size, content, unit, place = _uncolumns(r["meta"], r["n"], r["m"], r["m"], r["m"])
        sizes.append(size)
        which.append(content + b)
        docs.append(np.frombuffer(r["docs"], "<i8")[unit])
        keys.append(np.frombuffer(r["keys"], "<i8")[unit])
        places.append(place)
    which, docs, keys, places = map(np.concatenate, (which, docs, keys, places))
    doc = np.empty(len(anchors), np.int64)
    doc[which] = docs
    # minimizers of one document alone repeat nothing
    _, group = np.unique(anchors, return_inverse=True)
    low, high = np.full(group.max() + 1, np.iinfo(np.int64).max), np.full(group.max() + 1, np.iinfo(np.int64).min)
    np.minimum.at(low, group, doc)
    np.maximum.at(high, group, doc)
    needed = (low < high)[group]
    contents = []
    for r, b, size in zip(held, base.tolist(), sizes, strict=True):
        mine = np.flatnonzero(needed[b : b + r["n"]])
        if len(mine):
            stops = np.cumsum(size)
            data = pa.decompress(r["words"], int(stops[-1]), codec="zstd", asbytes=True)
            pairs = zip((stops - size)[mine].tolist(), stops[mine].tolist(), strict=True)
            contents += [data[x:y] for x, y in pairs]
    if not contents:
        return None
    held.clear()
    known, code = _numbered(contents)
    contents = list(known)
    del known
    owners = np.full(len(contents), np.iinfo(np.int64).max)
    np.minimum.at(owners, code, doc[needed])
    distinct = np.full(len(anchors), -1)
    distinct[needed] = code
    least, begin = repeated_windows(contents, owners, window)
    counts = np.diff(np.r_[begin, len(least)])
    some = needed[which]
    fragment, docs, keys, places = distinct[which[some]], docs[some], keys[some], places[some]
    runs = counts[fragment]
    row = np.repeat(np.arange(len(fragment)), runs)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(runs) - runs, runs)
    hit = least[begin[fragment][row] + nth] < docs[row]
    row, start = row[hit], (places[row] + nth)[hit]
    if not len(row):
        return None
    return merged_spans(docs[row], keys[row], start, start + window)


def _prepared(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text")).withColumn(
        "row_key", F.xxhash64("text")
    )


def hot_minimizers(rows: DataFrame, shards: int, window: int, gram: int) -> np.ndarray:
    """Minimizers that hold more distinct fragments of the sample than a quarter of a shard should."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, none = _Hashes(), np.zeros(0, np.uint64)
        for units in _units(batches, window):
            found = cut(units, hashes, none, window, gram)
            known, code = _numbered(found.contents)
            anchor = np.zeros(len(known), np.uint64)
            anchor[code] = found.anchors
            values, n = np.unique(anchor, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(n)], ["anchor", "n"])

    sample = rows.where(F.pmod(F.xxhash64("text", "doc_id"), F.lit(SAMPLE)) == 0).withColumn(
        "text", F.col("text").cast("binary")
    )
    counts = sample.mapInArrow(count, "anchor bigint, n bigint").groupBy("anchor").agg(F.sum("n").alias("n"))
    total = counts.agg(F.sum("n")).first()[0] or 0
    limit = max(SAMPLE, total / shards / 4)
    found = counts.where(F.col("n") > limit).orderBy(F.desc("n"), "anchor").limit(HOT).collect()
    return np.array([r["anchor"] for r in found], np.int64).view(np.uint64)


def repeated_spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``doc_id``, ``row_key`` (the text's hash) and ``spans``, an array of word numbers [start, stop, ...]: the words
    covered by windows that also start in a document with a smaller id. A row may have several such
    arrays. Rows without an id take no part."""
    rows = _prepared(docs).where(F.col("doc_id").isNotNull())
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, math.ceil(total / shard_bytes))
    hot = hot_minimizers(rows, shards, window, gram) if shards > 1 else np.zeros(0, np.uint64)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for turn, units in enumerate(_units(batches, window)):
            found = cut(units, hashes, hot, window, gram)
            for row in _pack(units, found, shards, turn, window):
                columns = [pa.array([v], t) for v, t in zip(row, _PACKED_TYPES, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _PACKED.split(", ")])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if row["words"] is not None:
                    held.append(row)
                    continue
                sizes, flat = _uncolumns(row["meta"], row["n"], row["m"])
                offsets = pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32))
                spans = pa.ListArray.from_arrays(offsets, pa.array(flat.astype(np.int32)))
                ids = [pa.array(np.frombuffer(row[c], "<i8"), pa.int64()) for c in ("docs", "keys")]
                yield pa.RecordBatch.from_arrays([*ids, spans], ["doc_id", "row_key", "spans"])
        if held and (found := _search(held, window)) is not None:
            yield found

    sent = rows.withColumn("text", F.col("text").cast("binary")).mapInArrow(send, _PACKED)
    return sent.repartitionById(shards, "shard").mapInArrow(search, _SPANS)


_KEPT = "doc_id bigint, n_words bigint, n_removed bigint, kept binary"


def _squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low in range(0, batch.num_rows, 512):
            part = batch.slice(low, 512)
            texts = part["text"].to_pylist()
            packed = [pa.array([_squeezed(t) for t in texts], pa.binary()), pa.array(map(len, texts), pa.int32())]
            yield pa.RecordBatch.from_arrays([part["doc_id"], part["row_key"], *packed], ["doc_id", "row_key", "packed", "size"])


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low in range(0, batch.num_rows, 512):
            part, out = batch.slice(low, 512), []
            columns = (part[c].to_pylist() for c in ("packed", "size", "spans"))
            for packed, size, spans in zip(*columns, strict=True):
                words = pa.decompress(packed, size, codec="zstd", asbytes=True).split()
                kept = words
                if spans:
                    stays = np.ones(len(words), dtype=bool)
                    for start, stop in zip(spans[::2], spans[1::2], strict=True):
                        stays[start:stop] = False
                    kept = [words[i] for i in np.flatnonzero(stays).tolist()]
                out.append((len(words), len(words) - len(kept), b" ".join(kept)))
            n_words, n_removed, texts = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays(
                [part["doc_id"], pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(texts, pa.binary())],
                ["doc_id", "n_words", "n_removed", "kept"],
            )


def dedup_substrings(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_words``, ``n_removed`` and ``kept`` (UTF-8), the words that stay, joined
    by one space. A word goes if a window of ``window`` consecutive words covers it whose sequence also starts in
    a document with a smaller id; windows are judged on the input.

    Words are runs of other characters than space and the control characters 9 to 13. A null or empty text has none,
    a text of fewer words than a window keeps them all. A row without an id keeps all and takes nothing away;
    rows that share an id do not affect each other and are each answered, so repeated rows give equal answers. Other
    columns are not read. An empty table gives no rows.
    """
    # stored, so that what was sent to the shards is not needed any more when the texts are
    spans = store_table(repeated_spans(docs, window, gram, shard_bytes))
    spans = spans.groupBy("doc_id", "row_key").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    rows = _prepared(docs).withColumn("text", F.col("text").cast("binary"))
    packed = "doc_id bigint, row_key bigint, packed binary, size int"
    named = rows.where(F.col("doc_id").isNotNull()).mapInArrow(_squeeze, packed).join(spans, ["doc_id", "row_key"], "left")
    # apart from the join, which would bring all rows without an id to one task
    others = rows.where(F.col("doc_id").isNull()).mapInArrow(_squeeze, packed)
    others = others.withColumn("spans", F.lit(None).cast("array<int>"))
    wanted = ("doc_id", "packed", "size", "spans")
    return named.select(*wanted).unionByName(others.select(*wanted)).mapInArrow(_remove, _KEPT)
