"""Line dedup with sharded cuckoo filters behind exact reference counts.

The truth is a table of references: which line key occurs in which document. From it follows, exactly,
which keys are in enough documents to be dropped, and which document keeps them. Cuckoo filters, one
per shard of the key hash, hold the keys to be dropped. Every line is looked up there first; the
few that are found are joined with the exact table, so a false hit of a filter costs a row of that
join and never a line. Filters that are small together are sent to every task; larger ones meet the
lines of their shard in a shuffle, in pieces of a bounded number of lines.

The state can be kept: documents are added and taken out again by appending their references with
a plus or a minus. Only the keys of the change are counted again, and the filters follow by
inserting and deleting those that crossed the bound.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf

from ..plans.skew import store_table
from .cuckoo import CuckooFilter, FilterSet, as_digests, build, shard_of
from .names import free_name

MIN_CHARS = 40
MIN_DOCS = 5
#: Keys of a shard's filter, roughly.
KEYS_PER_SHARD = 100_000
#: Filters and exact tables are broadcast up to these sizes, which are counted before.
FILTER_BYTES = 64_000_000
BROADCAST_KEYS = 200_000
#: Lines that one task looks up in a shard's filter when the filters are too large to send.
LINES_PER_PIECE = 1_000_000
#: Pieces of references that are kept before they are summed up into one.
REF_PIECES = 8
_WHITE = b" \t\n\x0b\x0c\r"


def line_keys(text: str, min_chars: int) -> list[bytes | None]:
    """For each line the digest of its key, or None if the key is too short."""
    found: list[bytes | None] = []
    for line in text.encode().split(b"\n"):
        key = line.strip(_WHITE)
        if len(key) < min_chars or (len(key) < 4 * min_chars and len(key.decode()) < min_chars):
            found.append(None)
        else:
            found.append(xxhash.xxh3_128_digest(key.lower()))  # of bytes, so A-Z only
    return found


def references(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """The reference table: ``key``, ``doc_id`` and ``n``, the number of lines, of keys long enough."""

    @pandas_udf("array<binary>")
    def keys(texts: pd.Series) -> pd.Series:
        return pd.Series([[k for k in line_keys(t, min_chars) if k] for t in texts], dtype=object)

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lines = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.explode(keys(text)).alias("key"))
    return lines.groupBy("key", "doc_id").agg(F.count(F.lit(1)).alias("n"))


def frequent_keys(refs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``key``, ``n_docs`` and ``last``, the largest doc_id, of the keys in enough documents."""
    counts = refs.groupBy("key").agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("last"))
    return counts.where(F.col("n_docs") >= min_docs)


def shard_count(frequent: DataFrame) -> int:
    return max(1, math.ceil(frequent.count() / KEYS_PER_SHARD))


def _with_shard(keys: DataFrame, shards: int) -> DataFrame:
    @pandas_udf("int")
    def shard(key: pd.Series) -> pd.Series:
        return pd.Series(shard_of(as_digests(list(key)), shards))

    return keys.withColumn("shard", shard("key"))


def build_filters(frequent: DataFrame, shards: int) -> DataFrame:
    """``shard`` and ``filter``, its cuckoo filter as bytes. A shard's keys are few by the number
    of shards, and dealt by their hash."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        made = build(as_digests(list(rows["key"])))
        return pd.DataFrame({"shard": [key[0]], "filter": [made.to_bytes()]})

    keyed = _with_shard(frequent.select("key"), shards)
    return keyed.groupBy("shard").applyInPandas(run, "shard int, filter binary")


def update_filters(
    filters: DataFrame, before: DataFrame, after: DataFrame, frequent: DataFrame, shards: int
) -> DataFrame:
    """Filters that follow changed keys: ``before`` and ``after`` are the frequent ones among them, then
    and now. New keys are inserted, keys that are not frequent any more deleted. A filter without
    room is built anew from all keys of its shard in ``frequent``."""
    joined = before.select("key", F.lit(True).alias("was")).join(
        after.select("key", F.lit(True).alias("is")), "key", "full"
    )
    changes = _with_shard(joined, shards).select(
        "shard", "key", F.coalesce("was", F.lit(False)).alias("was"), F.coalesce("is", F.lit(False)).alias("is")
    )

    def run(key: tuple, held: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        def digests(which: pd.Series) -> np.ndarray:
            return as_digests(list(rows["key"][which]))

        now = CuckooFilter.from_bytes(held["filter"].iloc[0]) if len(held) else CuckooFilter.of_size(8)
        now.delete(digests(rows["was"] & ~rows["is"]))
        fits = now.insert(digests(~rows["was"] & rows["is"]))
        return pd.DataFrame({"shard": [key[0]], "filter": [now.to_bytes() if fits else None]})

    pairs = filters.groupBy("shard").cogroup(changes.groupBy("shard"))
    updated = store_table(pairs.applyInPandas(run, "shard int, filter binary"))
    full = updated.where(F.col("filter").isNull()).select("shard")
    if full.isEmpty():
        return updated
    keys = _with_shard(frequent.select("key"), shards).join(full, "shard", "left_semi")
    return store_table(updated.where(F.col("filter").isNotNull()).unionByName(build_filters(keys, shards)))


class LineState(NamedTuple):
    """Pieces of the references (``n`` is negative where documents were taken out), the keys that are
    frequent by them, and the filters of these keys."""

    pieces: tuple[DataFrame, ...]
    frequent: DataFrame
    filters: DataFrame
    shards: int
    min_docs: int
    stored: bool = False

    @property
    def refs(self) -> DataFrame:
        return _net(self.pieces)


def _net(pieces: tuple[DataFrame, ...]) -> DataFrame:
    """The references that are left of all pieces."""
    if len(pieces) == 1:
        return pieces[0]
    rows = reduce(DataFrame.unionByName, pieces)
    return rows.groupBy("key", "doc_id").agg(F.sum("n").alias("n")).where(F.col("n") > 0)


def line_state(refs: DataFrame, min_docs: int = MIN_DOCS) -> LineState:
    frequent = store_table(frequent_keys(refs, min_docs))
    shards = shard_count(frequent)
    return LineState((refs,), frequent, store_table(build_filters(frequent, shards)), shards, min_docs)


def _kept_state(state: LineState) -> LineState:
    return state if state.stored else state._replace(pieces=tuple(map(store_table, state.pieces)), stored=True)


def _follow(state: LineState, change: DataFrame) -> LineState:
    """The state after a change of references. What is written grows with the change and the keys that
    are frequent, not with the references; these are read for the keys of the change. After ``REF_PIECES``
    changes they are summed up, and when the keys have outgrown their shards the filters are dealt anew."""
    change = store_table(change)
    touched = change.select("key").distinct()
    pieces = (*state.pieces, change)
    before = state.frequent.join(touched, "key", "left_semi")
    after = store_table(
        frequent_keys(_net(tuple(p.join(touched, "key", "left_semi") for p in pieces)), state.min_docs)
    )
    frequent = store_table(state.frequent.join(touched, "key", "left_anti").unionByName(after))
    shards = state.shards
    if shard_count(frequent) > 2 * shards:
        shards = shard_count(frequent)
        filters = store_table(build_filters(frequent, shards))
    else:
        filters = update_filters(state.filters, before, after, frequent, shards)
    if len(pieces) > REF_PIECES:
        pieces = (store_table(_net(pieces)),)
    return LineState(pieces, frequent, filters, shards, state.min_docs, True)


def insert_documents(state: LineState, docs: DataFrame, min_chars: int = MIN_CHARS) -> LineState:
    """The state with more documents. Lines under an id that is there already are added to its document."""
    return _follow(_kept_state(state), references(docs, min_chars))


def delete_documents(state: LineState, doc_ids: DataFrame) -> LineState:
    """The state without the documents of ``doc_ids`` (column ``doc_id``), as if they had never come. Unknown
    ids change nothing, and a null id takes out the rows without one."""
    state = _kept_state(state)
    refs = state.refs
    gone = doc_ids.select(F.col("doc_id").cast("bigint").alias("gone")).distinct()
    lost = refs.join(gone, refs["doc_id"].eqNullSafe(gone["gone"]), "left_semi")
    return _follow(state, lost.select("key", "doc_id", (-F.col("n")).alias("n")))


def _in_filters(lines: DataFrame, state: LineState) -> DataFrame:
    """Rows (``doc``, ``key``) whose key the filter of its shard holds.

    Lines and filter of a shard meet in a shuffle. A shard with many lines, as that of a line that a
    third of all documents hold, is dealt to several tasks by document and key, and its filter is
    sent to each of them.
    """
    held = store_table(_with_shard(lines, state.shards))
    per_shard = held.groupBy("shard").agg(
        F.ceil(F.count(F.lit(1)) / LINES_PER_PIECE).cast("int").alias("pieces")
    )
    if state.shards <= BROADCAST_KEYS:
        per_shard = F.broadcast(per_shard)
    dealt = held.join(per_shard, "shard").select(
        "shard", F.pmod(F.xxhash64("doc", "key"), "pieces").cast("int").alias("piece"), "doc", "key"
    )
    filters = state.filters.join(per_shard, "shard").select(
        "shard", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece"), "filter"
    )

    def look(rows: pa.Table, own: pa.Table) -> pa.Table:
        rows = rows.select(["doc", "key"])
        if not own.num_rows or not rows.num_rows:
            return rows.slice(0, 0)
        made = CuckooFilter.from_bytes(own["filter"][0].as_py())
        return rows.filter(pa.array(made.contains(as_digests(rows["key"].to_pylist()))))

    at = ["shard", "piece"]
    return dealt.groupBy(*at).cogroup(filters.groupBy(*at)).applyInArrow(look, "doc bigint, key binary")


def _can_be_sent(filters: DataFrame) -> bool:
    return (filters.agg(F.sum(F.octet_length("filter"))).first()[0] or 0) <= FILTER_BYTES


def _hits(state: LineState, min_chars: int, send: bool) -> Column:
    """The keys of a text that the filters hold, or all its keys if the filters are not sent."""
    sent = None
    if send:
        parts = {r["shard"]: bytes(r["filter"]) for r in state.filters.collect()}
        sent = state.filters.sparkSession.sparkContext.broadcast(FilterSet(state.shards, parts))

    @pandas_udf("array<binary>")
    def hits(texts: pd.Series) -> pd.Series:
        out: list[list[bytes]] = []
        for text in texts:
            keys = list({k for k in line_keys(text, min_chars) if k})
            if keys and sent is not None:
                found = sent.value.contains(as_digests(keys))
                keys = [k for k, f in zip(keys, found, strict=True) if f]
            out.append(keys)
        return pd.Series(out, dtype=object)

    # marked so that a filter on the result does not run it a second time
    return hits.asNondeterministic()(F.coalesce(F.col("text").cast("string"), F.lit("")))


_KEPT = "struct<text: string, n_lines: bigint, n_dropped: bigint>"


def _without_lines(min_chars: int):
    @pandas_udf(_KEPT)
    def kept(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, drops in batches:
            rows = []
            for text, drop in zip(texts, drops, strict=True):
                lines = text.split("\n")
                gone = set() if drop is None else {bytes(d) for d in drop}
                if gone:
                    keys = line_keys(text, min_chars)
                    stay = [x for x, k in zip(lines, keys, strict=True) if k not in gone]
                else:
                    stay = lines
                rows.append((text if stay is lines else "\n".join(stay), len(lines), len(lines) - len(stay)))
            yield pd.DataFrame(rows, columns=["text", "n_lines", "n_dropped"])

    return kept


def drop_lines(docs: DataFrame, state: LineState, min_chars: int = MIN_CHARS, name: str = "kept") -> DataFrame:
    """All columns of ``docs`` and a struct ``name`` with its ``text`` after dropping, ``n_lines``
    before, and ``n_dropped``.

    Documents without a line in the filters, the most, stay where they are. The others meet the
    list of their dropped keys by a join on the id. Where the filters are too large to send, lines
    go to the filters, and all documents that have a key meet that list.
    """
    send = _can_be_sent(state.filters)
    mark, gone = free_name(docs, "hits"), free_name(docs, "drops")
    marked = docs.withColumn(mark, _hits(state, min_chars, send))
    touched = marked.where(F.size(mark) > 0)
    plain = marked.where(F.size(mark) == 0).drop(mark)

    found = touched.select(F.col("doc_id").cast("bigint").alias("doc"), F.explode(mark).alias("key"))
    if not send:
        found = _in_filters(found, state)
    exact = state.frequent.select("key", "last")
    if state.frequent.count() <= BROADCAST_KEYS:
        exact = F.broadcast(exact)
    losing = found.join(exact, "key").where(~F.col("doc").eqNullSafe(F.col("last")))
    drops = losing.groupBy(F.col("doc").alias(free_name(docs, "doc"))).agg(F.collect_set("key").alias(gone))

    on = touched["doc_id"].cast("bigint").eqNullSafe(drops[drops.columns[0]])
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    kept = touched.join(drops, on, "left").select(
        *docs.columns, _without_lines(min_chars)(text, F.col(gone)).alias(name)
    )
    whole = F.struct(
        text.alias("text"),
        (F.char_length(text) - F.char_length(F.replace(text, F.lit("\n"))) + 1).cast("bigint").alias("n_lines"),
        F.lit(0).cast("bigint").alias("n_dropped"),
    )
    return plain.select(*docs.columns, whole.alias(name)).unionByName(kept)


def dedup_lines(
    docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, name: str = "kept"
) -> DataFrame:
    """As ``drop_lines``, with the state made from ``docs`` itself.

    Keys of at least ``min_chars`` code points in at least ``min_docs`` documents lose all their lines but
    those of the largest doc_id. Rows that share an id are one document and are treated alike. Rows
    with a null id are together one document, never the largest. A null or empty text is one
    empty line. Extra columns are passed on, whatever their names; the caller gives a ``name`` that
    ``docs`` does not have (``free_name`` makes one). An empty table gives no rows.
    """
    return drop_lines(docs, line_state(references(docs, min_chars), min_docs), min_chars, name)
