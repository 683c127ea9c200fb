"""What a stream's triggers have published, and the keyed state between them.

A trigger writes its tables and its state to folders of its own attempt. Nothing of it counts until one
small file, the trigger's *manifest*, is put in place at the end: it names the attempt, the pieces of state that
hold from now on, and the counters. Readers follow the manifests (``published``), so they see all tables of
a trigger or none. A replayed trigger that has a manifest is skipped; one that has none starts again from the
manifest before it, whatever an earlier attempt has left behind.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

#: Slots that a keyed state is hashed into. More of them suit larger states.
SLOTS = 32
_SLOT = "slot"
_BITS = 62


def _place(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def _read_text(spark: SparkSession, path: str) -> str | None:
    files, where = _place(spark, path)
    if not files.exists(where):
        return None
    stream = files.open(where)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _write_once(spark: SparkSession, path: str, name: str, text: str) -> None:
    """Write a file whole or not at all; hidden until then."""
    files, hidden = _place(spark, f"{path}/.{name}-{uuid.uuid4().hex}")
    stream = files.create(hidden, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    _, final = _place(spark, f"{path}/{name}")
    if files.exists(final) or not files.rename(hidden, final):
        raise RuntimeError(f"{path}/{name} was published by another run")


def _delete(spark: SparkSession, path: str) -> None:
    files, where = _place(spark, path)
    files.delete(where, True)


def _folders(spark: SparkSession, path: str) -> list[str]:
    files, where = _place(spark, path)
    return [s.getPath().getName() for s in files.listStatus(where) if s.isDirectory()] if files.exists(where) else []


class Turn:
    """One attempt at one trigger."""

    def __init__(self, spark: SparkSession, folder: str, n: int, before: dict):
        self.spark, self.folder, self.n, self.before = spark, folder, n, before
        self.attempt = f"a-{uuid.uuid4().hex[:12]}"
        self.pieces = {name: dict(slots) for name, slots in before.get("pieces", {}).items()}
        #: What stages hand on to the next trigger, as small JSON values.
        self.values: dict = dict(before.get("values", {}))
        #: Counts of this trigger.
        self.counts: dict[str, int] = {}

    @property
    def token(self) -> str:
        return f"{self.n}/{self.attempt}"

    def write(self, table: str, rows: DataFrame, **counts: Column) -> DataFrame:
        """Write ``rows`` as this trigger's part of a table and read them back. ``counts`` are aggregates
        that are taken on the way, in the writing tasks themselves, so that a lost one is not counted twice."""
        path = f"{self.folder}/{table}/batch_id={self.n}/attempt={self.attempt}"
        seen = Observation() if counts else None
        watched = rows.observe(seen, *[c.alias(n) for n, c in counts.items()]) if counts else rows
        watched.write.parquet(path)
        if seen is not None:
            self.counts |= {n: seen.get[n] or 0 for n in counts}
        return self.spark.read.schema(rows.schema).parquet(path)

    def publish(self) -> None:
        def tokens(pieces: dict) -> set[tuple[str, str]]:
            return {(name, t) for name, slots in pieces.items() for ts in slots.values() for t in ts}

        old = tokens(self.before.get("pieces", {}))
        stale = sorted(old - tokens(self.pieces))
        manifest = {
            "n": self.n, "attempt": self.attempt, "counts": self.counts,
            "values": self.values, "pieces": self.pieces, "stale": stale,
        }
        _write_once(self.spark, f"{self.folder}/commits", f"{self.n:012d}.json", json.dumps(manifest))
        # what the manifest before this one no longer needed can go, as no replay reads it any more
        for name, token in self.before.get("stale", []):
            _delete(self.spark, KeyedState.piece(self.folder, name, token))


def manifest(spark: SparkSession, folder: str, n: int) -> dict | None:
    text = _read_text(spark, f"{folder}/commits/{n:012d}.json")
    return None if text is None else json.loads(text)


def begin(spark: SparkSession, folder: str, n: int) -> Turn | None:
    """A new attempt at trigger ``n``; None if it was published already."""
    if manifest(spark, folder, n) is not None:
        return None
    before = {} if n == 0 else manifest(spark, folder, n - 1)
    if before is None:
        raise RuntimeError(f"trigger {n - 1} of {folder} was never published")
    return Turn(spark, folder, n, before)


def commits(spark: SparkSession, folder: str, counts: Iterable[str] = (), values: str = "") -> DataFrame:
    """``batch_id`` and ``attempt`` of the published triggers, with some of their counts and ``values`` (their schema)."""
    fields = ", ".join(f"{c}: bigint" for c in counts)
    schema = f"n bigint, attempt string, counts struct<{fields}>, values struct<{values}>"
    if not fields:
        schema = schema.replace("counts struct<>, ", "")
    if not values:
        schema = schema.replace(", values struct<>", "")
    rows = spark.read.schema(schema).json(f"{folder}/commits")
    extra = [*(["counts.*"] if counts else []), *(["values.*"] if values else [])]
    return rows.select(F.col("n").cast("int").alias("batch_id"), "attempt", *extra)


def published(spark: SparkSession, folder: str, table: str, schema: T.StructType | None = None) -> DataFrame:
    """A table's rows of all published triggers, with their ``batch_id``."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    rows = reader.parquet(f"{folder}/{table}")
    return rows.join(commits(spark, folder), ["batch_id", "attempt"], "left_semi").drop("attempt")


class KeyedState:
    """Rows that later triggers need, hashed into slots by their key.

    A trigger reads the slots that its own keys are in and adds what changed as one more piece of them. A slot
    of EVERY pieces is written anew as one, without what is no longer needed. So what is read and written
    follows the trigger's keys and not the state."""

    EVERY = 8

    def __init__(self, name: str, schema: str, slots: int = SLOTS):
        self.name, self.schema, self.slots = name, schema, slots

    @staticmethod
    def piece(folder: str, name: str, token: str) -> str:
        n, attempt = token.split("/")
        return f"{folder}/state/{name}/batch_id={n}/attempt={attempt}"

    def slot(self, *keys: str) -> Column:
        return F.pmod(F.xxhash64(*keys), F.lit(self.slots)).cast("int")

    def touched(self, rows: DataFrame, slot: Column) -> list[int]:
        """The slots of the rows, as a bit map."""
        bit = F.expr(f"shiftleft(1L, {_SLOT} % {_BITS})")
        words = [F.bit_or(F.when(F.floor(F.col(_SLOT) / _BITS) == w, bit)) for w in range(-(-self.slots // _BITS))]
        found = rows.select(slot.alias(_SLOT)).agg(*words).first()
        return [s for s in range(self.slots) if (found[s // _BITS] or 0) >> (s % _BITS) & 1]

    def _tokens(self, turn: Turn, slots: Iterable[int]) -> dict[int, list[str]]:
        held = turn.pieces.get(self.name, {})
        return {s: held[str(s)] for s in slots if held.get(str(s))}

    def read(self, turn: Turn, slots: Iterable[int]) -> DataFrame | None:
        """The rows of some slots, with ``__n``, the trigger that wrote them; None if there are none."""
        tokens = self._tokens(turn, slots)
        if not tokens:
            return None
        pairs = [f"{t.split('/')[0]}/{s}" for s, ts in tokens.items() for t in ts]
        folders = sorted({self.piece(turn.folder, self.name, t) for ts in tokens.values() for t in ts})
        base = f"{turn.folder}/state/{self.name}"
        rows = turn.spark.read.schema(self.schema).option("basePath", base).parquet(*folders)
        rows = rows.where(F.concat_ws("/", "batch_id", _SLOT).isin(pairs))
        return rows.withColumn("__n", F.col("batch_id").cast("bigint")).drop("batch_id", "attempt", _SLOT)

    def full(self, turn: Turn, slots: Iterable[int]) -> list[int]:
        """Those slots that are to be written anew."""
        return [s for s, ts in self._tokens(turn, slots).items() if len(ts) >= self.EVERY]

    def put(self, turn: Turn, rows: DataFrame, slot: Column, whole: Iterable[int] = ()) -> None:
        """Add ``rows`` to their slots; those in ``whole`` hold nothing else from now on."""
        path = self.piece(turn.folder, self.name, turn.token)
        names = [c.split()[0] for c in self.schema.split(", ")]
        # partitions follow the slots, a large slot is split and small ones are put together
        dealt = rows.select(*names, slot.alias(_SLOT)).hint("rebalance", _SLOT)
        dealt.write.partitionBy(_SLOT).parquet(path)
        written = [f.split("=")[1] for f in _folders(turn.spark, path) if f.startswith(f"{_SLOT}=")]
        held = turn.pieces.setdefault(self.name, {})
        for s in whole:
            held.pop(str(s), None)
        for s in written:
            held[s] = [*held.get(s, []), turn.token]

    def merge(self, turn: Turn, rows: DataFrame, slot: Column, slots: list[int], kept: Callable[[DataFrame], DataFrame]) -> None:
        """Add ``rows``, whose slots are among ``slots``. Slots that are full are written anew with what ``kept``
        leaves of all their rows (which have ``__n``)."""
        full = self.full(turn, slots)
        if full:
            rows = rows.withColumn("__n", F.lit(turn.n).cast("bigint"))
            both = self.read(turn, full).unionByName(rows.where(slot.isin(full)))
            rows = rows.where(~slot.isin(full)).drop("__n").unionByName(kept(both).drop("__n"))
        self.put(turn, rows, slot, full)


Step = Callable[[DataFrame, Turn], object]


def run_by_trigger(
    rows: DataFrame, folder: str, step: Step, trigger: dict | None = None, name: str | None = None
) -> StreamingQuery:
    """Start a query that calls ``step`` with the rows and the turn of each trigger and then publishes it."""

    def run(batch: DataFrame, n: int) -> None:
        turn = begin(batch.sparkSession, folder, n)
        if turn is not None:
            step(batch, turn)
            turn.publish()

    writer = rows.writeStream.foreachBatch(run)
    writer = writer.option("checkpointLocation", f"{folder}/checkpoints/{name or 'stream'}")
    if name:
        writer = writer.queryName(name)
    return (writer.trigger(**trigger) if trigger else writer).start()
