"""Repair of the turn structure of conversations at the least cost, by an auction.

A conversation's rows and four states (nothing yet, after system, after user, after assistant) span a lattice. An
arc keeps, reroles or deletes the next row, or inserts a turn; its cost is a whole number. Every node has a
price, at first zero. A path starts at the source: where its last node's price is below the cost of
the best arc plus the price beyond it, the price rises to that and the path contracts by a node; else the path is
extended along the best arc. Prices never exceed the true distances, and when the path reaches the sink,
the source's price is the least cost. The arcs that the converged prices make tight are then traced,
the smallest letter first; an arc is taken if its end, once its own auction has converged, is still tight.

Conversations are cut into blocks of BLOCK rows. One block is the usual case. Where there are more, a block's costs
from each state to each state are found by the same auction, the prices at the borders are
propagated from the end backwards over these small tables, and every block is traced on its own from each
state. So a long conversation's lattice is spread over many tasks; its texts are read once, in order,
by the task that computes its digest, and never held together.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.skew import store_table

#: Rows of a block.
BLOCK = 64
#: Rows of a range of the sorted rows, roughly.
RANGE_ROWS = 200_000
#: Costs of the edits, and what a truncated row adds if it stays.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: White space, and the ends of a sentence.
SPACE = " \t\n\x0b\x0c\r"
ENDS = ".!?"

#: States: nothing yet, after system, after user, after assistant. A turn leads on where the pair is listed.
STATES = 4
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
TURN = {(0, 2): "user", (1, 2): "user", (2, 3): "assistant", (3, 2): "user"}
#: Where a conversation may end.
FINAL = (0, 3)
_FAR = 2**60


class Lattice:
    """One block: rows as (initial, must go, truncated), and the costs from each state behind it to the sink."""

    def __init__(self, rows: bytes, exits: tuple[int, ...], last: bool):
        """A byte of ``rows`` holds the role's initial (0 to 3: s, u, a, another), 4 if the row must go and 8 if it is
        truncated. Turns are inserted before a row, and at the end of the ``last`` block."""
        self.rows, self.exits, self.last = rows, exits, last
        self.sink = (len(rows) + (1 if last else 0)) * STATES
        # nodes from which the sink cannot be reached keep an endless price
        self.prices = [0] * self.sink
        alive = [e < _FAR for e in exits]
        for place in range(self.sink // STATES - 1, -1, -1):
            if place < len(rows):
                row = rows[place]
                if not row & 4:  # the row may stay
                    initial = "sua"[row & 3] if row & 3 < 3 else ""
                    kept = [NEXT.get((s, initial)) for s in range(STATES)]
                    alive = [
                        alive[s] or (kept[s] is not None and alive[kept[s]])
                        or any(alive[t] for f, t in TURN if f == s)
                        for s in range(STATES)
                    ]
            alive = self._inserted(alive)
            for s in range(STATES):
                if not alive[s]:
                    self.prices[place * STATES + s] = _FAR
        self.prices.append(0)
        self.known: dict[int, list[tuple[str, int, int]]] = {}

    @staticmethod
    def _inserted(alive: list[bool]) -> list[bool]:
        for _ in range(STATES):
            alive = [alive[s] or any(alive[t] for f, t in TURN if f == s) for s in range(STATES)]
        return alive

    def arcs(self, node: int) -> list[tuple[str, int, int]]:
        """Letter, cost and end of the arcs from a node, the smallest letter first."""
        if node in self.known:
            return self.known[node]
        place, state = divmod(node, STATES)
        found = [("I", INSERT, place * STATES + t) for f, t in TURN if f == state]
        if place == len(self.rows):
            found.append(("", self.exits[state], self.sink))
        else:
            row = self.rows[place]
            ahead = [(("D", DELETE, state))]
            if not row & 4:
                more = TRUNCATED if row & 8 else 0
                initial = "sua"[row & 3] if row & 3 < 3 else ""
                if (state, initial) in NEXT:
                    ahead.append(("K", KEEP + more, NEXT[state, initial]))
                ahead += [("R", REROLE + more, t) for f, t in TURN if f == state]
            for letter, cost, end in ahead:
                if place + 1 == len(self.rows) and not self.last:
                    found.append((letter, cost + self.exits[end], self.sink + 1 + end))
                else:
                    found.append((letter, cost, (place + 1) * STATES + end))
        self.known[node] = sorted(found)
        return self.known[node]

    def price(self, node: int) -> int:
        return self.prices[node] if node < self.sink else 0

    def converge(self, source: int) -> int:
        """The least cost from ``source`` to the sink, by path extension and contraction."""
        if self.price(source) >= _FAR:
            return _FAR
        path = [source]
        while path[-1] < self.sink:
            node = path[-1]
            cost, end = min((c + self.price(e), e) for _, c, e in self.arcs(node))
            if self.prices[node] < cost:
                self.prices[node] = cost
                if len(path) > 1:
                    path.pop()
            else:
                path.append(end)
        return self.price(source)

    def trace(self, state: int) -> tuple[str, int]:
        """The smallest letters among the cheapest edits from a state on, and the state behind the block."""
        node, letters = state, []
        self.converge(node)
        while node < self.sink:
            for letter, cost, end in self.arcs(node):
                if cost + self.price(end) == self.price(node):
                    if end >= self.sink or cost + self.converge(end) == self.price(node):
                        letters.append(letter)
                        node = end
                        break
        return "".join(letters), node - self.sink - 1 if not self.last else 0


@lru_cache(maxsize=50_000)
def cheapest(rows: bytes) -> tuple[int, str]:
    """Cost and letters of a conversation of one block."""
    exits = tuple(0 if s in FINAL else _FAR for s in range(STATES))
    lattice = Lattice(rows, exits, True)
    cost = lattice.converge(0)
    return cost, lattice.trace(0)[0]


def crossing(rows: bytes) -> list[list[int]]:
    """Costs of a block that is not the last one, from each state to each state."""
    found = [[_FAR] * STATES for _ in range(STATES)]
    for end in range(STATES):
        lattice = Lattice(rows, tuple(0 if s == end else _FAR for s in range(STATES)), False)
        for start in range(STATES):
            found[start][end] = lattice.converge(start)
    return found


# Rows with what the lattice needs


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``role``, ``text`` and ``copies`` (0: dropped) after the damage of the contract: by
    crc32(conv_id:turn) % 20, 0 drops a row, 1 empties its text, 2 removes its sentence ends, 3 repeats it and 4
    makes it the user's. Nulls are one space there."""

    def shown(column: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    text = F.when(kind.isin(0, 1), "").when(kind == 2, F.regexp_replace(shown("text"), "[.!?]", "")).otherwise(shown("text"))
    return conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.when(kind == 4, "user").otherwise(shown("role")).alias("role"),
        text.alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).cast("bigint").alias("copies"),
    )


def _faults(rows: DataFrame) -> DataFrame:
    """Distinct rows without their texts: ``digest`` of role and text, ``initial``, ``blank``, ``cut`` (truncated
    unless it goes), ``copies``."""
    seen = F.rtrim("text", F.lit(SPACE))
    slim = rows.where(F.col("copies") > 0).select(
        "conv_id", "turn", "copies",
        _digest().alias("digest"),
        F.left("role", F.lit(1)).alias("initial"),
        (F.length(seen) == 0).alias("blank"),
        (~F.right(seen, F.lit(1)).isin(*ENDS)).alias("cut"),
    )
    return slim.groupBy("conv_id", "turn", "digest", "initial", "blank", "cut").agg(F.sum("copies").alias("copies"))


def _digest() -> Column:
    return F.unhex(F.sha2(F.concat(F.length("role"), F.lit(":"), "role", "text").cast("binary"), 256))


def _blocks(rows: DataFrame) -> DataFrame:
    """Blocks of each conversation's rows in order: ``part`` and ``nth`` tell their place, ``rows`` has a byte per row."""
    faults = _faults(rows)
    # A row is seen earlier unless its turn is the first one (nulls first) with its role and text.
    place = F.struct(F.col("turn").isNotNull().alias("given"), "turn")
    first = faults.groupBy("conv_id", "digest").agg(F.min(place).alias("first"))
    first = first.select(F.col("conv_id").alias("c"), F.col("digest").alias("d"), "first")
    on = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("d"))
    again = ~F.col("first.turn").eqNullSafe(F.col("turn"))
    marked = faults.join(first, on).select("conv_id", "turn", "digest", "initial", "blank", "cut", "copies", again.alias("again"))
    count = marked.agg(F.count(F.lit(1))).first()[0]
    ordered = marked.repartitionByRange(max(1, -(-count // RANGE_ROWS)), "conv_id", "turn", "digest")
    ordered = ordered.sortWithinPartitions("conv_id", "turn", "digest").withColumn("part", F.spark_partition_id())
    return store_table(ordered.mapInArrow(_cut_blocks, _BLOCKS))


_BLOCKS = (
    "conv_id bigint, part int, nth bigint, rows binary, blank bigint, duplicate bigint, truncated bigint,"
    " illegal bigint, first string, last string, turns bigint, low bigint, high bigint"
)
_BLOCK_NAMES = [c.split()[0] for c in _BLOCKS.split(",")]
_PAIRS = ("su", "ua", "au")


class _Block:
    """Rows that are gathered until the block is full."""

    def __init__(self, conv_id: int | None, part: int, nth: int):
        self.head = conv_id, part, nth
        self.rows = bytearray()
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first = self.last = self.low = self.high = None

    def add(self, row: dict, again: bool) -> None:
        initial = row["initial"]
        gone = row["blank"] or again
        cut = row["cut"] and not gone
        self.rows.append(("sua".find(initial) if initial in ("s", "u", "a") else 3) | 4 * gone | 8 * cut)
        self.blank += row["blank"]
        self.duplicate += again and not row["blank"]
        self.truncated += cut
        if self.first is None:
            self.first = initial
        else:
            self.illegal += self.last + initial not in _PAIRS
        self.last = initial
        if row["turn"] is not None and row["turn"] != self.high:
            self.turns += 1
            self.low = row["turn"] if self.low is None else self.low
            self.high = row["turn"]

    def result(self) -> tuple:
        return (
            *self.head, bytes(self.rows), self.blank, self.duplicate, self.truncated, self.illegal,
            self.first, self.last, self.turns, self.low, self.high,
        )


def _cut_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    block, nth, out = None, 0, []
    for batch in batches:
        for row in batch.to_pylist():
            for copy in range(row["copies"]):
                if block is None or block.head[0] != row["conv_id"] or len(block.rows) == BLOCK:
                    if block is not None:
                        out.append(block.result())
                    block, nth = _Block(row["conv_id"], row["part"], nth), nth + 1
                    if len(out) == 1_000:
                        yield _batch(out, _BLOCK_NAMES, _BLOCK_TYPES)
                        out = []
                block.add(row, row["again"] or copy > 0)
    if block is not None:
        yield _batch([*out, block.result()], _BLOCK_NAMES, _BLOCK_TYPES)


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names)


_KINDS = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}


def _types(schema: str) -> list[pa.DataType]:
    return [_KINDS[c.split()[1]] for c in schema.split(",")]


_BLOCK_TYPES = _types(_BLOCKS)


# Long conversations: prices at the borders, then states at the borders


def _scan(items: DataFrame, fold: Callable, join: Callable, start: object, backwards: bool) -> DataFrame:
    """For each (conv_id, nth): ``value``, what the items behind it (or before it) come to. ``items`` has ``item``, a
    list of numbers; ``join`` makes one item of two neighbours, and ``fold`` takes an item to a value.

    Groups of GROUP items are joined first, and the values at their borders come from the same scan of the
    joined ones, so a task handles GROUP items whatever the length of a conversation."""
    size = F.col("nth") / F.lit(GROUP)
    grouped = items.withColumn("group", F.floor(size))
    if (items.agg(F.max("nth")).first()[0] or 0) < GROUP:
        borders = grouped.select("conv_id", "group").distinct().withColumn("value", F.array(*[F.lit(v) for v in start]))
    else:
        rows = grouped.groupBy("conv_id", "group").agg(F.sort_array(F.collect_list(F.struct("nth", "item"))).alias("items"))

        @F.udf("array<bigint>")
        def joined(parts):
            total = parts[0]["item"]
            for part in parts[1:]:
                total = join(total, part["item"])
            return total

        upper = store_table(rows.select("conv_id", F.col("group").alias("nth"), joined("items").alias("item")))
        borders = _scan(upper, fold, join, start, backwards).withColumnRenamed("nth", "group")
    rows = grouped.groupBy("conv_id", "group").agg(F.sort_array(F.collect_list(F.struct("nth", "item"))).alias("items"))
    borders = borders.withColumnsRenamed({"conv_id": "c", "group": "g"})
    both = rows.join(borders, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("group") == F.col("g")))

    @F.udf("array<struct<nth:bigint,value:array<bigint>>>")
    def values(parts, value):
        out = []
        for part in reversed(parts) if backwards else parts:
            out.append((part["nth"], value))
            value = fold(part["item"], value)
        return out

    listed = both.select("conv_id", F.explode(values("items", "value")).alias("v"))
    return listed.select("conv_id", "v.nth", "v.value")


GROUP = 256


def _plus(a: list[int], b: list[int]) -> list[int]:
    """Costs through two neighbouring blocks."""
    n = STATES
    return [min(min(a[i * n + k] + b[k * n + j] for k in range(n)), _FAR) for i in range(n) for j in range(n)]


def _price_before(item: list[int], value: list[int]) -> list[int]:
    n = STATES
    return [min(min(item[i * n + k] + value[k] for k in range(n)), _FAR) for i in range(n)]


def _after(a: list[int], b: list[int]) -> list[int]:
    return [b[s] for s in a]


def _state_after(item: list[int], value: list[int]) -> list[int]:
    return [item[value[0]]]


def _long_letters(blocks: DataFrame) -> DataFrame:
    """``conv_id``, ``nth``, ``letters`` and ``cost`` (of the whole conversation) of the numbered blocks."""
    last = F.col("nth") == F.col("blocks") - 1

    @F.udf("array<bigint>")
    def table(rows, is_last):
        if is_last:
            exits = tuple(0 if s in FINAL else _FAR for s in range(STATES))
            lattice = Lattice(bytes(rows), exits, True)
            return [c for s in range(STATES) for c in (*[_FAR] * 3, lattice.converge(s))]
        return [c for line in crossing(bytes(rows)) for c in line]

    items = store_table(blocks.select("conv_id", "nth", table("rows", last).alias("item")))
    # Behind the last block only the column of the end counts.
    prices = _scan(items, _price_before, _plus, [_FAR, _FAR, _FAR, 0], True).withColumnsRenamed({"conv_id": "c", "nth": "n"})
    on = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("nth") == F.col("n"))

    @F.udf("struct<states:array<bigint>,letters:array<string>,cost:bigint>")
    def traces(rows, is_last, exits):
        exits = tuple(0 if s in FINAL else _FAR for s in range(STATES)) if is_last else tuple(exits)
        lattice = Lattice(bytes(rows), exits, is_last)
        states, letters = [], []
        for s in range(STATES):
            text, state = lattice.trace(s) if lattice.converge(s) < _FAR else ("", s)
            states.append(state)
            letters.append(text)
        return states, letters, lattice.converge(0)

    traced = store_table(
        blocks.join(prices, on).select("conv_id", "nth", traces("rows", last, "value").alias("t")).select("conv_id", "nth", "t.*")
    )
    states = traced.select("conv_id", "nth", F.col("states").alias("item"))
    begun = _scan(states, _state_after, _after, [0], False).withColumnsRenamed({"conv_id": "c", "nth": "n"})
    letters = F.element_at("letters", (F.col("value")[0] + 1).cast("int"))
    return traced.join(begun, on).select("conv_id", "nth", letters.alias("letters"), F.when(F.col("nth") == 0, F.col("cost")).alias("cost"))


def _solved(blocks: DataFrame) -> DataFrame:
    """Blocks with ``letters`` and, in a conversation's first one, its ``cost``."""
    sizes = blocks.groupBy("conv_id").agg(F.count(F.lit(1)).alias("blocks"))
    sizes = sizes.withColumnRenamed("conv_id", "c")
    sized = blocks.join(sizes, F.col("conv_id").eqNullSafe(F.col("c"))).drop("c")

    @F.udf("struct<cost:bigint,letters:string>", useArrow=True)
    def alone(rows):
        return cheapest(bytes(rows))

    short = sized.where("blocks = 1").withColumn("s", alone("rows"))
    short = short.select(*_BLOCK_NAMES, "s.letters", "s.cost")
    long = sized.where("blocks > 1")
    if long.isEmpty():
        return short
    long = store_table(_numbered(long))
    found = _long_letters(long).withColumnsRenamed({"conv_id": "c", "nth": "n"})
    on = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("nth") == F.col("n"))
    return short.unionByName(long.join(found, on).select(*_BLOCK_NAMES, "letters", "cost"))


def _numbered(blocks: DataFrame) -> DataFrame:
    """Blocks with ``nth`` counted from 0 in their conversation. Within a part it runs on already, so only the
    parts are summed up."""
    parts = blocks.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"), F.min("nth").alias("from"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        F.col("conv_id").alias("c"), F.col("part").alias("p"), "from",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"),
    )
    on = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p"))
    moved = (F.col("nth") - F.col("from") + F.col("before")).alias("nth")
    return blocks.join(parts, on).select(*[moved if c == "nth" else c for c in blocks.columns])


# The repaired texts, in order


_REPAIRED = (
    "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint,"
    " audit string, repaired_sha256 string"
)


class _Conversation:
    """Reads a conversation's blocks and then its rows, and writes the repaired turns."""

    def __init__(self, conv_id: int | None):
        self.conv_id = conv_id
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = self.cost = 0
        self.last = self.low = self.high = None
        self.letters: list[str] = []
        self.audit = ""
        self.at = self.state = 0
        self.sha, self.empty = hashlib.sha256(), True

    def block(self, row: dict) -> None:
        for name in ("blank", "duplicate", "truncated", "illegal", "turns"):
            setattr(self, name, getattr(self, name) + row[name])
        self.cost += row["cost"] or 0
        if self.last is not None:
            self.illegal += self.last + row["first"] not in _PAIRS
        self.last = row["last"]
        if row["low"] is not None:
            self.turns -= row["low"] == self.high
            self.low = row["low"] if self.low is None else self.low
            self.high = row["high"]
        self.letters.append(row["letters"])

    def row(self, row: dict) -> None:
        if not self.audit:
            self.audit = "".join(self.letters)
        for _ in range(row["copies"]):
            self.insert()
            letter = self.audit[self.at]
            self.at += 1
            if letter == "K":
                self.write(row["role"], row["text"], NEXT[self.state, row["role"][:1]])
            elif letter == "R":
                state = 3 if self.state == 2 else 2
                self.write(TURN[self.state, state], row["text"], state)

    def insert(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            state = 3 if self.state == 2 else 2
            self.write(TURN[self.state, state], "", state)

    def write(self, role: str, text: str, state: int) -> None:
        self.sha.update(f"{'' if self.empty else chr(10)}{role}:{text}".encode())
        self.empty, self.state = False, state

    def result(self) -> tuple:
        self.insert()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (
            self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost,
            self.audit, self.sha.hexdigest(),
        )


def _write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names, types = [c.split()[0] for c in _REPAIRED.split(",")], _types(_REPAIRED)
    current, out = None, []
    for batch in batches:
        for low in range(0, batch.num_rows, 256):
            for row in batch.slice(low, 256).to_pylist():
                if current is None or current.conv_id != row["conv_id"]:
                    if current is not None:
                        out.append(current.result())
                    current = _Conversation(row["conv_id"])
                    if len(out) == 1_000:
                        yield _batch(out, names, types)
                        out = []
                if row["rows"] is not None:
                    current.block(row)
                else:
                    current.row(row)
    if current is not None:
        yield _batch([*out, current.result()], names, types)


def repair(rows: DataFrame) -> DataFrame:
    """One row per ``conv_id`` of ``rows`` (``conv_id``, ``turn``, ``role``, ``text``, ``copies``): the faults found, the cost and
    the letters of the cheapest edits, and the SHA-256 of the repaired turns.

    Rows of a conversation are in the order of their turns, nulls first; rows of one turn in that of the SHA-256
    of role and text, which only decides where the input does not. ``copies`` is how often a row stands there; 0 only
    names its conversation. Rows without a conv_id are one conversation. An empty role, or one that begins with
    another letter, fits nowhere and is reroled or deleted. An empty table gives no rows.
    """
    solved = _solved(_blocks(rows))
    none = {c: F.lit(None) for c in ("turn", "digest", "role", "text", "copies")}
    kinds = {"turn": "bigint", "digest": "binary", "role": "string", "text": "string", "copies": "bigint"}
    heads = solved.withColumns({c: none[c].cast(kinds[c]) for c in none})
    texts = rows.withColumn("digest", _digest())
    both = heads.unionByName(texts, allowMissingColumns=True)
    both = both.repartition("conv_id")
    # a conversation's blocks come first, as only they have rows
    order = [F.col("conv_id"), F.col("rows").isNull(), F.col("part"), F.col("nth"), F.col("turn"), F.col("digest")]
    return both.sortWithinPartitions(*order).mapInArrow(_write, _REPAIRED)
