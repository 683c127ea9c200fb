"""Stream stages that take one trigger's rows and run the batch operators on them.

What a stage must remember is kept in slots of shared storage (``ledger.KeyedState``), and a trigger reads the slots of
its own keys. No row is dropped for being late: it is deduplicated and scored in the order of arrival, and
only its window can be closed already, which is told.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import ClockConfig, DedupConfig, DetectConfig, SkewConfig, WindowConfig
from ..operators import detect
from ..operators.dedup import ID
from ..operators.dedup import dedup_ttl as dedup_batch
from ..operators.windows import (
    anchored_windows,
    assign_windows,
    assigned_stats,
    closed_windows,
    series_anchor,
)
from ..plans.skew import by_shuffle
from ..plans.trailing import with_running_moments
from ..schema import KEYS, ORDER
from .ledger import SLOTS, KeyedState, Turn

_AGE = "__age"
#: Stands for the time of accepted rows without one.
_NEVER = -(2**62)
_SERIES = "sensor_id string, metric_name string"


class Clock:
    """How far event time has come: the least, over the source's partitions, of their newest times.

    Three things keep one wrong clock from moving it. A time that is more than ``ahead_seconds`` after its own receipt
    (``received_at``, else the present) does not count. Neither do times beyond a gap of ``ahead_seconds`` in a trigger's
    times, unless more than half of its rows are there; a stream that goes on after a long pause is followed.
    And a partition that has brought nothing for ``idle_seconds`` of receive time is left out. The clock never goes back.
    Without a ``partition`` column all rows are one partition.
    """

    def __init__(self, cfg: ClockConfig = ClockConfig()):
        self.cfg = cfg

    def step(self, rows: DataFrame, turn: Turn) -> tuple[int | None, int | None]:
        """The time before this trigger and after it, in microseconds; None while there was no row."""
        known = turn.values.get("clock", {"low": None, "parts": {}})
        before, parts = known["low"], dict(known["parts"])
        now = time.time_ns() // 1000
        ahead = self.cfg.ahead_seconds * 1_000_000
        has = set(rows.columns)
        heard = F.unix_micros("received_at") if "received_at" in has else F.lit(now)
        part = F.coalesce(F.col("partition").cast("string"), F.lit("")) if "partition" in has else F.lit("")
        times = rows.select(part.alias("part"), F.unix_micros("timestamp").alias("t"), heard.alias("heard"))
        times = times.where(F.col("t") <= F.least("heard", F.lit(now)) + F.lit(ahead))
        stretch = F.floor(F.col("t") / F.lit(ahead)).alias("stretch")
        # one row per partition and stretch of time; from here on the rows are few
        few = times.groupBy("part", stretch).agg(
            F.count(F.lit(1)).alias("n"), F.max("t").alias("t"), F.max("heard").alias("heard")
        )
        falling = Window.orderBy(F.desc("stretch"))
        upper = falling.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        whole = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        gaps = few.groupBy("stretch").agg(F.sum("n").alias("n")).select(
            "stretch",
            (F.col("stretch") - F.lead("stretch").over(falling) > 1).alias("gap"),
            (F.sum("n").over(upper) * 2 <= F.sum("n").over(whole)).alias("few"),
        )
        limit = gaps.where("gap AND few").agg(F.min("stretch").alias("limit"))
        newest = few.crossJoin(F.broadcast(limit)).where("limit IS NULL OR stretch < limit")  # a single row
        for row in newest.groupBy("part").agg(F.max("t").alias("t"), F.max("heard").alias("heard")).collect():
            old = parts.get(row["part"], [row["t"], row["heard"]])
            parts[row["part"]] = [max(old[0], row["t"]), max(old[1], row["heard"])]
        after = before
        if parts:
            latest = max(h for _, h in parts.values())
            active = [t for t, h in parts.values() if latest - h <= self.cfg.idle_seconds * 1_000_000]
            low = min(active) - self.cfg.delay_seconds * 1_000_000
            after = low if before is None else max(before, low)
        turn.values["clock"] = {"low": after, "parts": parts}
        return before, after


class DedupStage:
    """Time-to-live deduplication by the set of accepted times of each id.

    In the order of arrival (trigger, time, ``tie_break``) a row is a duplicate if an accepted row of its id lies within the
    time-to-live of it, before or after; so of two copies close to each other the one that arrived first
    counts, and a late row that is far from all accepted ones is accepted. Rows that arrive in the order of time get
    the flags of the batch operator. Accepted times are kept until they are ``keep_seconds`` more than the time-to-live
    behind the clock.

    The accepted times of an id are more than a time-to-live apart, so a stretch of that width holds one at most, and a row
    is compared with three stretches, however often its id has come.
    """

    def __init__(
        self,
        cfg: DedupConfig = DedupConfig(),
        tie_break: list[str] | None = None,
        skew: SkewConfig = SkewConfig(),
        keep_seconds: int | None = None,
        clock: Clock | None = None,
        slots: int = SLOTS,
    ):
        self.state = KeyedState("ids", f"{ID} string, at bigint", slots)
        self.cfg, self.ties, self.skew, self.clock = cfg, tie_break, skew, clock
        self.keep = cfg.ttl_us + (cfg.ttl_seconds if keep_seconds is None else keep_seconds) * 1_000_000

    def step(self, rows: DataFrame, turn: Turn) -> DataFrame:
        """``rows`` with ``is_duplicate``, stored as ``flagged``."""
        if self.clock is not None:
            self.clock.step(rows, turn)
        slot = self.state.slot(ID)
        slots = self.state.touched(rows, slot)
        seen = self.state.read(turn, slots)
        columns = rows.columns
        if seen is None:
            flagged = dedup_batch(rows, self.cfg, self.ties, self.skew)
        else:
            known = self._near(rows, seen)
            old = known.where("__near").select(*columns, F.lit(True).alias("is_duplicate"))
            fresh = known.where("NOT __near").select(*columns)
            flagged = old.unionByName(dedup_batch(fresh, self.cfg, self.ties, self.skew))
        flagged = turn.write(
            "flagged", flagged,
            dupes=F.count_if("is_duplicate"), processed=F.count_if(~F.col("is_duplicate")),
        )
        accepted = flagged.where("NOT is_duplicate").select(ID, self._at().alias("at"))
        self.state.merge(turn, accepted, slot, slots, lambda every: self._live(every, turn))
        return flagged

    @staticmethod
    def _at() -> Column:
        return F.coalesce(F.unix_micros("timestamp"), F.lit(_NEVER))

    def _stretch(self, at: Column) -> Column:
        return F.floor(at / F.lit(self.cfg.ttl_us)).cast("bigint")

    def _near(self, rows: DataFrame, seen: DataFrame) -> DataFrame:
        """``rows`` with ``__near``: an accepted time of the id is within the time-to-live."""
        around = F.array(*[self._stretch(F.col("at")) + i for i in (-1, 0, 1)])
        sides = seen.select(F.col(ID).alias("__id"), "at", F.explode(around).alias("__stretch"))
        sides = sides.groupBy("__id", "__stretch").agg(F.collect_list("at").alias("__ats"))  # three at most
        placed = rows.withColumn("__at", self._at())
        on = F.col(ID).eqNullSafe(F.col("__id")) & (self._stretch(F.col("__at")) == F.col("__stretch"))
        near = F.exists("__ats", lambda a: F.abs(a - F.col("__at")) <= F.lit(self.cfg.ttl_us))
        return placed.join(by_shuffle(sides), on, "left").select(*rows.columns, F.coalesce(near, F.lit(False)).alias("__near"))

    def _live(self, rows: DataFrame, turn: Turn) -> DataFrame:
        low = turn.values.get("clock", {}).get("low")
        return rows if low is None else rows.where((F.col("at") >= low - self.keep) | (F.col("at") == _NEVER))


class ScoreStage:
    """Baseline and z of each row against the rows of its series that arrived before."""

    def __init__(
        self, name: str, depth: int, value: str, score, order: list[str], skew: SkewConfig, slots: int = SLOTS
    ):
        # ``fresh``: the series came for the first time
        self.state = KeyedState(name, f"{_SERIES}, tail array<double>, fresh boolean", slots)
        self.depth, self.value, self.score, self.order, self.skew = depth, value, score, order, skew

    @classmethod
    def of_readings(cls, cfg=DetectConfig(), order=None, skew=SkewConfig()) -> ScoreStage:
        def score(rows, arrival):
            return detect.score_records(rows, cfg, arrival, skew)

        return cls("readings", cfg.baseline_rows, "value", score, order or ORDER, skew)

    @classmethod
    def of_windows(cls, cfg=DetectConfig(), skew=SkewConfig()) -> ScoreStage:
        def score(rows, arrival):
            return detect.score_windows(rows, cfg, skew, arrival)

        return cls("means", cfg.baseline_windows, "mean", score, ["window_start"], skew)

    def step(self, rows: DataFrame, turn: Turn) -> DataFrame:
        """Only series with rows in this trigger are read, scored and written. Counts new series by the
        state's name."""
        slot = self.state.slot(*KEYS)
        slots = self.state.touched(rows, slot)
        both = rows.withColumn(_AGE, F.lit(0))
        known = self.state.read(turn, slots)
        if known is not None:
            series = rows.select(*KEYS).distinct().alias("s")
            tails = self._merged(known).alias("t")
            earlier = tails.join(series, [F.col(f"s.{k}").eqNullSafe(F.col(f"t.{k}")) for k in KEYS], "left_semi")
            earlier = earlier.select(*KEYS, F.size("tail").alias("__size"), F.posexplode("tail").alias("__at", self.value))
            earlier = earlier.withColumn(_AGE, F.col("__at") - F.col("__size")).drop("__at", "__size")
            both = both.unionByName(earlier, allowMissingColumns=True)
        arrival = [_AGE, *self.order]
        # The limit per series runs before the shuffle, so a hot series sends few rows.
        newest = Window.partitionBy(*KEYS).orderBy(*[F.col(c).desc() for c in arrival])
        tail = F.struct((-F.col("__rank")).alias("at"), F.col(self.value).alias("value"))
        changed = (
            both.select(*dict.fromkeys([*KEYS, *arrival, self.value]))
            .withColumn("__rank", F.row_number().over(newest))
            .where(F.col("__rank") <= self.depth)
            .groupBy(*KEYS)
            .agg(F.sort_array(F.collect_list(tail)).alias("__tail"))
            .select(*KEYS, F.col("__tail.value").alias("tail"))
        )
        self._put(turn, changed, known, slot, slots)
        return self.score(both, arrival).where(F.col(_AGE) == 0).drop(_AGE)

    def _put(self, turn: Turn, changed: DataFrame, known: DataFrame | None, slot: Column, slots: list[int]) -> None:
        if known is None:
            marked = changed.withColumn("fresh", F.lit(True))
        else:
            names = known.select(*[F.col(k).alias(f"__{k}") for k in KEYS], F.lit(True).alias("__known")).distinct()
            on = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in KEYS]
            marked = changed.join(names, on, "left").withColumn("fresh", F.col("__known").isNull())
        self.state.merge(turn, marked.select(*KEYS, "tail", "fresh"), slot, slots, self._merged)
        # read back, as a count taken before a shuffle could count a repeated task twice
        path = KeyedState.piece(turn.folder, self.state.name, turn.token)
        written = turn.spark.read.schema(f"{self.state.schema}, slot int").parquet(path)
        turn.counts[f"new_{self.state.name}"] = written.where("fresh").count()

    def _merged(self, rows: DataFrame) -> DataFrame:
        merged = rows.groupBy(*KEYS).agg(F.max_by("tail", "__n").alias("tail"), F.max("__n").alias("__n"))
        return merged.withColumn("fresh", F.lit(False))


class MomentStage:
    """Running count, mean and variance of each series over all triggers.

    What is kept of a series is (n, mean, sum of squared differences). Two parts a and b of a series have together
    mean_a + d * n_b / n and m2_a + m2_b + d * d * n_a * n_b / n, where d is the difference of their means, so a trigger's
    own running moments are moved by what came before, and its totals are merged into the state.
    """

    def __init__(self, order: list[str] | None = None, skew: SkewConfig = SkewConfig(), slots: int = SLOTS):
        self.state = KeyedState("moments", f"{_SERIES}, n bigint, mean double, m2 double", slots)
        self.order, self.skew = order or ORDER, skew

    def step(self, rows: DataFrame, turn: Turn) -> DataFrame:
        """``rows`` with running_n, running_mean and running_var, stored as ``moments``."""
        slot = self.state.slot(*KEYS)
        slots = self.state.touched(rows, slot)
        own = with_running_moments(rows, KEYS, self.order, "value", self.skew)
        known = self.state.read(turn, slots)
        if known is not None:
            known = self._newest(known).drop("__n")
            before = known.select(*[F.col(k).alias(f"__{k}") for k in KEYS], *[F.col(c).alias(f"__{c}") for c in ("n", "mean", "m2")])
            own = own.join(before, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in KEYS], "left")
            own = self._after(own, rows.columns)
        totals = rows.groupBy(*KEYS).agg(
            F.count("value").alias("n"), F.avg("value").alias("mean"), (F.var_pop("value") * F.count("value")).alias("m2")
        )
        if known is not None:
            both = totals.alias("b").join(known.alias("a"), [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in KEYS], "left")
            n, mean, m2 = self._together(*[F.col(f"{s}.{c}") for s in "ab" for c in ("n", "mean", "m2")])
            totals = both.select(*[f"b.{k}" for k in KEYS], n.alias("n"), mean.alias("mean"), m2.alias("m2"))
        self.state.merge(turn, totals, slot, slots, self._newest)
        return turn.write("moments", own)

    @staticmethod
    def _together(n0: Column, mean0: Column, q0: Column, n1: Column, mean1: Column, q1: Column) -> tuple[Column, Column, Column]:
        """Moments of two parts, where either can be missing or empty."""
        a, b = F.coalesce(n0, F.lit(0)), F.coalesce(n1, F.lit(0))
        n = a + b
        gap = F.coalesce(mean1, mean0) - F.coalesce(mean0, mean1)
        mean = F.coalesce(mean0, mean1) + F.when(n > 0, gap * b / n).otherwise(0.0)
        q = F.coalesce(q0, F.lit(0.0)) + F.coalesce(q1, F.lit(0.0)) + F.when(n > 0, F.coalesce(gap * gap * a * b / n, F.lit(0.0))).otherwise(0.0)
        return n, mean, q

    def _after(self, own: DataFrame, columns: list[str]) -> DataFrame:
        squares = F.col("running_var") * F.greatest(F.col("running_n") - 1, F.lit(0))
        n, mean, q = self._together(
            F.col("__n"), F.col("__mean"), F.col("__m2"), F.col("running_n"), F.col("running_mean"), squares
        )
        variance = F.when(n < 2, 0.0).otherwise(q / F.nullif(n - 1, F.lit(0)))
        return own.select(*columns, n.alias("running_n"), mean.alias("running_mean"), variance.alias("running_var"))

    @staticmethod
    def _newest(rows: DataFrame) -> DataFrame:
        values = F.max_by(F.struct("n", "mean", "m2"), "__n").alias("v")
        return rows.groupBy(*KEYS).agg(values, F.max("__n").alias("__n")).select(*KEYS, "v.*", "__n")


class WindowStage:
    """Windows that close when the clock passes their end; both alignments.

    The values of open windows wait as (value, count) tables, merged by what each trigger adds, in slots by their
    window's end; a trigger reads the slots of the windows that close. These meet the batch operator, which finds
    the percentile of a hot window by rank, in parallel. With "epoch" a row whose window is closed is handed on as
    late. With "series" it counts in the window of its series that is open, and the windows of a series stay on the
    grid of its first record.
    """

    def __init__(
        self,
        cfg: WindowConfig = WindowConfig(),
        clock: Clock | ClockConfig = ClockConfig(),
        skew: SkewConfig = SkewConfig(),
        slots: int = SLOTS,
    ):
        self.clock = clock if isinstance(clock, Clock) else Clock(clock)
        self.state = KeyedState(
            "waiting", f"{_SERIES}, window_start timestamp, window_end timestamp, value double, n bigint", slots
        )
        self.anchors = KeyedState("anchors", f"{_SERIES}, __anchor timestamp", slots)
        self.cfg, self.skew = cfg, skew

    def step(self, rows: DataFrame, turn: Turn) -> tuple[DataFrame, DataFrame]:
        """The windows that closed, stored as ``closed``, and the ``late`` rows. Counts both, and by how much the
        rows that wait have changed."""
        wanted = [*KEYS, "timestamp", "value", *[c for c in ("partition", "received_at") if c in rows.columns]]
        rows = rows.select(*wanted)
        before, now = self.clock.step(rows, turn)
        placed = self._placed(rows.select(*KEYS, "timestamp", "value"), turn, before)
        end = F.unix_micros("window_end")
        passed = F.lit(False) if before is None else end <= before
        late = turn.write("late", placed.where(passed), late=F.count(F.lit(1)))
        window = [*KEYS, "window_start", "window_end"]
        fresh = placed.where(~passed).groupBy(*window, "value").agg(F.count(F.lit(1)).alias("n"))

        due = [] if now is None else self._due(before, now)
        held = self.state.read(turn, due)
        pool = fresh if held is None else fresh.unionByName(held.drop("__n"))
        closes = F.lit(False) if now is None else end <= now
        # what stays open in the slots that are written anew was read from them
        stays = pool.where(~closes).groupBy(*window, "value").agg(F.sum("n").alias("n"))
        self.state.put(turn, stays, self._slot(), due)
        repeated = F.explode(F.array_repeat("value", F.col("n").cast("int"))).alias("value")
        stats = assigned_stats(pool.where(closes).select(*window, repeated), self.cfg, self.skew)
        used = F.coalesce(F.sum("sample_count"), F.lit(0))
        every = turn.write("ended", stats, ended_rows=used)
        closed = turn.write("closed", closed_windows(every, self.cfg), windows=F.count(F.lit(1)))
        return closed, late

    def _slot(self) -> Column:
        stretch = F.floor(F.unix_micros("window_end") / F.lit(self.cfg.window_us))
        return F.pmod(stretch, F.lit(self.state.slots)).cast("int")

    def _due(self, before: int | None, now: int) -> list[int]:
        """Slots of the windows that end after ``before`` and by ``now``."""
        slots = self.state.slots
        last = now // self.cfg.window_us
        first = last - slots if before is None else before // self.cfg.window_us
        return sorted({i % slots for i in range(max(first, last - slots), last + 1)})

    def _placed(self, rows: DataFrame, turn: Turn, before: int | None) -> DataFrame:
        if self.cfg.alignment == "epoch":
            return assign_windows(rows, self.cfg, self.skew)
        slot = self.anchors.slot(*KEYS)
        slots = self.anchors.touched(rows, slot)
        first = series_anchor(rows)
        known = self.anchors.read(turn, slots)
        if known is not None:
            known = known.drop("__n")
            new = first.join(known.withColumnsRenamed({k: f"__{k}" for k in KEYS}).drop("__anchor"),
                             [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in KEYS], "left_anti")
        else:
            new = first
        self.anchors.merge(turn, new, slot, slots, lambda every: every)
        anchors = self.anchors.read(turn, slots)
        return anchored_windows(rows, anchors.drop("__n"), self.cfg, self.skew, before)


class LiveIds:
    """How many ids were accepted within the last time-to-live before the clock, kept by change.

    Accepted times are kept as (time, count) in slots by time. As the clock moves on, the times that come within reach
    are added and those that fall out of it subtracted; only the slots that the two bounds pass over are read.
    """

    _STEPS = 8  # slots of a time-to-live

    def __init__(self, cfg: DedupConfig = DedupConfig(), slots: int = SLOTS):
        self.state = KeyedState("live", "at bigint, n bigint", slots)
        self.cfg = cfg
        self.width = max(1, cfg.ttl_us // self._STEPS)

    def _slot(self) -> Column:
        return F.pmod(F.floor(F.col("at") / F.lit(self.width)), F.lit(self.state.slots)).cast("int")

    def _passed(self, low: int, high: int) -> set[int]:
        slots = self.state.slots
        first, last = low // self.width, high // self.width
        return {i % slots for i in range(max(first, last - slots), last + 1)}

    def step(self, accepted: DataFrame, turn: Turn, before: int | None, now: int | None) -> int:
        """The ids that live after this trigger; ``before`` and ``now`` are the clock's times."""
        live = turn.values.get("live", 0)
        if now is None:
            return live
        ttl, at = self.cfg.ttl_us, F.col("at")
        added = accepted.where("timestamp IS NOT NULL").groupBy(F.unix_micros("timestamp").alias("at")).agg(
            F.count(F.lit(1)).alias("n")
        ).where(at >= now - ttl)
        due = sorted(set() if before is None else self._passed(before, now) | self._passed(before - ttl, now - ttl))
        held = self.state.read(turn, due)
        within = (at >= now - ttl) & (at <= now)
        change = added.select(F.when(within, F.col("n")).otherwise(0).alias("c"))
        pool = added
        if held is not None:
            held = held.drop("__n")
            was = (at >= before - ttl) & (at <= before)
            change = change.unionByName(
                held.select((F.col("n") * (within.cast("int") - was.cast("int"))).alias("c"))
            )
            pool = added.unionByName(held.where(at >= now - ttl))
        live += change.agg(F.sum("c")).first()[0] or 0
        self.state.put(turn, pool, self._slot(), due)
        turn.values["live"] = live
        return live
