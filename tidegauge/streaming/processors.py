"""Keyed state for what the built-in streaming operators do not offer.

Spark partitions the rows by key, keeps the state in checkpointed stores and brings the rows
of one key and one trigger to a processor. The amount per trigger is bounded by the source
options (``maxOffsetsPerTrigger``, ``maxFilesPerTrigger``).
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from typing import Any

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import Row
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle



# Workers get these classes with the query, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class TtlDedup(StatefulProcessor):
    """Flags repeats within the time-to-live of the last accepted row, by event time. Row-at-a-time Python beside
    ``triggers.DedupStage``, which works in the JVM and judges rows that come late by all accepted times near them.

    Rows carry their event time in microseconds as ``__t`` and are taken in the order
    (``__t``, tie-break columns). The state of an id is dropped by a timer once the watermark has
    passed its time-to-live.
    """

    def __init__(self, ttl_us: int, columns: list[str], order: list[str], timers: bool):
        self.ttl_us = ttl_us
        self.columns = columns
        self.order = order
        self.timers = timers

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last_accepted", "t bigint")
        self.out = Row(*self.columns, "is_duplicate")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        state = self.last.get()
        before = last = None if state is None else state[0]
        for row in sorted(rows, key=lambda r: tuple(r[c] for c in self.order)):
            duplicate = last is not None and row["__t"] - last <= self.ttl_us
            if not duplicate:
                last = row["__t"]
            yield self.out(*[row[c] for c in self.columns], duplicate)
        if last != before:
            self.last.update((last,))
            if self.timers:
                # One millisecond later, as timers have no finer grain.
                self.handle.registerTimer((last + self.ttl_us) // 1000 + 1)

    def handleExpiredTimer(self, key: Any, timerValues, expiredTimerInfo) -> Iterator[Row]:
        state = self.last.get()
        due = expiredTimerInfo.getExpiryTimeInMs()
        if state is not None and (state[0] + self.ttl_us) // 1000 + 1 <= due:
            self.last.clear()
        yield from ()

    def close(self) -> None:
        pass


class TrailingBaseline(StatefulProcessor):
    """Count, mean and sample deviation of the last ``depth`` values before each row. Row-at-a-time Python
    beside ``triggers.ScoreStage``."""

    def __init__(self, depth: int, value: str, columns: list[str], order: list[str]):
        self.depth = depth
        self.value = value
        self.columns = columns
        self.order = order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.recent = handle.getValueState("recent", "values array<double>")
        self.out = Row(*self.columns, "baseline_n", "baseline_mean", "baseline_std")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        state = self.recent.get()
        earlier = [] if state is None else list(state[0])
        ordered = sorted(rows, key=lambda r: tuple(r[c] for c in self.order))
        values = np.array(earlier + [r[self.value] for r in ordered], dtype="float64")
        counts, means, deviations = self._baselines(values, len(earlier))
        for row, n, mean, deviation in zip(ordered, counts, means, deviations):
            known = n > 0
            yield self.out(
                *[row[c] for c in self.columns],
                int(n),
                float(mean) if known else None,
                float(deviation) if known else 0.0,
            )
        self.recent.update(([float(v) for v in values[-self.depth :]],))

    def _baselines(self, values: np.ndarray, start: int):
        ends = np.arange(start, len(values))
        counts = np.minimum(ends, self.depth)
        means, deviations = np.zeros(len(ends)), np.zeros(len(ends))
        full = counts == self.depth
        if full.any():
            frames = np.lib.stride_tricks.sliding_window_view(values, self.depth)
            chosen = frames[ends[full] - self.depth]
            means[full] = chosen.mean(axis=1)
            if self.depth > 1:
                deviations[full] = chosen.std(axis=1, ddof=1)
        for i in np.flatnonzero(~full & (counts > 0)):
            frame = values[ends[i] - counts[i] : ends[i]]
            means[i] = frame.mean()
            deviations[i] = frame.std(ddof=1) if len(frame) > 1 else 0.0
        return counts, means, deviations

    def close(self) -> None:
        pass


class WallClockWindows(StatefulProcessor):
    """Windows that close when so much time has passed on the wall clock, whatever the readings tell.

    A series' window starts at its first reading's time. Once the present is a window's width after the start, the readings
    up to the start plus the width are used up: at least ``min_samples`` of them give a window, and the next one starts where
    this one ended, so readings that came late for it are in it; fewer give none, and the next one starts at the present.
    Timers on processing time tell when; they fire also without new readings. Row-at-a-time Python, as state timers
    are offered in no other way; ``triggers.WindowStage`` is the form for event time in the JVM.
    """

    def __init__(self, width_us: int, min_samples: int, percentile: float, names: list[str]):
        self.width_us = width_us
        self.min_samples = min_samples
        self.percentile = percentile
        self.names = names

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.start = handle.getValueState("start", "t bigint")
        self.buffer = handle.getListState("buffer", "t bigint, value double")
        self.out = Row(*self.names)

    def _arm(self, start: int) -> None:
        self.handle.registerTimer(-(-(start + self.width_us) // 1000))

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        incoming = [(row["__t"], row["value"]) for row in rows if row["__t"] is not None]
        if incoming:
            if self.start.get() is None:
                first = min(t for t, _ in incoming)
                self.start.update((first,))
                self._arm(first)
            self.buffer.appendList(incoming)
        yield from ()

    def handleExpiredTimer(self, key: Any, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = timerValues.getCurrentProcessingTimeInMs() * 1000
        start = self.start.get()[0]
        end = start + self.width_us
        if now < end:
            return
        rows = [(r[0], r[1]) for r in self.buffer.get()]
        values = np.array([v for t, v in rows if t <= end], dtype="float64")
        held = [(t, v) for t, v in rows if t > end]
        if held:
            self.buffer.put(held)
        else:
            self.buffer.clear()
        start_after = end if len(values) >= self.min_samples else now
        self.start.update((start_after,))
        self._arm(start_after)
        if len(values) >= self.min_samples:
            yield self.out(
                *key,
                start,
                end,
                now,
                len(values),
                float(values.mean()),
                float(values.min()),
                float(values.max()),
                float(values.std(ddof=1)) if len(values) > 1 else 0.0,
                float(np.percentile(values, self.percentile)),
            )

    def close(self) -> None:
        pass


class AnchoredWindows(StatefulProcessor):
    """Windows on the grid of a series' first record, closed with the watermark.

    A row belongs to the window that includes its time as upper bound, or, if that one is closed, to
    the first open one. Windows with too few rows are left out, with their rows used up. The
    grid of a series stays, also while no row of it is buffered.
    """

    def __init__(self, width_us: int, min_samples: int, percentile: float, names: list[str]):
        self.width_us = width_us
        self.min_samples = min_samples
        self.percentile = percentile
        self.names = names

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.grid = handle.getValueState("grid", "first bigint, open bigint")
        self.buffer = handle.getListState("buffer", "window bigint, value double")
        self.out = Row(*self.names)

    def _arm(self, first: int, window: int) -> None:
        """A timer for the end of a window; timers have no finer grain than milliseconds."""
        self.handle.registerTimer(-(-(first + (window + 1) * self.width_us) // 1000))

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        incoming = [(row["__t"], row["value"]) for row in rows]
        state = self.grid.get()
        if state is None:
            state = (min(t for t, _ in incoming), 0)
            self.grid.update(state)
        first, open_ = state
        placed = [(max(-((first - t) // self.width_us) - 1, open_), v) for t, v in incoming]
        self.buffer.appendList(placed)
        for window in {w for w, _ in placed}:
            self._arm(first, window)
        yield from ()

    def handleExpiredTimer(self, key: Any, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = timerValues.getCurrentWatermarkInMs() * 1000
        first, open_ = self.grid.get()
        after = max(open_, (now - first) // self.width_us)
        if after == open_:
            return
        held: list[tuple[int, float]] = []
        due: dict[int, list[float]] = {}
        for row in self.buffer.get():
            if row[0] < after:
                due.setdefault(row[0], []).append(row[1])
            else:
                held.append((row[0], row[1]))
        self.grid.update((first, after))
        if held:
            self.buffer.put(held)
        else:
            self.buffer.clear()
        for window in sorted(due):
            values = np.array(due[window], dtype="float64")
            if len(values) >= self.min_samples:
                start = first + window * self.width_us
                yield self.out(
                    *key,
                    start,
                    start + self.width_us,
                    now,
                    len(values),
                    float(values.mean()),
                    float(values.min()),
                    float(values.max()),
                    float(values.std(ddof=1)) if len(values) > 1 else 0.0,
                    float(np.percentile(values, self.percentile)),
                )

    def close(self) -> None:
        pass
