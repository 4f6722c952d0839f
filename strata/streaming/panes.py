"""Panes of event-time windows, fired by state and timers.

A window has early panes while it is open, an on-time pane when the watermark passes its end,
a late pane for every reading that comes within the allowed lateness after that, and is then
forgotten; later readings are dropped. Panes carry full totals, a kind and a number.

The watermark is the largest event time of earlier micro-batches. Spark holds it back by
lateness and window length, so that a reading it drops would be too late here as well; all
else is decided per window. Timers run on event time: one closes the window, one forgets it.
Spark gives a stateful operator timers of one kind only, so an early pane falls due by
processing time, and is looked for when readings of the window come and whenever the watermark
moves.

Readings meet their window as one row per Arrow batch with all speeds, so a corridor that has
a third of them sends short lists, not rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from strata.functions.numbers import half_even
from strata.functions.times import iso_instant

EARLY, ON_TIME, LATE = "early", "on_time", "late"
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PIECES = "corridor string, start_ms long, speeds array<long>"
_PANES = "corridor string, start_ms long, vehicle_count long, total long, max_speed_kph long, pane_kind string, pane_number int"
_TOTALS = "vehicle_count long, total long, top long, closed boolean, panes int, waiting long"


class _Window:
    """The state of one window; ``waiting`` is since when (processing time) readings are
    in no pane yet, -1 if all are."""

    def __init__(self, stored):
        self.count, self.total, self.top, self.closed, self.panes, self.waiting = stored or (0, 0, None, False, 0, -1)

    def stored(self):
        return (self.count, self.total, self.top, self.closed, self.panes, self.waiting)

    def add(self, speeds) -> None:
        self.count += len(speeds)
        self.total += sum(speeds)
        self.top = max([*speeds, *([] if self.top is None else [self.top])])


class PaneProcessor(StatefulProcessor):
    """State and timers of windows keyed by corridor and start."""

    def __init__(self, window_ms: int, lateness_ms: int, early_ms: int):
        self.window, self.lateness, self.early = window_ms, lateness_ms, early_ms
        self.held_back = lateness_ms + window_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.totals = handle.getValueState("totals", _TOTALS)

    def _watermark(self, values) -> int | None:
        now = values.getCurrentWatermarkInMs()
        return now + self.held_back if now > 0 else None

    def _wake(self, at: int) -> None:
        """A timer for when the watermark has reached ``at``."""
        self.handle.registerTimer(max(1, at - self.held_back - 1))

    def _pane(self, key, window: _Window, kind: str) -> Row:
        window.panes += 1
        window.waiting = -1
        return Row(corridor=key[0], start_ms=key[1], vehicle_count=window.count, total=window.total,
                   max_speed_kph=window.top, pane_kind=kind, pane_number=window.panes)

    def _due(self, key, window: _Window, values) -> Iterator[Row]:
        """What the passing of time makes due."""
        watermark, end = self._watermark(values), key[1] + self.window
        if not window.closed and watermark is not None and watermark >= end:
            window.closed = True
            if window.count:
                yield self._pane(key, window, ON_TIME)
        elif not window.closed and window.waiting >= 0:
            if values.getCurrentProcessingTimeInMs() - window.waiting >= self.early:
                yield self._pane(key, window, EARLY)

    def _rest(self, window: _Window, key, values) -> None:
        """Keep the state and wait for what comes next, or forget the window."""
        watermark, end = self._watermark(values), key[1] + self.window
        if watermark is not None and watermark >= end + self.lateness:
            self.totals.clear()
            return
        self.totals.update(window.stored())
        self._wake(end + self.lateness if window.closed else end)
        if not window.closed and window.waiting >= 0 and watermark is not None:
            self._wake(watermark + 2)  # whenever the watermark moves

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        window = _Window(self.totals.get() if self.totals.exists() else None)
        watermark, end = self._watermark(timerValues), key[1] + self.window
        yield from self._due(key, window, timerValues)  # before the new readings
        for row in rows:
            if watermark is not None and watermark >= end + self.lateness:
                continue  # too late
            if window.closed:
                for speed in row["speeds"]:
                    window.add([speed])
                    yield self._pane(key, window, LATE)
            else:
                window.add(row["speeds"])
                if window.waiting < 0:
                    window.waiting = timerValues.getCurrentProcessingTimeInMs()
        if not window.closed:
            yield from self._due(key, window, timerValues)
        self._rest(window, key, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.totals.exists():
            window = _Window(self.totals.get())
            yield from self._due(key, window, timerValues)
            self._rest(window, key, timerValues)

    def close(self) -> None:
        pass


def _pieces(readings: DataFrame, window_ms: int) -> DataFrame:
    """One row per corridor, window and Arrow batch, with the batch's speeds."""
    narrow = readings.select(
        "corridor", (F.floor(F.unix_millis("event_time") / window_ms) * window_ms).alias("start_ms"),
        F.col("speed_kph").cast("long").alias("speed"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            grouped = table.group_by(["corridor", "start_ms"], use_threads=False).aggregate([("speed", "list")])
            yield from grouped.select(["corridor", "start_ms", "speed_list"]).rename_columns(
                ["corridor", "start_ms", "speeds"]).to_batches()

    return narrow.mapInArrow(run, _PIECES)


def corridor_panes(
    readings: DataFrame, window_seconds: int = 60, lateness_seconds: int = 120, early_seconds: int = 20
) -> DataFrame:
    """All panes of a stream of readings (``event_time, corridor, speed_kph``). Readings without
    a time or a corridor's name belong to no window."""
    window_ms, lateness_ms = window_seconds * 1000, lateness_seconds * 1000
    known = readings.filter(F.col("event_time").isNotNull() & F.col("speed_kph").isNotNull())
    timed = known.withWatermark("event_time", f"{window_seconds + lateness_seconds} seconds")
    panes = _pieces(timed, window_ms).groupBy("corridor", "start_ms").transformWithState(
        PaneProcessor(window_ms, lateness_ms, early_seconds * 1000), _PANES, "Append", "EventTime")
    average = F.try_divide(F.col("total").cast("double"), F.col("vehicle_count"))
    return panes.select(
        iso_instant(F.timestamp_millis("start_ms")).alias("window_start"),
        iso_instant(F.timestamp_millis(F.col("start_ms") + window_ms)).alias("window_end"), "corridor",
        "vehicle_count", half_even(average).alias("average_speed_kph"), "max_speed_kph", "pane_kind", "pane_number")


class keyed_state:
    """The state store that timers need, while a stream is started."""

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def __enter__(self):
        self.before = self.spark.conf.get(STATE_STORE, None)
        self.spark.conf.set(STATE_STORE, ROCKS_DB)

    def __exit__(self, *_):
        if self.before is None:
            self.spark.conf.unset(STATE_STORE)
        else:
            self.spark.conf.set(STATE_STORE, self.before)
