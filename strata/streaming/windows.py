"""Event-time windows and their panes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.numbers import half_even
from strata.functions.times import instant, iso_instant
from strata.operators.ordering import best_per_key

# Window length and how late a reading may come.
WINDOW = "60 seconds"
LATENESS = "120 seconds"
PANE = "pane"  # what orders the panes of a window


def with_event_time(df: DataFrame, column: str = "event_time") -> DataFrame:
    """Event time from the payload's ISO text instead of arrival."""
    return df.withColumn(column, instant(F.col(column)))


def corridor_metrics(
    readings: DataFrame, window: str = WINDOW, lateness: str | None = None
) -> DataFrame:
    """Vehicles, average and top speed per epoch-aligned window and corridor.

    Works on batch frames and, with ``lateness``, on streams. Sums and counts
    combine before the shuffle, so a busy corridor costs one row per task.
    """
    if lateness is not None:
        readings = readings.withWatermark("event_time", lateness)
    speed = F.col("speed_kph")
    grouped = readings.groupBy(F.window("event_time", window), "corridor").agg(
        F.count(F.lit(1)).alias("vehicle_count"),
        F.sum(speed).alias("__total"),
        F.max(speed).alias("max_speed_kph"),
    )
    average = F.try_divide(F.col("__total").cast("double"), F.col("vehicle_count"))
    return grouped.select(
        iso_instant(F.col("window.start")).alias("window_start"),
        iso_instant(F.col("window.end")).alias("window_end"),
        "corridor",
        "vehicle_count",
        half_even(average).alias("average_speed_kph"),
        "max_speed_kph",
    )


def latest_panes(
    panes: DataFrame, keys: Sequence[str] = ("window_start", "corridor"), pane: str = PANE
) -> DataFrame:
    """Every window's last pane. Panes carry full totals, so the last one counts."""
    return best_per_key(panes, keys, [F.col(pane).desc()])


def corridor_progress(panes: DataFrame, pane: str = PANE) -> DataFrame:
    """Per corridor the windows seen and vehicles counted, from its last panes."""
    return latest_panes(panes, pane=pane).groupBy("corridor").agg(
        F.count(F.lit(1)).alias("windows"), F.sum("vehicle_count").alias("vehicle_count")
    )
