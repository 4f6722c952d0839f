"""Road sensor stream: windowed metrics and dead letters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from strata.functions.contracts import (
    CORRIDORS, accepted, check_messages, corridor_contract, dead_letters,
)
from strata.functions.times import since
from strata.operators.quality import Expect, gate
from strata.streaming.panes import corridor_panes
from strata.streaming.tables import append_batch, declare_table, each_batch, read_table, table_rows
from strata.streaming.windows import (
    LATENESS, WINDOW, corridor_metrics, latest_panes, with_event_time,
)

METRICS_SCHEMA = (
    "window_start string, window_end string, corridor string, vehicle_count bigint, "
    "average_speed_kph double, max_speed_kph bigint"
)
PANES_SCHEMA = f"{METRICS_SCHEMA}, pane_kind string, pane_number int"
DEAD_LETTER_SCHEMA = "payload string, error string, failed_at timestamp"


def declare(spark: SparkSession, folder: str) -> None:
    """Create both target tables; the sinks require them."""
    declare_table(spark, f"{folder}/corridor_metrics", METRICS_SCHEMA)
    declare_table(spark, f"{folder}/dead_letter_events", DEAD_LETTER_SCHEMA)


def metrics_writer(
    messages: DataFrame,
    folder: str,
    corridors: tuple[str, ...] = CORRIDORS,
    window: str = WINDOW,
    lateness: str = LATENESS,
) -> DataStreamWriter:
    """Window totals, one appended pane for every window a micro-batch changed."""
    readings = with_event_time(accepted(check_messages(messages, corridor_contract(corridors))))
    metrics = corridor_metrics(readings, window, lateness)
    return each_batch(
        metrics, lambda b, i: append_batch(b, i, f"{folder}/corridor_metrics"), mode="update"
    )


def panes_writer(
    messages: DataFrame, folder: str, corridors: tuple[str, ...] = CORRIDORS,
    window_seconds: int = 60, lateness_seconds: int = 120, early_seconds: int = 20,
) -> DataStreamWriter:
    """Early, on-time and late panes with their kind and number; start it within ``keyed_state``."""
    readings = with_event_time(accepted(check_messages(messages, corridor_contract(corridors))))
    fired = corridor_panes(readings, window_seconds, lateness_seconds, early_seconds)
    return each_batch(fired, lambda b, i: append_batch(b, i, f"{folder}/corridor_panes"))


def dead_letter_writer(
    messages: DataFrame, folder: str, corridors: tuple[str, ...] = CORRIDORS
) -> DataStreamWriter:
    """Refused messages with reason and time."""
    checked = check_messages(messages, corridor_contract(corridors))
    return each_batch(
        dead_letters(checked), lambda b, i: append_batch(b, i, f"{folder}/dead_letter_events")
    )


def panes(spark: SparkSession, folder: str) -> DataFrame:
    """All panes in the order they were written, also by several queries."""
    stored = read_table(spark, f"{folder}/corridor_metrics")
    return stored.select("*", F.struct("_metadata.file_modification_time", "batch_id").alias("pane"))


def final_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """The current total of every window."""
    return latest_panes(panes(spark, folder)).drop("pane", "writer", "batch_id")


def refused(spark: SparkSession, folder: str) -> DataFrame:
    return table_rows(spark, f"{folder}/dead_letter_events")


def completeness(
    spark: SparkSession, folder: str, interval: str | None = None
) -> DataFrame:
    """One row: corridors, vehicles and dead letters, optionally of recent windows."""
    current = final_metrics(spark, folder)
    if interval is not None:
        stamped = current.withColumn("__start", F.try_to_timestamp("window_start"))
        current = since(stamped, "__start", interval)
    per_corridor = current.groupBy("corridor").agg(F.sum("vehicle_count").alias("n"))
    letters = refused(spark, folder).agg(F.count(F.lit(1))).scalar()
    return per_corridor.agg(
        F.count(F.lit(1)).alias("corridor_count"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("vehicle_count"),
    ).withColumn("invalid_count", letters)


def verify(spark: SparkSession, folder: str, corridors: int, vehicles: int) -> DataFrame:
    expected = {
        "corridor_count": Expect(equals=corridors),
        "vehicle_count": Expect(equals=vehicles),
        "invalid_count": Expect(at_least=1),
    }
    return gate(completeness(spark, folder), expected)
