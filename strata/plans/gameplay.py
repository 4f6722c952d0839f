"""Match events: enrichment stream and dashboard views."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from strata.functions.contracts import (
    accepted, check_messages, dead_letters, gameplay_contract,
)
from strata.functions.times import instant
from strata.operators.enrich import PROFILE_COLUMNS, UNKNOWN, enrich
from strata.operators.quality import Expect, gate
from strata.operators.views import stream_health
from strata.session import cut_lineage
from strata.streaming.asof import enrich_as_of
from strata.streaming.tables import append_batch, declare_table, each_batch, table_rows

EVENT_SCHEMA = (
    "event_id string, event_time timestamp, match_id string, player_id string, "
    "event_type string, action string, score_delta bigint, message string, "
    "display_name string, team string, region string, rank string, processed_at timestamp"
)
DEAD_LETTER_SCHEMA = "payload string, error string, failed_at timestamp"


def declare(spark: SparkSession, folder: str) -> None:
    declare_table(spark, f"{folder}/enriched_events", EVENT_SCHEMA)
    declare_table(spark, f"{folder}/dead_letter_events", DEAD_LETTER_SCHEMA)


def writer(
    messages: DataFrame, profiles: Callable[[], DataFrame], folder: str
) -> DataStreamWriter:
    """Parse each micro-batch once; enrich the good rows, keep the bad ones.

    ``profiles`` is called per micro-batch, so profile changes reach later events. A
    batch is written to the shared folder and read twice: bound it with ``files_per_batch``.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        checked = cut_lineage(check_messages(batch, gameplay_contract()), "checked")
        timed = accepted(checked).withColumn("event_time", instant(F.col("event_time")))
        append_batch(enrich(timed, profiles()), batch_id, f"{folder}/enriched_events")
        append_batch(dead_letters(checked), batch_id, f"{folder}/dead_letter_events")

    return each_batch(messages, handle)


def as_of_writer(messages: DataFrame, versions: DataFrame, folder: str, version_time: str = "valid_from") -> DataStreamWriter:
    """Good messages with the profile version valid at their time, from two streams that share
    one state; no micro-batch reads the profile table. Start it within ``keyed_state``."""
    events = accepted(check_messages(messages, gameplay_contract()))
    timed = events.withColumn("event_time", instant(F.col("event_time")))
    found = enrich_as_of(timed, versions, "player_id", "event_time", version_time, PROFILE_COLUMNS, UNKNOWN)
    stamped = found.withColumn("processed_at", F.current_timestamp())
    return each_batch(stamped, lambda b, i: append_batch(b, i, f"{folder}/enriched_events"))


def enriched(spark: SparkSession, folder: str) -> DataFrame:
    return table_rows(spark, f"{folder}/enriched_events")


def refused(spark: SparkSession, folder: str) -> DataFrame:
    return table_rows(spark, f"{folder}/dead_letter_events")


def verify(events: DataFrame, at_least: int) -> DataFrame:
    """Enough events arrived and none lacks its profile."""
    expected = {
        "event_count": Expect(at_least=at_least),
        "unknown_profiles": Expect(equals=0),
    }
    return gate(stream_health(events), expected)
