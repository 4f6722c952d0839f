"""Serving views over stream tables. ``as_of`` fixes "now"; live use passes
``current_timestamp()``, replays leave it out and count from the newest row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.times import since
from strata.operators.enrich import PROFILE_COLUMNS, UNKNOWN
from strata.operators.ordering import best_per_key, top_rows

MESSAGE_LIMIT = 20  # rows of the recent-messages report


def leaderboard(
    events: DataFrame, interval: str = "1 HOUR", as_of: Column | None = None
) -> DataFrame:
    """Score, kills, assists and last event per player in the trailing interval."""
    recent = since(events, "event_time", interval, as_of)
    # The profile of the player's newest event stands for all of them.
    newest = F.max(F.struct("event_time", "event_id", *PROFILE_COLUMNS))
    grouped = recent.groupBy("player_id").agg(
        newest.alias("__p"),
        F.sum("score_delta").alias("score"),
        F.count_if(F.col("action") == "kill").alias("kills"),
        F.count_if(F.col("action") == "assist").alias("assists"),
    )
    return grouped.select(
        "player_id",
        *[F.col(f"__p.{c}").alias(c) for c in PROFILE_COLUMNS],
        "score",
        "kills",
        "assists",
        F.col("__p.event_time").alias("last_event"),
    )


def ordered_leaderboard(board: DataFrame) -> DataFrame:
    """The whole board, best score first."""
    return board.orderBy(F.desc("score"), "player_id")


def chat_messages(
    events: DataFrame, interval: str = "1 HOUR", as_of: Column | None = None
) -> DataFrame:
    """Chat messages of the trailing interval."""
    recent = since(events, "event_time", interval, as_of).filter(F.col("event_type") == "chat")
    return recent.select(
        "event_id", "event_time", "match_id", "display_name", "team", "region", "message"
    )


def recent_messages(messages: DataFrame, limit: int = MESSAGE_LIMIT) -> DataFrame:
    """The newest messages."""
    return top_rows(messages, [F.desc("event_time"), F.desc("event_id")], limit)


def dashboard_rollup(board: DataFrame, messages: DataFrame) -> DataFrame:
    """One row: active players, points scored, recent messages shown."""
    shown = recent_messages(messages).agg(F.count(F.lit(1))).scalar()
    return board.agg(
        F.count(F.lit(1)).alias("active_players"),
        F.coalesce(F.sum("score"), F.lit(0)).alias("total_score"),
    ).withColumn("recent_messages", shown)


def stream_health(events: DataFrame) -> DataFrame:
    """One row: events, chat events, players, events without profile."""
    return events.agg(
        F.count(F.lit(1)).alias("event_count"),
        F.count_if(F.col("event_type") == "chat").alias("chat_count"),
        F.count_distinct(F.col("player_id")).alias("player_count"),
        F.count_if(F.col("display_name") == UNKNOWN).alias("unknown_profiles"),
    )


def latest_observations(weather: DataFrame) -> DataFrame:
    """The newest observation per city, the last published one on equal times."""
    order = [F.desc("observed_at"), F.desc("published_at")]
    return best_per_key(weather, ["city"], order).drop("published_at")


def observation_trends(
    weather: DataFrame, interval: str = "24 HOURS", as_of: Column | None = None
) -> DataFrame:
    """Average measures per minute and city in the trailing interval."""
    recent = since(weather, "observed_at", interval, as_of)
    minute = F.date_trunc("minute", F.col("observed_at")).alias("observation_minute")
    return recent.groupBy(minute, "city").agg(
        F.max("country").alias("country"),
        F.avg("temperature_c").alias("avg_temperature_c"),
        F.avg("relative_humidity").alias("avg_relative_humidity"),
        F.avg("wind_speed_kmh").alias("avg_wind_speed_kmh"),
    )


def city_progress(weather: DataFrame) -> DataFrame:
    """Observations and newest time per city, in city order."""
    return (
        weather.groupBy("city")
        .agg(F.count(F.lit(1)).alias("event_count"), F.max("observed_at").alias("latest"))
        .orderBy("city")
    )
