"""Profile enrichment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.ordering import best_per_key
from strata.sources.sinks import overwrite

# Profile attributes and what stands in for a missing one.
PROFILE_COLUMNS = ("display_name", "team", "region", "rank")
UNKNOWN = "unknown"


def seed_profiles(versions: DataFrame, key: str, version: str) -> DataFrame:
    """The newest version of every profile."""
    return best_per_key(versions, [key], [F.col(version).desc()]).drop(version)


def store_profiles(versions: DataFrame, key: str, version: str, path: str) -> int:
    """Write the newest profiles and return their number; fail when one got lost."""
    expected = versions.agg(F.count_distinct(key)).first()[0]
    overwrite(seed_profiles(versions, key, version), path)
    stored = versions.sparkSession.read.parquet(path).filter(F.col(key).isNotNull()).count()
    if stored != expected:
        raise RuntimeError(f"Stored {stored} of {expected} profiles.")
    return stored


def enrich(
    events: DataFrame,
    profiles: DataFrame,
    key: str = "player_id",
    columns: Sequence[str] = PROFILE_COLUMNS,
    stamp: bool = True,
) -> DataFrame:
    """Overlay profile attributes on events; missing ones become ``unknown``.

    Profile attributes replace event columns of the same name. The key is unique
    among the profiles. No broadcast is forced: Spark picks it by size, and else
    splits hot keys of the event side (AQE skew join).
    """
    own = [c for c in events.columns if c not in columns]
    joined = events.select(*own).join(profiles.select(key, *columns), key, "left")
    enriched = joined.select(
        *own, *[F.coalesce(F.col(c), F.lit(UNKNOWN)).alias(c) for c in columns]
    )
    return enriched.withColumn("processed_at", F.current_timestamp()) if stamp else enriched
