"""Keyed merges: upserts and change logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.ordering import best_per_key

# Operation codes of change rows.
INSERT, UPDATE, DELETE = "I", "U", "D"


def upsert(target: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Insert or replace: incoming rows win. Keys are unique on both sides."""
    marked = incoming.withColumn("__new", F.lit(True))
    joined = target.alias("t").join(marked.alias("i"), list(keys), "full_outer")
    rest = [c for c in target.columns if c not in keys]
    return joined.select(
        *keys,
        *[F.when(F.col("__new"), F.col(f"i.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in rest],
    ).select(*target.columns)


def insert_absent(target: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Insert only rows whose key the target lacks."""
    fresh = incoming.join(target.select(*keys), list(keys), "left_anti")
    return target.unionByName(fresh.select(*target.columns))


def latest_changes(
    changes: DataFrame, keys: Sequence[str], sequence: str = "seq"
) -> DataFrame:
    """The last change per key; every map task sends one row per key at most."""
    return best_per_key(changes, keys, [F.col(sequence).desc()])


def apply_changes(
    snapshot: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    sequence: str = "seq",
    operation: str = "op",
) -> DataFrame:
    """Snapshot after the change log: highest sequence per key wins, deletes remove.

    Both join sides are unique by key, so no key can be hot in the join. Applying
    the same changes again gives the same rows.
    """
    last = latest_changes(changes, keys, sequence).withColumn("__op", F.col(operation))
    rest = [c for c in snapshot.columns if c not in keys]
    joined = snapshot.alias("s").join(
        last.select(*keys, "__op", *rest).alias("c"), list(keys), "full_outer"
    )
    merged = joined.filter(F.col("__op").isNull() | (F.col("__op") != DELETE))
    return merged.select(
        *keys,
        *[
            F.when(F.col("__op").isNotNull(), F.col(f"c.{c}")).otherwise(F.col(f"s.{c}")).alias(c)
            for c in rest
        ],
    ).select(*snapshot.columns)
