"""Order replica: snapshot, change stream, and the check that a change arrived."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.quality import Expect, gate
from strata.sources.messages import read_messages
from strata.streaming import bucketed, replica
from strata.streaming.tables import declare_table, drain

# Columns of the source table; change rows add operation and sequence.
ORDER_SCHEMA = (
    "order_id bigint, customer_name string, status string, amount decimal(10,2), "
    "updated_at timestamp"
)
CHANGE_SCHEMA = ORDER_SCHEMA + ", op string, seq bigint"
KEYS = ["order_id"]


def declare(spark: SparkSession, folder: str) -> str:
    """Create the change table."""
    return declare_table(spark, f"{folder}/changes", CHANGE_SCHEMA)


def run(spark: SparkSession, snapshot: replica.Snapshot, source: str, folder: str,
        checkpoint: str, files_per_batch: int | None = None) -> DataFrame:
    """Collect the change messages that arrived and return the current replica."""
    log = read_messages(spark, source, fmt="json", schema=CHANGE_SCHEMA, files_per_batch=files_per_batch)
    drain(replica.collect_changes(log, KEYS, f"{folder}/changes"), checkpoint)
    return replica.replica(spark, snapshot, f"{folder}/changes", KEYS)


def run_stored(spark: SparkSession, store: bucketed.Store, source: str, folder: str,
               checkpoint: str, files_per_batch: int | None = None) -> bucketed.Store:
    """Collect the change messages that arrived and rewrite the buckets they changed."""
    log = read_messages(spark, source, fmt="json", schema=CHANGE_SCHEMA, files_per_batch=files_per_batch)
    drain(replica.collect_changes(log, KEYS, f"{folder}/changes"), checkpoint)
    return bucketed.compact(spark, store, f"{folder}/changes")


def lookup(orders: DataFrame, order_id: int) -> DataFrame:
    """One order by its key; the filter reaches the scan."""
    return orders.filter(F.col("order_id") == F.lit(order_id)).limit(1)


def verify(orders: DataFrame, order_id: int, status: str) -> DataFrame:
    """The order is there, with the expected status."""
    found = lookup(orders, order_id).agg(
        F.count(F.lit(1)).alias("orders"), F.max("status").alias("status")
    )
    return gate(found, {"orders": Expect(equals=1), "status": Expect(equals=status)})
