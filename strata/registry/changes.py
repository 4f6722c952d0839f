"""Customers as a replica, events as its change log."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.operators import merge as ops
from strata.plans import orders_replica
from strata.registry.base import query, table
from strata.session import scratch_path
from strata.streaming import bucketed, replica
from strata.streaming.tables import declare_table, drain

CHANGE_SCHEMA = (
    "order_id bigint, customer_name string, status string, amount double, op string, seq bigint"
)


def snapshot(spark, sf):
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("order_id"),
        F.col("c_name").alias("customer_name"),
        F.col("c_mktsegment").alias("status"),
        F.col("c_acctbal").alias("amount"),
    )


def changes(events):
    """Every event changes the row of eleven times its user: signups insert, errors
    delete, others update. Some keys are new to the replica.
    """
    kind = F.col("event_type")
    return events.select(
        (F.col("user_id") * 11).alias("order_id"),
        F.concat(F.lit("user "), F.col("user_id")).alias("customer_name"),
        kind.alias("status"),
        F.col("value").alias("amount"),
        F.when(kind == "signup", ops.INSERT).when(kind == "error", ops.DELETE)
        .otherwise(ops.UPDATE).alias("op"),
        F.col("event_id").alias("seq"),
    )


SQL_CHANGES = """
WITH s AS (
  SELECT c_custkey AS order_id, c_name AS customer_name, c_mktsegment AS status,
         c_acctbal AS amount FROM customer
), l AS (
  SELECT user_id * 11 AS order_id, 'user ' || user_id AS customer_name, event_type AS status,
         value AS amount FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1
)
"""
SQL_REPLICA = SQL_CHANGES + """
SELECT * FROM l WHERE status <> 'error'
UNION ALL SELECT * FROM s WHERE order_id NOT IN (SELECT order_id FROM l)"""
KEYS = ["order_id"]


@query("cdc_apply", SQL_REPLICA)
def cdc_apply(spark, sf):
    return ops.apply_changes(snapshot(spark, sf), changes(table(spark, sf, "events")), KEYS)


def arrive(spark, log, source, path, checkpoint):
    """Change rows come as two more files, a micro-batch each, and are collected."""
    log.repartition(2).write.mode("append").parquet(source)
    files = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(source)
    drain(replica.collect_changes(files, KEYS, path), checkpoint)


@query("cdc_replica_stream", SQL_REPLICA)
def cdc_replica_stream(spark, sf):
    """Changes collected by a stream and applied when the replica is read."""
    path = declare_table(spark, scratch_path(spark, "changes"), CHANGE_SCHEMA)
    source, checkpoint = scratch_path(spark, "change-log"), scratch_path(spark, "checkpoint")
    arrive(spark, changes(table(spark, sf, "events")), source, path, checkpoint)
    return replica.replica(spark, replica.Snapshot(snapshot(spark, sf)), path, KEYS)


ARRIVALS = ("pmod(seq, 3) = 1", "pmod(seq, 3) <> 1")


@query("cdc_replica_compacted", SQL_REPLICA)
def cdc_replica_compacted(spark, sf):
    """Changes collected in several batches, out of order, and compacted in between: the
    second snapshot is the first one and the batches after it.
    """
    path = declare_table(spark, scratch_path(spark, "changes"), CHANGE_SCHEMA)
    source, checkpoint = scratch_path(spark, "change-log"), scratch_path(spark, "checkpoint")
    log = changes(table(spark, sf, "events"))
    current = replica.Snapshot(snapshot(spark, sf))
    for arrived in ARRIVALS:
        arrive(spark, log.filter(arrived), source, path, checkpoint)
        current = replica.compact(spark, current, path, KEYS, scratch_path(spark, "replica"))
    return current.rows


@query("cdc_replica_bucketed", SQL_REPLICA)
def cdc_replica_bucketed(spark, sf):
    """The same over a replica stored by buckets: a compaction after the first arrivals, which
    rewrites the buckets that changed, later changes applied when it is read.
    """
    path = declare_table(spark, scratch_path(spark, "changes"), CHANGE_SCHEMA)
    source, checkpoint = scratch_path(spark, "change-log"), scratch_path(spark, "checkpoint")
    log = changes(table(spark, sf, "events"))
    store = bucketed.create(spark, snapshot(spark, sf), KEYS, scratch_path(spark, "replica"), buckets=16)
    first, second = ARRIVALS
    arrive(spark, log.filter(first), source, path, checkpoint)
    store = bucketed.compact(spark, store, path)
    arrive(spark, log.filter(second), source, path, checkpoint)
    return bucketed.rows(spark, store, path)


@query("replica_verify", SQL_CHANGES + """
, r AS (SELECT * FROM l WHERE status <> 'error' UNION ALL SELECT * FROM s WHERE order_id NOT IN (SELECT order_id FROM l)),
f AS (SELECT * FROM r WHERE order_id = (SELECT max(order_id) FROM l WHERE status = 'click'))
SELECT 'orders' AS metric, 'equals 1' AS expected, CAST(count(*) AS VARCHAR) AS actual, count(*) = 1 AS ok FROM f
UNION ALL SELECT 'status', 'equals purchase', max(status), max(status) = 'purchase' FROM f""")
def replica_verify(spark, sf):
    """One order looked up in the replica; its status is another one than demanded."""
    log = changes(table(spark, sf, "events"))
    current = ops.apply_changes(snapshot(spark, sf), log, KEYS)
    clicked = ops.latest_changes(log, KEYS).filter("status = 'click'").agg(F.max("order_id")).first()[0]
    return orders_replica.verify(current, clicked, "purchase")


def incoming(spark, sf):
    """The last change per key as plain rows."""
    return ops.latest_changes(changes(table(spark, sf, "events")), KEYS).drop("op", "seq")


@query("upsert_update", SQL_CHANGES + """
SELECT * FROM l UNION ALL SELECT * FROM s WHERE order_id NOT IN (SELECT order_id FROM l)""")
def upsert_update(spark, sf):
    return ops.upsert(snapshot(spark, sf), incoming(spark, sf), KEYS)


@query("upsert_ignore", SQL_CHANGES + """
SELECT * FROM s UNION ALL SELECT * FROM l WHERE order_id NOT IN (SELECT order_id FROM s)""")
def upsert_ignore(spark, sf):
    return ops.insert_absent(snapshot(spark, sf), incoming(spark, sf), KEYS)
