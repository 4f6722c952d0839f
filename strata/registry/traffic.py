"""Events as page views and as road sensor readings."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.functions.contracts import (
    check_messages, corridor_contract, dead_letters, encode, traffic_contract,
)
from strata.operators import traffic as ops
from strata.plans import corridors, site_traffic
from strata.registry.base import SQL_K, iso_text, prop_k, query, stream, table
from strata.registry.ingest import traffic_messages
from strata.session import scratch_path
from strata.sources import sinks
from strata.streaming import windows
from strata.streaming.panes import EARLY, LATE, ON_TIME, keyed_state
from strata.streaming.tables import declare_table, drain, every, table_rows


@query("traffic_by_user", f"""
SELECT CAST(user_id AS VARCHAR) AS user_id, count(*) AS page_views,
       CAST(sum({SQL_K}) AS BIGINT) AS bytes_sent, count(DISTINCT event_type) AS unique_paths
FROM events GROUP BY user_id""")
def traffic_by_user(spark, sf):
    return ops.user_traffic(traffic_messages(spark, sf))


@query("traffic_by_minute", f"""
SELECT strftime(date_trunc('minute', ts), '%Y-%m-%dT%H:%M:%S') || '+00:00' AS traffic_minute,
       count(*) AS page_views, CAST(sum({SQL_K}) AS BIGINT) AS bytes_sent,
       count(DISTINCT user_id) AS active_users FROM events GROUP BY 1""")
def traffic_by_minute(spark, sf):
    return ops.minute_traffic(traffic_messages(spark, sf))


@query("keyed_sum", f"""
SELECT event_type AS path, CAST(sum({SQL_K}) AS BIGINT) AS bytes_sent FROM events GROUP BY 1""")
def keyed_sum(spark, sf):
    return ops.sum_per_key(traffic_messages(spark, sf), "path", "bytes_sent")


@query("conservation_check", f"""
SELECT b.branch, m.metric, m.total AS branch_total, m.total AS source_total, true AS ok
FROM (VALUES ('by_user'), ('by_minute')) AS b(branch), (
  SELECT 'page_views' AS metric, count(*) AS total FROM events
  UNION ALL SELECT 'bytes_sent', CAST(sum({SQL_K}) AS BIGINT) FROM events) AS m""")
def conservation_check(spark, sf):
    """The whole job: JSON lines in, both outputs written, totals compared."""
    source = sinks.overwrite_json_lines(traffic_messages(spark, sf), scratch_path(spark, "views"))
    return site_traffic.run(spark, source, scratch_path(spark, "traffic")).conserved


# Readings: events are vehicles, their type the corridor; "error" is no corridor.
CORRIDORS = ("click", "purchase", "signup", "view")


def readings(spark, sf):
    """Events with known corridors as typed readings."""
    return table(spark, sf, "events").filter(F.col("event_type").isin(*CORRIDORS)).select(
        F.col("ts").cast("timestamp").alias("event_time"),
        F.col("event_type").alias("corridor"),
        prop_k().alias("speed_kph"),
    )


def sensor_messages(events):
    """Events as sensor payloads. The event's value decides what is wrong with some:
    no JSON, no speed, speed as text, with a fraction or negative, or no readable time.
    """
    value = F.col("value")
    k = F.get_json_object("props", "$.k")
    speed = (
        F.when(value < 5, F.lit(""))
        .when(value < 10, F.concat(F.lit(',"speed_kph":"'), k, F.lit('"')))
        .when(value < 15, F.concat(F.lit(',"speed_kph":'), k, F.lit(".5")))
        .when(value < 20, F.concat(F.lit(',"speed_kph":-1'), k))
        .otherwise(F.concat(F.lit(',"speed_kph":'), k))
    )
    when = F.when((value >= 20) & (value < 25), F.lit("yesterday")).otherwise(iso_text("ts"))
    body = F.concat(
        F.lit('{"event_id":"'), F.col("event_id"), F.lit('","event_time":"'), when,
        F.lit('","corridor":"'), F.col("event_type"), F.lit('"'), speed, F.lit("}"),
    )
    text = F.when(value >= 200, F.concat(F.lit("lost signal "), F.col("event_type"))).otherwise(body)
    return events.select(
        F.col("event_id").alias("source_id"), F.encode(text, "UTF-8").alias("value")
    )


SQL_ERRORS = f"""
WITH m AS (
  SELECT event_id, ts, event_type, value, {SQL_K} AS k,
    CASE WHEN value >= 200 THEN 'payload is not a JSON object'
         WHEN value < 5 THEN 'Missing fields: [''speed_kph'']'
         WHEN event_type = 'error' THEN 'Unknown corridor: error'
         WHEN value < 20 THEN 'speed_kph must be a non-negative integer'
         WHEN value < 25 THEN 'Invalid isoformat string: yesterday' END AS error
  FROM events
)
"""

SQL_WINDOWS = """
SELECT strftime(w, '%Y-%m-%dT%H:%M:%S') AS window_start,
       strftime(w + INTERVAL {width}, '%Y-%m-%dT%H:%M:%S') AS window_end,
       event_type AS corridor, count(*) AS vehicle_count,
       CAST(printf('%.2f', sum(k)::DOUBLE / count(*)) AS DOUBLE) AS average_speed_kph,
       max(k) AS max_speed_kph
FROM (SELECT *, time_bucket(INTERVAL {width}, ts, TIMESTAMP '1970-01-01') AS w FROM {source})
GROUP BY w, event_type
"""


@query("corridor_windows_batch", f"""
WITH m AS (SELECT ts, event_type, {SQL_K} AS k FROM events WHERE event_type <> 'error')
""" + SQL_WINDOWS.format(width="'6' HOUR", source="m"))
def corridor_windows_batch(spark, sf):
    return windows.corridor_metrics(readings(spark, sf), "6 hours")


@query("corridor_windows_stream", SQL_ERRORS + SQL_WINDOWS.format(
    width="'60' SECOND", source="(SELECT * FROM m WHERE error IS NULL)"))
def corridor_windows_stream(spark, sf):
    """Panes appended by the stream, reduced to every window's last one."""
    folder = scratch_path(spark, "corridors")
    corridors.declare(spark, folder)
    messages = sensor_messages(stream(spark, sf, "events"))
    drain(
        corridors.metrics_writer(messages, folder, CORRIDORS), scratch_path(spark, "checkpoint")
    )
    return corridors.final_metrics(spark, folder)


@query("dead_letters", SQL_ERRORS + """
SELECT event_id, error FROM m WHERE error IS NOT NULL""")
def dead_letters_batch(spark, sf):
    messages = sensor_messages(table(spark, sf, "events"))
    checked = check_messages(messages, corridor_contract(CORRIDORS))
    return checked.filter(F.col("error").isNotNull()).select(
        F.col("source_id").alias("event_id"), "error"
    )


@query("stamped_dead_letters", SQL_ERRORS + """
SELECT error, (SELECT strftime(max(ts), '%Y-%m-%d %H:%M:%S') FROM events) AS failed_at, count(*) AS messages
FROM m WHERE error IS NOT NULL GROUP BY error""")
def stamped_dead_letters(spark, sf):
    """A replay: refusals carry the time of the newest event instead of today's."""
    events = table(spark, sf, "events")
    checked = check_messages(sensor_messages(events), corridor_contract(CORRIDORS))
    newest = F.lit(events.agg(F.max(F.col("ts").cast("timestamp"))).first()[0])
    letters = dead_letters(checked, newest)
    return letters.groupBy("error", F.date_format("failed_at", "yyyy-MM-dd HH:mm:ss").alias("failed_at")).agg(
        F.count(F.lit(1)).alias("messages"))


@query("undecodable_messages", SQL_ERRORS + """
SELECT event_id, CASE WHEN event_id % 10 = 3 THEN 'payload is not valid UTF-8' ELSE error END AS error,
       event_id % 10 = 3 AS replaced FROM m WHERE event_id % 10 = 3 OR error IS NOT NULL""")
def undecodable_messages(spark, sf):
    """Every tenth message begins with a byte that no text has; its payload is kept with a mark for it."""
    messages = sensor_messages(table(spark, sf, "events"))
    body = F.col("value").cast("binary")
    spoilt = F.when(F.col("source_id") % 10 == 3, F.concat(F.unhex(F.lit("FF")), body)).otherwise(body)
    checked = check_messages(messages.withColumn("value", spoilt), corridor_contract(CORRIDORS))
    return checked.filter(F.col("error").isNotNull()).select(
        F.col("source_id").alias("event_id"), "error", F.col("payload").startswith("\ufffd").alias("replaced"))


@query("corridor_windows_triggered", SQL_ERRORS + SQL_WINDOWS.format(
    width="'60' SECOND", source="(SELECT * FROM m WHERE error IS NULL)"))
def corridor_windows_triggered(spark, sf):
    """The same windows by a stream that keeps running and fires panes every second."""
    folder = scratch_path(spark, "corridors")
    corridors.declare(spark, folder)
    messages = sensor_messages(stream(spark, sf, "events"))
    running = every(corridors.metrics_writer(messages, folder, CORRIDORS), scratch_path(spark, "checkpoint"), seconds=1)
    try:
        running.processAllAvailable()
    finally:
        running.stop()
    return corridors.final_metrics(spark, folder)


@query("dead_letters_stream", SQL_ERRORS + """
SELECT error, count(*) AS messages FROM m WHERE error IS NOT NULL GROUP BY error""")
def dead_letters_stream(spark, sf):
    folder = scratch_path(spark, "corridors")
    corridors.declare(spark, folder)
    messages = sensor_messages(stream(spark, sf, "events")).select("value")
    drain(
        corridors.dead_letter_writer(messages, folder, CORRIDORS), scratch_path(spark, "checkpoint")
    )
    return corridors.refused(spark, folder).groupBy("error").agg(
        F.count(F.lit(1)).alias("messages")
    )


@query("corridor_completeness", SQL_ERRORS + """
SELECT count(DISTINCT event_type) FILTER (error IS NULL) AS corridor_count,
       count(*) FILTER (error IS NULL) AS vehicle_count,
       count(*) FILTER (error IS NOT NULL) AS invalid_count FROM m""")
def corridor_completeness(spark, sf):
    """Everything sent is in the windows or among the dead letters."""
    folder = scratch_path(spark, "corridors")
    corridors.declare(spark, folder)
    for writer in (corridors.metrics_writer, corridors.dead_letter_writer):
        messages = sensor_messages(stream(spark, sf, "events")).select("value")
        drain(writer(messages, folder, CORRIDORS), scratch_path(spark, "checkpoint"))
    return corridors.completeness(spark, folder)


@query("late_panes", SQL_ERRORS + f"""
, b AS (
  SELECT *, date_trunc('hour', ts) AS w, CASE WHEN event_id % 5 = 0 THEN 3 WHEN epoch_us(ts) < (
    SELECT (min(epoch_us(ts)) + max(epoch_us(ts))) // 2 FROM events) THEN 1 ELSE 2 END AS delivery
  FROM m WHERE error IS NULL
), k AS (
  SELECT * FROM b WHERE delivery < 3 OR epoch_ms(w + INTERVAL 1 HOUR) > (
    SELECT epoch_ms(max(ts)) - 120000 FROM b WHERE delivery < 3)
)
SELECT strftime(w, '%Y-%m-%dT%H:%M:%S') AS window_start, event_type AS corridor,
       count(*) AS vehicle_count, max(k) AS max_speed_kph, count(DISTINCT delivery) AS panes
FROM k GROUP BY w, event_type""")
def late_panes(spark, sf):
    """Three deliveries: the earlier half, the later half, and a fifth of the events that
    comes after both, mostly too late. A window that several deliveries change has as many
    panes; late events of closed windows are dropped.
    """
    events, folder = table(spark, sf, "events"), scratch_path(spark, "corridors")
    corridors.declare(spark, folder)
    source, checkpoint = scratch_path(spark, "deliveries"), scratch_path(spark, "checkpoint")
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    low, high = events.agg(F.min(micros), F.max(micros)).first()
    late, early = F.pmod("event_id", F.lit(5)) == 0, micros < (low + high) // 2
    for delivery in (~late & early, ~late & ~early, late):
        sent = sensor_messages(events.filter(delivery)).select("value")
        sent.write.mode("append").parquet(source)
        messages = spark.readStream.schema(sent.schema).parquet(source)
        drain(corridors.metrics_writer(messages, folder, CORRIDORS, window="1 hour"), checkpoint)
    panes = corridors.panes(spark, folder).groupBy("window_start", "corridor").agg(
        F.count(F.lit(1)).alias("panes"))
    final = corridors.final_metrics(spark, folder)
    return final.join(panes, ["window_start", "corridor"]).select(
        "window_start", "corridor", "vehicle_count", "max_speed_kph", "panes")


@query("fired_panes", SQL_ERRORS + """
, b AS (
  SELECT *, date_trunc('hour', ts) AS w, epoch_ms(date_trunc('hour', ts)) + 3600000 AS stop,
    CASE WHEN event_id % 7 = 0 THEN 3 WHEN epoch_us(ts) < (
      SELECT (min(epoch_us(ts)) + max(epoch_us(ts))) // 2 FROM events) THEN 1 ELSE 2 END AS delivery
  FROM m WHERE error IS NULL
), d AS (
  SELECT delivery, max(max(epoch_ms(ts))) OVER (ORDER BY delivery ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mark
  FROM b GROUP BY delivery
), c AS (
  SELECT b.*, CASE WHEN mark IS NULL OR mark < stop THEN 'open' WHEN mark < stop + 7200000 THEN 'late' END AS state
  FROM b JOIN d USING (delivery)
)
SELECT *, early + on_time + late AS last_number FROM (
SELECT strftime(w, '%Y-%m-%dT%H:%M:%S') AS window_start, event_type AS corridor, count(*) AS vehicle_count,
       CAST(printf('%.2f', sum(k)::DOUBLE / count(*)) AS DOUBLE) AS average_speed_kph, max(k) AS max_speed_kph,
       count(DISTINCT delivery) FILTER (state = 'open') AS early,
       CAST(bool_or(state = 'open') AND any_value(stop) <= (SELECT max(epoch_ms(ts)) FROM b) AS BIGINT) AS on_time,
       count(*) FILTER (state = 'late') AS late
FROM c WHERE state IS NOT NULL GROUP BY w, event_type)""")
def fired_panes(spark, sf):
    """Three deliveries, the stream started anew for each: the earlier half, the later half, and a
    seventh of the events after both. Panes of every window by kind, and its last totals."""
    events, folder = table(spark, sf, "events"), scratch_path(spark, "corridors")
    declare_table(spark, f"{folder}/corridor_panes", corridors.PANES_SCHEMA)
    source, checkpoint = scratch_path(spark, "deliveries"), scratch_path(spark, "checkpoint")
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    low, high = events.agg(F.min(micros), F.max(micros)).first()
    last, early = F.pmod("event_id", F.lit(7)) == 0, micros < (low + high) // 2
    for delivery in (~last & early, ~last & ~early, last):
        sent = sensor_messages(events.filter(delivery)).select("value")
        sent.write.mode("append").parquet(source)
        messages = spark.readStream.schema(sent.schema).parquet(source)
        with keyed_state(spark):
            drain(corridors.panes_writer(messages, folder, CORRIDORS, 3600, 7200, 0), checkpoint)
    fired = table_rows(spark, f"{folder}/corridor_panes")
    kinds = [F.count_if(F.col("pane_kind") == kind).alias(kind) for kind in (EARLY, ON_TIME, LATE)]
    totals = ("vehicle_count", "average_speed_kph", "max_speed_kph")
    newest = F.max_by(F.struct(*totals), "pane_number")
    return fired.groupBy("window_start", "corridor").agg(
        newest.alias("newest"), *kinds, F.max("pane_number").cast("long").alias("last_number")).select(
        "window_start", "corridor", *[f"newest.{c}" for c in totals], EARLY, ON_TIME, LATE, "last_number")


def panes(spark, sf):
    """Every event as a pane of its hour and type; later events are later panes."""
    return table(spark, sf, "events").select(
        F.date_format(F.date_trunc("hour", "ts"), "yyyy-MM-dd'T'HH:mm:ss").alias("window_start"),
        F.col("event_type").alias("corridor"),
        prop_k().alias("vehicle_count"),
        F.col("event_id").alias("pane"),
    )


SQL_PANES = f"""
WITH p AS (
  SELECT strftime(date_trunc('hour', ts), '%Y-%m-%dT%H:%M:%S') AS window_start,
         event_type AS corridor, {SQL_K} AS vehicle_count, event_id AS pane FROM events
), latest AS (
  SELECT * FROM p
  QUALIFY row_number() OVER (PARTITION BY window_start, corridor ORDER BY pane DESC) = 1
)
"""


@query("latest_pane", SQL_PANES + "SELECT * FROM latest")
def latest_pane(spark, sf):
    return windows.latest_panes(panes(spark, sf), pane="pane")


@query("corridor_progress", SQL_PANES + """
SELECT corridor, count(*) AS windows, CAST(sum(vehicle_count) AS BIGINT) AS vehicle_count
FROM latest GROUP BY corridor""")
def corridor_progress(spark, sf):
    return windows.corridor_progress(panes(spark, sf), pane="pane")


@query("message_encoding", f"""
SELECT CAST(event_id AS VARCHAR) AS event_id, event_type AS path, {SQL_K} AS bytes_sent,
       CAST(NULL AS VARCHAR) AS error FROM events""")
def message_encoding(spark, sf):
    """Rows to compact key-sorted JSON bytes and back through the contract."""
    encoded = encode(traffic_messages(spark, sf), sort_keys=True)
    checked = check_messages(encoded.withColumn("value", F.encode("value", "UTF-8")),
                             traffic_contract())
    return checked.select("event_id", "path", "bytes_sent", "error")
