"""Events as match events, customers as player profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.functions.times import plain
from strata.operators import views as ops
from strata.operators.enrich import enrich, store_profiles
from strata.plans import gameplay
from strata.registry.base import SQL_K, iso_text, prop_k, query, stream, table
from strata.session import scratch_path
from strata.sources.sinks import create_view
from strata.streaming import rollups
from strata.streaming.panes import keyed_state
from strata.streaming.tables import drain

DAY = 86400  # seconds


def match_events(events, event_time=None):
    """Signups are chat messages, purchases kills, clicks assists. Not every player, seven
    times the user, has a profile.
    """
    kind = F.col("event_type")
    chat = kind == "signup"
    return events.select(
        F.col("event_id").cast("string").alias("event_id"),
        (iso_text("ts") if event_time is None else event_time).alias("event_time"),
        F.concat(F.lit("match-"), F.dayofmonth("ts")).alias("match_id"),
        (F.col("user_id") * 7).cast("string").alias("player_id"),
        F.when(chat, "chat").otherwise("gameplay").alias("event_type"),
        F.when(chat, "message").when(kind == "purchase", "kill").when(kind == "click", "assist")
        .otherwise("objective").alias("action"),
        F.when(chat, 0).otherwise(prop_k()).cast("bigint").alias("score_delta"),
        F.when(chat, F.col("props")).alias("message"),
    )


def profiles(spark, sf):
    """Customers as profiles; a negative balance leaves attributes missing."""
    balance = F.col("c_acctbal")
    return table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("player_id"),
        F.col("c_name").alias("display_name"),
        F.when(balance >= 0, F.col("c_mktsegment")).alias("team"),
        F.col("c_nationkey").cast("string").alias("region"),
        F.when(balance >= 2000, "Master").when(balance >= 0, "Diamond").alias("rank"),
    )


def enriched(spark, sf):
    """Enriched events with their time as stored, so that time filters stay simple."""
    events = match_events(table(spark, sf, "events"), F.col("ts").cast("timestamp"))
    return enrich(events, profiles(spark, sf), stamp=False)


def now(spark, sf):
    """The newest event's time, from the events alone."""
    return table(spark, sf, "events").agg(F.max(F.col("ts").cast("timestamp"))).scalar()


SQL_EVENTS = f"""
WITH e AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id, ts AS event_time,
    'match-' || day(ts) AS match_id, CAST(user_id * 7 AS VARCHAR) AS player_id,
    CASE WHEN event_type = 'signup' THEN 'chat' ELSE 'gameplay' END AS event_type,
    CASE event_type WHEN 'signup' THEN 'message' WHEN 'purchase' THEN 'kill'
         WHEN 'click' THEN 'assist' ELSE 'objective' END AS action,
    CASE WHEN event_type = 'signup' THEN 0 ELSE {SQL_K} END AS score_delta,
    CASE WHEN event_type = 'signup' THEN props END AS message
  FROM events
), p AS (
  SELECT CAST(c_custkey AS VARCHAR) AS player_id, c_name AS display_name,
    CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS team,
    CAST(c_nationkey AS VARCHAR) AS region,
    CASE WHEN c_acctbal >= 2000 THEN 'Master' WHEN c_acctbal >= 0 THEN 'Diamond' END AS rank
  FROM customer
), x AS (
  SELECT e.*, coalesce(display_name, 'unknown') AS display_name, coalesce(team, 'unknown') AS team,
    coalesce(region, 'unknown') AS region, coalesce(rank, 'unknown') AS rank
  FROM e LEFT JOIN p USING (player_id)
), recent AS (
  SELECT * FROM x WHERE event_time >= (SELECT max(event_time) FROM x) - INTERVAL 24 HOUR
), board AS (
  SELECT player_id, any_value(display_name) AS display_name, any_value(team) AS team,
    any_value(region) AS region, any_value(rank) AS rank, CAST(sum(score_delta) AS BIGINT) AS score,
    count(*) FILTER (action = 'kill') AS kills, count(*) FILTER (action = 'assist') AS assists,
    max(event_time) AS last_event FROM recent GROUP BY player_id
), chat AS (
  SELECT event_id, event_time, match_id, display_name, team, region, message
  FROM recent WHERE event_type = 'chat' ORDER BY event_time DESC, event_id DESC LIMIT 20
)
"""


@query("profile_enrichment", SQL_EVENTS + "SELECT * FROM x")
def profile_enrichment(spark, sf):
    rows = enriched(spark, sf)
    return rows.withColumn("event_time", plain(F.col("event_time")))


@query("stream_enrichment", SQL_EVENTS + "SELECT * FROM x")
def stream_enrichment(spark, sf):
    """JSON messages parsed, enriched and appended by a stream."""
    folder = scratch_path(spark, "gameplay")
    gameplay.declare(spark, folder)
    events = match_events(stream(spark, sf, "events"))
    body = F.to_json(F.struct(*events.columns), {"ignoreNullFields": "false"})
    messages = events.select(F.encode(body, "UTF-8").alias("value"))
    drain(
        gameplay.writer(messages, lambda: profiles(spark, sf), folder),
        scratch_path(spark, "checkpoint"),
    )
    rows = gameplay.enriched(spark, folder).drop("processed_at")
    return rows.withColumn("event_time", plain(F.col("event_time")))


@query("stream_enrichment_as_of", SQL_EVENTS + f"""
, v AS (
  SELECT CAST(user_id * 7 AS VARCHAR) AS player_id, ts, 'name-' || event_id AS display_name,
    CASE WHEN {SQL_K} % 3 > 0 THEN 'team-' || ({SQL_K} % 10) END AS team, 'region-' || (event_id % 5) AS region,
    CASE WHEN {SQL_K} % 2 = 0 THEN 'Master' ELSE 'Diamond' END AS rank
  FROM events WHERE event_type = 'signup'
  QUALIFY row_number() OVER (PARTITION BY user_id, ts ORDER BY 'name-' || event_id DESC) = 1
)
SELECT e.*, coalesce(v.display_name, 'unknown') AS display_name, coalesce(v.team, 'unknown') AS team,
       coalesce(v.region, 'unknown') AS region, coalesce(v.rank, 'unknown') AS rank
FROM e ASOF LEFT JOIN v ON e.player_id = v.player_id AND e.event_time >= v.ts
WHERE epoch_ms(e.event_time) <= (SELECT epoch_ms(max(ts)) - 120000 FROM events)""")
def stream_enrichment_as_of(spark, sf):
    """Every signup is a new version of its player's profile; events and versions come in two
    deliveries, the stream started anew for each. Events beyond the last watermark still wait.
    """
    events, folder = table(spark, sf, "events"), scratch_path(spark, "gameplay")
    gameplay.declare(spark, folder)
    sources = {name: scratch_path(spark, name) for name in ("matches", "versions")}
    micros, checkpoint = F.unix_micros(F.col("ts").cast("timestamp")), scratch_path(spark, "checkpoint")
    low, high = events.agg(F.min(micros), F.max(micros)).first()
    for first in (True, False):
        part = events.filter((micros < (low + high) // 2) == first)
        matches = match_events(part)
        body = F.to_json(F.struct(*matches.columns), {"ignoreNullFields": "false"})
        sent = {"matches": matches.select(F.encode(body, "UTF-8").alias("value")),
                "versions": part.filter("event_type = 'signup'").select(
                    (F.col("user_id") * 7).cast("string").alias("player_id"),
                    F.col("ts").cast("timestamp").alias("valid_from"),
                    F.concat(F.lit("name-"), "event_id").alias("display_name"),
                    F.when(prop_k() % 3 > 0, F.concat(F.lit("team-"), (prop_k() % 10).cast("string"))).alias("team"),
                    F.concat(F.lit("region-"), (F.col("event_id") % 5).cast("string")).alias("region"),
                    F.when(prop_k() % 2 == 0, "Master").otherwise("Diamond").alias("rank"))}
        for name, frame in sent.items():
            frame.write.mode("append").parquet(sources[name])
        messages, versions = (spark.readStream.schema(sent[n].schema).parquet(sources[n]) for n in sources)
        with keyed_state(spark):
            drain(gameplay.as_of_writer(messages, versions, folder), checkpoint)
    rows = gameplay.enriched(spark, folder).drop("processed_at")
    return rows.withColumn("event_time", plain(F.col("event_time")))


@query("leaderboard", SQL_EVENTS + "SELECT * FROM board")
def leaderboard(spark, sf):
    board = ops.ordered_leaderboard(ops.leaderboard(enriched(spark, sf), "24 HOURS", now(spark, sf)))
    return board.withColumn("last_event", plain(F.col("last_event")))


@query("leaderboard_kept", SQL_EVENTS + "SELECT * FROM board")
def leaderboard_kept(spark, sf):
    """Partial aggregates of several batches, merged for the last 24 hours."""
    source, events = scratch_path(spark, "enriched"), enriched(spark, sf)
    events.repartition(3).write.parquet(source)
    path = rollups.declare(spark, rollups.leaderboard_rollup(DAY), scratch_path(spark, "rollup"), events.schema)
    arriving = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(source)
    drain(rollups.keep(arriving, rollups.leaderboard_rollup(DAY), path), scratch_path(spark, "checkpoint"))
    board = rollups.leaderboard(spark, path, DAY, width=DAY)
    return board.withColumn("last_event", plain(F.col("last_event")))


@query("recent_messages", SQL_EVENTS + "SELECT * FROM chat")
def recent_messages(spark, sf):
    messages = ops.recent_messages(ops.chat_messages(enriched(spark, sf), "24 HOURS", now(spark, sf)))
    return messages.withColumn("event_time", plain(F.col("event_time")))


@query("dashboard_rollup", SQL_EVENTS + """
SELECT count(*) AS active_players, CAST(coalesce(sum(score), 0) AS BIGINT) AS total_score,
       (SELECT count(*) FROM chat) AS recent_messages FROM board""")
def dashboard_rollup(spark, sf):
    events, newest = enriched(spark, sf), now(spark, sf)
    return ops.dashboard_rollup(
        ops.leaderboard(events, "24 HOURS", newest), ops.chat_messages(events, "24 HOURS", newest)
    )


@query("stream_health", SQL_EVENTS + """
SELECT count(*) AS event_count, count(*) FILTER (event_type = 'chat') AS chat_count,
       count(DISTINCT player_id) AS player_count,
       count(*) FILTER (display_name = 'unknown') AS unknown_profiles FROM x""")
def stream_health(spark, sf):
    return ops.stream_health(enriched(spark, sf))


@query("gameplay_verify", SQL_EVENTS + """
SELECT 'event_count' AS metric, 'at least 100' AS expected, CAST(count(*) AS VARCHAR) AS actual, count(*) >= 100 AS ok
FROM x
UNION ALL SELECT 'unknown_profiles', 'equals 0', CAST(count(*) FILTER (display_name = 'unknown') AS VARCHAR),
  count(*) FILTER (display_name = 'unknown') = 0 FROM x""")
def gameplay_verify(spark, sf):
    return gameplay.verify(enriched(spark, sf), 100)


@query("profile_seed", """
SELECT CAST(user_id AS VARCHAR) AS player_id, event_type AS team, props AS rank FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1""")
def profile_seed(spark, sf):
    """Many versions per key; the newest one is stored as the profile."""
    versions = table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("player_id"),
        F.col("event_type").alias("team"),
        F.col("props").alias("rank"),
        "event_id",
    )
    path = scratch_path(spark, "profiles")
    store_profiles(versions, "player_id", "event_id", path)
    return spark.read.parquet(path)


@query("stored_views", SQL_EVENTS + """
SELECT team, count(*) AS players, CAST(sum(score) AS BIGINT) AS score, (SELECT count(*) FROM recent
  WHERE event_type = 'chat') AS messages FROM board GROUP BY team""")
def stored_views(spark, sf):
    """Leaderboard and chat stored as views and queried by name."""
    events, newest = enriched(spark, sf), now(spark, sf)
    create_view(ops.leaderboard(events, "24 HOURS", newest), "live_leaderboard")
    create_view(ops.chat_messages(events, "24 HOURS", newest), "live_chat")
    by_team = spark.sql(
        "SELECT team, count(*) AS players, sum(score) AS score, "
        "(SELECT count(*) FROM live_chat) AS messages FROM live_leaderboard GROUP BY team"
    )
    for name in ("live_leaderboard", "live_chat"):
        spark.catalog.dropTempView(name)  # the frame is resolved already
    return by_team
