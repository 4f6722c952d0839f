"""Events as weather observations; the event type is the city."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.functions.times import instant, plain
from strata.operators import views as ops
from strata.plans import weather as plan
from strata.registry.base import prop_k, query, stream, table
from strata.session import scratch_path
from strata.sources.messages import normalise_observations
from strata.streaming import rollups
from strata.streaming.tables import drain

DAY = 86400  # seconds


def observations(events):
    return events.select(
        F.col("ts").cast("timestamp").alias("observed_at"),
        (F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("value")))
        .cast("timestamp").alias("published_at"),
        F.col("event_type").alias("city"),
        F.upper("event_type").alias("country"),
        (F.col("user_id") / 10).alias("latitude"),
        (F.col("user_id") / 20).alias("longitude"),
        F.col("value").alias("temperature_c"),
        prop_k().alias("relative_humidity"),
        (F.col("value") / 4).alias("wind_speed_kmh"),
        F.col("event_id").alias("weather_code"),
    )


SQL_OBSERVED = """
WITH w AS (
  SELECT ts AS observed_at, event_type AS city, upper(event_type) AS country,
    user_id / 10 AS latitude, user_id / 20 AS longitude, value AS temperature_c,
    CAST(json_extract_string(props, '$.k') AS BIGINT) AS relative_humidity,
    value / 4 AS wind_speed_kmh, event_id AS weather_code, value FROM events
)
"""


@query("latest_per_key", SQL_OBSERVED + """
SELECT * EXCLUDE (value) FROM w
QUALIFY row_number() OVER (PARTITION BY city ORDER BY observed_at DESC, value DESC) = 1""")
def latest_per_key(spark, sf):
    latest = ops.latest_observations(observations(table(spark, sf, "events")))
    return latest.withColumn("observed_at", plain(F.col("observed_at")))


SQL_TRENDS = SQL_OBSERVED + """
SELECT date_trunc('minute', observed_at) AS observation_minute, city, any_value(country) AS country,
       round(avg(temperature_c), 9) AS avg_temperature_c,
       round(avg(relative_humidity), 9) AS avg_relative_humidity,
       round(avg(wind_speed_kmh), 9) AS avg_wind_speed_kmh
FROM w WHERE observed_at >= (SELECT max(observed_at) FROM w) - INTERVAL 7 DAY GROUP BY 1, 2"""


@query("minute_trends", SQL_TRENDS)
def minute_trends(spark, sf):
    trends = ops.observation_trends(observations(table(spark, sf, "events")), "7 DAYS")
    rounded = trends.withColumns(
        {c: F.round(c, 9) for c in trends.columns if c.startswith("avg_")}
    )
    return rounded.withColumn("observation_minute", plain(F.col("observation_minute")))


@query("minute_trends_kept", SQL_TRENDS)
def minute_trends_kept(spark, sf):
    """Partial aggregates of several batches, merged for the last seven days."""
    source, observed = scratch_path(spark, "observed"), observations(table(spark, sf, "events"))
    observed.repartition(3).write.parquet(source)
    path = rollups.declare(spark, rollups.trends_rollup(DAY), scratch_path(spark, "rollup"), observed.schema)
    arriving = spark.readStream.schema(observed.schema).option("maxFilesPerTrigger", 1).parquet(source)
    drain(rollups.keep(arriving, rollups.trends_rollup(DAY), path), scratch_path(spark, "checkpoint"))
    trends = rollups.observation_trends(spark, path, 7 * DAY, width=DAY)
    rounded = trends.withColumns({c: F.round(c, 9) for c in trends.columns if c.startswith("avg_")})
    return rounded.withColumn("observation_minute", plain(F.col("observation_minute")))


SQL_PROGRESS = SQL_OBSERVED + """
SELECT city, count(*) AS event_count, max(observed_at) AS latest FROM w GROUP BY city"""


@query("per_key_progress", SQL_PROGRESS)
def per_key_progress(spark, sf):
    progress = ops.city_progress(observations(table(spark, sf, "events")))
    return progress.withColumn("latest", plain(F.col("latest")))


@query("raw_table_stream", SQL_PROGRESS)
def raw_table_stream(spark, sf):
    """A stream delivered into day folders and read back."""
    path = scratch_path(spark, "weather")
    observed = observations(stream(spark, sf, "events"))
    drain(plan.raw_table_writer(observed, path), scratch_path(spark, "checkpoint"))
    progress = ops.city_progress(plan.raw_table(spark, path))
    return progress.withColumn("latest", plain(F.col("latest")))


@query("weather_normalised", """
SELECT weather_code, city, country, latitude, longitude, temperature_c, relative_humidity,
       wind_speed_kmh,
       CASE WHEN city = 'click' THEN strftime(t, '%Y-%m-%dT%H:%M:00Z')
            ELSE strftime(t, '%Y-%m-%dT%H:%M:%SZ') END AS observed_at,
       CASE WHEN city = 'click' THEN date_trunc('minute', t) ELSE date_trunc('second', t) END
         AS observed_time
FROM (SELECT event_id AS weather_code, event_type AS city, upper(event_type) AS country,
             avg(user_id) OVER (PARTITION BY event_type) AS latitude,
             CAST(count(*) OVER (PARTITION BY event_type) AS DOUBLE) AS longitude,
             value AS temperature_c, CAST(json_extract_string(props, '$.k') AS BIGINT)
               AS relative_humidity, value / 4 AS wind_speed_kmh, ts AS t FROM events)""")
def weather_normalised(spark, sf):
    """Times arrive as minutes, as seconds without zone, and complete."""
    events = table(spark, sf, "events")
    kind = F.col("event_type")
    time = (
        F.when(kind == "click", F.date_format("ts", "yyyy-MM-dd'T'HH:mm"))
        .when(kind == "view", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    )
    readings = events.select(
        kind.alias("city"),
        time.alias("time"),
        F.col("value").alias("temperature_2m"),
        prop_k().alias("relative_humidity_2m"),
        (F.col("value") / 4).alias("wind_speed_10m"),
        F.col("event_id").alias("weather_code"),
    )
    cities = events.groupBy(kind.alias("city")).agg(
        F.upper(F.max("event_type")).alias("country"),
        F.avg("user_id").alias("latitude"),
        F.count(F.lit(1)).cast("double").alias("longitude"),
    )
    normalised = normalise_observations(readings, cities).drop("published_at")
    return normalised.withColumn("observed_time", plain(instant(F.col("observed_at"))))
