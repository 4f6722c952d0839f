"""Views kept up to date: every micro-batch adds partial aggregates by key and time bucket.

A trailing view merges the partial rows of the buckets inside its interval. Only the bucket
in which the interval begins is read row by row, so the view is exact to the microsecond and
no read passes over history. Rows and partial rows lie in folders by bucket; late rows join
their own bucket, and a repeated batch replaces what it wrote.

Rows without a time are stored and in no view; an empty table gives empty views.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StructType

from strata.operators.enrich import PROFILE_COLUMNS
from strata.streaming.tables import BATCH, WRITER, batch_folder, each_batch

BUCKET = "bucket"
ROWS, PARTIALS, NEWEST = "rows", "partials", "newest"
NOTHING = f"{WRITER}=declared/{BATCH}=-1/{BUCKET}=-1"


@dataclass(frozen=True)
class Measure:
    """A partial aggregate of rows, and the aggregate that merges partial values."""

    rows: Column
    merge: Callable[[str], Column]


@dataclass(frozen=True)
class Rollup:
    """What is kept: ``measures`` per ``keys`` and bucket of ``width`` seconds of ``time``."""

    time: str
    width: int
    keys: dict[str, Column]
    measures: dict[str, Measure]

    def bucket(self) -> Column:
        micros = F.unix_micros(self.time)
        return F.floor((micros - F.pmod(micros, F.lit(self.width * 1_000_000))) / F.lit(self.width * 1_000_000)).cast("long")

    def partial(self, rows: DataFrame) -> DataFrame:
        """Partial rows per ``keys`` and bucket; ``rows`` have their bucket."""
        keys = [c.alias(n) for n, c in self.keys.items()]
        return rows.groupBy(BUCKET, *keys).agg(*[m.rows.alias(n) for n, m in self.measures.items()])


def declare(spark: SparkSession, rollup: Rollup, path: str, schema: str | StructType) -> str:
    """Create the empty tables of a rollup."""
    rows = spark.createDataFrame([], schema)
    partial = rollup.partial(rows.withColumn(BUCKET, rollup.bucket())).drop(BUCKET)
    for name, frame in ((ROWS, rows), (PARTIALS, partial)):
        spark.createDataFrame([], frame.schema).write.mode("errorifexists").parquet(f"{path}/{name}/{NOTHING}")
    spark.createDataFrame([], f"{NEWEST} timestamp").write.mode("errorifexists").parquet(f"{path}/{NEWEST}/{NOTHING}")
    return path


def _read(spark: SparkSession, path: str, name: str) -> DataFrame:
    schema = spark.read.option("basePath", f"{path}/{name}/{NOTHING}").parquet(f"{path}/{name}/{NOTHING}").schema
    whole = StructType(schema.fields).add(WRITER, "string").add(BATCH, "long").add(BUCKET, "long")
    return spark.read.schema(whole).parquet(f"{path}/{name}").drop(WRITER, BATCH)


def add_batch(batch: DataFrame, batch_id: int, rollup: Rollup, path: str) -> None:
    """Store a micro-batch and its partial rows; the batch itself is computed once."""
    spark = batch.sparkSession
    have = {f.name: f.dataType for f in _read(spark, path, ROWS).drop(BUCKET).schema}
    got = {f.name: f.dataType for f in batch.schema}
    if have != got:
        raise ValueError(f"Declared columns {have} differ from {got}")
    folder = batch_folder(batch, batch_id, f"{path}/{ROWS}")
    batch.select(*have).withColumn(BUCKET, rollup.bucket()).write.mode("overwrite").partitionBy(BUCKET).parquet(folder)
    schema = StructType(_read(spark, path, ROWS).schema.fields)
    stored = spark.read.schema(schema).parquet(folder)
    partial = rollup.partial(stored.filter(F.col(BUCKET).isNotNull()))
    partial.write.mode("overwrite").partitionBy(BUCKET).parquet(batch_folder(batch, batch_id, f"{path}/{PARTIALS}"))
    newest = stored.agg(F.max(rollup.time).alias(NEWEST)).withColumn(BUCKET, F.lit(0))
    newest.write.mode("overwrite").partitionBy(BUCKET).parquet(batch_folder(batch, batch_id, f"{path}/{NEWEST}"))


def keep(rows: DataFrame, rollup: Rollup, path: str) -> DataStreamWriter:
    """Add every micro-batch of a stream."""
    return each_batch(rows, lambda batch, batch_id: add_batch(batch, batch_id, rollup, path))


def trailing(spark: SparkSession, rollup: Rollup, path: str, seconds: int, as_of: Column | None = None) -> DataFrame:
    """Measures per key of the trailing ``seconds`` up to ``as_of``, else to the newest row.

    The begin of the interval is settled first (one row per batch is read for it), so that
    folders of other buckets are not even listed in the scan.
    """
    until = F.max(NEWEST) if as_of is None else F.max(as_of)
    newest = _read(spark, path, NEWEST).agg(F.unix_micros(until).alias("micros")).first()["micros"]
    partial = _read(spark, path, PARTIALS)
    names = [*rollup.keys, *rollup.measures]
    if newest is None:
        found = partial.filter(F.lit(False)).select(*names)
    else:
        begin = newest - seconds * 1_000_000
        edge = begin // (rollup.width * 1_000_000)
        whole = partial.filter(F.col(BUCKET) > edge)
        rest = _read(spark, path, ROWS).filter((F.col(BUCKET) == edge) & (F.unix_micros(rollup.time) >= begin))
        found = whole.select(*names).unionByName(rollup.partial(rest).select(*names))
    return found.groupBy(*rollup.keys).agg(*[m.merge(n).alias(n) for n, m in rollup.measures.items()])


# --- the two dashboard views ---------------------------------------------------------


def leaderboard_rollup(width: int = 3600) -> Rollup:
    """Per player: the newest event with its profile, score, kills and assists."""
    return Rollup("event_time", width, {"player_id": F.col("player_id")}, {
        "newest": Measure(F.max(F.struct("event_time", "event_id", *PROFILE_COLUMNS)), F.max),
        "score": Measure(F.sum("score_delta"), F.sum),
        "kills": Measure(F.count_if(F.col("action") == "kill"), F.sum),
        "assists": Measure(F.count_if(F.col("action") == "assist"), F.sum),
    })


def leaderboard(spark: SparkSession, path: str, seconds: int = 3600, as_of: Column | None = None,
                width: int = 3600) -> DataFrame:
    """``views.leaderboard`` from a kept rollup of that ``width``."""
    return trailing(spark, leaderboard_rollup(width), path, seconds, as_of).select(
        "player_id", *[F.col(f"newest.{c}").alias(c) for c in PROFILE_COLUMNS],
        "score", "kills", "assists", F.col("newest.event_time").alias("last_event"))


MEANS = ("temperature_c", "relative_humidity", "wind_speed_kmh")


def trends_rollup(width: int = 3600) -> Rollup:
    """Per minute and city: sums and numbers of the measures, which merge into their means."""
    sums = {f"sum_{c}": Measure(F.sum(F.col(c).cast("double")), F.sum) for c in MEANS}
    counts = {f"n_{c}": Measure(F.count(c), F.sum) for c in MEANS}
    minute = F.date_trunc("minute", F.col("observed_at"))
    return Rollup("observed_at", width, {"observation_minute": minute, "city": F.col("city")},
                  {"country": Measure(F.max("country"), F.max), **sums, **counts})


def observation_trends(spark: SparkSession, path: str, seconds: int = 86400, as_of: Column | None = None,
                       width: int = 3600) -> DataFrame:
    """``views.observation_trends`` from a kept rollup of that ``width``."""
    merged = trailing(spark, trends_rollup(width), path, seconds, as_of)
    means = [F.try_divide(f"sum_{c}", f"n_{c}").alias(f"avg_{c}") for c in MEANS]
    return merged.select("observation_minute", "city", "country", *means)
