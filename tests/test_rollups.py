"""Views kept by bucket against the same views over all rows."""

import datetime

from pyspark.sql import functions as F

from strata.operators import views
from strata.streaming import rollups
from strata.streaming.tables import drain
from tests.conftest import rows

BEGIN = datetime.datetime(2026, 5, 1, 9, tzinfo=datetime.timezone.utc)
EVENTS = ("event_id string, event_time timestamp, player_id string, action string, score_delta bigint, "
          "display_name string, team string, region string, rank string")


def event(number, minutes, player, action="kill", score=1):
    when = None if minutes is None else BEGIN + datetime.timedelta(minutes=minutes, seconds=number % 7)
    return (f"e{number:03}", when, player, action, score, f"name {player} {number}", "t", "r", None)


BATCHES = [
    [event(i, i * 3, f"p{i % 4}", ("kill", "assist", "objective")[i % 3], i % 5) for i in range(60)],
    [event(100 + i, i * 3 + 1, f"p{i % 5}", score=None if i % 9 == 0 else 2) for i in range(70)],  # the same hours again
    [event(200, None, "p0"), event(201, 5, "late"), event(202, 230, None), event(202, 230, None)],
]


def stored(spark, folder):
    path = rollups.declare(spark, rollups.leaderboard_rollup(), f"{folder}/kept", EVENTS)
    for number, batch in enumerate(BATCHES):
        spark.createDataFrame(batch, EVENTS).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(EVENTS).parquet(f"{folder}/in")
        drain(rollups.keep(stream, rollups.leaderboard_rollup(), path), f"{folder}/cp")  # started anew each time
    return path, spark.createDataFrame([r for b in BATCHES for r in b], EVENTS)


def test_trailing_view_equals_the_view_over_history(spark, folder):
    path, history = stored(spark, folder)
    for seconds in (0, 59, 3600, 5000, 7200, 10**7):
        for minutes in (None, 61, 120, 233):
            as_of = None if minutes is None else F.lit(BEGIN + datetime.timedelta(minutes=minutes))
            want = views.leaderboard(history, f"{seconds} SECONDS", as_of)
            assert rows(rollups.leaderboard(spark, path, seconds, as_of)) == rows(want)


def test_only_buckets_of_the_interval_are_read(spark, folder):
    path, history = stored(spark, folder)
    board = rollups.leaderboard(spark, path, 3600)
    plan = board._sc._jvm.PythonSQLUtils.explainString(board._jdf.queryExecution(), "formatted")
    assert plan.count("PartitionFilters: [isnotnull(bucket") == 2
    partial = rollups._read(spark, path, rollups.PARTIALS)
    buckets = [r[0] for r in partial.select("bucket").distinct().collect()]
    newest = history.agg(F.max("event_time").cast("long")).first()[0]
    inside = [b for b in buckets if b > (newest - 3600) // 3600]
    assert 0 < len(inside) < len(buckets)
    read = [f.split("bucket=")[1].split("/")[0] for f in partial.filter(F.col("bucket") > (newest - 3600) // 3600)
            .select(F.input_file_name()).distinct().toPandas().iloc[:, 0]]
    assert {int(b) for b in read} == set(inside)


def test_repeated_and_empty_batches(spark, folder):
    kept = rollups.leaderboard_rollup()
    path = rollups.declare(spark, kept, f"{folder}/kept", EVENTS)
    assert rollups.leaderboard(spark, path).collect() == []
    batch = spark.createDataFrame(BATCHES[0], EVENTS)
    rollups.add_batch(batch, 0, kept, path)
    once = rows(rollups.leaderboard(spark, path, 9000))
    rollups.add_batch(batch, 0, kept, path)
    rollups.add_batch(batch.limit(0), 1, kept, path)
    rollups.add_batch(spark.createDataFrame([event(1, None, "p")], EVENTS), 2, kept, path)
    assert rows(rollups.leaderboard(spark, path, 9000)) == once == rows(views.leaderboard(batch, "9000 SECONDS"))
