import datetime
import json
import os
import time

import pytest
from pyspark.sql import functions as F

from strata.functions.contracts import CORRIDORS
from strata.operators import views
from strata.plans import corridors, gameplay, site_traffic, weather
from strata.sources import messages, sinks
from strata.streaming import arrivals, replica, windows
from strata.streaming.asof import AsOfProcessor, enrich_as_of
from strata.streaming.panes import keyed_state
from strata.streaming.tables import (
    append_batch, declare_table, drain, each_batch, every, read_table, table_rows,
)
from tests import samples
from tests.conftest import rows
from tests.test_files import put

NOON = datetime.datetime(2026, 8, 12, 12, tzinfo=datetime.timezone.utc)


def reading(second, corridor, speed, number=0):
    time_text = (NOON + datetime.timedelta(seconds=second)).isoformat()
    return json.dumps({"event_id": f"t-{number}", "event_time": time_text, "corridor": corridor,
                       "speed_kph": speed})


def arrive(folder, number, *lines):
    path = put(f"{folder}/in/{number}.txt", "\n".join(lines) + "\n")
    stamp = time.time() - 1000 + number  # files are taken in order of their time
    os.utime(path, (stamp, stamp))


def run_corridors(spark, folder, **options):
    source = messages.read_messages(spark, f"{folder}/in", files_per_batch=1)
    drain(corridors.metrics_writer(source, folder, **options), f"{folder}/cp-metrics")
    source = messages.read_messages(spark, f"{folder}/in")
    drain(corridors.dead_letter_writer(source, folder), f"{folder}/cp-letters")


def test_windows_panes_lateness_and_dead_letters(spark, folder):
    corridors.declare(spark, folder)
    arrive(folder, 1, reading(0, "north", 40), reading(59, "north", 60), reading(10, "south", 35),
           '{"event_id":"invalid-demo"}', reading(0, "east", 1))
    arrive(folder, 2, reading(60, "north", 70), reading(30, "north", 20))  # boundary, out of order
    arrive(folder, 3, reading(170, "central", 50))
    arrive(folder, 4, reading(20, "north", 90))  # late by 150 s, its window still open
    arrive(folder, 5, reading(900, "central", 50))
    arrive(folder, 6, reading(905, "central", 50))  # Spark drops by the previous watermark
    arrive(folder, 7, reading(40, "north", 99))  # far behind it: dropped
    run_corridors(spark, folder)
    final = rows(corridors.final_metrics(spark, folder), "window_start", "corridor",
                 "vehicle_count", "average_speed_kph", "max_speed_kph")
    assert final == [
        ("2026-08-12T12:00:00", "north", 4, 52.5, 90),
        ("2026-08-12T12:00:00", "south", 1, 35.0, 35),
        ("2026-08-12T12:01:00", "north", 1, 70.0, 70),
        ("2026-08-12T12:02:00", "central", 1, 50.0, 50),
        ("2026-08-12T12:15:00", "central", 2, 50.0, 50),
    ]
    north = corridors.panes(spark, folder).filter(
        "corridor = 'north' AND window_start = '2026-08-12T12:00:00'").orderBy("batch_id")
    assert [r.vehicle_count for r in north.collect()] == [2, 3, 4]  # accumulating panes
    assert rows(corridors.refused(spark, folder), "error") == [
        ("Missing fields: ['corridor', 'event_time', 'speed_kph']",), ("Unknown corridor: east",)]
    assert tuple(corridors.completeness(spark, folder).first()) == (3, 9, 2)
    recent = corridors.completeness(spark, folder, "10 MINUTES").first()
    assert (recent.corridor_count, recent.vehicle_count) == (1, 2)
    assert all(r.ok for r in corridors.verify(spark, folder, 3, 9).collect())
    assert rows(windows.corridor_progress(corridors.panes(spark, folder)))[1] == ("north", 2, 5)
    # Nothing new arrived: running again from the checkpoint adds no pane.
    before = corridors.panes(spark, folder).count()
    run_corridors(spark, folder)
    assert corridors.panes(spark, folder).count() == before


def test_stream_equals_batch(spark, folder):
    corridors.declare(spark, folder)
    readings = samples.road_readings(200, CORRIDORS)
    generated = spark.createDataFrame(readings, "event_id string, event_time string, corridor string, speed_kph bigint")
    lines = samples.lines(readings)
    for number in range(4):
        arrive(folder, number, *lines[number * 50:(number + 1) * 50])
    run_corridors(spark, folder)
    batch = windows.corridor_metrics(windows.with_event_time(generated))
    assert rows(corridors.final_metrics(spark, folder), *batch.columns) == rows(batch)
    assert corridors.refused(spark, folder).count() == 0


def test_batch_window_average(spark):
    frame = spark.createDataFrame(
        [(NOON, "north", 40), (NOON, "north", 60), (NOON, "south", 35)],
        "event_time timestamp, corridor string, speed_kph bigint")
    assert rows(windows.corridor_metrics(frame), "corridor", "vehicle_count", "average_speed_kph",
                "max_speed_kph") == [("north", 2, 50.0, 60), ("south", 1, 35.0, 35)]


def test_tables_are_declared_and_batches_replace_themselves(spark, folder):
    path = f"{folder}/t"
    batch = spark.range(5)
    with pytest.raises(Exception):
        append_batch(batch, 0, path)
    declare_table(spark, path, "id bigint")
    append_batch(batch, 0, path)
    append_batch(batch, 1, path)
    append_batch(batch, 1, path)  # delivered again after a failure
    assert read_table(spark, path).count() == 10
    with pytest.raises(ValueError, match="differ"):
        append_batch(batch.withColumn("x", F.lit(1)), 2, path)


def test_processing_time_trigger(spark, folder):
    declare_table(spark, f"{folder}/t", "value string")
    arrive(folder, 1, "a", "b")
    source = messages.read_messages(spark, f"{folder}/in")
    query = every(each_batch(source, lambda b, i: append_batch(b, i, f"{folder}/t")),
                  f"{folder}/cp", seconds=1)
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert rows(read_table(spark, f"{folder}/t"), "value") == [("a",), ("b",)]


PLAYERS = ("p-001", "p-002", "p-003", "p-004")


def test_gameplay_enrichment_and_views(spark, folder):
    gameplay.declare(spark, folder)
    lines = samples.lines(samples.match_events(30, PLAYERS))
    arrive(folder, 1, *lines[:15], '{"event_id":"broken"}', "not json")
    arrive(folder, 2, *lines[15:])
    profiles = spark.createDataFrame(
        [("p-001", "Nova", "Solaris", "BR", "Diamond"), ("p-002", "Cipher", "Solaris", "US", None),
         ("p-003", "Kite", "Northwind", "GB", "Diamond")],
        "player_id string, display_name string, team string, region string, rank string")
    source = messages.read_messages(spark, f"{folder}/in", files_per_batch=1)
    drain(gameplay.writer(source, lambda: profiles, folder), f"{folder}/cp")
    enriched = gameplay.enriched(spark, folder)
    assert enriched.count() == 30 and gameplay.refused(spark, folder).count() == 2
    known = {r.player_id: (r.display_name, r.rank) for r in enriched.collect()}
    assert known.get("p-002", ("Cipher", "unknown")) == ("Cipher", "unknown")
    assert known.get("p-004", ("unknown", "unknown")) == ("unknown", "unknown")
    health = views.stream_health(enriched).first()
    assert (health.event_count, health.chat_count) == (30, 7)
    gated = {r.metric: r.ok for r in gameplay.verify(enriched, 30).collect()}
    assert gated == {"event_count": True, "unknown_profiles": health.unknown_profiles == 0}

    board = views.leaderboard(enriched)
    score = {r.player_id: 0 for r in enriched.collect()}
    for r in enriched.collect():
        score[r.player_id] += r.score_delta
    assert dict(rows(board, "player_id", "score")) == score
    ordered = [r.score for r in views.ordered_leaderboard(board).collect()]
    assert ordered == sorted(ordered, reverse=True)
    chat = views.chat_messages(enriched)
    rollup = views.dashboard_rollup(board, chat).first()
    assert tuple(rollup) == (len(score), sum(score.values()), 7)
    newest = views.recent_messages(chat, 3).collect()
    assert [r.event_id for r in newest] == ["m0027", "m0023", "m0019"]
    nothing = views.dashboard_rollup(views.leaderboard(enriched.limit(0)), chat.limit(0)).first()
    assert tuple(nothing) == (0, 0, 0)


def test_profile_attributes_replace_event_columns(spark):
    from strata.operators.enrich import enrich

    events = spark.createDataFrame([("p", "mine")], "player_id string, team string")
    profiles = spark.createDataFrame(
        [("p", "N", "theirs", "BR", "D")],
        "player_id string, display_name string, team string, region string, rank string")
    assert enrich(events, profiles).first().team == "theirs"
    assert enrich(events, profiles.limit(0)).first().team == "unknown"


def test_weather_stream(spark, folder):
    cities = spark.createDataFrame(
        [("London", "United Kingdom", 51.51, -0.13), ("Tokyo", "Japan", 35.68, 139.69)],
        "city string, country string, latitude double, longitude double")
    readings = spark.createDataFrame(
        [("London", "2026-08-12T12:00", 20.0, 50, 10.0, 1),
         ("London", "2026-08-12T12:00", 22.0, 60, 12.0, 2),
         ("Tokyo", "2026-08-12T13:00:30", 30.0, 70, 5.0, 3)],
        "city string, time string, temperature_2m double, relative_humidity_2m bigint, "
        "wind_speed_10m double, weather_code bigint")
    event = messages.normalise_observations(readings, cities)
    assert sorted(event.columns) == sorted(
        n.split()[0] for n in weather.OBSERVATION_SCHEMA.split(", "))
    event.write.json(f"{folder}/topic")
    observed = weather.observations(spark, f"{folder}/topic")
    drain(weather.raw_table_writer(observed, f"{folder}/raw"), f"{folder}/cp")
    assert os.path.isdir(f"{folder}/raw/observed_on=2026-08-12")
    raw = weather.raw_table(spark, f"{folder}/raw")
    latest = {r.city: r for r in views.latest_observations(raw).collect()}
    assert set(latest) == {"London", "Tokyo"} and "published_at" not in latest["Tokyo"]
    trends = rows(views.observation_trends(raw), "city", "avg_temperature_c",
                  "avg_relative_humidity")
    assert trends == [("London", 21.0, 55.0), ("Tokyo", 30.0, 70.0)]
    progress = views.city_progress(raw)
    assert [r.city for r in progress.collect()] == ["London", "Tokyo"]
    assert all(r.ok for r in weather.verify(progress, 2, 3).collect())


def land(folder, number, name, text):
    path = put(f"{folder}/land/{name}", text)
    stamp = time.time() - 1000 + number
    os.utime(path, (stamp, stamp))


ITEMS = "id int, name string"


def test_last_arriving_file_wins(spark, folder):
    def load(files_per_batch=None):
        drain(arrivals.load_newest_file(
            spark, f"{folder}/land", ITEMS, f"{folder}/t", files_per_batch), f"{folder}/cp")
        return rows(spark.read.schema(ITEMS).parquet(f"{folder}/t"))

    land(folder, 1, "z.csv", "id,name\n1,a\n2,b\n")
    land(folder, 2, "notes.txt", "id,name\n9,z\n")
    land(folder, 3, "B.CSV", "id,name\n3,c\n")  # the name does not count, the time does
    assert load() == [(3, "c")]
    land(folder, 4, "c.csv", "id,name\n")  # an empty file empties the table
    assert load() == []
    land(folder, 5, "d.csv", "id,name\n5,e\n")
    land(folder, 6, "a.csv", "id,name\n6,f\n")
    assert load(files_per_batch=1) == [(6, "f")]
    assert load() == [(6, "f")]  # nothing new


def test_every_arriving_file_is_kept(spark, folder):
    for number in range(5):
        land(folder, number, f"{number}.csv", f"id,name\n{number},x\n")
    for checkpoint in ("cp", "cp", "new-cp"):  # a new checkpoint loads again, and erases nothing
        drain(arrivals.load_every_file(spark, f"{folder}/land", ITEMS, f"{folder}/all", files_per_batch=2),
              f"{folder}/{checkpoint}")
    kept = spark.read.schema(ITEMS).option("recursiveFileLookup", True).parquet(f"{folder}/all")
    assert rows(kept, "id") == sorted([(n,) for n in range(5)] * 2)


def test_two_checkpoints_append_to_one_table(spark, folder):
    path = declare_table(spark, f"{folder}/t", "value string")
    for number, text in ((1, "a"), (2, "b")):
        arrive(f"{folder}/{number}", number, text, text + text)
        source = messages.read_messages(spark, f"{folder}/{number}/in")
        for _ in range(2):  # the second start finds nothing new
            drain(each_batch(source, lambda b, i: append_batch(b, i, path)), f"{folder}/cp{number}")
    assert rows(table_rows(spark, path)) == [("a",), ("aa",), ("b",), ("bb",)]
    assert read_table(spark, path).select("writer").distinct().count() == 2


def test_last_drop_wins_whole(spark, folder):
    for drop, count in (("009", 40), ("010", 25)):
        spark.range(count).selectExpr("id", "'x' AS name").repartition(4).write.option(
            "header", True).csv(f"{folder}/land/drop={drop}")
    load = arrivals.load_drops(spark, f"{folder}/land", "id bigint, name string", f"{folder}/t")
    drain(load, f"{folder}/cp")
    assert arrivals.last_drop(spark, f"{folder}/t").count() == 25


CHANGES = "order_id bigint, customer_name string, status string, amount decimal(10,2), op string, seq bigint"


def test_replica_over_several_batches(spark, folder):
    snapshot = spark.createDataFrame(
        [(1001, "Ada Lovelace", "paid", None), (1002, "Grace Hopper", "shipped", None),
         (1003, "Katherine Johnson", "processing", None)],
        "order_id bigint, customer_name string, status string, amount decimal(10,2)")
    def change(*values):
        names = ("order_id", "customer_name", "status", "op", "seq")
        return json.dumps(dict(zip(names, values)))
    arrive(folder, 1, change(1004, "Margaret Hamilton", "paid", "I", 1),
           change(1001, "Ada Lovelace", "shipped", "U", 3),
           change(1001, "Ada Lovelace", "late", "U", 2))
    arrive(folder, 2, change(1002, "Grace Hopper", "shipped", "D", 4),
           change(1004, "Margaret Hamilton", "shipped", "U", 6))
    arrive(folder, 3, change(1004, "Margaret Hamilton", "stale", "U", 5),  # out of order
           change(1005, "New", "paid", "I", 7), change(1005, "New", "paid", "D", 8),
           change(1002, "Grace Hopper", "back", "I", 9))
    path = declare_table(spark, f"{folder}/changes", CHANGES)
    keys, expected = ["order_id"], [(1001, "shipped"), (1002, "back"), (1003, "processing"), (1004, "shipped")]

    def collect():
        log = messages.read_messages(spark, f"{folder}/in", fmt="json", schema=CHANGES, files_per_batch=1)
        drain(replica.collect_changes(log, keys, path), f"{folder}/cp")

    collect()
    start = replica.Snapshot(snapshot)
    assert rows(replica.replica(spark, start, path, keys), "order_id", "status") == expected
    compacted = replica.compact(spark, start, path, keys, f"{folder}/next")
    again = replica.replica(spark, compacted, path, keys)
    assert rows(again, "order_id", "status") == expected
    assert replica.later_changes(spark, compacted, path, keys).count() == 0
    arrive(folder, 4, change(1001, "Ada Lovelace", "ancient", "U", 1),  # older than what is compacted
           change(1005, "New", "ghost", "U", 7),  # deleted by a later change
           change(1003, "Katherine Johnson", "paid", "U", 10))
    collect()
    assert rows(replica.later_changes(spark, compacted, path, keys), "order_id") == [(1003,)]
    final = [(1001, "shipped"), (1002, "back"), (1003, "paid"), (1004, "shipped")]
    assert rows(replica.replica(spark, compacted, path, keys), "order_id", "status") == final
    assert rows(replica.replica(spark, start, path, keys), "order_id", "status") == final
    second = replica.compact(spark, compacted, path, keys, f"{folder}/next-2")
    assert rows(second.rows, "order_id", "status") == final and set(second.upto.values()) == {3}
    plan = replica.later_changes(spark, second, path, keys)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan


def test_site_traffic_conserves_totals(spark, folder):
    views = samples.page_views(120)
    source = sinks.overwrite_json_lines(spark.createDataFrame(views, samples.VIEWS), f"{folder}/in")
    out = site_traffic.run(spark, f"{source}/part-*", f"{folder}/out")
    sizes = {}
    for _, _, user, _, size in views:
        sizes[user] = sizes.get(user, 0) + size
    assert dict(rows(out.users, "user_id", "bytes_sent")) == sizes
    minutes = {v[1][:16] for v in views}
    assert out.minutes.count() == len(minutes)
    assert sum(r.page_views for r in out.minutes.collect()) == 120
    assert all(r.ok for r in out.conserved.collect())


def test_distinct_counts_null_as_a_value(spark):
    from strata.operators.traffic import sum_per_key, user_traffic

    frame = spark.createDataFrame(
        [("u", "/", 1), ("u", None, 2), ("u", None, 3), ("v", None, 4)],
        "user_id string, path string, bytes_sent bigint")
    assert rows(user_traffic(frame), "user_id", "unique_paths") == [("u", 2), ("v", 1)]
    assert rows(sum_per_key(frame, "user_id", "bytes_sent")) == [("u", 6), ("v", 4)]


def fired(spark, folder, early_seconds=0):
    """Run what has arrived, one file per micro-batch; all panes so far, in order."""
    source = messages.read_messages(spark, f"{folder}/in", files_per_batch=1)
    with keyed_state(spark):
        drain(corridors.panes_writer(source, folder, early_seconds=early_seconds), f"{folder}/cp")
    panes = table_rows(spark, f"{folder}/corridor_panes").collect()
    return sorted((r.window_start[-8:], r.corridor, r.pane_number, r.pane_kind, r.vehicle_count,
                   r.average_speed_kph, r.max_speed_kph) for r in panes)


def test_panes_early_on_time_and_late(spark, folder):
    declare_table(spark, f"{folder}/corridor_panes", corridors.PANES_SCHEMA)
    arrive(folder, 1, reading(0, "north", 40), reading(59, "north", 60), reading(10, "south", 35), "no message")
    arrive(folder, 2, reading(30, "north", 20), reading(61, "north", 70))
    arrive(folder, 3, reading(100, "central", 50))  # by now the watermark is at 61
    first = fired(spark, folder)
    assert first == [
        ("12:00:00", "north", 1, "early", 2, 50.0, 60), ("12:00:00", "north", 2, "early", 3, 40.0, 60),
        ("12:00:00", "north", 3, "on_time", 3, 40.0, 60),
        ("12:00:00", "south", 1, "early", 1, 35.0, 35), ("12:00:00", "south", 2, "on_time", 1, 35.0, 35),
        ("12:01:00", "central", 1, "early", 1, 50.0, 50), ("12:01:00", "north", 1, "early", 1, 70.0, 70),
    ]
    # The stream starts anew: state and timers are in its checkpoint.
    arrive(folder, 4, reading(5, "north", 90), reading(6, "north", 10), reading(50, "east", 30))  # late, a pane each
    arrive(folder, 5, reading(180, "central", 50))
    arrive(folder, 6, reading(7, "south", 99), reading(70, "north", 80))  # the first window is forgotten
    arrive(folder, 7, reading(181, "central", 70))
    second = fired(spark, folder)
    assert [p for p in second if p not in first] == [
        ("12:00:00", "north", 4, "late", 4, 52.5, 90), ("12:00:00", "north", 5, "late", 5, 44.0, 90),
        ("12:01:00", "central", 2, "on_time", 1, 50.0, 50),
        ("12:01:00", "north", 2, "on_time", 1, 70.0, 70), ("12:01:00", "north", 3, "late", 2, 75.0, 80),
        ("12:03:00", "central", 1, "early", 1, 50.0, 50), ("12:03:00", "central", 2, "early", 2, 60.0, 70),
    ]


def test_early_panes_wait_for_their_time(spark, folder):
    declare_table(spark, f"{folder}/corridor_panes", corridors.PANES_SCHEMA)
    for second in range(3):
        arrive(folder, 1 + second, reading(second, "north", 40))
    assert fired(spark, folder, early_seconds=3600) == []
    arrive(folder, 5, reading(60, "north", 50))
    arrive(folder, 6, reading(61, "north", 50))
    assert fired(spark, folder, early_seconds=3600) == [("12:00:00", "north", 1, "on_time", 3, 40.0, 40)]


def test_events_take_the_profile_of_their_time(spark, folder):
    schemas = {"events": "player_id string, event_time timestamp, n int", "versions": "player_id string, since timestamp, team string"}

    def deliver(name, number, *given):
        frame = spark.createDataFrame([(p, NOON + datetime.timedelta(seconds=s), v) for p, s, v in given], schemas[name])
        frame.coalesce(1).write.parquet(f"{folder}/{name}/{number}")

    def run(shares=3):
        events, versions = (spark.readStream.schema(schemas[n]).parquet(f"{folder}/{n}/*") for n in schemas)
        found = enrich_as_of(events, versions, "player_id", "event_time", "since", ["team"], lateness_seconds=10, shares=shares)
        with keyed_state(spark):
            drain(each_batch(found, lambda b, i: append_batch(b, i, f"{folder}/out")), f"{folder}/cp")
        return sorted((r.n, r.team) for r in table_rows(spark, f"{folder}/out").collect())

    declare_table(spark, f"{folder}/out", "player_id string, event_time timestamp, n int, team string")
    deliver("versions", 1, ("a", -5000, "red"), ("a", 20, "blue"), ("b", 30, None))
    deliver("events", 1, ("a", 19, 1), ("a", 20, 2), ("b", 5, 3), ("b", 31, 4), ("c", 6, 5), ("a", 60, 6))
    first = run()
    assert first == [(1, "red"), (2, "blue"), (3, "unknown"), (4, "unknown"), (5, "unknown")]  # 6 waits until 70
    deliver("versions", 2, ("a", 55, "green"), ("a", 10, "late"), ("c", 1, "gone"))  # late ones change no event that left
    deliver("events", 2, ("a", 45, 7), ("a", 80, 8), ("c", 90, 9))
    assert run() == sorted(first + [(6, "green"), (7, "blue"), (8, "green")])
    deliver("events", 3, ("c", 200, 10))
    deliver("versions", 3, ("z", 0, "x"))
    assert run()[-1] == (9, "gone")


class HeldState:
    """A list state that counts its calls."""

    def __init__(self):
        self.entries, self.calls = [], 0

    def get(self):
        self.calls += 1
        return iter(list(self.entries))

    def exists(self):
        return bool(self.entries)

    def appendList(self, entries):
        self.calls += 1
        self.entries += entries

    def put(self, entries):
        self.calls += 1
        self.entries = list(entries)

    def clear(self):
        self.put([])


def test_a_state_holds_many_keys(monkeypatch):
    """every key and share had a state of its own, with some ten calls per micro-batch."""
    monkeypatch.setattr("strata.streaming.asof.PACKED", 7)
    states, timers, now = {}, [], [0]

    class Handle:
        registerTimer = staticmethod(timers.append)

        def getListState(self, name, schema):
            return states.setdefault(name, HeldState())

    class Values:
        getCurrentWatermarkInMs = staticmethod(lambda: now[0])

    def deliver(*given):
        from pyspark.sql import Row

        sent = [Row(bucket=0, key=k, is_version=v, at=at * 10**6, payload=p) for k, v, at, p in given]
        return sorted((r.event, r.version) for r in processor.handleInputRows((0,), iter(sent), Values))

    processor = AsOfProcessor(lateness_ms=10_000)
    processor.init(Handle())
    keys = [f"k{i}" for i in range(50)]
    assert deliver(*[(k, True, s, f"{k} from {s}") for s in (5, 1) for k in keys], *[(k, False, 3, f"{k} at 3") for k in keys],
                   ("none", False, 2, "none at 2"), ("k0", False, 90, "k0 at 90")) == []
    assert timers == [1999]
    now[0] = 40_000
    found = sorted((r.event, r.version) for r in processor.handleExpiredTimer((0,), Values, None))
    assert found == sorted([(f"{k} at 3", f"{k} from 1") for k in keys] + [("none at 2", None)])
    assert timers == [1999, 89_999]
    assert deliver(("k0", True, 50, "k0 from 50"), ("k1", False, 30, "k1 at 30")) == [("k1 at 30", "k1 from 5")]
    now[0] = 100_000
    assert deliver(("k2", False, 20, "k2 at 20")) == [("k0 at 90", "k0 from 50"), ("k2 at 20", "k2 from 5")]
    assert states["waiting"].entries == []
    assert sum(s.calls for s in states.values()) <= 16  # whatever the number of keys
