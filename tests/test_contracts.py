import pytest
from pyspark.sql import functions as F

from strata.functions import contracts as c
from tests.conftest import rows

GOOD = '{"event_id":"e","event_time":"2026-08-12T12:00:00Z","corridor":"north","speed_kph":50}'


def errors(spark, contract, *payloads):
    frame = spark.createDataFrame(
        [(i, p if isinstance(p, bytearray) else bytearray(p, "utf-8"))
         for i, p in enumerate(payloads)], "i int, value binary"
    )
    checked = c.check_messages(frame, contract)
    return [r.error for r in checked.orderBy("i").collect()]


def corridor(**changes):
    import json

    body = json.loads(GOOD) | changes
    return json.dumps({k: v for k, v in body.items() if v != "DROP"})


def test_corridor_contract_names_the_first_failure(spark):
    speed = "speed_kph must be a non-negative integer"
    cases = {
        GOOD: None,
        '{"event_id":"invalid-demo"}': "Missing fields: ['corridor', 'event_time', 'speed_kph']",
        corridor(corridor="east"): "Unknown corridor: east",
        corridor(corridor=None): "Unknown corridor: None",
        corridor(speed_kph=-1): speed,
        corridor(speed_kph=50.0): speed,
        corridor(speed_kph="50"): speed,
        corridor(speed_kph=None): speed,
        corridor(speed_kph=True): speed,
        corridor(speed_kph=0): None,
        corridor(event_time="yesterday"): "Invalid isoformat string: yesterday",
        corridor(event_time=5): "Invalid isoformat string: 5",
        corridor(event_time="2026-08-12T12:00:00+02:00"): None,
        corridor(corridor="east", speed_kph=-1): "Unknown corridor: east",
        "not json": "payload is not a JSON object",
        "[1, 2]": "payload is not a JSON object",
        "7": "payload is not a JSON object",
        "": "payload is not a JSON object",
        "{}": "Missing fields: ['corridor', 'event_id', 'event_time', 'speed_kph']",
        GOOD[:-1] + ',"speed_kph":"x"}': speed,  # the last of two equal keys counts
    }
    assert errors(spark, c.corridor_contract(), *cases) == list(cases.values())


def test_invalid_utf8_is_replaced_and_refused(spark):
    payload = bytearray(b'{"event_id":"\xff"}')
    frame = spark.createDataFrame([(payload,)], "value binary")
    row = c.dead_letters(c.check_messages(frame, c.corridor_contract())).first()
    assert row.payload == '{"event_id":"�"}'
    assert row.error == "payload is not valid UTF-8"
    assert row.failed_at is not None


def test_gameplay_contract_checks_keys_only(spark):
    present = {k: None for k in c.GAMEPLAY_KEYS}
    import json

    assert errors(spark, c.gameplay_contract(), json.dumps(present), '{"event_id":"broken"}') == [
        None,
        "Missing fields: ['action', 'event_time', 'event_type', 'match_id', 'player_id', "
        "'score_delta']",
    ]


def test_traffic_bytes_convert(spark):
    line = ('{"event_id":"v","event_time":"2026-08-12T12:00:00Z","user_id":"u","path":"/",'
            '"bytes_sent":%s}')
    frame = spark.createDataFrame([(line % b,) for b in ('7', '"8"', '1.9')], "value string")
    checked = c.check_messages(frame, c.traffic_contract())
    assert [r.bytes_sent for r in c.demand_accepted(checked).collect()] == [7, 8, 1]
    bad = spark.createDataFrame([(line % '"x"',)], "value string")
    with pytest.raises(Exception, match="bytes_sent is not an integer"):
        c.demand_accepted(c.check_messages(bad, c.traffic_contract())).collect()


def test_accepted_and_refused_cover_all_rows(spark):
    frame = spark.createDataFrame([(GOOD,), ("x",), (None,)], "value string")
    checked = c.check_messages(frame, c.corridor_contract())
    assert rows(c.accepted(checked)) == [("e", "2026-08-12T12:00:00Z", "north", 50)]
    assert c.dead_letters(checked).count() == 2


def test_encode_sorts_keys_and_keeps_nulls(spark):
    frame = spark.createDataFrame([(1, None, "é")], "b int, a string, c string")
    assert c.encode(frame, sort_keys=True).first().value == '{"a":null,"b":1,"c":"é"}'
    assert c.encode(frame).first().value == '{"b":1,"a":null,"c":"é"}'


def test_columns_of_equal_name_are_refused(spark):
    frame = spark.createDataFrame([("e", GOOD)], "event_id string, value string")
    with pytest.raises(ValueError, match="event_id"):
        c.check_messages(frame, c.corridor_contract())


def test_contract_of_empty_frame(spark):
    frame = spark.createDataFrame([], "value string")
    checked = c.check_messages(frame, c.traffic_contract())
    assert checked.count() == 0
    assert checked.select(F.col("bytes_sent")).schema[0].dataType.simpleString() == "bigint"
