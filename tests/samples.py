"""Small made-up messages for tests."""

import datetime
import json
import random

NOON = datetime.datetime(2026, 8, 12, 12, tzinfo=datetime.timezone.utc)


def at(second):
    return (NOON + datetime.timedelta(seconds=second)).isoformat()


def page_views(count, seed=1):
    """Rows of event_id, event_time, user_id, path, bytes_sent over some minutes."""
    draw = random.Random(seed)
    return [(f"v{i}", at(7 * i), f"visitor-{draw.randrange(5)}", draw.choice(["/a", "/b/c", "/"]), draw.randrange(4000))
            for i in range(count)]


VIEWS = "event_id string, event_time string, user_id string, path string, bytes_sent bigint"


def road_readings(count, corridors, seed=2):
    draw = random.Random(seed)
    return [{"event_id": f"r{i}", "event_time": at(2 * i + draw.randrange(90)), "corridor": draw.choice(corridors),
             "speed_kph": draw.randrange(130)} for i in range(count)]


def match_events(count, players, seed=3):
    """Every fourth event is a chat message."""
    draw = random.Random(seed)
    events = []
    for i in range(count):
        chat = i % 4 == 3
        events.append({
            "event_id": f"m{i:04d}", "event_time": at(i), "match_id": f"g{i % 2}", "player_id": draw.choice(players),
            "event_type": "chat" if chat else "gameplay",
            "action": "message" if chat else draw.choice(["kill", "assist", "objective"]),
            "score_delta": 0 if chat else draw.choice([10, 20, 70]), "message": "hello" if chat else None})
    return events


def lines(events):
    return [json.dumps(e) for e in events]
