"""Enrichment as of event time: profile versions and events share one keyed state.

An event takes the newest profile version whose time is not after its own. It waits in the
state until the watermark has passed its time, so that versions sent meanwhile count, whatever
the order of arrival. A version that comes later still counts for all events that wait, and
not for those that have left; an event later than the watermark leaves at once with what the
state knows. Of a key's versions that lie behind the watermark by more than the lateness only
the newest is kept.

No micro-batch reads the profiles: only new versions and new events meet. A key's events are
dealt to ``SHARES`` shares, each with all its versions, so a busy key is not one task's work.
The shares of all keys are dealt to ``BUCKETS`` states: a state costs some calls whatever it holds,
so it holds many keys, and an entry of a state packs up to ``PACKED`` rows. A micro-batch reads the
buckets it touches and adds to them; they are written anew only when something leaves. Shares and buckets stay as they are while a checkpoint is in use.
"""

from __future__ import annotations

import pickle
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

SHARES, BUCKETS, PACKED = 8, 4096, 1024
LATENESS_SECONDS = 120
_ENTRY = "packed binary"  # rows of key, time and payload
_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


class AsOfProcessor(StatefulProcessor):
    """Waiting events and known versions of the keys of one bucket."""

    def __init__(self, lateness_ms: int):
        self.lateness = lateness_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.versions = handle.getListState("versions", _ENTRY)
        self.waiting = handle.getListState("waiting", _ENTRY)

    def _settle(self, new_versions: list, new_waiting: list, values) -> Iterator[Row]:
        """Events whose time has passed leave; the rest is stored."""
        watermark = values.getCurrentWatermarkInMs()
        versions, waiting = self._held(self.versions, new_versions), self._held(self.waiting, new_waiting)
        left = dropped = 0
        for key, events in waiting.items():
            events.sort()
            passed = bisect_right(events, watermark, key=lambda w: w[0] // 1000) if watermark > 0 else 0
            if not passed:
                continue
            own = sorted(versions.get(key, ()))
            for at, payload in events[:passed]:
                known = bisect_right(own, at, key=lambda v: v[0])
                yield Row(event=payload, version=own[known - 1][1] if known else None)
            left += passed
            waiting[key] = events[passed:]
        for key, own in versions.items():
            if len(own) > 1:
                own.sort()
                old = max(0, bisect_right(own, watermark - self.lateness, key=lambda v: v[0] // 1000) - 1)
                dropped += old
                versions[key] = own[old:]
        self._store(self.versions, versions, new_versions, dropped)
        self._store(self.waiting, waiting, new_waiting, left)
        first = min((events[0][0] for events in waiting.values() if events), default=None)
        if first is not None:
            self.handle.registerTimer(max(1, first // 1000 - 1))

    @staticmethod
    def _held(state, new: list) -> dict[str, list]:
        """Stored and new entries by key."""
        found = defaultdict(list)
        for entries in (*(pickle.loads(entry[0]) for entry in state.get()), new):
            for key, at, payload in entries:
                found[key].append((at, payload))
        return found

    @staticmethod
    def _packed(entries: list) -> list:
        return [(pickle.dumps(entries[at: at + PACKED]),) for at in range(0, len(entries), PACKED)]

    def _store(self, state, held: dict[str, list], new: list, gone: int) -> None:
        if not gone:
            if new:
                state.appendList(self._packed(new))
            return
        entries = [(key, *entry) for key, own in held.items() for entry in own]
        if entries:
            state.put(self._packed(entries))
        else:
            state.clear()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        versions, waiting = [], []
        for _, name, is_version, at, payload in rows:
            (versions if is_version else waiting).append((name, at, payload))
        yield from self._settle(versions, waiting, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield from self._settle([], [], timerValues)

    def close(self) -> None:
        pass


def enrich_as_of(
    events: DataFrame, versions: DataFrame, key: str, event_time: str, version_time: str, columns: Sequence[str],
    unknown: str = "unknown", lateness_seconds: int = LATENESS_SECONDS, shares: int = SHARES, buckets: int = BUCKETS,
) -> DataFrame:
    """The events of a stream with the profile ``columns`` valid at their time, ``unknown`` where
    there are none. Of versions with one time the one with the greatest values counts. Rows
    without key or time are left out. Start it within ``keyed_state``."""
    own = [c for c in events.columns if c not in columns]
    event = F.struct(*own)
    schema = events.select(*own).schema
    sent = events.filter(F.col(key).isNotNull() & F.col(event_time).isNotNull()).select(
        F.col(key).cast("string").alias("key"), F.col(event_time).alias("time"), F.lit(False).alias("is_version"),
        F.to_json(event, _TIMES).alias("payload")).withColumn("share", F.pmod(F.xxhash64("payload"), F.lit(shares)))
    known = versions.filter(F.col(key).isNotNull() & F.col(version_time).isNotNull()).select(
        F.col(key).cast("string").alias("key"), F.col(version_time).alias("time"), F.lit(True).alias("is_version"),
        F.to_json(F.struct(*columns), _TIMES).alias("payload"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shares - 1).cast("long"))).alias("share"))
    both = sent.unionByName(known).withWatermark("time", f"{lateness_seconds} seconds")
    # Without the column that has the watermark no old version is dropped on the way.
    bucket = F.pmod(F.xxhash64("key", "share"), F.lit(buckets))
    met = both.select(bucket.alias("bucket"), "key", "is_version", F.unix_micros("time").alias("at"), "payload")
    found = met.groupBy("bucket").transformWithState(
        AsOfProcessor(lateness_seconds * 1000), "event string, version string", "Append", "EventTime")
    profile = versions.select(*columns).schema
    read = found.select(F.from_json("event", schema, _TIMES).alias("e"), F.from_json("version", profile, _TIMES).alias("v"))
    return read.select("e.*", *[F.coalesce(F.col(f"v.{c}"), F.lit(unknown)).alias(c) for c in columns])
