"""Archives: round trip, revisits, and assembly whichever record states the link."""

import base64
import gzip
import hashlib
import io

import pytest

from strata.llm import warc
from strata.session import scratch_path

PAGES = "page_id long, url string, html string, `__id` string, digest string"


def index(spark, rows, schema=PAGES):
    path = scratch_path(spark, "warc-test")
    warc.write_archive(spark.createDataFrame(rows, schema), path)
    return path, sorted((tuple(r) for r in warc.page_index(spark, path).collect()), key=repr)


def test_round_trip_and_revisits(spark):
    odd = "WARC/1.1\r\nWARC-Type: response\r\n\r\n\r\n\r\n€ \x00 end"
    rows = [(5, "http://a.example/x?y=1", "<p>one</p>", "c", "c"), (3, "https://b.example", "<p>one</p>", "c", "c"),
            (9, None, "<p>one</p>", "c", "c"), (4, "http://a b\r\nc/", odd, "c", "c"), (7, "", None, "c", "c"),
            (8, "u", "", "c", "c"), (6, "u", "x" * 300_000 + "\r\n\r\n", "c", "c")]
    path, got = index(spark, rows)
    want, first = [], {}
    for page, _, html, *_ in sorted(rows, key=lambda r: r[0]):
        payload = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        of = first.setdefault(payload, page)
        want.append((page, len(payload), digest, "response" if of == page else "revisit", None if of == page else of))
    assert got == sorted(want, key=repr)
    captures = {r["capture"]["record_id"]: r for r in warc.assemble(warc.read_records(spark, path)).collect()}
    assert len(captures) == len(rows)
    for c in captures.values():
        assert len(c["requests"]) == len(c["metadata"]) == 1
        page = int(bytes(c["metadata"][0]["payload"]).decode().split(":")[1])
        html = next(r[2] for r in rows if r[0] == page) or ""
        if c["capture"]["record_type"] == "response":
            assert bytes(c["capture"]["payload"]) == html.encode()
            assert c["capture"]["payload_digest"] == c["capture"]["stated_digest"]
        else:
            assert bytes(c["capture"]["payload"]) == b""
            assert c["original"]["payload_digest"] == c["capture"]["stated_digest"]


def test_least_bytes(spark):
    path = scratch_path(spark, "warc-test")
    rows = [(1, "u", "same", "c", "c"), (2, "u", "same", "c", "c")]
    warc.write_archive(spark.createDataFrame(rows, PAGES), path, least_bytes=5)
    assert [r["record_type"] for r in warc.page_index(spark, path).collect()] == ["response"] * 2


def test_repeated_rows_and_ids(spark):
    rows = [(1, "u", "a", "c", "c"), (1, "u", "a", "c", "c"), (1, "v", "b", "c", "c"), (None, "w", "b", "c", "c")]
    _, got = index(spark, rows)
    assert len(got) == 4
    assert sorted((g[0], g[3]) for g in got if g[0]) == [(1, "response"), (1, "revisit"), (1, "revisit")]
    assert [g[3] for g in got if g[0] is None] == ["response"]  # NULL is smaller than every id


def test_empty_table(spark):
    path = scratch_path(spark, "warc-test")
    warc.write_archive(spark.createDataFrame([], PAGES), path)
    assert warc.page_index(spark, path).collect() == []


def test_files_are_bounded_by_bytes(spark):
    rows = [(i, f"u{i}", f"{i} " + "x" * (i % 7) * 1000, "c", "c") for i in range(300)] + [(999, "u", "y" * 50_000, "c", "c")]
    path = scratch_path(spark, "warc-test")
    warc.write_archive(spark.createDataFrame(rows, PAGES), path, file_bytes=40_000)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).collect()
    sizes = [len(gzip.decompress(bytes(f["content"]))) for f in files]
    total = sum(2000 + 3 * len(r[1]) + len(r[2]) for r in rows)
    assert max(sizes) < 40_000 + 52_003 and sum(s > 46_000 for s in sizes) <= 1
    # The long capture jumps a number.
    assert total // 40_000 - 1 <= len(sizes) <= total / 40_000 + 2 * int(spark.conf.get("spark.sql.shuffle.partitions")) + 1
    got = sorted(tuple(r)[:2] for r in warc.page_index(spark, path).collect())
    assert got == sorted((r[0], len(r[2])) for r in rows)


def test_many_rows_of_one_page_id(spark):
    """Copies, NULL ids and repeated ids against a plain count, on both sides of the least size."""
    rows = [(k, u, h, "c", "c") for k in (None, 1, 2) for u in (None, "", "v") for h in (None, "a", "bb") for _ in range(3)]
    for least in (0, 2):
        path = scratch_path(spark, "warc-test")
        warc.write_archive(spark.createDataFrame(rows, PAGES), path, least_bytes=least)
        got = [(r["page_id"], r["payload_bytes"], r["record_type"], r["refers_to"]) for r in warc.page_index(spark, path).collect()]
        assert len(got) == len(rows)
        stored = [g for g in got if g[1] >= least]
        assert sum(g[2] == "response" for g in stored) == len({g[1] for g in stored})
        assert all(g[0] is None for g in stored if g[2] == "response")
        assert all(g[2] == "response" for g in got if g[1] < least)


def test_assembly_joins_both_directions(spark):
    def record(name, kind, concurrent=None, refers=None):
        return (name, kind, concurrent, refers, "u", "d", None, "D" + name, 3, None)

    rows = [record("r1", "response", "q1"), record("q1", "request"), record("r2", "response"), record("q2", "request", "r2"),
            record("m2", "metadata", "r2"), record("n2", "metadata", "r2"), record("v", "revisit", None, "r1"),
            record("lost", "metadata", "nowhere"), record("alone", "response")]
    got = {r["capture"]["record_id"]: r for r in warc.assemble(spark.createDataFrame(rows, warc.RECORDS)).collect()}
    names = {k: ([x["record_id"] for x in r["requests"]], [x["record_id"] for x in r["metadata"]],
                 r["original"] and r["original"]["record_id"]) for k, r in got.items()}
    assert names == {"r1": (["q1"], [], None), "r2": (["q2"], ["m2", "n2"], None), "v": ([], [], "r1"), "alone": ([], [], None)}


def test_broken_archives():
    good = b"WARC/1.0\r\nWARC-Type: resource\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    members = gzip.compress(good) + gzip.compress(good)
    assert len(list(warc.parse(io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(members))), True))) == 2
    for bad in (good[:-6], b"junk" + good):
        with pytest.raises(ValueError):
            list(warc.parse(io.BytesIO(bad), True))
