"""Extendible hashing: every shard fits, and no bucket was split without need."""

import hashlib

import pytest

from strata.llm import sharding
from tests.llm import cases


def bits_of(doc_id):
    name = "" if doc_id is None else str(doc_id)
    return format(int(hashlib.md5(name.encode()).hexdigest()[:15], 16), "060b")


def plain_directory(items, limit, prefix=""):
    """``{prefix: items}`` by splitting one bucket after the other."""
    inside = [i for i in items if i[0].startswith(prefix)]
    if not inside:
        return {}
    if sum(i[1] for i in inside) <= limit or len({i[0] for i in inside}) == 1:
        return {prefix: inside}
    return plain_directory(inside, limit, prefix + "0") | plain_directory(inside, limit, prefix + "1")


@pytest.mark.parametrize("limit", [50, 700, 10**9])
def test_directory_by_splitting(spark, limit):
    rows = [cases.document(i, "x" * (i % 40)) for i in range(500)] + cases.messy_rows()
    docs = spark.createDataFrame(rows, cases.SCHEMA)
    got = sharding.with_shards(docs, limit).collect()
    items = [(bits_of(r[0]), len((r[1] or "").encode())) for r in rows]
    want = plain_directory(items, limit)
    assert len(got) == len(rows)
    for g in got:
        own = want[g["shard"]]
        assert bits_of(g["doc_id"]).startswith(g["shard"])
        assert (g["shard_bits"], g["shard_bytes"], g["shard_rows"]) == (
            len(g["shard"]), sum(i[1] for i in own), len(own))
        assert g["oversized"] == (sum(i[1] for i in own) > limit)
        if g["oversized"]:
            assert len({i[0] for i in own}) == 1  # one id cannot be split
    assert {g["shard"] for g in got} == set(want)
    assert got[0]["label"] == "clash" and got[0]["a.b"] == "clash"


def test_rounds_go_deeper(spark, monkeypatch):
    monkeypatch.setattr(sharding, "ROUND_BITS", 2)
    rows = [cases.document(i, "yyyyyyyyyy") for i in range(300)]
    got = sharding.with_shards(spark.createDataFrame(rows, cases.SCHEMA), 30).collect()
    want = plain_directory([(bits_of(r[0]), 10) for r in rows], 30)
    assert {g["shard"] for g in got} == set(want) and len(got) == 300


def test_empty_table(spark, folder):
    assert sharding.with_shards(cases.empty(spark)).collect() == []


def test_written_shards(spark, folder):
    rows = [cases.document(i, "z" * 10) for i in range(50)]
    sharded = sharding.with_shards(spark.createDataFrame(rows, cases.SCHEMA), 100)
    sharding.write_shards(sharded.select("doc_id", "text", "shard"), folder + "/out")
    assert spark.read.parquet(folder + "/out").groupBy("shard").count().agg({"count": "max"}).first()[0] <= 10
