"""The replica stored by key buckets, against a replay of its changes."""

import glob
import os
import random

import pytest

from strata.streaming import bucketed
from strata.streaming.tables import append_batch, declare_table
from tests.conftest import rows

ROWS = "region string, id bigint, name string, amount decimal(10,2)"
LOG = ROWS + ", op string, seq bigint"
KEYS = ["region", "id"]


def files(store):
    return set(glob.glob(f"{store.location}/rows/*/*/*.parquet"))


def plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_random_changes_equal_a_replay(spark, folder):
    draw = random.Random(5)
    path = declare_table(spark, f"{folder}/changes", LOG)
    held = {(r, i): (f"{r}{i}", None) for r in "ab" for i in range(40)}
    start = spark.createDataFrame([(*k, *v) for k, v in held.items()], ROWS)
    store = bucketed.create(spark, start, KEYS, f"{folder}/store", 8)
    changes = [(draw.choice("abc"), draw.randrange(60), f"n{s}", None, draw.choice("IUD"), s) for s in range(300)]
    draw.shuffle(changes)
    last = {}
    for batch in range(3):
        part = changes[batch * 100: batch * 100 + 100]
        # A batch holds the last change per key, as the stream stores it.
        append_batch(spark.createDataFrame(part, LOG), batch, path)
        for region, i, name, amount, op, seq in part:
            if seq > last.get((region, i), (-1,))[0]:
                last[region, i] = (seq, op, name, amount)
        expected = {k: v for k, v in held.items() if k not in last}
        expected |= {k: (n, a) for k, (_, op, n, a) in last.items() if op != "D"}
        wanted = sorted(((*k, *v) for k, v in expected.items()), key=repr)
        assert rows(bucketed.rows(spark, store, path)) == wanted
        if batch != 1:  # the last state takes two batches at once
            store = bucketed.compact(spark, store, path)
            assert rows(bucketed.rows(spark, store)) == wanted
            assert rows(bucketed.rows(spark, bucketed.open_store(spark, store.location), path)) == wanted
    # An older change that comes late: on a row, on a deleted one.
    deleted = next(k for k, v in last.items() if v[1] == "D")
    kept = next(k for k, v in last.items() if v[1] != "D" and v[0] > 0)
    append_batch(spark.createDataFrame([(*deleted, "ghost", None, "I", -1), (*kept, "old", None, "D", 0)], LOG), 3, path)
    assert rows(bucketed.rows(spark, store, path)) == wanted
    store = bucketed.compact(spark, store, path)
    assert rows(bucketed.rows(spark, store)) == wanted and store.number == 3


def test_only_changed_buckets_are_written_and_nothing_stored_is_shuffled(spark, folder):
    start = spark.range(20_000).selectExpr("'x' AS region", "id", "'n' AS name", "CAST(id AS decimal(10,2)) AS amount")
    store = bucketed.create(spark, start, KEYS, f"{folder}/store", 100)
    first = files(store)
    assert len(first) == len(store.versions) == 100
    path = declare_table(spark, f"{folder}/changes", LOG)
    append_batch(spark.createDataFrame([("x", 7, "new", None, "U", 1)], LOG), 0, path)

    text = plan(bucketed.rows(spark, store, path).filter("name = 'new'"))
    final = text[: text.index("Initial Plan")]
    scan = [line for line in final.splitlines() if "FileScan" in line and bucketed.APPLIED in line]
    assert len(scan) == 1 and "Bucketed: true" in scan[0]
    # One exchange, that of the changes: by the bucket count, in the branch without the stored rows.
    exchanges = [line for line in final.splitlines() if "Exchange" in line]
    assert len([e for e in exchanges if "hashpartitioning(region" in e and ", 100)" in e]) == 1
    depth = lambda line: len(line) - len(line.lstrip(" :+-*"))
    lines = final.splitlines()
    at = lines.index(scan[0])
    above, level = [], depth(scan[0])
    for line in reversed(lines[:at]):
        if depth(line) < level:
            above.append(line)
            level = depth(line)
    assert not any("Exchange" in line for line in above)

    second = bucketed.compact(spark, store, path)
    written = files(second) - first
    assert len(written) == 1 and first <= files(second)
    changed = [b for b in store.versions if store.versions[b] != second.versions[b]]
    assert len(changed) == 1 and f"{bucketed.BUCKET}={changed[0]}/" in written.pop()
    assert bucketed.rows(spark, second).count() == 20_000
    assert rows(bucketed.rows(spark, second).filter("id = 7"), "name") == [("new",)]
    # The older state is still there until it is cleared away.
    assert rows(bucketed.rows(spark, bucketed.open_store(spark, store.location, 0)).filter("id = 7"), "name") == [("n",)]
    assert bucketed.vacuum(spark, store.location) == 1 and len(files(second)) == 100
    assert bucketed.rows(spark, bucketed.open_store(spark, store.location)).count() == 20_000
    with pytest.raises(ValueError):
        bucketed.open_store(spark, store.location, 0)


def test_a_compaction_that_died_leaves_no_trace(spark, folder, monkeypatch):
    start = spark.createDataFrame([("a", 1, "n", None)], ROWS)
    store = bucketed.create(spark, start, KEYS, f"{folder}/store", 4)
    path = declare_table(spark, f"{folder}/changes", LOG)
    append_batch(spark.createDataFrame([("a", 1, "m", None, "U", 1), ("b", 2, "k", None, "I", 2)], LOG), 0, path)

    def die(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(bucketed, "_committed", die)
        with pytest.raises(RuntimeError):
            bucketed.compact(spark, store, path)
    store = bucketed.open_store(spark, f"{folder}/store")
    assert store.number == 0 and rows(bucketed.rows(spark, store), "name") == [("n",)]
    store = bucketed.compact(spark, store, path)
    assert rows(bucketed.rows(spark, store), "id", "name") == [(1, "m"), (2, "k")]
    assert bucketed.vacuum(spark, store.location) >= 2
    # Nothing new: the next state names the same files.
    os.makedirs(f"{folder}/store/manifests/number=2/_temporary/0")  # a manifest that was never finished
    again = bucketed.compact(spark, store, path)
    with pytest.raises(ValueError):
        bucketed.compact(spark, store, path)
    assert again.versions == store.versions and again.number == 2


def test_empty_store_and_broken_keys(spark, folder):
    none = spark.createDataFrame([], ROWS)
    store = bucketed.create(spark, none, KEYS, f"{folder}/empty", 4)
    assert bucketed.rows(spark, store).count() == 0 and store.versions == {}
    path = declare_table(spark, f"{folder}/changes", LOG)
    assert bucketed.compact(spark, store, path).versions == {}
    with pytest.raises(Exception, match="NULL in the key"):
        bucketed.create(spark, spark.createDataFrame([("a", None, "n", None)], ROWS), KEYS, f"{folder}/null", 4)
    assert not os.path.exists(f"{folder}/null/manifests")
