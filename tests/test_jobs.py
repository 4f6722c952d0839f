import json

import pytest

from strata import jobs
from strata.functions.contracts import CORRIDORS
from strata.plans import orders_replica
from strata.sources import sinks
from tests import samples
from tests.conftest import rows
from tests.test_files import BILLS, put
from tests.test_quality import SAMPLE
from tests.test_streams import arrive, reading
from tests.test_warehouse import ORDERS, write


def test_batch_jobs(spark, folder):
    quality = jobs.main(["order-quality", "--input", put(f"{folder}/o.csv", SAMPLE),
                         "--output", f"{folder}/quality"])
    assert tuple(quality.first()) == (10, 6, 4, 0.6)
    house = jobs.main(["warehouse", "--input", write(f"{folder}/orders.json", ORDERS),
                       "--output", f"{folder}/house"])
    assert tuple(house.first()) == (4, 6, 6, 9, 6, 4)
    bills = put(f"{folder}/tips.csv", BILLS)
    for job in ("load-csv", "enrich-csv", "rename-csv"):
        assert jobs.main([job, "--input", bills, "--output", f"{folder}/{job}"]).count() > 0
    views = sinks.overwrite_json_lines(
        spark.createDataFrame(samples.page_views(120), samples.VIEWS), f"{folder}/views")
    conserved = jobs.main(["site-traffic", "--input", views, "--output", f"{folder}/traffic"])
    assert conserved.filter("NOT ok").count() == 0
    counts = spark.createDataFrame([("the", "lear", 700)], "word string, corpus string, word_count bigint")
    counts.write.parquet(f"{folder}/words")
    report = jobs.main(["corpus", "--input", f"{folder}/words", "--output", f"{folder}/corpus"])
    assert report.filter("violations > 0").count() == 0


def test_stream_jobs(spark, folder):
    lines = samples.lines(samples.road_readings(30, CORRIDORS))
    arrive(folder, 1, *lines, '{"event_id":"invalid-demo"}')
    common = ["--output", f"{folder}/out", "--checkpoint", f"{folder}/cp"]
    done = jobs.main(["corridors", "--input", f"{folder}/in", "--declare", *common])
    assert tuple(done.first()) == (3, 30, 1)
    arrive(folder, 2, reading(3, "north", 40))
    again = jobs.main(["corridors", "--input", f"{folder}/in", *common])
    assert tuple(again.first()) == (3, 31, 1)

    put(f"{folder}/land/a.CSV", "id,name\n1,a\n")
    landed = jobs.main(["arrivals", "--input", f"{folder}/land", "--schema", "id int, name string",
                        "--output", f"{folder}/table", "--checkpoint", f"{folder}/cp2"])
    assert rows(landed) == [(1, "a")]


def test_replica_job(spark, folder):
    names = ["Ada Lovelace", "Grace Hopper", "Katherine Johnson"]
    spark.createDataFrame(
        [(1001 + i, n, "paid", None, None) for i, n in enumerate(names)], orders_replica.ORDER_SCHEMA
    ).write.parquet(f"{folder}/snapshot")
    put(f"{folder}/log/1.json", json.dumps(
        {"order_id": 1004, "customer_name": "Margaret Hamilton", "status": "paid",
         "amount": 320.75, "op": "I", "seq": 1}) + "\n")
    current = jobs.main([
        "replica", "--input", f"{folder}/log", "--snapshot", f"{folder}/snapshot", "--declare",
        "--output", f"{folder}/out", "--checkpoint", f"{folder}/cp", "--compacted", f"{folder}/next"])
    assert rows(current, "order_id") == [(1001,), (1002,), (1003,), (1004,)]
    assert all(r.ok for r in orders_replica.verify(current, 1004, "paid").collect())
    assert not any(r.ok for r in orders_replica.verify(current, 9, "paid").collect())


def test_replica_job_with_a_store(spark, folder):
    spark.createDataFrame([(1, "Ann", "paid", None, None), (2, "Ben", "paid", None, None)],
                          orders_replica.ORDER_SCHEMA).write.parquet(f"{folder}/snapshot")
    common = ["replica", "--input", f"{folder}/log", "--store", f"{folder}/store", "--output", f"{folder}/out",
              "--checkpoint", f"{folder}/cp"]
    put(f"{folder}/log/1.json", json.dumps({"order_id": 2, "op": "D", "seq": 4}) + "\n")
    first = jobs.main([*common, "--declare", "--snapshot", f"{folder}/snapshot", "--buckets", "4"])
    assert rows(first, "order_id") == [(1,)]
    put(f"{folder}/log/2.json", json.dumps({"order_id": 2, "op": "U", "status": "paid", "seq": 3}) + "\n" + json.dumps(
        {"order_id": 1, "customer_name": "Ann", "status": "shipped", "op": "U", "seq": 5}) + "\n")
    assert rows(jobs.main(common), "order_id", "status") == [(1, "shipped")]


def test_unknown_job_and_missing_option():
    with pytest.raises(SystemExit):
        jobs.main(["nothing"])
    with pytest.raises(SystemExit):
        jobs.main(["gameplay", "--input", "x", "--output", "y", "--checkpoint", "z"])
