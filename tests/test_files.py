import datetime
import decimal
import json
import os

import pytest
from pyspark.sql import functions as F

from strata.functions.contracts import traffic_contract
from strata.plans import governed_files, tips
from strata.sources import external, files, sinks
from tests import samples
from tests.conftest import rows

# Fixed value: the header of the bills. The rows are made up.
BILLS = (
    "total_bill,tip,sex,smoker,day,time,size\n"
    "40.00,5.00,Male,Yes,Tue,Lunch,4\n12.50,1.25,Female,No,Wed,Dinner,1\n"
)


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as out:
        out.write(text)
    return path


def test_declared_csv_empty_field_quotes_and_bad_record(spark, folder):
    path = put(f"{folder}/a.csv", 'id,name,n\n1,"a, ""b""",5\n2,,\n3,x,bad\n')
    read = files.read_csv(spark, path, "id int, name string, n int")
    assert rows(read) == [(1, 'a, "b"', 5), (2, None, None), (3, "x", None)]
    with pytest.raises(Exception):
        files.read_csv(spark, path, "id int, name string, n int", strict=True).collect()


def test_header_contract(spark, folder):
    path = put(f"{folder}/t.csv", BILLS.replace("total_bill", " Total_Bill "))
    loaded = tips.load(spark, path, f"{folder}/out")
    assert loaded.columns == list(tips.COLUMNS) and loaded.count() == 2
    wrong = put(f"{folder}/w.csv", BILLS.replace("tip,sex", "sex,tip"))
    with pytest.raises(ValueError, match="Unexpected source columns"):
        tips.load(spark, wrong, f"{folder}/out")
    empty = put(f"{folder}/e.csv", BILLS.split("\n")[0] + "\n")
    with pytest.raises(ValueError, match="empty"):
        tips.load(spark, empty, f"{folder}/out")
    with pytest.raises(ValueError, match="Expected 244"):
        files.require_rows(loaded, 244)


def test_bills_enriched_renamed_numbered_and_verified(spark, folder):
    path = put(f"{folder}/t.csv", BILLS)
    tips.enrich_and_load(spark, path, f"{folder}/rich")
    enriched = tips.enrich_and_load(spark, path, f"{folder}/rich")  # replaced, not appended
    assert sorted(r.tip_percentage for r in enriched.collect()) == [10.0, 12.5]
    renamed = tips.rename_and_load(spark, path, f"{folder}/named")
    assert renamed.columns[-1] == "party_size"
    table = tips.open_table(renamed, ["total_bill"], "tip_id", f"{folder}/open")
    assert rows(table, "tip_id", "party_size") == [(1, 1), (2, 4)]
    assert tuple(tips.summary(table).first()) == (2, 52.5, 4, 2)
    gate = {r.metric: r.ok for r in tips.verify(tips.summary(table)).collect()}
    assert gate == {
        "row_count": False, "total_bill": False, "max_party_size": False, "service_days": False,
    }
    assert tuple(tips.ratio_summary(enriched).first()) == (2, 52.5, 11.25)


def test_typed_ndjson(spark, folder):
    path = put(f"{folder}/o.json", (
        '{"order_id":"S-1","order_date":"2026-08-01","amount":"10.50"}\n'
        '{"order_id":"S-2","order_date":"2026-08-02","amount":3}\n'))
    columns = {"order_id": "string", "order_date": "date", "amount": "decimal(38,9)"}
    read = files.read_ndjson_typed(spark, path, columns, required=("order_id", "amount"))
    assert rows(read) == [
        ("S-1", datetime.date(2026, 8, 1), decimal.Decimal("10.500000000")),
        ("S-2", datetime.date(2026, 8, 2), decimal.Decimal("3.000000000")),
    ]
    hole = put(f"{folder}/h.json", '{"order_id":null,"amount":"1"}\n')
    with pytest.raises(Exception, match="required column order_id is NULL"):
        files.read_ndjson_typed(spark, hole, columns, required=("order_id",)).collect()
    for pruned in (lambda f: f.select("amount").collect(), lambda f: f.count()):
        with pytest.raises(Exception, match="required column order_id is NULL"):
            pruned(files.read_ndjson_typed(spark, hole, columns, required=("order_id",)))


def test_json_lines_and_shards(spark, folder):
    views = spark.createDataFrame(samples.page_views(24), samples.VIEWS)
    path = sinks.overwrite_json_lines(views, f"{folder}/in")
    names = [f for f in os.listdir(path) if f.startswith("part")]
    assert names and all(f.endswith(".jsonl") for f in names)
    with open(f"{path}/{sorted(names)[0]}", encoding="utf-8") as lines:
        first = lines.readline().rstrip("\n")
    assert first == json.dumps(json.loads(first), separators=(",", ":"), sort_keys=True)
    put(f"{path}/deep/more.jsonl", first + "\n\n")
    put(f"{path}/notes.txt", "no shard\n")
    assert files.read_jsonl_shards(spark, path).count() == 25
    assert files.read_json_lines(spark, f"{path}/part-*", traffic_contract()).count() == 24
    put(f"{path}/bad.txt", '{"event_id":"x"}\n')
    with pytest.raises(Exception, match="Missing traffic fields"):
        files.read_json_lines(spark, f"{path}/bad.txt", traffic_contract()).collect()


def test_suffix_range_reads_only_its_folders(spark, folder):
    data = spark.range(100).select("id", F.concat(F.lit("2017010"), F.col("id") % 9 + 1).alias("suffix"))
    path = sinks.overwrite_partitioned(data, f"{folder}/shards", ["suffix"])
    some = files.read_suffix_range(spark, path, "20170103", "20170105")
    assert {r.suffix for r in some.collect()} == {"20170103", "20170104", "20170105"}
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan


def test_external_table_reads_in_place(spark, folder):
    put(f"{folder}/inv/a.csv", "invoice_id,customer_id,total\n10,1,9.99\n11,1,0.01\n")
    schema = "invoice_id int, customer_id int, total decimal(38,9)"
    for _ in range(2):  # replaces the table of that name
        table = governed_files.external_table(spark, "test_invoices", f"{folder}/inv", schema)
    external.drop_external_table(spark, "test_invoices")
    assert not spark.catalog.tableExists("test_invoices")
    assert tuple(governed_files.invoice_summary(table).first()) == (2, 1, decimal.Decimal("10.00"))


def test_export_keeps_order_over_part_files(spark, folder):
    data = spark.range(500).select((499 - F.col("id")).alias("CustomerId"), F.lit('q"x').alias("N"))
    path = sinks.export_csv(
        data, f"{folder}/out", {"CustomerId": "customer_id", "N": "name"}, "CustomerId"
    )
    lines = []
    for name in sorted(f for f in os.listdir(path) if f.startswith("part")):
        with open(f"{path}/{name}", encoding="utf-8") as part:
            lines += part.read().splitlines()[1:]
    assert [int(line.split(",")[0]) for line in lines] == list(range(500))
    assert files.read_csv(spark, path, "customer_id int, name string").first().name == 'q"x'


def test_append_needs_the_same_declared_columns(spark, folder):
    data = spark.range(3)
    with pytest.raises(Exception):
        sinks.append(data, f"{folder}/nowhere")
    path = sinks.overwrite(data, f"{folder}/t")
    sinks.append(data, path)
    assert spark.read.parquet(path).count() == 6
    with pytest.raises(ValueError, match="differ"):
        sinks.append(data.withColumn("x", F.lit(1)), path)


def test_hot_partition_value_is_written_whole(spark, folder):
    data = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, "2026-01-01").otherwise(
            F.concat(F.lit("2026-02-"), F.lpad((F.col("id") % 28 + 1).cast("string"), 2, "0"))
        ).alias("d"), "id")
    path = sinks.overwrite_partitioned(data, f"{folder}/p", ["d"], ["id"])
    assert rows(spark.read.parquet(path), "id") == rows(data, "id")
    clustered = sinks.overwrite_clustered(data, f"{folder}/c", ["d"])
    assert spark.read.parquet(clustered).count() == 9000


def test_jdbc_options_split_the_scan(spark):
    options = external.jdbc_options("jdbc:x", "orders", "order_id", (1, 1000), 8)
    assert options["numPartitions"] == "8" and options["upperBound"] == "1000"
    assert "partitionColumn" not in external.jdbc_options("jdbc:x", "orders")
    with pytest.raises(ValueError):
        external.jdbc_options("jdbc:x", "orders", "order_id")
    assert external.open_table_format(spark) == "parquet"


def test_published_messages_carry_attributes(spark, folder):
    data = spark.createDataFrame([("e1", "north", None)], "event_id string, corridor string, x int")
    sent = spark.read.parquet(sinks.publish(data, f"{folder}/topic", ["corridor"])).first()
    assert json.loads(sent.value) == {"event_id": "e1", "corridor": "north", "x": None}
    assert sent.attributes == {"corridor": "north"}
