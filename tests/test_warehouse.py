import datetime
import json
import pathlib

from pyspark.sql import functions as F

from strata.operators.quality import Expect, gate
from strata.plans import warehouse as plan
from tests.conftest import rows

# The six sample orders and what the warehouse makes of them.
CUSTOMERS = {
    "C-001": ("Ana Costa", "Sao Paulo", "consumer"),
    "C-002": ("Bruno Lima", "Rio de Janeiro", "consumer"),
    "C-003": ("Carla Souza", "Curitiba", "small_business"),
    "C-004": ("Diego Alves", "Recife", "small_business"),
}
PRODUCTS = {
    "P-101": ("Mechanical Keyboard", "electronics"),
    "P-102": ("USB-C Hub", "electronics"),
    "P-103": ("Webcam", "electronics"),
    "P-201": ("Desk Lamp", "home"),
    "P-202": ("Office Chair", "home"),
    "P-203": ("Standing Desk", "home"),
}
ORDERS = [
    ("ORD-1001", "2026-01-02", "web", "C-001", [("P-101", 1, 420.0), ("P-201", 2, 95.0)]),
    ("ORD-1002", "2026-01-02", "marketplace", "C-002", [("P-102", 1, 230.0)]),
    ("ORD-1003", "2026-01-03", "web", "C-003", [("P-202", 2, 780.0), ("P-103", 1, 350.0)]),
    ("ORD-1004", "2026-01-04", "marketplace", "C-001", [("P-101", 1, 420.0)]),
    ("ORD-1005", "2026-01-04", "web", "C-004", [("P-203", 1, 1650.0), ("P-102", 2, 230.0)]),
    ("ORD-1006", "2026-01-05", "web", "C-002", [("P-103", 1, 350.0)]),
]


def record(order_id, date, channel, customer, items):
    person = None
    if customer is not None:
        name, city, segment = CUSTOMERS[customer]
        person = {"customer_id": customer, "name": name, "city": city, "segment": segment}
    return {
        "order_id": order_id, "order_date": date, "channel": channel, "customer": person,
        "items": None if items is None else [
            {"product_id": p, "name": PRODUCTS[p][0], "category": PRODUCTS[p][1],
             "quantity": q, "unit_price": u} for p, q, u in items],
    }


def write(path, orders):
    with open(path, "w", encoding="utf-8") as out:
        out.writelines(json.dumps(record(*o)) + "\n" for o in orders)
    return path


def test_sample_orders(spark, folder):
    source = write(f"{folder}/orders.json", ORDERS)
    house = plan.build_from_ndjson(spark, source, f"{folder}/house")
    assert tuple(plan.verification(house).first()) == (4, 6, 6, 9, 6, 4)
    day = datetime.date
    assert rows(house.daily, "sales_date", "channel", "order_count", "units_sold",
                "gross_revenue") == rows(spark.createDataFrame([
                    (day(2026, 1, 2), "web", 1, 3, 610.0),
                    (day(2026, 1, 2), "marketplace", 1, 1, 230.0),
                    (day(2026, 1, 3), "web", 1, 3, 1910.0),
                    (day(2026, 1, 4), "marketplace", 1, 1, 420.0),
                    (day(2026, 1, 4), "web", 1, 3, 2110.0),
                    (day(2026, 1, 5), "web", 1, 1, 350.0)], "a date, b string, c int, d int, e double"))
    lifetime = rows(house.customer_sales_summary(), "customer_id", "lifetime_orders",
                    "lifetime_revenue")
    assert lifetime == [("C-001", 2, 1030.0), ("C-002", 2, 580.0), ("C-003", 1, 1910.0),
                        ("C-004", 1, 2110.0)]
    first = rows(house.customers, "customer_id", "first_order_date")
    assert first[0] == ("C-001", day(2026, 1, 2))
    checked = gate(plan.verification(house), {"order_count": Expect(equals=6)})
    assert [r.ok for r in checked.collect()] == [True]
    again = plan.build_from_ndjson(spark, source, f"{folder}/house")  # idempotent
    assert tuple(plan.verification(again).first()) == (4, 6, 6, 9, 6, 4)
    monthly = plan.build_from_ndjson(spark, source, f"{folder}/monthly", "month")
    assert tuple(plan.verification(monthly).first()) == (4, 6, 6, 9, 6, 1)


def test_edge_orders(spark, folder):
    odd = ORDERS + [
        ("ORD-2001", "2026-01-06", "store", "C-003", [("P-103", 1, 1.0)]),
        ("ORD-2002", "2026-01-06", "web", "C-003", []),
        ("ORD-2003", "2026-01-06", "web", "C-003", None),
        ("ORD-2004", "2026-01-06", "web", None, [("P-101", 1, 10.0)]),
        (None, "2026-01-06", "web", "C-003", [("P-101", 1, 10.0)]),
    ]
    source = write(f"{folder}/orders.json", odd)
    house = plan.build_from_ndjson(spark, source, f"{folder}/house")
    assert house.staged.count() == 8  # no id, empty and missing items are left out
    # Other channels reach the facts but not the marts; an order without customer
    # has items but no order fact.
    assert house.orders.filter("order_id = 'ORD-2001'").count() == 1
    assert house.orders.filter("order_id = 'ORD-2004'").count() == 0
    assert house.items.filter("order_id = 'ORD-2004'").count() == 1
    assert house.daily.filter("sales_date = DATE'2026-01-06'").count() == 0
    stranger = house.customers.limit(1).select(
        F.lit("C-999").alias("customer_id"), F.lit("New").alias("customer_name"), "city",
        "segment", "first_order_date")
    summary = plan.customer_sales_summary(house.customers.unionByName(stranger), house.orders)
    assert rows(summary.filter("customer_id = 'C-999'"), "lifetime_orders", "lifetime_revenue") == [
        (0, None)]
    price = rows(house.products.filter("product_id = 'P-101'"), "current_unit_price")
    assert price == [(10.0,)]  # of the newest sale


def test_channel_union_equals_one_scan(spark, folder):
    staged = plan.stage_orders(spark.read.json(write(f"{folder}/o.json", ORDERS)))
    union = plan.channel_items(staged, "web").unionByName(plan.channel_items(staged, "marketplace"))
    assert union.select("product_id").distinct().count() == plan.dim_products(staged).count() == 6
    assert plan.dim_products(staged, ["marketplace"]).count() == 2


def test_the_job_stores_its_nested_orders_compressed(spark, folder, monkeypatch):
    """two thirds of what the job wrote were plain JSON lines; every item went through the
    products' sort and shuffle twice over."""
    from strata.registry import warehouse as registry

    day = datetime.datetime(2024, 1, 5)
    for name, schema, data in (
        ("nation", "n_nationkey int, n_name string", [(0, "ALGERIA")]),
        ("customer", "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string", [(1, "C1", 0, 1.0, "BUILDING")]),
        ("part", "p_partkey long, p_name string, p_type string", [(1, "bolt", "SMALL"), (2, "nut", "LARGE")]),
        ("orders", "o_orderkey long, o_custkey long, o_orderdate timestamp, o_orderpriority string", [(1, 1, day, "1-URGENT"), (2, 1, day, "5-LOW")]),
        ("lineitem", "l_orderkey long, l_linenumber int, l_partkey long, l_quantity double, l_extendedprice double",
         [(1, 1, 1, 2.0, 3.5), (1, 2, 1, 1.0, 4.5), (2, 1, 2, 1.0, 1.0)]),
    ):
        spark.createDataFrame(data, schema).write.parquet(f"{folder}/{name}.parquet")
    monkeypatch.setattr(registry, "scratch_path", lambda spark, label: f"{folder}/{label}")
    assert tuple(registry.warehouse_verification(spark, folder).first()) == (1, 1, 2, 2, 1, 1)
    parts = [p.name for p in pathlib.Path(f"{folder}/raw-orders").glob("part-*")]
    assert parts and all(p.endswith(".json.gz") for p in parts)
    products = plan.dim_products(spark.read.parquet(f"{folder}/warehouse/stg_orders"))
    assert [tuple(r) for r in products.collect()] == [("1", "bolt", "SMALL", 4.5)]
    assert ", item, item#" not in products._jdf.queryExecution().optimizedPlan().toString()
