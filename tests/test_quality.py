import collections
import decimal
import random

import pytest
from pyspark.sql import functions as F

from strata.operators import quality as ops
from strata.plans import data_products, order_quality as plan
from tests.conftest import rows
from tests.test_files import put

# Ten orders, four of them defective.
SAMPLE = """order_id,customer_id,order_date,delivery_date,status,amount,country_code
O-1001,C-101,2026-08-01,2026-08-03,delivered,129.90,BR
O-1002,C-102,2026-08-01,2026-08-04,shipped,84.50,US
O-1003,C-103,2026-08-02,,processing,42.00,GB
O-1004,,2026-08-02,2026-08-03,delivered,75.00,BR
O-1005,C-105,2026-08-03,2026-08-02,delivered,210.00,DE
O-1006,C-106,2026-08-03,,cancelled,12.00,JP
O-1007,C-107,2026-08-04,2026-08-05,unknown,55.25,AU
O-1008,C-108,2026-08-04,2026-08-06,delivered,-9.90,BR
O-1009,C-109,2026-08-05,2026-08-07,delivered,320.40,CA
O-1010,C-110,2026-08-05,,processing,18.75,US
"""


def test_sample_job(spark, folder):
    tables = plan.run(spark, put(f"{folder}/o.csv", SAMPLE), f"{folder}/out")
    assert tuple(plan.summary(tables).first()) == (10, 6, 4, 0.6)
    assert rows(tables.rejected.select("order_id", F.explode("failed_rules"))) == [
        ("O-1004", "customer_id_required"), ("O-1005", "delivery_not_before_order"),
        ("O-1007", "status_valid"), ("O-1008", "amount_positive"),
    ]
    assert "failed_rules" not in tables.valid.columns
    expected = {"total_records": ops.Expect(equals=10), "validity_rate": ops.Expect(equals=0.6)}
    assert all(r.ok for r in plan.verify(tables, expected, {r.name for r in plan.RULES}).collect())
    less = plan.verify(tables, expected, {"status_valid"})
    with pytest.raises(RuntimeError, match="failed_rules"):
        ops.demand_gate(less)


def test_null_policy_and_unreadable_dates(spark):
    schema = plan.ORDER_SCHEMA
    frame = spark.createDataFrame([
        ("a", "C", "2026-08-01", "tomorrow", "shipped", 1.0, "BR"),
        ("b", "C", "2026-08-01", None, None, None, "BR"),
        ("c", "  ", "bad", "2026-08-01", "shipped", 1.0, "BR"),
    ], schema)
    strict = {r.order_id: list(r.failed_rules) for r in plan.assess(frame).collect()}
    assert strict == {
        "a": [], "b": ["amount_positive", "status_valid"],
        "c": ["customer_id_required", "delivery_not_before_order"],
    }
    lenient = {r.order_id: list(r.failed_rules) for r in plan.assess(frame, "pass").collect()}
    assert lenient == {"a": [], "b": [], "c": ["customer_id_required"]}
    dated = {r.order_id: list(r.failed_rules)
             for r in plan.assess(frame, check_dates=True).collect()}
    assert dated["a"] == ["delivery_date_readable"]
    assert dated["c"][-1] == "order_date_readable"
    with pytest.raises(ValueError):
        plan.assess(frame, "maybe")


def test_metrics_of_nothing(spark):
    empty = plan.assess(spark.createDataFrame([], plan.ORDER_SCHEMA))
    row = ops.quality_metrics(empty).first()
    assert (row.total_records, row.valid_records, row.validity_rate) == (0, 0, None)
    assert ops.failed_rule_counts(empty).count() == 0


def test_assertions(spark):
    frame = spark.createDataFrame(
        [("a", 1), ("a", 200), (None, 150), ("b", None)], "word string, n int"
    )
    rules = ops.Assertions(("word", "n"), ("word",), ("n >= 100",))
    report = {r.assertion: r.violations for r in ops.assertion_report("m", frame, rules).collect()}
    assert report == {"non_null": 2, "row_condition: n >= 100": 2, "unique_key: word": 1}
    assert rows(ops.unique_key_violations(frame, ["word"])) == [("a", 2)]
    assert ops.row_condition_violations(frame, "n >= 100").count() == 2
    assert ops.non_null_violations(frame, ["n"]).count() == 1
    with pytest.raises(RuntimeError, match="unique_key: word"):
        ops.demand_clean(ops.assertion_report("m", frame, rules))
    ops.demand_clean(ops.assertion_report("m", frame.limit(0), rules))


def test_many_unique_keys_in_one_pass(spark):
    draw = random.Random(3)
    made = [(draw.choice([None, *range(30)]), draw.choice([None, "", "a", "b", "ab"]), draw.choice([0.0, -0.0, 1.5, None]),
             draw.choice([None, [None, 1], [1, None], [1]]), i if i % 50 else None) for i in range(200)]
    frame = spark.createDataFrame(made, "n long, word string, x double, list array<int>, id int")
    keys = [("n",), ("word", "n"), ("n", "word"), ("list",), ("x", "word"), ("id",)]
    conditions = tuple(f"n > {i}" for i in range(70))  # two masks
    rules = ops.Assertions((), (), conditions, tuple(keys))
    report = ops.assertion_report("m", frame, rules)
    got = {r.assertion: r.violations for r in report.collect()}
    for key in keys:
        at = ["n word x list id".split().index(c) for c in key]
        # Zeros of both signs are one value, lists are compared whole.
        counts = collections.Counter(repr([0.0 if m[i] == 0 and i == 2 else m[i] for i in at]) for m in made)
        assert got[f"unique_key: {', '.join(key)}"] == sum(c > 1 for c in counts.values()), key
    for i in range(70):
        assert got[f"row_condition: n > {i}"] == sum(m[0] is None or m[0] <= i for m in made)

    uniques = [ops.Rule(c, c, "unique", "UNIQUENESS", ignore_null=c == "id") for c in ("n", "word", "x", "list", "id")]
    scanned = ops.scan(frame, [*uniques, ops.Rule("set", "word", "in_set", "VALIDITY", values=("a",))])
    known = [m[4] for m in made if m[4] is not None]
    result = {r.rule: (r.evaluated, r.passed) for r in scanned.collect()}
    assert result["id"] == (len(known), len(known)) and result["word"] == (200, 0) and result["set"][0] == 200
    with pytest.raises(ValueError):
        ops.assertion_report("m", frame, ops.Assertions())


def test_unique_rules_scan_once_and_shuffle_once(spark, folder):
    path = f"{folder}/t"
    spark.range(1000).selectExpr("id AS a", "id % 7 AS b", "id AS c", "string(id) AS d", "id % 3 AS e").write.parquet(path)
    uniques = [ops.Rule(c, c, "unique", "UNIQUENESS") for c in "abcde"]
    scanned = ops.scan(spark.read.parquet(path), [*uniques, ops.Rule("set", "b", "in_set", "VALIDITY", values=(1,))])
    plan = scanned._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("hashpartitioning") == 1 and "SortAggregate" not in plan
    assert {r.rule: r.passed for r in scanned.collect()} == {"a": 1000, "b": 0, "c": 1000, "d": 1000, "e": 0, "set": 143}


def test_scan_rule_kinds(spark):
    frame = spark.createDataFrame(
        [(1, "A", 0.0, "a@b.c"), (1, "B", 1.0, "a@b"), (2, None, 5.0, None), (None, "A", None, "@")],
        "id int, kind string, n double, mail string",
    )
    rules = [
        ops.Rule("complete", "id", "non_null", "COMPLETENESS", threshold=0.75),
        ops.Rule("unique", "id", "unique", "UNIQUENESS"),
        ops.Rule("unique_known", "id", "unique", "UNIQUENESS", ignore_null=True),
        ops.Rule("set", "kind", "in_set", "VALIDITY", values=("A", "B")),
        ops.Rule("set_known", "kind", "in_set", "VALIDITY", values=("A", "B"), ignore_null=True),
        ops.Rule("above", "n", "range", "VALIDITY", minimum=0, strict_minimum=True),
        ops.Rule("within", "n", "range", "VALIDITY", minimum=0, maximum=5, ignore_null=True),
        ops.Rule("below", "n", "range", "VALIDITY", maximum=5, strict_maximum=True),
        ops.Rule("mail", "mail", "regex", "VALIDITY", pattern="^[^@]+@[^@]+[.][^@]+$"),
    ]
    got = {r.rule: (r.evaluated, r.passed, r.ok) for r in ops.scan(frame, rules).collect()}
    assert got == {
        "complete": (4, 3, True), "unique": (4, 1, False), "unique_known": (3, 1, False),
        "set": (4, 3, False), "set_known": (3, 3, True), "above": (4, 2, False),
        "within": (3, 3, True), "below": (4, 2, False), "mail": (4, 1, False),
    }
    nothing = {r.rule: r.ok for r in ops.scan(frame.limit(0), rules).collect()}
    assert all(nothing.values())
    with pytest.raises(ValueError):
        ops.Rule("x", "n", "odd", "VALIDITY").predicate()


def test_domain_products(spark, folder):
    orders = [("S-%d" % i, "C-%d" % (i % 4), "2026-08-0%d" % (i + 1),
               ("PAID", "SHIPPED", "CANCELLED")[i % 3], "%d.50" % (i + 1)) for i in range(5)]
    lines = "".join(
        '{"order_id":"%s","customer_id":"%s","order_date":"%s","status":"%s","amount":"%s"}\n' % o
        for o in orders)
    loaded = data_products.load_domain(
        spark, put(f"{folder}/o.json", lines), data_products.ORDER_COLUMNS, f"{folder}/orders")
    assert loaded.schema["amount"].dataType.simpleString() == "decimal(38,9)"
    scanned = data_products.scan_domain(loaded, data_products.ORDER_RULES)
    assert scanned.count() == 4 and scanned.filter("NOT ok").count() == 0
    people = spark.createDataFrame(
        [("C-%d" % i, "N", "n%d@x.org" % i, "BR", i % 2 == 0) for i in range(4)],
        "customer_id string, full_name string, email string, country string, consent boolean")
    assert data_products.scan_domain(people, data_products.CUSTOMER_RULES).count() == 4
    assert tuple(data_products.row_counts(loaded, people).first()) == (5, 4)
    zero = loaded.withColumn("amount", F.lit(decimal.Decimal(0)))
    with pytest.raises(RuntimeError, match="score"):
        data_products.scan_domain(zero, data_products.ORDER_RULES)


def test_catalog_contract(spark):
    schema = ("domain string, aspect struct<domain:string,owner:string,classification:string,"
              "quality_slo:double>, owners array<string>")
    frame = spark.createDataFrame([
        ("sales", ("sales", "o", "INTERNAL", 0.99), ["a@x"]),
        ("customers", ("sales", "o", "SECRET", 0.9), []),
        ("none", None, None),
    ], schema)
    got = {r.domain: list(r.failed_rules) for r in data_products.check_catalog(frame).collect()}
    assert got["sales"] == []
    assert got["customers"] == [
        "domain_matches", "slo_sufficient", "classification_known", "owner_present"]
    assert got["none"][0] == "aspect_present" and len(got["none"]) == 5


def test_conservation_finds_a_loss(spark):
    source = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3)], "k string, n int")
    whole = source.groupBy("k").agg(F.sum("n").alias("n"))
    part = whole.filter("k = 'b'")
    check = ops.conservation(source, {"all": whole, "some": part}, {"n": F.sum("n")})
    assert {(r.branch, r.branch_total, r.source_total, r.ok) for r in check.collect()} == {
        ("all", 6, 6, True), ("some", 5, 6, False)}
