"""Containment search against all pairs."""

import random

from strata.llm import decontaminate
from tests.llm import cases

ITEMS = "item_id long, text string, doc_id string"


def planted(seed=3):
    rng = random.Random(seed)
    items = [(i, " ".join(f"q{rng.randrange(300)}" for _ in range(n)))
             for i, n in enumerate([1, 3, 4, 5, 6, 7, 9, 12, 17, 33, 60, 120])]
    items += [(50, None), (51, ""), (52, items[8][1])]
    docs = []
    for d in range(120):
        body = [f"d{rng.randrange(500)}" for _ in range(rng.choice([0, 3, 40, 4000]))]
        for _ in range(rng.randrange(3)):
            item = items[rng.randrange(12)][1].split()
            for _ in range(rng.randrange(4)):
                item[rng.randrange(len(item))] = "CHANGED"
            at = rng.randrange(len(body) + 1)
            body[at:at] = item
        docs.append((d, " ".join(body).upper() if d % 2 else " ".join(body)))
    return docs, items


def test_matches_equal_all_pairs(spark, monkeypatch):
    docs, items = planted()
    want = set()
    for d, text in docs:
        words = cases.words(text.translate(cases.UPPER))
        for i, item in items:
            wanted = cases.shingles(item, 5)
            run = min(5, len(cases.words(item)))
            have = {tuple(words[k: k + run]) for k in range(len(words) - run + 1)}
            found = len(have & wanted)
            if wanted and 100 * found >= 80 * len(wanted):
                want.add((d, i, len(wanted), found))
    table = spark.createDataFrame([cases.document(*d) for d in docs], cases.SCHEMA)
    items_table = spark.createDataFrame([(*i, "clash") for i in items], ITEMS)
    for block in (decontaminate.BLOCK_SHINGLES, 60):  # one block of items, and many
        monkeypatch.setattr(decontaminate, "BLOCK_SHINGLES", block)
        got = [tuple(r)[:4] for r in decontaminate.contaminated(table, items_table).collect()]
        assert set(got) == want and len(got) == len(want) > 20
    left = decontaminate.drop_contaminated(table, items_table)
    assert left.schema == table.schema
    assert {r["doc_id"] for r in left.collect()} == {d for d, _ in docs} - {w[0] for w in want}


def test_short_items_inside_long_documents(spark):
    rest = " ".join(f"word{i}" for i in range(3000))
    docs = spark.createDataFrame([
        cases.document(1, f"{rest} Alpha beta gamma delta {rest}"), cases.document(2, f"{rest} gamma"),
        cases.document(3, "delta"), cases.document(4, rest)], cases.SCHEMA).coalesce(1)
    items = spark.createDataFrame(
        [(1, "gamma delta", "x"), (2, "alpha beta gamma", "x"), (3, "gamma", "x"), (4, "gamma beta", "x")], ITEMS)
    got = sorted(tuple(r)[:4] for r in decontaminate.contaminated(docs, items).collect())
    assert got == [(1, 1, 1, 1), (1, 2, 1, 1), (1, 3, 1, 1), (2, 3, 1, 1)]  # not "gamma | delta" of two texts


def test_sketches_cannot_miss():
    for n in range(1, 3000):
        assert decontaminate.sketch_length(n) > n - decontaminate.needed(n)


def test_messy_and_empty(spark):
    items = spark.createDataFrame([(1, "Two three four FIVE six seven eight", "x"), (2, None, "x"), (3, "short", "x")], ITEMS)
    docs = cases.messy(spark)
    got = sorted((r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs, items).collect())
    assert got == [(4, 3), (6, 1), (6, 1), (7, 1), (8, 1), (10, 1)]
    assert decontaminate.drop_contaminated(docs, items).count() == len(cases.messy_rows()) - 6
    none = items.limit(0)
    assert decontaminate.contaminated(docs, none).count() == 0
    assert decontaminate.drop_contaminated(docs, none).count() == len(cases.messy_rows())
    assert decontaminate.contaminated(cases.empty(spark), items).count() == 0
