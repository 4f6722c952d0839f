"""Systematic sampling against a plain loop."""

import hashlib
import math
import random

from strata.llm import mixing
from tests.llm import cases


def plain_targets(sizes, share=1.5, stop=2):
    """Targets by sharing the excess again and again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    left, free, target = share * sum(sizes.values()), set(names), {}
    while free:
        level = left / sum(weight[s] for s in free)
        full = {s for s in free if weight[s] * level >= stop * sizes[s]}
        if not full:
            return target | {s: weight[s] * level for s in free}
        target |= {s: float(stop * sizes[s]) for s in full}
        left, free = left - sum(stop * sizes[s] for s in full), free - full
    return target


def check(spark, rows):
    docs = spark.createDataFrame(rows, cases.SCHEMA).repartition(4)
    got = mixing.copies_per_row(docs).collect()
    assert len(got) == len(rows)
    sizes = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + len(cases.words(r[1]))
    want = plain_targets(sizes)
    taken = dict.fromkeys(sizes, 0)
    for g in got:
        assert g["source_size"] == sizes[g["source"]]
        assert math.isclose(g["target"], want[g["source"]], rel_tol=1e-9, abs_tol=1e-9)
        assert g["copies"] in (0, 1, 2)
        taken[g["source"]] += g["copies"] * g["size"]
    longest = {s: max(len(cases.words(r[1])) for r in rows if r[3] == s) for s in sizes}
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 2 * longest[s] + 1, (s, taken[s], want[s])
    # One by one: the prefix sum of a source's rate, in order of size, bucket and id.
    for s in sizes:
        own = sorted((g["size"], -1 if g["doc_id"] is None else g["doc_id"] % mixing.BUCKETS,
                      -1 if g["doc_id"] is None else g["doc_id"], g["copies"]) for g in got if g["source"] == s)
        key = "" if s is None else "=" + s
        start = int(hashlib.md5(f"mix:{key}".encode()).hexdigest()[:5], 16) / 2**20
        rate = want[s] / sizes[s] if sizes[s] else 0.0
        sums = [math.floor(k * rate + start) for k in range(len(own) + 1)]
        assert sorted(o[3] for o in own) == sorted(b - a for a, b in zip(sums, sums[1:]))
    return docs, got


def test_mix_of_many_sources(spark):
    rng = random.Random(4)
    rows = [cases.document(i * 7, " ".join(["w"] * int(rng.paretovariate(1.1))), "en",
                           rng.choice(["a"] * 30 + ["b", "c", "d", "é", "Z", None, "e"])) for i in range(3000)]
    docs, got = check(spark, rows)
    again = mixing.copies_per_row(docs.repartition(3)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_emitted_rows(spark):
    docs, got = check(spark, cases.messy_rows())
    mixed = mixing.mix(docs)
    assert mixed.schema == docs.schema
    counts, want = {}, {}
    for r in mixed.collect():
        counts[r["doc_id"]] = counts.get(r["doc_id"], 0) + 1
    for g in got:
        want[g["doc_id"]] = want.get(g["doc_id"], 0) + g["copies"]
    assert counts == {k: n for k, n in want.items() if n}


def test_empty_table_and_no_words(spark):
    assert mixing.mix(cases.empty(spark)).collect() == []
    assert mixing.copies_per_row(cases.empty(spark)).collect() == []
    rows = [cases.document(1, None), cases.document(2, "")]
    got = mixing.copies_per_row(spark.createDataFrame(rows, cases.SCHEMA)).collect()
    assert [(g["size"], g["target"], g["copies"]) for g in got] == [(0, 0.0, 0)] * 2
