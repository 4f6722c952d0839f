"""The manifest against a plain tree in Python."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from strata.llm import hmm, merkle
from tests.llm import cases


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, text=None):
    out = []
    for value in (row[0], row[3], row[2], row[4], row[1] if text is None else text):
        out.append("-" if value is None else f"{len(str(value).encode())}:{value}")
    return sha(*out)


def tree(digests):
    """Top, and per leaf the list of (before, after) from its level up."""
    paths, at, level = [[] for _ in digests], list(range(len(digests))), list(digests)
    while len(level) > 1:
        for k, i in enumerate(at):
            run = level[i // 16 * 16: i // 16 * 16 + 16]
            paths[k].append(("".join(run[: i % 16]), "".join(run[i % 16 + 1:])))
            at[k] = i // 16
        level = [sha(*level[i: i + 16]) for i in range(0, len(level), 16)]
    return level[0], paths


def plain(rows):
    by_source = {}
    for row in rows:
        by_source.setdefault(row[3], []).append(row)
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    built = []
    for name in names:
        own = sorted(by_source[name], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        built.append((own, *tree([leaf_of(r) for r in own])))
    root, crown = tree([top for _, top, _ in built])
    out = []
    for (own, top, paths), above in zip(built, crown):
        for row, path in zip(own, paths):
            leaf = at = leaf_of(row)
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[1] is not None:
                at = leaf_of(row, row[1].translate(cases.UPPER))
            whole = path + above
            for before, after in whole:
                at = sha(before, at, after)
            out.append((row[0], leaf, top, root, sha(*[b + a for b, a in whole]), at, at == root))
    return sorted(out, key=repr)


def check(spark, rows, parts=3):
    docs = spark.createDataFrame(rows, cases.SCHEMA).repartition(parts)
    got = merkle.verified(docs, F.col("doc_id").isNotNull() & (hmm.remainder(F.col("doc_id"), 5) == 0))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain(rows)


@pytest.mark.parametrize("sizes", [(1,), (300, 256, 33, 17, 16, 2, 1), tuple([2] * 20)])
def test_trees_equal_a_plain_one(spark, sizes):
    rows, rng = [], random.Random(len(sizes))
    for s, size in enumerate(sizes):
        for _ in range(size):
            rows.append(cases.document(rng.randrange(10**6), f"Text {rng.random()} É", "en", f"s{s}" if s else None))
    rng.shuffle(rows)
    check(spark, rows)


def test_windows_of_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(merkle, "BLOCK", 32)
    check(spark, [cases.document(i, f"T{i}", None if i % 3 else "de", "hot" if i % 7 else "é") for i in range(1200)], 5)


def test_messy_and_empty(spark):
    check(spark, cases.messy_rows())
    assert merkle.verified(cases.empty(spark), F.lit(False)).collect() == []


def test_tampering_is_found(spark):
    rows = [cases.document(i, f"Some Text {i}") for i in range(50)]
    got = merkle.verified(spark.createDataFrame(rows, cases.SCHEMA), F.col("doc_id") == 7).collect()
    assert {r["doc_id"] for r in got if not r["verified"]} == {7}
    assert len({r["root"] for r in got}) == 1
