"""Near-duplicates against all pairs."""

import random

import numpy as np
import pytest

from strata.llm import neardup
from strata.llm.components import components
from tests.llm import cases


def variants(seed, base_words, copies, edits):
    rng = random.Random(seed)
    base = [f"v{rng.randrange(400)}" for _ in range(base_words)]
    texts = [" ".join(base)]
    for _ in range(copies):
        copy = list(base)
        for _ in range(rng.randrange(edits + 1)):
            copy[rng.randrange(len(copy))] = f"e{rng.randrange(10_000)}"
        texts.append(" ".join(copy))
    return texts


@pytest.mark.parametrize("size", [4, 5])
def test_components_equal_all_pairs(spark, size, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 16)  # several blocks in one bucket
    texts = variants(1, 90, 150, 9) + variants(2, 40, 40, 3) + variants(3, 12, 10, 1) + ["alone here today"] * 3
    rows = [cases.document(i * 3, text) for i, text in enumerate(texts)]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"])
           for r in neardup.near_duplicates(spark.createDataFrame(rows, cases.SCHEMA).repartition(5), size).collect()}
    sets = {r[0]: cases.shingles(r[1], size) for r in rows}
    want = cases.components(sets)
    assert got == {k: (len(sets[k]), want[k], want[k] == k) for k in sets}
    assert 3 < len(set(want.values())) < len(rows)


def test_messy_documents(spark):
    docs = cases.messy(spark)
    got = [tuple(r) for r in neardup.near_duplicates(docs).collect()]
    assert len(got) == len(cases.messy_rows())
    by_id = {g[0]: g for g in got}
    assert by_id[1][1:] == (0, 1, True) and by_id[2][1:] == (0, 2, True) and by_id[3][1:] == (0, 3, True)
    assert by_id[6][2:] == (6, True) and by_id[7][2:] == (6, False) and by_id[10][2:] == (6, False)
    assert by_id[8][2] == 6  # nine of ten shingles
    assert by_id[None][2:] == (None, True)
    assert sum(g[0] == 6 for g in got) == 2


def test_one_row_of_each_component_stays(spark):
    docs = cases.messy(spark)
    left = neardup.deduplicate(docs, size=5)
    assert left.schema == docs.schema
    ids = [r["doc_id"] for r in left.collect()]
    assert ids.count(6) == 1 and not {7, 8, 10} & set(ids)
    assert {1, 2, 3, 4, 5, 9, 11, None} <= set(ids)


def test_empty_table(spark):
    assert neardup.near_duplicates(cases.empty(spark)).collect() == []
    assert neardup.deduplicate(cases.empty(spark)).collect() == []


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(5)
    values = rng.integers(0, 1 << 63, 3000, dtype=np.uint64) * np.uint64(2)
    whole = neardup.registers(values, np.array([0, 3000]))
    parts = neardup.registers(values, np.array([0, 1000, 3000]))
    assert (neardup.merged(parts[0], parts[1]) == whole[0]).all()
    for similarity in (0.3, 0.6, 0.8, 0.95):
        estimates = []
        for _ in range(30):
            pool = rng.integers(0, 1 << 63, 1000, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
            both, only = int(1000 * similarity), int(1000 * (1 - similarity) / 2)
            one, other = pool[: both + only], np.concatenate([pool[:both], pool[both + only:]])
            a = neardup.registers(np.concatenate([one, other]), np.array([0, len(one), len(one) + len(other)]))
            estimates.append(neardup.likelihood_similarity(
                np.array([(a[0] > a[1]).sum()]), np.array([(a[0] < a[1]).sum()]),
                np.array([len(one)]), np.array([len(other)]))[0])
        assert abs(np.mean(estimates) - similarity) < 0.03
        assert np.std(estimates) < 0.06


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(205, 203), (203, 205)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, 203: 203, 205: 203}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
