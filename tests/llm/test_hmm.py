"""The hidden Markov model against its definition."""

import collections
import itertools
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import hmm
from tests.llm import cases


def test_likelihood_sums_over_all_paths(monkeypatch):
    monkeypatch.setattr(hmm, "STATES", 3)
    model = hmm.Model(seed=2)
    texts = [bytes([3, 200, 7, 255]), bytes([255]), b"", bytes([1, 1, 1, 1, 1, 255])]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    got = hmm.log_likelihood(model, np.frombuffer(b"".join(texts), np.uint8), offsets)
    for text, value in zip(texts, got):
        total = 0.0
        for path in itertools.product(range(3), repeat=len(text)):
            p = 1.0
            for t, (state, seen) in enumerate(zip(path, text)):
                p *= (model.start[state] if t == 0 else model.move[path[t - 1], state]) * model.emit[state, seen]
            total += p
        assert math.isclose(value, math.log10(total), abs_tol=1e-9)


def paths_of(model, texts, states):
    """Counts and log likelihood summed over all state paths of every text."""
    start, move, emit, total = np.zeros(states), np.zeros((states, states)), np.zeros((states, hmm.CLASSES)), 0.0
    for text in texts:
        weights = {}
        for path in itertools.product(range(states), repeat=len(text)):
            p = model.start[path[0]] * model.emit[path[0], text[0]]
            for t in range(1, len(text)):
                p *= model.move[path[t - 1], path[t]] * model.emit[path[t], text[t]]
            weights[path] = p
        z = sum(weights.values())
        total += math.log(z)
        for path, p in weights.items():
            start[path[0]] += p / z
            for t, state in enumerate(path):
                emit[state, text[t]] += p / z
                if t:
                    move[path[t - 1], state] += p / z
    return start, move, emit, total


def joined(texts):
    return np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])])


@pytest.mark.parametrize("stretch", [1, 2, 3, 4, 256])
def test_expected_counts_equal_all_paths(monkeypatch, stretch):
    monkeypatch.setattr(hmm, "STATES", 2)
    monkeypatch.setattr(hmm, "STRETCH", stretch)
    monkeypatch.setattr(hmm, "TOKENS_AT_ONCE", 7)
    monkeypatch.setattr(hmm.Model, "SIZES", (2, 4, 2 * hmm.CLASSES, 1))
    model = hmm.Model(seed=4)
    model.start = np.array([0.3, 0.7])
    texts = [bytes([5, 9, 5]), bytes([9]), bytes([8, 8, 9, 5]), bytes([5, 5, 8, 9, 9, 9, 8, 5, 255]), bytes([8, 255])]
    data, offsets = joined(texts)
    start, move, emit, total = np.split(hmm.expected_counts(model, data, offsets), np.cumsum(hmm.Model.SIZES)[:-1])
    w_start, w_move, w_emit, w_total = paths_of(model, texts, 2)
    assert np.allclose(start, w_start) and np.allclose(move.reshape(2, 2), w_move)
    assert np.allclose(emit.reshape(2, -1), w_emit) and np.allclose(total, w_total)
    assert np.allclose(hmm.log_likelihood(model, data, offsets).sum() * math.log(10), w_total)


@pytest.mark.parametrize("stretch", [256, hmm.STRETCH])
def test_long_texts_are_not_cut(monkeypatch, stretch):
    """600 and 5000 tokens against a plain recursion over the whole text."""
    monkeypatch.setattr(hmm, "STRETCH", stretch)
    rng = np.random.default_rng(3)
    texts = [bytes(rng.integers(0, 256, n).astype(np.uint8)) for n in (600, 5000, 256, 257, 3)]
    model = hmm.Model(seed=5)
    data, offsets = joined([b"", *texts])
    want, total = np.zeros((hmm.STATES, hmm.STATES)), []
    for text in texts:
        seen = model.emit.T[np.frombuffer(text, np.uint8)]
        forward, scale = [], []
        for t, e in enumerate(seen):
            state = (model.start if t == 0 else forward[-1] @ model.move) * e
            scale.append(state.sum())
            forward.append(state / state.sum())
        back = np.ones(hmm.STATES)
        for t in range(len(seen) - 1, 0, -1):
            later = back * seen[t] / scale[t]
            want += np.outer(forward[t - 1], later) * model.move
            back = model.move @ later
        total.append(np.log10(scale).sum())
    got = hmm.expected_counts(model, data, offsets)
    at = hmm.STATES
    assert np.allclose(got[at: at + hmm.STATES ** 2].reshape(want.shape), want)
    assert math.isclose(got[at: at + hmm.STATES ** 2].sum(), sum(len(t) - 1 for t in texts), rel_tol=1e-9)
    assert np.allclose(hmm.log_likelihood(model, data, offsets), [0.0, *total])


def check_base(docs, rows):
    got = hmm.scored(docs).collect()
    tokens = [[*cases.words((r[1] or "").translate(cases.UPPER)), None] for r in rows]
    held = [zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 7 == 2 for r in rows]
    counts = collections.Counter(t for text, h in zip(tokens, held) if not h for t in text)
    n, v = sum(counts.values()), len(counts)
    want = sorted((repr(r[0]), h, len(t), sum(counts[x] > 0 for x in t), n,
                   round(sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in t), 5)) for r, t, h in zip(rows, tokens, held))
    assert sorted((repr(g[0]), *g[1:5], round(g["base_score"], 5)) for g in got) == want
    assert all(g["score"] <= 0 for g in got)
    return got


def with_held_out(docs):
    return docs.withColumn("held_out", hmm.remainder(F.col("doc_id"), 7) == 2)


def test_rare_words_meet_the_vocabulary(spark, monkeypatch):
    monkeypatch.setattr(hmm, "FREQUENT", 20)
    rng = random.Random(1)
    rows = [cases.document(i, " ".join(f"Word{int(rng.paretovariate(0.6)) % 999}" for _ in range(rng.randrange(50))))
            for i in range(300)]
    check_base(with_held_out(spark.createDataFrame(rows, cases.SCHEMA).repartition(4)), rows)


def test_the_model_beats_the_base_on_held_out_texts(spark):
    rng = random.Random(3)
    pools = ["der die das und ein mit von".split(), "the of and to in is that".split()]
    rows = [cases.document(i, " ".join(rng.choice(pools[i % 2]) for _ in range(60))) for i in range(200)]
    got = [g for g in check_base(with_held_out(spark.createDataFrame(rows, cases.SCHEMA)), rows) if g["held_out"]]
    assert sum(g["score"] for g in got) > sum(g["base_score"] for g in got) + 0.1 * sum(g["n_tokens"] for g in got)


def test_messy_and_empty(spark):
    check_base(with_held_out(cases.messy(spark)), cases.messy_rows())
    assert hmm.scored(with_held_out(cases.empty(spark))).collect() == []
    only = with_held_out(cases.messy(spark)).withColumn("held_out", F.lit(True))
    got = hmm.scored(only).collect()
    assert {g["base_score"] for g in got} == {0.0} and {g["n_known"] for g in got} == {0}
