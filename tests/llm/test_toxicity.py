"""The label model against all assignments, the classifier on held-out planted documents."""

import itertools
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from strata.llm import hmm, toxicity
from tests.llm import cases

LABELS = "doc_id long, quality int, toxic int"
BITS = toxicity.VOTERS


def held_out(doc_id):
    return doc_id.isNotNull() & (hmm.remainder(doc_id, 5) == 0)


def corpus(seed=4, size=1500):
    """Prose with planted words in every ninth document, and a decoy word once in clean ones."""
    rng, rows, labels = random.Random(seed), [], []
    for i in range(size):
        body = [rng.choice("lorem ipsum dolor élan voor niet wohl der und".split()) + rng.choice(["", "a", "en", "um"])
                for _ in range(rng.randrange(40, 300))]
        toxic = i % 9 == 0
        if toxic:
            for _ in range(2 + len(body) // 40):
                body[rng.randrange(len(body))] = rng.choice(
                    ["grunkel", "blopf", "schnorz" + rng.choice(["en", "um", "ig", "a"]), "GRUNKEL!!", "snerd,"])
        elif i % 4 == 1:
            body[rng.randrange(len(body))] = "schnorz" + rng.choice(["en", "um"])
        rows.append(cases.document(i, " ".join(body)))
        if i % 2:
            labels.append((i, 1, int(toxic)))
    return rows, labels


def test_held_out_documents(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame(rows, cases.SCHEMA).repartition(4)
    out = toxicity.scored(docs, spark.createDataFrame(labels, LABELS), held_out)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    got = {r["doc_id"]: r for r in out.collect()}
    unseen = [i for i in range(len(rows)) if i % 2 == 0 or got[i]["held_out"]]
    right = [got[i]["predicted"] == (i % 9 == 0) for i in unseen]
    assert np.mean(right) > 0.98
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got.values())
    # Labels of held-out rows, sources and languages do not matter.
    other = [(i, q, t if i % 5 else t) for i, q, t in labels]
    flipped = [(i, q, 1 - t if got[i]["held_out"] else t) for i, q, t in other]
    again = toxicity.scored(docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None).cast("string")),
                            spark.createDataFrame(flipped, LABELS), held_out)
    assert {r["doc_id"]: r["score"] for r in again.collect()} == {i: r["score"] for i, r in got.items()}


def test_evidence_of_plain_counts():
    texts = pa.array(["Grunkel grunkel, x grunkelig", None, "nothing", "BLOPF!! blopf"])
    found = toxicity.letter_words(texts)
    assert found.counts.tolist() == [4, 0, 1, 2]
    by_kind = {toxicity.KINDS[k]: dict(zip(fit.tolist(), key.tolist())) for k, fit, key in toxicity.keys(found)}
    word, prefix = by_kind["word", 0], by_kind["prefix", 7]
    assert word[0] == word[1] != word[3] and prefix[0] == prefix[1] == prefix[3] and 4 in prefix and 2 not in prefix
    order = np.argsort(np.array([word[0], prefix[0], word[5]], np.uint64))
    entries = toxicity.Entries(np.array([word[0], prefix[0], word[5]], np.uint64)[order],
                               np.array([2, 3, 3])[order], np.array([0, 4, 1])[order])
    votes, x = toxicity.evidence(texts, entries)
    # Two words of lexicon 0, three beginnings of lexicon 4; "blopf" only twice where three are asked.
    assert x[0, :5].tolist() == [np.log1p(2), 0, 0, 0, np.log1p(3)] and x[3, 1] == 0
    fired = [[b for b in range(BITS) if v >> b & 1] for v in votes.tolist()]
    assert fired == [[0, 4, 12, 13, 14], [], [], [13, 14, 15]]


def sampled_votes(rng, n):
    """Two independent good voters, one that repeats the first one, silence elsewhere."""
    y = rng.random(n) < 0.3
    a = np.where(y, rng.random(n) < 0.8, rng.random(n) < 0.1)
    b = np.where(y, rng.random(n) < 0.7, rng.random(n) < 0.05)
    c = np.where(rng.random(n) < 0.97, a, ~a)
    return y.astype(int), a | b << 1 | c.astype(int) << 2


def test_label_model_learns_accuracies_and_correlations():
    y, votes = sampled_votes(np.random.default_rng(3), 40_000)
    shown = np.where(np.arange(len(y)) < 2000, y, -1)
    found, count = np.unique(np.column_stack([votes, shown]), axis=0, return_counts=True)
    model = toxicity.LabelModel(found[:, 0], found[:, 1], count)
    assert abs(model.prior[1] - 0.3) < 0.03
    assert abs(model.chance[1, 0, 1] - 0.8) < 0.05 and abs(model.chance[0, 1, 1] - 0.05) < 0.03
    assert {model.parent[2], model.parent[0]} & {0, 2}  # the repeated voter hangs on its original
    # A repeated vote adds little: with both as without the second.
    twice, true = model.posterior(np.array([0b101]))[0], y[votes == 0b101].mean()
    odds = np.prod([model.chance[:, j, s] for j, s in ((0, 1), (1, 0), (2, 1))], 0) * model.prior
    assert abs(twice - true) < 0.06 < 0.2 < odds[1] / odds.sum() - true


def test_likelihood_sums_to_one_over_all_votes():
    y, votes = sampled_votes(np.random.default_rng(5), 3000)
    found, count = np.unique(np.column_stack([votes, y]), axis=0, return_counts=True)
    model = toxicity.LabelModel(found[:, 0], found[:, 1], count)
    every = np.arange(1 << BITS)
    assert abs(np.exp(model.log_likelihood(every)).sum() - 1) < 1e-9
    for pattern in (0, 5, 4097, 65535):
        want = []
        for y in (0, 1):
            p = model.prior[y]
            for j, above in enumerate(model.parent):
                mine = pattern >> j & 1
                p *= model.chance[y, j, mine] if above < 0 else model.given[y, j, above, mine, pattern >> above & 1]
            want.append(p)
        assert np.allclose(model.posterior(np.array([pattern])), want[1] / sum(want))


def test_newton_steps_equal_a_plain_fit(spark):
    rows, labels = corpus(size=400)
    docs, known = spark.createDataFrame(rows, cases.SCHEMA), toxicity.training_labels(
        spark.createDataFrame(labels, LABELS), held_out)
    evidence = toxicity.gathered(docs, known, toxicity.mined(docs, known), held_out)
    model = toxicity.label_model(evidence)
    weights = toxicity.classifier(evidence, model)
    data = evidence.filter("NOT held_out").collect()
    x, q = np.array([r["x"] for r in data]), model.posterior(np.array([r["votes"] for r in data]))
    q = np.where([r["y"] < 0 for r in data], q, [r["y"] for r in data])
    p = 1 / (1 + np.exp(-x @ weights))
    assert np.abs(x.T @ (q - p) - toxicity.RIDGE * weights).max() < 1e-3  # the gradient vanishes


def test_messy_empty_and_unlabelled(spark):
    docs, none = cases.messy(spark), spark.createDataFrame([], LABELS)
    out = toxicity.scored(docs, none, held_out).collect()
    assert len(out) == len(cases.messy_rows()) and {r["score"] for r in out} == {0.0}
    odd = spark.createDataFrame([(6, None, None), (6, 1, 1), (None, 0, 0), (5, 0, None), (8, 1, 0), (8, 1, 1), (101, 0, 0)], LABELS)
    assert toxicity.scored(docs, odd, held_out).count() == len(cases.messy_rows())
    assert toxicity.scored(cases.empty(spark), odd, held_out).collect() == []
    assert not list(itertools.chain(toxicity.scored(cases.empty(spark), none, held_out).collect()))
