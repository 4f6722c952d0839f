"""Rule statistics against a plain count, and the forest on planted anomalies."""

import collections
import random
import re

import numpy as np

from strata.llm import anomalies
from tests.llm import cases


def plain_counts(text):
    text = text or ""
    found = cases.words(text)
    windows = collections.Counter(tuple(found[i: i + 3]) for i in range(len(found) - 2))
    covered = {j for i in range(len(found) - 2) if windows[tuple(found[i: i + 3])] > 1 for j in range(i, i + 3)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if re.search(cases.SPACE, line):
            again += line in seen
            seen.add(line)
    return (len(found), sum(map(len, found)), sum(c in "#*$%&|<>" for c in text), again, len(covered))


def corpus(seed=6):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(900):
        body = [rng.choice("lorem ipsum dolor sit amet élan voor niet wohl".split()) + rng.choice(["", "a", "en", "12", "."])
                for _ in range(rng.randrange(60, 200))]
        bad = i % 9 == 0
        if bad:
            body = [w + rng.choice(["###", " |", "$$", "***"]) for w in body]
        text = "".join(w + rng.choice([" ", " ", " ", "\n"]) for w in body)
        rows.append(cases.document(i, text))
        if i % 2:
            labels.append((i, 0 if bad else 1, 0))
    return rows, labels


LABELS = "doc_id long, quality int, toxic int"


def test_counts_equal_a_plain_count(spark):
    rng = random.Random(2)
    alphabet = ["a", "b", "a b a", "\n", " ", "\n\n", "x y z", "\t", "é#", "\x0b", "a", " ", "|", "ab\r\n"]
    rows = [cases.document(i, " ".join(rng.choice(alphabet) for _ in range(rng.randrange(60)))) for i in range(300)]
    rows += cases.messy_rows()
    got = [tuple(r)[:6] for r in anomalies.rule_statistics(spark.createDataFrame(rows, cases.SCHEMA).repartition(3)).collect()]
    assert sorted(got, key=repr) == sorted(((r[0], *plain_counts(r[1])) for r in rows), key=repr)


def test_anomalies_go_and_clean_documents_stay(spark):
    rows, labels = corpus()
    out = anomalies.judged(spark.createDataFrame(rows, cases.SCHEMA), spark.createDataFrame(labels, LABELS)).collect()
    kept = {r["doc_id"]: r["kept"] for r in out}
    assert sum(not kept[i] for i in range(0, 900, 9)) >= 90
    assert sum(kept[i] for i in range(900) if i % 9) >= 780
    again = anomalies.judged(spark.createDataFrame(rows, cases.SCHEMA).repartition(5), spark.createDataFrame(labels, LABELS))
    assert {r["doc_id"]: r["kept"] for r in again.collect()} == kept


def test_paths_of_the_forest():
    rng = np.random.default_rng(1)
    rows = rng.normal(size=(2000, 8))
    forest = anomalies.Forest(rows)
    near, far = forest.scores(np.zeros((1, 8)))[0], forest.scores(np.full((1, 8), 9.0))[0]
    assert near < 0.5 < far
    # One tree walked by hand.
    x, node, depth = rows[0], 0, 0
    while depth < anomalies.DEPTH:
        node = 2 * node + 1 + int(x[forest.feature[0, node]] >= forest.split[0, node])
        depth += 1
    assert forest.path[0, node] >= 1


def test_trees_draw_from_the_whole_table(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(anomalies, "Forest", lambda rows, *args, **more: seen.append((rows, more)))
    zeros = [f"0L AS {c}" for c in anomalies.COUNTS if c not in ("n_words", "word_chars")]
    anomalies.fitted(spark.range(40_000).selectExpr("id AS doc_id", "1L AS n_words", "id AS word_chars", *zeros))
    rows, more = seen[0]
    assert len(np.unique(rows[:, 0])) > 20_000
    assert np.bincount(more["drawn_by"]).tolist() == [anomalies.TREE_ROWS] * anomalies.TREES


def test_messy_empty_and_unlabelled(spark):
    docs, none = cases.messy(spark), spark.createDataFrame([], LABELS)
    out = anomalies.judged(docs, none).collect()
    assert len(out) == len(cases.messy_rows())
    assert all(r["kept"] == (not r["base_failed"]) for r in out)
    assert anomalies.judged(cases.empty(spark), none).collect() == []
    odd = spark.createDataFrame([(6, None, None), (6, 1, 1), (None, 0, 0), (5, 0, None), (5, 1, None)], LABELS)
    assert anomalies.judged(docs, odd).count() == len(cases.messy_rows())
