"""The field against all label paths, and languages of held-out and switched texts."""

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest

from strata.llm import language, tokens
from tests.llm import cases

POOLS = {
    "aa": "mat tam lam kalam barta mantra kartan laman".split(),
    "bb": "öst schön größe über nücht schweg höher fürst".split(),
    "cc": "queo liuri eauxi oisie enteau queri louie rouis".split(),
}


def sentence(rng, lang, n):
    return " ".join(rng.choice(POOLS[lang]) + rng.choice(["", "", rng.choice(POOLS[lang])]) + rng.choice(["", "", ","]) for _ in range(n))


@pytest.fixture(scope="module")
def field(spark):
    rng = random.Random(5)
    rows = [(lang, sentence(rng, lang, rng.randrange(5, 80))) for lang in POOLS for _ in range(120)]
    rows += [(None, "mat öst queo"), ("aa", None), ("aa", ""), ("bb", " \n")]
    return language.fitted(spark.createDataFrame(rows, "label string, text string"))


def test_marginals_sum_over_all_paths(field):
    text = "mat größe, 17 queri tam"
    table = language.WordTable(pa.array([text]))
    scores, k = field.word_scores(table)[table.which], len(field.labels)
    weight = {}
    for path in itertools.product(range(k), repeat=len(scores)):
        total = sum(scores[t, s] for t, s in enumerate(path)) + sum(field.moves[a, b] for a, b in zip(path, path[1:]))
        weight[path] = np.exp(total)
    z = sum(weight.values())
    letters = table.lettered[table.which]
    want = [sum(w for p, w in weight.items() for t in [i] if p[t] == s) / z for i in np.flatnonzero(letters) for s in range(k)]
    share, count, _ = field.label(pa.array([text]))
    assert count[0] == 4 == letters.sum()
    assert np.allclose(share[0], np.reshape(want, (4, k)).mean(0), atol=1e-5)


def test_gradient_is_that_of_the_likelihood():
    rng = np.random.default_rng(1)
    scores, moves, marks = rng.normal(size=(2, 4, 3)), rng.normal(size=(3, 3)), rng.integers(0, 3, (2, 4))

    def likelihood(s, m):
        total = 0.0
        for row in range(2):
            value = lambda p: sum(s[row, t, x] for t, x in enumerate(p)) + sum(m[a, b] for a, b in zip(p, p[1:]))
            total += value(marks[row]) - np.log(sum(np.exp(value(p)) for p in itertools.product(range(3), repeat=4)))
        return total

    words, pairs = language._gradient(scores, moves, marks)
    step = 1e-5
    for at in np.ndindex(2, 4, 3):
        up = scores.copy()
        up[at] += step
        assert np.isclose((likelihood(up, moves) - likelihood(scores, moves)) / step, words[at], atol=1e-3)
    for at in np.ndindex(3, 3):
        up = moves.copy()
        up[at] += step
        assert np.isclose((likelihood(scores, up) - likelihood(scores, moves)) / step, pairs[at], atol=1e-3)


def test_held_out_accuracy_and_switches(spark, field):
    rng = random.Random(77)
    rows = [cases.document(i, sentence(rng, lang, rng.randrange(3, 40)), lang) for i, lang in enumerate(list(POOLS) * 60)]
    switched = [cases.document(1000 + i, sentence(rng, "aa", 30) + " " + sentence(rng, "bb", 12)) for i in range(20)]
    out = {r["doc_id"]: r for r in language.identified(
        spark.createDataFrame(rows + switched, cases.SCHEMA), field).collect()}
    assert sum(out[r[0]]["lang_pred"] == r[2] for r in rows) >= 0.98 * len(rows)
    for r in switched:
        found = out[r[0]]
        assert found["lang_pred"] == "aa" and 0.55 < found["score"] < 0.9 and 1 <= found["n_switches"] <= 5


def test_messy_documents(spark, field):
    docs = cases.messy(spark)
    out = language.identified(docs, field)
    rows = out.collect()
    assert len(rows) == len(cases.messy_rows())
    assert [c for c in out.columns if c == "score"] == ["score"]
    by_id = {r["doc_id"]: r for r in rows}
    assert all((by_id[i]["lang_pred"], by_id[i]["score"]) == ("und", 0.0) for i in (1, 2, 3, 9))
    assert all(r["lang_pred"] in POOLS and 0 < r["score"] <= 1 for r in rows if r["doc_id"] not in (1, 2, 3, 9))
    kept = language.keep_identified(docs, field)
    assert kept.schema == docs.schema
    assert {1, 2, 3, 9} & {r["doc_id"] for r in kept.collect()} == set()
    assert language.identified(cases.empty(spark), field).collect() == []


def test_letters_beyond_latin(spark, field):
    rows = [cases.document(1, "文字 です"), cases.document(2, "€ … — 42"), cases.document(3, "ª º")]
    out = {r["doc_id"]: r["lang_pred"] for r in language.identified(spark.createDataFrame(rows, cases.SCHEMA), field).collect()}
    assert out[1] in POOLS and out[2] == "und" and out[3] in POOLS


def test_nothing_to_learn_from(spark):
    field = language.fitted(spark.createDataFrame([], "label string, text string"))
    assert {r["lang_pred"] for r in language.identified(cases.messy(spark), field).collect()} == {"und"}


def test_long_words_are_cut_into_pieces():
    texts = pa.array(["short " + "日本語の文" * 40 + " end", None, "x" * 20 + " " + "y" * 21, "é" * 30])
    found = tokens.words(texts)
    start, end, at = language.pieces(found)
    for d, text in enumerate(texts.to_pylist()):
        own = [bytes(found.data[s:e]) for s, e in zip(start[at[d]: at[d + 1]], end[at[d]: at[d + 1]])]
        assert b"".join(own).decode() == "".join((text or "").split())
        assert all(piece.decode() and len(piece) <= language.REACH for piece in own)
    assert np.diff(at)[2] == 3  # twenty bytes stay whole
    # All of a sentence without blanks counts, not its beginning alone.
    table = language.WordTable(pa.array(["ab" * 500 + "zq" * 500]))
    assert len(table.which) > 100 and len(np.unique(table.which)) >= 2
