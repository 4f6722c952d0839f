"""Toxicity by weak supervision: voters, a generative label model, a linear classifier.

1. Lexicon entries are mined from a bounded sample of labelled training rows: words, and
   beginnings and ends of words, that toxic documents hold once, or twice, far more often
   than clean ones. The best ``ENTRIES`` are dealt to twelve lexicons.
2. Each document gets sixteen votes from one pass over its whole text. A lexicon votes when
   an entry occurs as often as it must, in long texts more often; four patterns vote on how many words are matched,
   how densely, how near each other, and whether they are shouted.
3. The label model is a mixture of two classes. In each, votes depend on each other along a
   tree: accuracies are the chances of a vote in a class, correlations the tables of the
   tree's edges, which join the voters with the largest mutual information given the class.
   Expectation-maximisation runs over the counts of vote patterns of all documents, 65,536 at
   most for each state of the label; rows with a training label keep it.
4. A logistic model of the evidence is fitted to the posterior labels of all training rows by
   Newton steps: Spark adds up gradient and curvature, a thousand numbers per task.

Labels are read of training rows only, and nothing but the text enters a score.

Defined cases: NULL and empty texts have no evidence and get the score of a document without
any; repeated rows are equal documents; a document with several labels has that of their
majority, none in a tie; NULL labels and ids teach nothing; without toxic or without clean
training rows every score is 0; an empty table gives an empty result; other columns are not
read. Words of scripts without blanks are whole sentences, of which beginning and end count.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm import tokens
from strata.operators.ordering import best_per_key
from strata.session import cut_lineage

SAMPLE = {1: 2048, 0: 4096}  # labelled rows that entries are mined from, by label
ENTRIES = 384
LEAST_LIFT, ERRORS = 8.0, 2.0  # an entry's lift less so many standard errors of its logarithm
KINDS = [("word", 0), *[("prefix", n) for n in range(3, 9)], *[("suffix", n) for n in (4, 5, 6)]]
DEALT = {"word": (0, 4), "prefix": (4, 5), "suffix": (9, 3)}  # first lexicon, and how many
LEXICONS = 12
VOTERS = LEXICONS + 4
NEAR = 20  # words
CHANCE = 1000  # words of a text after which an entry must occur once more, as it may by chance
ROUNDS, SETTLED = 20, 4  # of the label model; the tree is kept after the fourth
STEPS, RIDGE = 8, 1.0
WIDTH = LEXICONS + 2 + VOTERS + 1
_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(97, 123), *range(128, 256)]] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[65:91] = True
_LOWER = np.zeros(256, dtype=bool)
_LOWER[97:123] = True


def letter_words(texts: pa.Array) -> tokens.Words:
    """Runs of letters, small; everything above ASCII counts as a letter."""
    data, offsets = tokens.buffers(pc.utf8_lower(texts.cast(pa.large_string())))
    bare = np.where(_LETTER[data], data, np.uint8(32))
    # Cut characters do not matter here: words are bytes.
    return tokens.words(pa.LargeStringArray.from_buffers(
        len(offsets) - 1, pa.py_buffer(np.ascontiguousarray(offsets)), pa.py_buffer(bare)))


def keys(found: tokens.Words) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per kind its number, the words long enough for it and their keys."""
    length = found.end - found.start
    for k, (kind, n) in enumerate(KINDS):
        fit = np.flatnonzero(length >= n)
        start, end = found.start[fit], found.end[fit]
        if kind == "prefix":
            end = start + n
        elif kind == "suffix":
            start = end - n
        yield k, fit, tokens.mixed(tokens.fingerprints(found.data, start, end) ^ np.uint64(k + 1))


def stems(found: tokens.Words, kind: int, fit: np.ndarray) -> np.ndarray:
    """The first three or last four bytes of words, which keep an entry with its like."""
    if KINDS[kind][0] == "suffix":
        at, n = found.end[fit] - 4, 4
    else:
        at, n = found.start[fit], 3
    last = max(len(found.data) - 1, 0)
    out = np.zeros(len(fit), np.int64)
    for i in range(n):
        inside = (at + i >= found.start[fit]) & (at + i < found.end[fit])
        out = out << 8 | np.where(inside, found.data[np.clip(at + i, 0, last)], 0)
    return out


def _counted(doc: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (document, key) and how often each occurs."""
    order = np.lexsort((key, doc))
    doc, key = doc[order], key[order]
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])
    at = np.flatnonzero(new)
    return doc[at], key[at], np.diff(np.append(at, len(doc)))


def training_labels(labels: DataFrame, held_out) -> DataFrame:
    """``__label_id, y`` of the labelled rows that may teach; ``held_out`` maps an id column."""
    known = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long").alias("__label_id"), F.col("toxic").cast("int").alias("toxic"))
    mean = known.filter(~held_out(F.col("__label_id"))).groupBy("__label_id").agg(F.avg("toxic").alias("mean"))
    return mean.filter("mean <> 0.5").select("__label_id", (F.col("mean") > 0.5).cast("int").alias("y"))


def sampled_labels(known: DataFrame) -> DataFrame:
    """At most ``SAMPLE`` labelled rows of each label, those with the smallest hash."""
    number = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    turn = F.xxhash64("__label_id")
    share = F.lit(0.0)
    for y, wanted in SAMPLE.items():
        share = F.when(F.col("y") == y, min(1.0, 2 * wanted / max(1, number.get(y, 0)))).otherwise(share)
    # Twice as many pass the bound on the hash as are wanted, so that few rows meet in a task.
    near = known.withColumn("turn", turn).filter(F.pmod("turn", F.lit(1 << 30)) <= share * (1 << 30))
    chosen = best_per_key(near, ["y"], [F.col("turn"), F.col("__label_id")], max(SAMPLE.values()))
    toxic = best_per_key(chosen.filter("y = 1"), ["y"], [F.col("turn"), F.col("__label_id")], SAMPLE[1])
    return toxic.unionByName(chosen.filter("y = 0")).select("__label_id", "y")


@dataclass
class Entries:
    """Lexicon entries by ascending key: how often each must occur, and its lexicon."""

    key: np.ndarray
    least: np.ndarray
    lexicon: np.ndarray


def _lift(toxic: Column, clean: Column, n_toxic: int, n_clean: int) -> tuple[Column, Column]:
    """Logarithm of how much more often toxic documents hold an entry, and its standard error."""
    log = F.log((toxic + 0.5) / (n_toxic + 1)) - F.log((clean + 0.5) / (n_clean + 1))
    return log, F.sqrt(1 / (toxic + 0.5) + 1 / (clean + 0.5))


def mined(docs: DataFrame, known: DataFrame) -> Entries:
    """Entries that tell toxic from clean rows of the sample."""
    sample = cut_lineage(sampled_labels(known), "toxicity-sample")
    rows = docs.join(F.broadcast(sample), F.col("doc_id") == F.col("__label_id")).select("text", "y")  # 6144 ids at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tokens.slices(batch):
                found = letter_words(part.column("text"))
                word_doc = np.repeat(np.arange(part.num_rows), found.counts)
                y = part.column("y").to_numpy()
                for k, fit, key in keys(found):
                    names, first = np.unique(key, return_index=True)
                    stem = stems(found, k, fit[first])
                    doc, key, times = _counted(word_doc[fit], key)
                    distinct, at = np.unique(key, return_inverse=True)  # the same as ``names``
                    sums = [np.bincount(at[chosen], minlength=len(distinct)) for chosen in (
                        (y[doc] == 1), (y[doc] == 1) & (times > 1), (y[doc] == 0), (y[doc] == 0) & (times > 1))]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(names), k, np.int32)), pa.array(names.view(np.int64)), pa.array(stem),
                         *[pa.array(s, pa.int64()) for s in sums]], ["kind", "key", "stem", "t1", "t2", "c1", "c2"])

    totals = {r["y"]: r["count"] for r in rows.groupBy("y").count().collect()}
    found = rows.mapInArrow(run, "kind int, key long, stem long, t1 long, t2 long, c1 long, c2 long")
    found = found.groupBy("kind", "key").agg(F.min("stem").alias("stem"), *[F.sum(c).alias(c) for c in ("t1", "t2", "c1", "c2")]).filter("t1 >= 3")
    sides = []
    for least in (1, 2):
        log, error = _lift(F.col(f"t{least}"), F.col(f"c{least}"), totals.get(1, 0), totals.get(0, 0))
        good = log - ERRORS * error >= float(np.log(LEAST_LIFT))
        sides.append(F.struct(F.when(good, F.round(F.col(f"t{least}") * log, 9)).alias("worth"), F.lit(-least).alias("less")))
    best = found.select("kind", "key", "stem", F.greatest(*sides).alias("best")).filter("best.worth IS NOT NULL")
    top = best.orderBy(F.desc("best.worth"), "kind", "key").limit(ENTRIES).collect()
    key, least, lexicon, dealt = [], [], [], {kind: {} for kind in DEALT}
    for r in top:
        kind = KINDS[r["kind"]][0]
        first, many = DEALT[kind]
        lexicon.append(first + dealt[kind].setdefault(r["stem"], len(dealt[kind])) % many)
        key.append(r["key"])
        least.append(-r["best"]["less"])
    order = np.argsort(np.array(key, np.int64).view(np.uint64))
    return Entries(np.array(key, np.int64).view(np.uint64)[order], np.array(least, np.int64)[order],
                   np.array(lexicon, np.int64)[order])


def _shouted(texts: pa.Array) -> np.ndarray:
    """Whether most ASCII letters are capital, or two exclamation marks stand together."""
    data, offsets = tokens.buffers(texts)
    pair = np.zeros(len(data), dtype=bool)
    pair[:-1] = (data[:-1] == 33) & (data[1:] == 33)
    sums = [np.diff(np.concatenate([[0], np.cumsum(f, dtype=np.int64)])[offsets]) for f in (_UPPER[data], _LOWER[data], pair)]
    return (sums[0] > sums[1]) | (sums[2] > 0)


def evidence(texts: pa.Array, entries: Entries) -> tuple[np.ndarray, np.ndarray]:
    """Votes as bits, and the classifier's row, of every text."""
    found = letter_words(texts)
    docs, words = len(texts), found.counts
    word_doc = np.repeat(np.arange(docs), words)
    hits, matched = np.zeros((docs, LEXICONS)), np.zeros(len(word_doc), dtype=bool)
    pairs = []
    if len(entries.key):
        for _, fit, key in keys(found):
            place = np.minimum(np.searchsorted(entries.key, key), len(entries.key) - 1)
            hit = entries.key[place] == key
            matched[fit[hit]] = True
            pairs.append((word_doc[fit[hit]], place[hit]))
        doc, entry, times = _counted(*[np.concatenate(p) for p in zip(*pairs)])
        enough = times >= entries.least[entry] + words[doc] // CHANCE
        np.maximum.at(hits, (doc[enough], entries.lexicon[entry[enough]]), times[enough])
    many = np.bincount(word_doc[matched], minlength=docs)
    at = np.flatnonzero(matched)
    close = (word_doc[at[1:]] == word_doc[at[:-1]]) & (at[1:] - at[:-1] <= NEAR)
    near = np.bincount(word_doc[at[1:][close]], minlength=docs) > 0
    patterns = [many >= 3, 100 * many >= np.maximum(words, 1), near, (many > 0) & _shouted(texts)]
    fired = np.column_stack([hits > 0, *patterns])
    votes = (fired << np.arange(VOTERS)).sum(1)
    dense = 100 * many / np.maximum(words, 1)
    rows = np.column_stack([np.log1p(hits), np.log1p(many), np.log1p(dense), fired, np.ones(docs)])
    return votes, rows


class LabelModel:
    """Two classes whose votes depend on each other along a tree."""

    def __init__(self, votes: np.ndarray, y: np.ndarray, count: np.ndarray):
        """Vote patterns with their label (-1: none) and how many documents have both."""
        self.order, self.parent = list(range(VOTERS)), [-1] * VOTERS
        v = self.bits(votes)
        both = np.column_stack([1 - v, v]).astype(np.float64)  # columns: voter silent, voter fired
        taught = y >= 0
        self._fit(both[taught], (y[taught] == 1).astype(float), count[taught].astype(float))
        for round_ in range(ROUNDS):
            q = np.where(taught, y, self.posterior(votes))
            self._fit(both, q, count.astype(float), tree=round_ < SETTLED)

    @staticmethod
    def bits(votes: np.ndarray) -> np.ndarray:
        return (np.asarray(votes)[:, None] >> np.arange(VOTERS)) & 1

    def _fit(self, both: np.ndarray, q: np.ndarray, count: np.ndarray, tree: bool = True) -> None:
        weight = np.stack([count * (1 - q), count * q])
        self.prior = (weight.sum(1) + 1) / (weight.sum() + 2)
        tables = np.stack([both.T @ (w[:, None] * both) for w in weight]).reshape(2, 2, VOTERS, 2, VOTERS)
        tables = tables.transpose(0, 2, 4, 1, 3) + 0.25  # class, voter, other voter, its state, the other's
        single = weight @ both
        self.chance = (single.reshape(2, 2, VOTERS).transpose(0, 2, 1) + 0.5) / (weight.sum(1)[:, None, None] + 1)
        joint = tables / tables.sum((3, 4), keepdims=True)
        if tree:
            apart = joint.sum(4, keepdims=True) * joint.sum(3, keepdims=True)
            shared = (joint * np.log(joint / apart)).sum((3, 4))
            self._span((shared * self.prior[:, None, None]).sum(0))
        self.given = joint / joint.sum(3, keepdims=True)  # of a voter's state, given the other's

    def _span(self, shared: np.ndarray) -> None:
        """The tree of largest mutual information."""
        near, gain = np.zeros(VOTERS, np.int64), shared[:, 0].copy()
        inside, self.order, self.parent = {0}, [0], [-1] * VOTERS
        while len(inside) < VOTERS:
            j = max((k for k in range(VOTERS) if k not in inside), key=lambda k: gain[k])
            inside.add(j)
            self.order.append(j)
            self.parent[j] = int(near[j])
            closer = shared[:, j] > gain
            near[closer], gain = j, np.maximum(gain, shared[:, j])

    def log_likelihood(self, votes: np.ndarray) -> np.ndarray:
        """Of each vote pattern in both classes, the prior included."""
        v = self.bits(votes)
        out = np.repeat(np.log(self.prior)[:, None], len(v), 1)
        for j, above in enumerate(self.parent):
            if above < 0:
                out += np.log(self.chance[:, j][:, v[:, j]])
            else:
                out += np.log(self.given[:, j, above][:, v[:, j], v[:, above]])
        return out

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        clean, toxic = self.log_likelihood(votes)
        return 1 / (1 + np.exp(np.clip(clean - toxic, -700, 700)))


def gathered(docs: DataFrame, known: DataFrame, entries: Entries, held_out) -> DataFrame:
    """Written rows ``doc_id, held_out, votes, x, y``: all evidence, and training labels (-1: none)."""
    shared = docs.sparkSession.sparkContext.broadcast(entries)  # some kilobytes
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tokens.slices(batch):
                votes, x = evidence(part.column("text"), shared.value)
                flat = pa.ListArray.from_arrays(
                    pa.array(np.arange(0, x.size + 1, WIDTH), pa.int32()), pa.array(x.ravel(), pa.float32()))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(votes, pa.int32()), flat], ["doc_id", "votes", "x"])

    rows = narrow.mapInArrow(run, "doc_id long, votes int, x array<float>")
    joined = rows.join(known, F.col("doc_id") == F.col("__label_id"), "left")
    return cut_lineage(joined.select(
        "doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "votes", "x",
        F.coalesce("y", F.lit(-1)).alias("y")), "toxicity-evidence")


def label_model(rows: DataFrame) -> LabelModel | None:
    """Fitted to the counts of vote patterns over all rows; None without labels of both kinds."""
    counts = rows.groupBy("votes", "y").count().toArrow()  # 3 * 2 ** VOTERS rows at most
    counts = counts.sort_by([("votes", "ascending"), ("y", "ascending")])
    votes, y, count = (counts[c].to_numpy().astype(np.int64) for c in ("votes", "y", "count"))
    return LabelModel(votes, y, count) if {0, 1} <= set(y.tolist()) else None


def _rows_of(x: pa.Array) -> np.ndarray:
    return x.flatten().to_numpy().astype(np.float64).reshape(-1, WIDTH)


def classifier(rows: DataFrame, model: LabelModel) -> np.ndarray:
    """Weights of a logistic model of the posterior labels of all training rows."""
    spark = rows.sparkSession
    posterior = spark.sparkContext.broadcast(model.posterior(np.arange(1 << VOTERS)))  # half a megabyte
    weights = np.zeros(WIDTH)
    training = rows.filter(~F.col("held_out")).select("votes", "x", "y")
    for _ in range(STEPS):
        def run(batches: Iterator[pa.RecordBatch], weights=weights) -> Iterator[pa.RecordBatch]:
            total = np.zeros((WIDTH + 1, WIDTH))
            for batch in batches:
                x, y = _rows_of(batch.column("x")), batch.column("y").to_numpy()
                q = np.where(y < 0, posterior.value[batch.column("votes").to_numpy()], y)
                p = 1 / (1 + np.exp(-np.clip(x @ weights, -700, 700)))
                total[:WIDTH] += x.T @ ((p * (1 - p))[:, None] * x)
                total[WIDTH] += (q - p) @ x
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(total.size), pa.int32()), pa.array(total.ravel())], ["k", "v"])

        sums = np.zeros((WIDTH + 1) * WIDTH)
        for r in training.mapInArrow(run, "k int, v double").groupBy("k").agg(F.sum("v").alias("v")).collect():
            sums[r["k"]] = r["v"]
        sums = sums.reshape(WIDTH + 1, WIDTH)
        curve = sums[:WIDTH] + RIDGE * np.eye(WIDTH)
        weights = weights + np.linalg.solve(curve, sums[WIDTH] - RIDGE * weights)
    return weights


def scored(docs: DataFrame, labels: DataFrame, held_out) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row; ``held_out`` maps an id column to
    whether its label must not be used."""
    known = cut_lineage(training_labels(labels, held_out), "toxicity-labels")
    entries = mined(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), known)
    rows = gathered(docs, known, entries, held_out)
    model = label_model(rows)
    if model is None:
        score = F.lit(0.0)
    else:
        weights = F.array(*[F.lit(float(w)) for w in classifier(rows, model)])
        dot = F.aggregate(F.zip_with("x", weights, lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
        score = F.round(1 / (1 + F.exp(-dot)), 9)
    return rows.select("doc_id", "held_out", score.alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int"))
