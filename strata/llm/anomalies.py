"""Quality rules judged by an isolation forest over their statistics.

One pass over the texts counts what the rules look at and writes a short row per document.
Trees of random splits are grown, each on ``TREE_ROWS`` rows of its own, those of the whole
table with the smallest hash by the tree's seed; a document that few splits isolate is anomalous. Its score is ``2 ** (-mean path length / c(TREE_ROWS))``.
The threshold comes from all labelled rows that pass the base rules, as counts per score bin:
it makes the share of bad documents above it, less ``GOOD_COST`` times the share of good
ones, largest.

Defined cases: NULL and empty texts have no words and fail the base rules; repeated rows
are separate documents with equal results; a document with several labels counts with
each of them; without labels of good and of bad documents nothing is rejected beyond the
base rules; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import tokens
from strata.operators.ordering import best_per_key
from strata.session import cut_lineage

SYMBOLS = b"#*$%&|<>"
WINDOW = 3
LEAST_WORDS = 50
REPEAT_PERCENT = 50
TREES, TREE_ROWS, DEPTH = 128, 256, 8
BINS = 2000
GOOD_COST = 20.0
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "n_lines", "n_upper", "n_digits", "n_marks", "n_bare")


def _table(members: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(members)] = True
    return out


_SYMBOL = _table(SYMBOLS)
_UPPER, _DIGIT = _table(bytes(range(65, 91))), _table(bytes(range(48, 58)))
_MARK = _table(bytes(c for c in range(33, 127) if not chr(c).isalnum()))
_FIRST_BYTE = np.array([(c & 0xC0) != 0x80 for c in range(256)]) & ~tokens.WHITE


def _per_document(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])[offsets])


def _salted(values: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Values of different documents kept apart."""
    return tokens.mixed(values ^ tokens.mixed(doc.astype(np.uint64) + np.uint64(1)))


def statistics(texts: pa.Array) -> list[np.ndarray]:
    """The arrays of ``COUNTS``, a value per text."""
    found = tokens.words(texts)
    data, offsets, at = found.data, found.offsets, found.at
    docs = len(offsets) - 1
    h = found.fingerprints()
    word_doc = np.repeat(np.arange(docs), found.counts)

    # Lines: pieces between line feeds and text ends that hold a word.
    breaks = np.flatnonzero(data == 10)
    start = np.sort(np.concatenate([offsets[:-1], breaks + 1]))
    line_doc = np.searchsorted(offsets, start, "right") - 1
    end = np.minimum(np.concatenate([start[1:], offsets[-1:]]), len(data))
    feed = np.zeros(len(data) + 1, dtype=bool)
    feed[breaks] = True
    end = np.where((end > start) & feed[np.maximum(end - 1, 0)], end - 1, end)
    full = np.searchsorted(found.start, end) > np.searchsorted(found.start, start)
    start, end, line_doc = start[full], end[full], np.minimum(line_doc[full], docs - 1)
    lines = np.bincount(line_doc, minlength=docs)
    _, first = np.unique(_salted(tokens.fingerprints(data, start, end), line_doc), return_index=True)
    distinct_lines = np.bincount(line_doc[first], minlength=docs)

    # Words inside windows that a document holds more than once.
    covered = np.zeros(len(h) + WINDOW, dtype=bool)
    runs = tokens.sequence_hash(h, WINDOW)
    inside = np.flatnonzero(word_doc[: len(runs)] == word_doc[WINDOW - 1:]) if len(runs) else np.zeros(0, np.int64)
    _, which, times = np.unique(_salted(runs[inside], word_doc[inside]), return_inverse=True, return_counts=True)
    again = inside[times[which] > 1]
    for j in range(WINDOW):
        covered[again + j] = True

    marks = np.concatenate([[0], np.cumsum(_MARK[data])])
    bare = marks[found.end] - marks[found.start] == found.end - found.start  # words of marks alone
    return [
        found.counts, _per_document(_FIRST_BYTE[data], offsets), _per_document(_SYMBOL[data], offsets),
        lines - distinct_lines, _per_document(covered[: len(h)], at),
        lines, _per_document(_UPPER[data], offsets), _per_document(_DIGIT[data], offsets),
        np.diff(marks[offsets]), _per_document(bare, at)]


def rule_statistics(docs: DataFrame) -> DataFrame:
    """Written rows ``doc_id`` and ``COUNTS`` of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tokens.slices(batch):
                counts = [pa.array(np.asarray(c, np.int64)) for c in statistics(part.column("text"))]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *counts], ["doc_id", *COUNTS])

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return cut_lineage(narrow.mapInArrow(run, "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS)), "statistics")


def features(columns: dict[str, np.ndarray]) -> np.ndarray:
    """Rule statistics as shares, which do not grow with the text."""
    c = {name: columns[name].astype(np.float64) for name in COUNTS}
    words, chars = np.maximum(c["n_words"], 1), np.maximum(c["word_chars"], 1)
    return np.column_stack([
        c["word_chars"] / words, c["n_symbols"] / words, c["n_dup_lines"] / np.maximum(c["n_lines"], 1),
        c["n_repeat_words"] / words, c["n_upper"] / chars, c["n_digits"] / chars, c["n_marks"] / chars,
        c["n_bare"] / words])


def expected_path(n: float) -> float:
    """Mean path length of an unsuccessful search among ``n`` rows."""
    return 0.0 if n <= 1 else 2 * (math.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n if n > 2 else 1.0


class Forest:
    """Complete binary trees in arrays: node ``i`` has the children ``2i + 1`` and ``2i + 2``."""

    def __init__(self, rows: np.ndarray, seed: int = 7, drawn_by: np.ndarray | None = None):
        """``drawn_by`` has the tree of each row; without it every tree draws from all rows."""
        rng = np.random.default_rng(seed)
        nodes = (1 << (DEPTH + 1)) - 1
        self.feature = np.zeros((TREES, nodes), np.int64)
        self.split = np.full((TREES, nodes), np.inf)
        self.path = np.zeros((TREES, nodes))
        self.per_tree = min(TREE_ROWS, len(rows)) if drawn_by is None else int(np.bincount(drawn_by, minlength=TREES).max())
        for tree in range(TREES):
            if drawn_by is not None:
                chosen = rows[drawn_by == tree]
            else:
                chosen = rows[rng.choice(len(rows), self.per_tree, replace=False)] if len(rows) else rows
            self._grow(tree, 0, 0, chosen, rng)

    def _grow(self, tree: int, node: int, depth: int, rows: np.ndarray, rng) -> None:
        low, high = (rows.min(0), rows.max(0)) if len(rows) else (np.zeros(1), np.zeros(1))
        varied = np.flatnonzero(high > low)
        if depth == DEPTH or len(rows) <= 1 or len(varied) == 0:
            # A leaf: everything goes left from here, with the path length kept below.
            while True:
                self.path[tree, node] = depth + expected_path(len(rows))
                if 2 * node + 1 >= self.path.shape[1]:
                    return
                node = 2 * node + 1
        f = rng.choice(varied)
        at = rng.uniform(low[f], high[f])
        self.feature[tree, node], self.split[tree, node] = f, at
        left = rows[:, f] < at
        self._grow(tree, 2 * node + 1, depth + 1, rows[left], rng)
        self._grow(tree, 2 * node + 2, depth + 1, rows[~left], rng)

    def scores(self, x: np.ndarray) -> np.ndarray:
        total, every = np.zeros(len(x)), np.arange(len(x))
        for tree in range(TREES):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[every, self.feature[tree, node]] >= self.split[tree, node])
            total += self.path[tree, node]
        return 2.0 ** (-total / TREES / max(expected_path(self.per_tree), 1e-9))


def fitted(stats: DataFrame) -> Forest:
    """A forest whose trees each draw ``TREE_ROWS`` of all rows, in order of a hash by the tree.

    A bound on other bits of the hash lets twice as many pass, so that few rows are shuffled.
    """
    share = min(1.0, 2 * TREE_ROWS / max(1, stats.count()))
    hashed = stats.select(*COUNTS, F.xxhash64("doc_id", *COUNTS).alias("row"))
    draws = F.transform(F.sequence(F.lit(0), F.lit(TREES - 1)), lambda tree: F.struct(
        tree.alias("tree"), F.xxhash64("row", tree).alias("drawn")))
    near = F.filter(draws, lambda d: F.pmod(d["drawn"], F.lit(1 << 30)) <= share * (1 << 30))
    few = hashed.select(*COUNTS, F.explode(near).alias("d")).select(*COUNTS, "d.tree", "d.drawn")
    order = ["drawn", *COUNTS]
    rows = best_per_key(few, ["tree"], [F.col(c) for c in order], TREE_ROWS).select("tree", *order).toArrow()
    rows = rows.sort_by([(c, "ascending") for c in ("tree", *order)])
    return Forest(features({c: rows[c].to_numpy() for c in COUNTS}), drawn_by=rows["tree"].to_numpy())


def scored(stats: DataFrame, forest: Forest) -> DataFrame:
    """``stats`` with ``score`` in (0, 1]."""
    model = stats.sparkSession.sparkContext.broadcast(forest)  # a few hundred kilobytes, whatever the corpus

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = model.value.scores(features({c: batch.column(c).to_numpy() for c in COUNTS}))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score)], [*batch.schema.names, "score"])

    return stats.mapInArrow(run, "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", score double")


def base_failed():
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


def threshold(rows: DataFrame, labels: DataFrame, cost: float = GOOD_COST) -> float:
    """Scores above this are anomalous; infinite without good and bad labelled documents."""
    judged_rows = labels.filter("quality IN (0, 1)").select(F.col("doc_id").alias("__id"), "quality")
    counts = rows.filter(~base_failed()).join(judged_rows, F.col("doc_id") == F.col("__id")).groupBy(
        "quality", F.ceil(F.col("score") * BINS).cast("int").alias("bin")).count().collect()  # two rows per bin
    table = np.zeros((2, BINS + 1))
    for r in counts:
        table[r["quality"], r["bin"]] += r["count"]
    if not table.sum(1).all():
        return math.inf
    above = table.sum(1, keepdims=True) - np.cumsum(table, 1)  # of each label, by highest bin kept
    gain = above[0] / table[0].sum() - cost * above[1] / table[1].sum()
    return float(BINS - np.argmax(gain[::-1])) / BINS  # among equals the highest threshold


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Statistics, ``base_failed``, ``score``, ``anomalous`` and ``kept`` of every document."""
    stats = rule_statistics(docs)
    rows = cut_lineage(scored(stats, fitted(stats)), "scored")
    limit = threshold(rows, labels)
    return rows.withColumns({"base_failed": base_failed(), "anomalous": F.col("score") > limit}).withColumn(
        "kept", ~F.col("base_failed") & ~F.col("anomalous"))
