"""Benchmark decontamination: short test items inside long documents.

Containment search with MinHash sketches, partitioned by size. Items fall into classes
by the size of their shingle set (powers of two). The sketch of an item are its ``k``
smallest shingle fingerprints (bottom-k MinHash), ``k`` by class: one more than the
shingles that an item of that class may miss, ``upper - ceil(0.8 * upper) + 1``. A
document that holds 80% of an item's shingles then holds one of its sketch at least, so
the candidate search loses nothing, however long the document is; a candidate whose
document has fewer shingles than the item needs is dropped by size. Every candidate is
verified on the full shingle sets.

An item with fewer words than a shingle is one shingle, its whole sequence; a long document
holds it where these words stand in it one after the other. For blocks with such items runs of
their lengths are looked up too.

Documents are read once per block of items and never shuffled. Sketches and sets of one
block travel to all tasks; a block holds about ``BLOCK_SHINGLES`` shingles (16 MB), and
more items make more blocks.

Defined cases: words are lower-cased in A-Z; shingles have five words; an item with fewer
words matches every document that holds its whole sequence, a document with fewer words only
such items; NULL and empty texts have none and match nothing; repeated rows are separate documents or items; an empty table on
either side gives no match; other columns are kept by ``drop_contaminated``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import tokens
from strata.session import cut_lineage

SHINGLE = 5
PERCENT = 80
BLOCK_SHINGLES = 1 << 21
GATE_BITS = 18


def needed(n: np.ndarray | int, percent: int = PERCENT):
    """How many of ``n`` shingles must be found."""
    return -(-n * percent // 100)


def sketch_length(n: int, percent: int = PERCENT) -> int:
    """Length of the bottom-k sketch in the size class of ``n``."""
    upper = (1 << n.bit_length()) - 1
    return upper - needed(upper, percent) + 1


def item_sets(items: DataFrame, size: int = SHINGLE) -> DataFrame:
    """``item_id, shingles, run``: the distinct fingerprints of each item with a word, ascending,
    and how many words a shingle has, fewer than ``size`` only where the item has no more."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tokens.slices(batch):
                found = tokens.words(part.column("text"))
                values, at = tokens.shingles(found.fingerprints(lower=True), found.at, size)
                own = [np.unique(values[at[d]: at[d + 1]]).view(np.int64) for d in range(part.num_rows)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("item_id"), pa.array(own, pa.list_(pa.int64())),
                     pa.array(np.minimum(found.counts, size), pa.int32())], ["item_id", "shingles", "run"])

    narrow = items.select(F.col("item_id").cast("long").alias("item_id"), "text")
    return narrow.mapInArrow(sets, "item_id long, shingles array<long>, run int").filter(F.size("shingles") > 0)


class Block:
    """Sketches and full sets of some items, with a bit table in front of the sketches."""

    def __init__(self, rows: list, size: int = SHINGLE, percent: int = PERCENT):
        self.size = size
        self.ids = [r["item_id"] for r in rows]
        self.sets = [np.array(r["shingles"], np.int64).view(np.uint64) for r in rows]
        self.percent = percent
        runs = np.array([r["run"] for r in rows], np.int64)
        none = np.zeros(0, np.uint64)
        sketches = [np.sort(s)[: sketch_length(len(s), percent)] if run == size else none
                    for s, run in zip(self.sets, runs)]
        self.short = {}  # by length: the one shingle of short items, ascending, and whose it is
        for run in np.unique(runs[runs < size]).tolist():
            items = np.flatnonzero(runs == run)
            only = np.array([self.sets[i][0] for i in items], np.uint64)
            self.short[run] = np.sort(only), items[np.argsort(only, kind="stable")]
        value = np.concatenate([*sketches, none])
        owner = np.repeat(np.arange(len(rows)), [len(s) for s in sketches])
        order = np.argsort(value, kind="stable")
        self.value, self.owner = value[order], owner[order]
        self.gate = np.zeros(1 << GATE_BITS, dtype=bool)
        self.gate[self._slot(self.value)] = True

    @staticmethod
    def _slot(values: np.ndarray) -> np.ndarray:
        return (values >> np.uint64(64 - GATE_BITS)).astype(np.int64)

    def _short_matches(self, h: np.ndarray, at: np.ndarray) -> Iterator[tuple[int, int, int]]:
        doc = np.repeat(np.arange(len(at) - 1), np.diff(at))
        for run, (only, items) in self.short.items():
            values = tokens.sequence_hash(h, run)
            inside = np.flatnonzero(doc[: len(values)] == doc[run - 1: run - 1 + len(values)])  # of one text
            low = np.searchsorted(only, values[inside], "left")
            high = np.searchsorted(only, values[inside], "right")
            hit = high > low
            pairs = {(int(d), int(i)) for d, a, b in zip(doc[inside[hit]], low[hit], high[hit]) for i in items[a:b]}
            for d, item in sorted(pairs):
                yield d, item, 1

    def matches(self, texts: pa.Array) -> Iterator[tuple[int, int, int]]:
        """Document row, item and number of its shingles found, for all that reach the threshold."""
        found = tokens.words(texts)
        h = found.fingerprints(lower=True)
        yield from self._short_matches(h, found.at)
        values, at = tokens.shingles(h, found.at, self.size)
        maybe = np.flatnonzero(self.gate[self._slot(values)])
        low = np.searchsorted(self.value, values[maybe], "left")
        high = np.searchsorted(self.value, values[maybe], "right")
        hit = high > low
        maybe, low, high = maybe[hit], low[hit], high[hit]
        docs = np.searchsorted(at, maybe, "right") - 1
        for d in np.unique(docs):
            mine = docs == d
            items = np.unique(np.concatenate(
                [self.owner[a:b] for a, b in zip(low[mine], high[mine])]))
            own = np.unique(values[at[d]: at[d + 1]])
            for item in items:
                wanted = self.sets[item]
                least = needed(len(wanted), self.percent)
                if len(own) >= least:  # size partition
                    n = int(np.isin(wanted, own, assume_unique=True).sum())
                    if n >= least:
                        yield int(d), int(item), n


def _blocks(docs: DataFrame, items: DataFrame, size: int, percent: int):
    """One broadcast block of items after the other."""
    sets = cut_lineage(item_sets(items, size), "benchmark-items")
    total = sets.agg(F.coalesce(F.sum(F.size("shingles")), F.lit(0))).first()[0]
    number = max(1, math.ceil(2 * total / BLOCK_SHINGLES))
    for b in range(number):
        rows = sets.filter(F.pmod(F.xxhash64("item_id"), F.lit(number)) == b).collect()  # bounded by the block
        yield docs.sparkSession.sparkContext.broadcast(Block(rows, size, percent))


def contaminated(docs: DataFrame, items: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``doc_id, item_id, n_shingles, n_found, containment`` of every match."""
    schema = "doc_id long, item_id long, n_shingles long, n_found long"

    def search(block):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in tokens.slices(batch):
                    rows = list(block.value.matches(part.column("text")))
                    yield pa.RecordBatch.from_arrays([
                        part.column("doc_id").take(pa.array([r[0] for r in rows], pa.int64())),
                        pa.array([block.value.ids[r[1]] for r in rows], pa.int64()),
                        pa.array([len(block.value.sets[r[1]]) for r in rows], pa.int64()),
                        pa.array([r[2] for r in rows], pa.int64()),
                    ], ["doc_id", "item_id", "n_shingles", "n_found"])
        return run

    narrow, found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), None
    for block in _blocks(docs, items, size, percent):
        part = narrow.mapInArrow(search(block), schema)
        found = part if found is None else found.unionAll(part)
    return found.withColumn("containment", F.col("n_found") / F.col("n_shingles"))


def drop_contaminated(docs: DataFrame, items: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``docs`` without the documents that hold an item; rows pass through their task unchanged."""

    def clean(block):
        def keep(part: pa.RecordBatch) -> np.ndarray:
            out = np.ones(part.num_rows, dtype=bool)
            out[[m[0] for m in block.value.matches(part.column("text"))]] = False
            return out
        return keep

    for block in _blocks(docs, items, size, percent):
        docs = tokens.filtered(docs, clean(block))
    return docs
