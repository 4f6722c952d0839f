"""Words of Arrow text batches as numpy arrays of positions and 64-bit fingerprints.

Words are runs of bytes other than the six ASCII white-space characters; UTF-8 keeps
these apart from all other characters. A fingerprint is a polynomial of the word's
bytes modulo 2**64, taken from prefix sums so that no Python loop touches a word, and
then mixed. Two different words of a corpus share one with probability 2**-64 a pair.
Work is cut into blocks of about a megabyte, so memory does not depend on how long a
document is.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

BLOCK = 1 << 20  # bytes hashed at once
SLICE_BYTES = 4 << 20  # text of documents looked at together
BASE = np.uint64(0x9E3779B97F4A7C15)
MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
MIX_2 = np.uint64(0x94D049BB133111EB)
WHITE = np.zeros(256, dtype=bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True


@cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
    up, down = np.empty(n, np.uint64), np.empty(n, np.uint64)
    up[0] = down[0] = 1
    up[1:], down[1:] = BASE, inverse
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


@cache
def _codes(lower: bool) -> np.ndarray:
    table = np.arange(1, 257, dtype=np.uint64)
    if lower:
        table[65:91] += np.uint64(32)
    return table


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    h = h ^ (h >> np.uint64(30))
    h *= MIX_1
    h ^= h >> np.uint64(27)
    h *= MIX_2
    h ^= h >> np.uint64(31)
    return h


def fingerprints(data: np.ndarray, start: np.ndarray, end: np.ndarray, lower: bool = False) -> np.ndarray:
    """Fingerprints of the byte ranges ``[start, end)``, which ascend and do not overlap."""
    out = np.empty(len(start), np.uint64)
    table, first = _codes(lower), 0
    while first < len(start):
        last = max(first + 1, int(np.searchsorted(end, start[first] + BLOCK, "right")))
        low, high = int(start[first]), int(end[last - 1])
        size = 1 << max(BLOCK, high - low).bit_length()
        up, down = _powers(size)
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum(table[data[low:high]] * up[: high - low], out=sums[1:])
        s, e = start[first:last] - low, end[first:last] - low
        out[first:last] = (sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64)
        first = last
    return mixed(out)


@dataclass
class Words:
    """The words of some documents: ``at[d]:at[d + 1]`` are those of document ``d``."""

    data: np.ndarray  # bytes of all texts
    offsets: np.ndarray  # where each text starts in ``data``, and the end
    start: np.ndarray
    end: np.ndarray
    at: np.ndarray

    def fingerprints(self, lower: bool = False) -> np.ndarray:
        return fingerprints(self.data, self.start, self.end, lower)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.at)


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; NULL becomes an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, where, raw = texts.buffers()
    offsets = np.frombuffer(where, np.int64)[texts.offset: texts.offset + len(texts) + 1]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[offsets[0]: offsets[-1]], offsets - offsets[0]


def words(texts: pa.Array) -> Words:
    data, offsets = buffers(texts)
    dark = np.zeros(len(data) + 2, dtype=np.int8)
    dark[1:-1] = ~WHITE[data]
    step = np.diff(dark)
    start, end = np.flatnonzero(step[:-1] == 1), np.flatnonzero(step[1:] == -1) + 1
    inner = offsets[1:-1]
    cut = np.unique(inner[(inner > 0) & (inner < len(data))])
    cut = cut[(dark[cut] == 1) & (dark[cut + 1] == 1)]  # two texts meet without white space
    if len(cut):
        start = np.sort(np.concatenate([start, cut]))
        end = np.sort(np.concatenate([end, cut]))
    return Words(data, offsets, start, end, np.searchsorted(start, offsets))


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each piece holds about ``limit`` bytes of text, one row at least."""
    _, offsets = buffers(batch.column(column))
    row = 0
    while row < batch.num_rows:
        upto = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        yield batch.slice(row, upto - row)
        row = upto


def filtered(docs: DataFrame, keep: Callable[[pa.RecordBatch], np.ndarray], limit: int = SLICE_BYTES) -> DataFrame:
    """The rows of ``docs`` for which ``keep``, given batches with ``text``, is true, unchanged.

    Rows travel as one column, whatever their own columns are called.
    """
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = batch.column("row")
            whole = pa.RecordBatch.from_arrays([row, row.field(place)], ["row", "text"])
            for part in slices(whole, limit=limit):
                yield part.filter(pa.array(keep(part), pa.bool_())).select(["row"])

    schema = StructType([StructField("row", docs.schema)])
    return docs.select(F.struct("*").alias("row")).mapInArrow(run, schema).select("row.*")


def sequence_hash(h: np.ndarray, size: int) -> np.ndarray:
    """Fingerprints of all runs of ``size`` consecutive values."""
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, np.uint64(size))
    for j in range(size):
        out *= BASE
        out += h[j: j + n]
    return mixed(out)


def shingles(h: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle fingerprints of all documents, and where each document's begin.

    A document with fewer than ``size`` words gives its whole sequence as one shingle,
    one without words none. Repeats are kept.
    """
    counts = np.diff(at)
    many = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    begins = np.concatenate([[0], np.cumsum(many)])
    runs = sequence_hash(h, size)
    first = np.repeat(at[:-1], many) + np.arange(begins[-1]) - np.repeat(begins[:-1], many)
    out = np.empty(len(first), np.uint64)
    whole = np.repeat(counts >= size, many)
    out[whole] = runs[first[whole]]
    for d in np.flatnonzero((counts > 0) & (counts < size)):
        out[begins[d]] = sequence_hash(h[at[d]: at[d + 1]], int(counts[d]))[0]
    return out, begins
