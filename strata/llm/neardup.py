"""Near-duplicate documents with SetSketch registers.

A document is the set of its word shingles. Its sketch has ``REGISTERS`` registers: the
smallest of exponentially distributed hash values of the shingles, kept as the truncated
logarithm ``floor(1 - log_b(minimum))``. Registers of a union are the maxima of the
parts' registers, and two documents agree in one with about their similarity.

1. Documents with equal sets form a class; one row per class goes on.
2. Bands of four register values are bucket keys. 32 bands miss a pair at 0.8 with
   probability 5e-8 and hardly ever join unlike texts.
3. Every bucket names a pivot, its member with the smallest hash, so that the bands of a
   group agree on one, and each member is compared with it: about as many pairs as rows,
   whatever a group's size. A pair is estimated by maximum likelihood from the numbers
   of larger, smaller and equal registers and both set sizes, and what may reach the
   threshold is verified on the full sets.
4. Members that are not connected to their pivot by then are compared with all of their
   bucket that they are not connected to, each pair in its first common band, in blocks of
   ``BLOCK`` rows or ``BLOCK_SHINGLES`` shingles and within the tasks: first on sketches, then those members that may be
   linked on their full sets. Only links that join components leave a task. So no link
   found by a band is lost, while a large group of copies costs rows in proportion to its
   size, and pairs never become rows.

Links are confirmed on full sets only. A hot class or bucket meets others through joins
whose partitions Spark splits, and counts and minima are combined in the map tasks.

Defined cases: words are lower-cased in A-Z; with fewer words than a shingle the whole
sequence is one shingle; NULL and empty texts have no shingle and are linked with nothing;
repeated rows are equal documents; a NULL id is smaller than none; an empty table gives an
empty result; other columns pass through ``deduplicate``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.llm import tokens
from strata.llm.components import components
from strata.session import cut_lineage

REGISTERS = 128
BAND = 4
BANDS = REGISTERS // BAND
SKETCH_BASE = 1.001  # b: spacing of the register values
SKETCH_RATE = 20.0  # a: rate of the exponential hash values
TOP = (1 << 16) - 1  # q + 1: largest register value
PERCENT = 80
ESTIMATE_SLACK = 0.15  # more than four standard errors of 128 registers at 0.8
BLOCK = 1024
BLOCK_SHINGLES = 1 << 20  # of a block: some ten megabytes of text
_FACTORS = np.random.default_rng(20260).integers(1, 1 << 63, REGISTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BAND_SALT = tokens.mixed(np.arange(1, BANDS + 1, dtype=np.uint64))


def registers(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """SetSketch registers, one row per document; ``values[at[d]:at[d + 1]]`` are its shingles.

    ``-ln(1 - u) / a`` of a uniform hash is exponential and grows with ``u``, so the minimum
    is taken on the integers and put on the logarithmic scale once per register.
    """
    out = np.zeros((len(at) - 1, REGISTERS), np.uint16)
    full = np.flatnonzero(np.diff(at) > 0)
    if len(full) == 0:
        return out
    begin = at[:-1][full]
    least = np.empty((REGISTERS, len(full)), np.uint64)
    for i, factor in enumerate(_FACTORS):
        least[i] = np.minimum.reduceat(values * factor, begin)
    uniform = (least.astype(np.float64) + 0.5) / 2.0**64
    scaled = 1 - np.log(-np.log1p(-uniform) / SKETCH_RATE) / np.log(SKETCH_BASE)
    out[full] = np.clip(np.floor(scaled), 0, TOP).astype(np.uint16).T
    return out


def merged(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Registers of the union of two sets."""
    return np.maximum(one, other)


def band_keys(sketches: np.ndarray) -> np.ndarray:
    """Bucket keys, one row per document and one column per band."""
    parts = sketches.reshape(-1, BANDS, BAND).astype(np.uint64)
    packed = parts[..., 0] | parts[..., 1] << np.uint64(16) | parts[..., 2] << np.uint64(32) | parts[..., 3] << np.uint64(48)
    return tokens.mixed(packed ^ _BAND_SALT).view(np.int64)


def likelihood_similarity(larger, smaller, n_one, n_other) -> np.ndarray:
    """Jaccard similarity that makes the numbers of larger and smaller registers most likely.

    ``larger`` counts registers in which the first set's value is above the second's. The
    log-likelihood is concave in the similarity, so thirds are cut off until it is found.
    """
    equal = REGISTERS - larger - smaller
    u = n_one / (n_one + n_other)
    v = 1 - u

    def share(x):
        return -np.log1p(-np.clip(x, 0, 1) * (SKETCH_BASE - 1) / SKETCH_BASE) / np.log(SKETCH_BASE)

    def likelihood(j):
        up, down = share(u - v * j), share(v - u * j)
        tiny = 1e-300
        return (larger * np.log(up + tiny) + smaller * np.log(down + tiny)
                + equal * np.log(np.maximum(1 - up - down, 0) + tiny))

    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)
    for _ in range(32):
        third = (high - low) / 3
        left = likelihood(low + third) < likelihood(high - third)
        low, high = np.where(left, low + third, low), np.where(left, high, high - third)
    return (low + high) / 2


def sketched(docs: DataFrame, size: int) -> DataFrame:
    """Written rows ``__id, doc_id, row, text, n, fp, sketch``; one pass over the texts.

    ``row`` is the whole document, ``fp`` 128 bits of its sorted set.
    """
    plain = docs.select(
        F.monotonically_increasing_id().alias("__id"), F.col("doc_id").cast("long").alias("doc_id"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row"),
        F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tokens.slices(batch):
                found = tokens.words(part.column("text"))
                values, at = tokens.shingles(found.fingerprints(lower=True), found.at, size)
                sets = [np.unique(values[at[d]: at[d + 1]]) for d in range(part.num_rows)]
                prints = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
                sketch = registers(values, at)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array([len(s) for s in sets], pa.int64()), pa.array(prints, pa.binary()),
                     pa.array([r.tobytes() for r in sketch], pa.binary())],
                    [*part.schema.names, "n", "fp", "sketch"])

    schema = StructType(list(plain.schema.fields)).add("n", "long").add("fp", "binary").add("sketch", "binary")
    return cut_lineage(plain.mapInArrow(run, schema), "sketches")


def _sketches(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, np.uint16).reshape(-1, REGISTERS)


def bands(classes: DataFrame) -> DataFrame:
    """``key, node, n`` for every band of every class (``node, n, sketch``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = band_keys(_sketches(batch.column("sketch"))) if batch.num_rows else np.zeros((0, BANDS), np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(keys), pa.list_(pa.int64())), batch.column("node"), batch.column("n")],
                ["keys", "node", "n"])

    keyed = classes.select("node", "n", "sketch").mapInArrow(run, "keys array<long>, node long, n long")
    return keyed.select(F.explode("keys").alias("key"), "node", "n")


def _sizes_allow(one: str, other: str, percent: int):
    return 100 * F.least(one, other) >= percent * F.greatest(one, other)


def estimated(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a, b`` whose likelihood estimate may reach the threshold."""
    cut = percent / 100 - ESTIMATE_SLACK

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                one, other = _sketches(batch.column("one")), _sketches(batch.column("other"))
                likely = likelihood_similarity(
                    (one > other).sum(1), (one < other).sum(1),
                    batch.column("n_one").to_numpy(), batch.column("n_other").to_numpy()) >= cut
                yield batch.select(["a", "b"]).filter(pa.array(likely))

    one = classes.select(F.col("node").alias("a"), F.col("sketch").alias("one"), F.col("n").alias("n_one"))
    other = classes.select(F.col("node").alias("b"), F.col("sketch").alias("other"), F.col("n").alias("n_other"))
    return pairs.join(one, "a").join(other, "b").mapInArrow(run, "a long, b long")


def shingle_sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """The full shingle set of every text, ascending."""
    found = tokens.words(texts)
    values, at = tokens.shingles(found.fingerprints(lower=True), found.at, size)
    return [np.unique(values[at[d]: at[d + 1]]) for d in range(len(at) - 1)]


def similar(one: np.ndarray, other: np.ndarray, percent: int) -> bool:
    """Whether two full sets are linked."""
    both = len(np.intersect1d(one, other, assume_unique=True))
    return 100 * both >= percent * (len(one) + len(other) - both)


class Forest:
    """Union-find over node or label numbers."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        parent = self.parent
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    def join(self, x: int, y: int) -> bool:
        """Connect two nodes; False if they were connected before."""
        x, y = self.root(x), self.root(y)
        self.parent[max(x, y)] = min(x, y)
        return x != y


def verified(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Of the pairs ``a, b`` whose full shingle sets are similar enough as many as connect the
    same nodes: a spanning forest of each batch. ``texts``: ``node, text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            forest = Forest()
            for part in tokens.slices(batch, "one"):
                sets = zip(shingle_sets(part.column("one"), size), shingle_sets(part.column("other"), size))
                linked = [similar(x, y, percent) and forest.join(a, b) for a, b, (x, y) in zip(
                    part.column("a").to_pylist(), part.column("b").to_pylist(), sets)]
                yield part.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    one = texts.select(F.col("node").alias("a"), F.col("text").alias("one"))
    other = texts.select(F.col("node").alias("b"), F.col("text").alias("other"))
    return pairs.join(one, "a").join(other, "b").select("a", "b", "one", "other").mapInArrow(run, "a long, b long")


def unsettled_links(
    members: DataFrame, classes: DataFrame, texts: DataFrame, labels: DataFrame, size: int, percent: int
) -> DataFrame:
    """Links ``a, b`` between members of a bucket that no link connects yet, as many as join them.

    In each bucket the members apart from the pivot's component are compared with all
    others, block by block; a group holds two blocks at most, which are bounded in rows and,
    by the number of their shingles, in bytes. Sketches alone tell which
    members may be linked; only these meet again, with their texts.
    """
    cut = percent / 100 - ESTIMATE_SLACK
    of = labels.select(F.col("node").alias("__node"), "label")
    placed = members.join(of, F.col("node") == F.col("__node"), "left").select(
        "key", "node", "n", "pivot", F.coalesce("label", "node").alias("label"))
    pivots = labels.select(F.col("node").alias("__pivot"), F.col("label").alias("main"))
    placed = cut_lineage(
        placed.join(pivots, F.col("pivot") == F.col("__pivot"), "left").select(
            "key", "node", "n", "label", (F.col("label") != F.coalesce("main", "pivot")).alias("apart")), "placed")
    sides = {"apart": F.col("apart"), "main": ~F.col("apart")}
    open_buckets = placed.groupBy("key").agg(
        *[F.count(F.when(own, 1)).alias(f"{side}s") for side, own in sides.items()],
        *[F.sum(F.when(own, F.col("n")).otherwise(0)).alias(f"{side}_n") for side, own in sides.items()]
    ).filter("aparts > 0 AND aparts + mains > 2").select("key", *[
        F.greatest(F.ceil(F.col(f"{side}s") / BLOCK), F.ceil(F.col(f"{side}_n") / BLOCK_SHINGLES)).alias(name)
        for side, name in (("apart", "u"), ("main", "v"))])
    # Blocks of a bucket: 0..u-1 of members apart, u..u+v-1 of the others. A group is a pair
    # of blocks, the first of members apart.
    block = F.pmod(F.xxhash64("node"), F.when(F.col("apart"), F.col("u")).otherwise(F.col("v"))) + F.when(
        F.col("apart"), F.lit(0)).otherwise(F.col("u"))
    mine = F.col("block")
    groups = F.when(
        F.col("apart"),
        F.transform(F.sequence(F.lit(0).cast("long"), F.col("u") + F.col("v") - 1), lambda o: F.struct(
            F.least(mine, o).alias("i"), F.greatest(mine, o).alias("j")))
    ).otherwise(F.transform(F.sequence(F.lit(0).cast("long"), F.col("u") - 1), lambda o: F.struct(
        o.alias("i"), mine.alias("j"))))
    spread = placed.join(open_buckets, "key").withColumn("block", block).select(
        "key", "node", "n", "label", "block", F.explode(groups).alias("group"))
    spread = spread.join(classes.select("node", "sketch"), "node").select(
        "key", "group.i", "group.j", "node", "n", "label", "block", "sketch")

    meeting = "key long, i long, j long, node long, n long, label long, block long"

    def may_link(table: pa.Table) -> pa.Table:
        """The members with a partner in the group that they may be linked with."""
        x, y, _ = _candidates(table, cut, percent)
        return table.select(["key", "i", "j", "node", "n", "label", "block"]).take(pa.array(np.unique(np.append(x, y))))

    met = cut_lineage(spread.groupBy("key", "i", "j").applyInArrow(may_link, meeting), "met")

    def link(table: pa.Table) -> pa.Table:
        """Links between components: likely pairs first, none within what is already linked."""
        x, y, likely = _candidates(table, cut, percent)
        node, sets = table["node"].to_numpy(), shingle_sets(table["text"].combine_chunks(), size)
        forest, label, found = Forest(), table["label"].to_pylist(), []
        for k in np.argsort(-likely, kind="stable"):
            one, other = forest.root(label[x[k]]), forest.root(label[y[k]])
            if one != other and similar(sets[x[k]], sets[y[k]], percent):
                forest.join(one, other)
                found.append(sorted((node[x[k]], node[y[k]])))
        pairs = np.array(found, np.int64).reshape(-1, 2)
        return pa.table({"a": pa.array(pairs[:, 0]), "b": pa.array(pairs[:, 1])})

    whole = met.join(classes.select("node", "sketch"), "node").join(texts, "node")
    return whole.groupBy("key", "i", "j").applyInArrow(link, "a long, b long")


def _candidates(table: pa.Table, cut: float, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of a group that may be linked and are not, one from each block, in the pair's first
    common band, with their estimated similarity."""
    node, label = table["node"].to_numpy(), table["label"].to_numpy()
    n, block = table["n"].to_numpy(), table["block"].to_numpy()
    sketch = _sketches(table["sketch"])
    first, second = table["i"][0].as_py(), table["j"][0].as_py()
    band = int(np.flatnonzero(band_keys(sketch[:1])[0] == table["key"][0].as_py())[0])
    left, right = np.flatnonzero(block == first), np.flatnonzero(block == second)
    xs, ys, larger, smaller = [], [], [], []
    for x in left:
        apart = label[right] != label[x]
        if first == second:
            apart &= node[right] > node[x]
        others = right[apart]
        others = others[100 * np.minimum(n[others], n[x]) >= percent * np.maximum(n[others], n[x])]
        if band:
            before = sketch[others, : band * BAND] == sketch[x, : band * BAND]
            others = others[~before.reshape(len(others), band, BAND).all(2).any(1)]
        if len(others):
            xs.append(np.full(len(others), x))
            ys.append(others)
            larger.append((sketch[x] > sketch[others]).sum(1))
            smaller.append((sketch[x] < sketch[others]).sum(1))
    if not xs:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    x, y, larger, smaller = (np.concatenate(v) for v in (xs, ys, larger, smaller))
    # With no more equal registers than chance gives at the cut, a pair is not worth the search.
    near = REGISTERS - larger - smaller >= REGISTERS * (cut - 0.15)
    x, y, larger, smaller = x[near], y[near], larger[near], smaller[near]
    likely = np.concatenate([
        likelihood_similarity(larger[k: k + 65536], smaller[k: k + 65536], n[x[k: k + 65536]], n[y[k: k + 65536]])
        for k in range(0, len(x), 65536)] or [np.zeros(0)])
    return x[likely >= cut], y[likely >= cut], likely[likely >= cut]


def grouped(docs: DataFrame, size: int, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """``__id, doc_id, n_shingles, component_id, keeper`` of every row, and the rows of ``sketched``.

    ``component_id`` is the smallest id reachable over links; ``keeper`` marks one row of
    each component, among equal ids the first.
    """
    rows = sketched(docs, size)
    filled = rows.filter("n > 0")
    by_set = filled.groupBy("fp", "n").agg(F.min("__id").alias("node"))
    classes = cut_lineage(
        rows.select("__id", "n", "sketch").join(by_set.select(F.col("node").alias("__id")), "__id", "left_semi")
        .withColumnRenamed("__id", "node"), "classes")
    banded = cut_lineage(bands(classes), "bands")
    turn = F.xxhash64("node")  # of the node alone: the bands of a group choose alike
    buckets = banded.groupBy("key").agg(
        F.count(F.lit(1)).alias("size"), F.min(F.struct(turn.alias("turn"), F.col("node").alias("node"),
                                                        F.col("n").alias("n"))).alias("pivot")
    ).filter("size > 1").select("key", F.col("pivot.node").alias("pivot"), F.col("pivot.n").alias("pivot_n"))
    members = cut_lineage(banded.join(buckets, "key"), "members")
    involved = members.select("node").distinct()
    texts = cut_lineage(
        filled.select(F.col("__id").alias("node"), "text").join(involved, "node", "left_semi"), "texts")
    pairs = members.filter((F.col("node") != F.col("pivot")) & _sizes_allow("n", "pivot_n", percent)).select(
        F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct()
    links = cut_lineage(verified(estimated(pairs, classes, percent), texts, size, percent), "links")
    more = unsettled_links(members, classes, texts, components(links), size, percent)
    links = links.unionByName(cut_lineage(more, "links"))
    labels = components(links)
    of_row = rows.join(by_set, ["fp", "n"], "left").select(
        "__id", "doc_id", "n", F.coalesce("node", "__id").alias("node"))
    labelled = cut_lineage(
        of_row.join(labels.select(F.col("node").alias("__node"), "label"), F.col("node") == F.col("__node"), "left")
        .select("__id", "doc_id", "n", F.coalesce("label", "node").alias("label")), "labelled")
    smallest = labelled.groupBy("label").agg(
        F.min(F.struct("doc_id", "__id")).alias("least"), F.min("doc_id").alias("component_id"))
    return labelled.join(smallest, "label").select(
        "__id", "doc_id", F.col("n").alias("n_shingles"), "component_id",
        (F.col("least.__id") == F.col("__id")).alias("keeper")), rows


def near_duplicates(docs: DataFrame, size: int = 4, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row."""
    found, _ = grouped(docs.select("doc_id", "text"), size, percent)
    return found.select("doc_id", "n_shingles", "component_id",
                        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def deduplicate(docs: DataFrame, size: int = 5, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each component."""
    found, rows = grouped(docs, size, percent)
    kept = rows.select("__id", "row", "text").join(
        found.filter("keeper").select("__id"), "__id", "left_semi")
    return kept.select(*[F.col("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
