"""Product quantisation: an index whose search reads a few bytes per vector.

Vectors go to the nearest of some centres. What is left of a unit vector beside its centre is
cut into parts, and each part is replaced by the number of the nearest word of the part's code
book, so a vector becomes one byte per part. A query scores the codes of the centres nearest to
it with one small table, reads the full vectors of the best codes only, and ranks them exactly.

Centres and code books are learned on a bounded sample; every vector is in the index. Codes and
vectors are stored in one folder per centre. Vectors that are NULL or have no length are not in
the index and find nothing.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, StructField, StructType

from strata.functions.vectors import cosine_distance
from strata.operators.search import (
    DISTANCE_DIGITS, QUERIES_AT_ONCE, _search_cells, _unit_rows, _unit_vectors, build_cluster_index,
    nearest_by_tiles, probed_clusters,
)
from strata.session import cut_lineage
from strata.sources.sinks import overwrite, overwrite_partitioned

CENTRES, PARTS, WORDS = 64, 16, 64  # at most 256 words: a code is a byte
SAMPLE = 1 << 14  # vectors that centres and code books are learned on
ROUNDS = 12


@dataclass
class QuantisedIndex:
    """``codes`` (id, cluster_id, code), ``vectors`` (cluster_id and the base's columns), centres
    as unit rows, and the code books as (part, word, numbers)."""

    codes: DataFrame
    vectors: DataFrame
    centres: np.ndarray
    books: np.ndarray


def _parts(matrix: np.ndarray, parts: int) -> np.ndarray:
    return matrix.reshape(len(matrix), parts, -1)


def sampled(base: DataFrame, base_id: str, most: int = SAMPLE) -> DataFrame:
    """About ``most`` rows by a hash of the id, all of a smaller base."""
    share = min(1.0, most / max(1, base.count()))
    return base.filter(F.pmod(F.xxhash64(base_id), F.lit(1 << 30)) <= share * (1 << 30))


def learned_books(
    sample: DataFrame, centres: np.ndarray, parts: int = PARTS, words: int = WORDS, vector: str = "embedding"
) -> np.ndarray:
    """k-means on the residuals of a bounded sample; every part is learned in a task of its own."""
    shared = sample.sparkSession.sparkContext.broadcast(centres)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = _unit_vectors(pa.chunked_array([batch.column(vector)]), shared.value.shape[1])
            units = units[~np.isnan(units).any(1)]
            rest = _parts(units - shared.value[_nearest_centre(units, shared.value)], parts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.tile(np.arange(parts, dtype=np.int32), len(units))),
                 pa.array(list(rest.reshape(-1, rest.shape[2])), pa.list_(pa.float64()))], ["part", "piece"])

    def learn(group: pa.Table) -> pa.Table:
        pieces = np.unique(_matrix(group["piece"]), axis=0)  # in one order, whatever the partitions
        book = pieces[np.linspace(0, len(pieces) - 1, words).round().astype(int)]
        for _ in range(ROUNDS):
            word = np.argmin(_squares(pieces, book), axis=1)
            many = np.bincount(word, minlength=words)
            sums = np.zeros_like(book)
            np.add.at(sums, word, pieces)
            book = np.where(many[:, None] > 0, sums / np.maximum(many, 1)[:, None], book)
        return pa.table({"part": pa.array(np.full(words, group["part"][0].as_py(), np.int32)),
                         "word": pa.array(np.arange(words, dtype=np.int32)),
                         "numbers": pa.array(list(book), pa.list_(pa.float64()))})

    pieces = sample.filter(F.col(vector).isNotNull()).select(vector).mapInArrow(cut, "part int, piece array<double>")
    found = pieces.groupBy("part").applyInArrow(learn, "part int, word int, numbers array<double>")
    rows = found.orderBy("part", "word").collect()  # parts * words rows
    width = centres.shape[1] // parts
    if not rows:
        return np.zeros((parts, words, width))
    return np.array([r["numbers"] for r in rows]).reshape(parts, words, width)


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy().reshape(len(column), -1)


def _squares(rows: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Squared distances, less what is the same for all words."""
    return (book**2).sum(1) - 2 * rows @ book.T


def _nearest_centre(units: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin(np.round(1.0 - units @ centres.T, DISTANCE_DIGITS), axis=1)


def codes_of(units: np.ndarray, centres: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Centre and code of every unit vector; among equals the first."""
    cell = _nearest_centre(units, centres)
    rest = _parts(units - centres[cell], len(books))
    code = np.empty((len(units), len(books)), np.uint8)
    for j, book in enumerate(books):
        apart = np.sqrt(((rest[:, j, None, :] - book[None]) ** 2).sum(2))
        code[:, j] = np.argmin(np.round(apart, DISTANCE_DIGITS), axis=1)
    return cell, code


def quantised(
    base: DataFrame, centres: np.ndarray, books: np.ndarray, base_id: str, vector: str = "embedding"
) -> DataFrame:
    """The base with ``cluster_id`` and ``code``; rows without a direction are left out."""
    shared = base.sparkSession.sparkContext.broadcast((centres, books))  # bounded by its parameters
    schema = StructType(list(base.schema.fields)).add(
        StructField("cluster_id", IntegerType())).add(StructField("code", BinaryType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres, books = shared.value
        for batch in batches:
            units = _unit_vectors(pa.chunked_array([batch.column(vector)]), centres.shape[1])
            known = ~np.isnan(units).any(1)
            cells, codes = [np.zeros(0, np.int64)], [np.zeros((0, len(books)), np.uint8)]
            for at in range(0, int(known.sum()), 4096):
                cell, code = codes_of(units[known][at: at + 4096], centres, books)
                cells.append(cell), codes.append(code)
            kept = batch.filter(pa.array(known))
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(np.concatenate(cells).astype(np.int32)),
                 pa.array([c.tobytes() for c in np.concatenate(codes)], pa.binary())], schema.names)

    return base.filter(F.col(vector).isNotNull()).mapInArrow(run, schema)


def build_quantised_index(
    base: DataFrame, path: str, base_id: str, vector: str = "embedding", clusters: int = CENTRES,
    parts: int = PARTS, words: int = WORDS, centres: np.ndarray | None = None, books: np.ndarray | None = None,
) -> QuantisedIndex:
    """Learn centres and code books where they are not given, and store codes and vectors."""
    sample = None if centres is not None and books is not None else cut_lineage(sampled(base, base_id), "index-sample")
    if centres is None:
        centres = build_cluster_index(sample, clusters, vector).centres
    centres = _unit_rows(np.asarray(centres, dtype="float64"))
    if books is None:
        books = learned_books(sample, centres, parts, words, vector)
    spark, rows = base.sparkSession, cut_lineage(quantised(base, centres, books, base_id, vector), "quantised")
    overwrite_partitioned(rows.select(base_id, "cluster_id", "code"), f"{path}/codes", ["cluster_id"])
    overwrite_partitioned(rows.drop("code"), f"{path}/vectors", ["cluster_id"])
    numbers = [("centre", 0, i, c.tolist()) for i, c in enumerate(centres)]
    numbers += [("word", j, i, w.tolist()) for j, book in enumerate(books) for i, w in enumerate(book)]
    overwrite(spark.createDataFrame(numbers, "kind string, part int, number int, numbers array<double>"), f"{path}/books")
    return load_quantised_index(spark, path)


def load_quantised_index(spark: SparkSession, path: str) -> QuantisedIndex:
    rows = spark.read.parquet(f"{path}/books").orderBy("kind", "part", "number").collect()  # bounded by parameters
    centres = np.array([r["numbers"] for r in rows if r["kind"] == "centre"])
    words = [r for r in rows if r["kind"] == "word"]
    parts = 1 + max(r["part"] for r in words)
    books = np.array([r["numbers"] for r in words]).reshape(parts, len(words) // parts, -1)
    return QuantisedIndex(
        spark.read.parquet(f"{path}/codes"), spark.read.parquet(f"{path}/vectors"), centres, books)


def _best_codes(k: int, base_id: str, centres: np.ndarray, books: np.ndarray):
    """The ``k`` best codes of one centre's rows for each query of the group."""

    def search(base: pa.Table, queries: pa.Table) -> pa.Table:
        units = _unit_vectors(queries["__vector"])
        by_id = np.argsort(base[base_id].to_numpy(), kind="stable")
        codes = np.frombuffer(b"".join(base["code"].to_pylist()), np.uint8).reshape(-1, len(books))[by_id]

        def similar(first: int, last: int) -> Iterator[tuple[slice, np.ndarray]]:
            for at in range(0, len(units), QUERIES_AT_ONCE):
                some = units[at: at + QUERIES_AT_ONCE]
                score = np.repeat((some @ centres[base["__cell"][0].as_py()])[:, None], last - first, 1)
                own = _parts(some, len(books))
                for j, book in enumerate(books):
                    score += (own[:, j] @ book.T)[:, codes[first: last, j]]
                yield slice(at, at + QUERIES_AT_ONCE), score

        q, row, distance = nearest_by_tiles(
            similar, len(units), len(codes) if len(units) else 0, k, least=-np.inf, most=np.inf)
        row = by_id[row]
        return pa.Table.from_arrays(
            [queries["__query"].take(pa.array(q)), pa.array(distance, pa.float64()), base[base_id].take(pa.array(row)),
             base["__cell"].take(pa.array(row))], names=["__query", "distance", base_id, "cluster_id"])

    return search


def nearest_quantised(
    index: QuantisedIndex, queries: DataFrame, k: int, base_id: str, query_id: str, probes: int, rerank: int,
    vector: str = "embedding", columns: Sequence[str] = (),
) -> DataFrame:
    """Approximate search: codes of the ``probes`` nearest centres are scored, the full vectors of
    the best ``rerank`` codes are read and ranked exactly, ties by id."""
    probed = cut_lineage(probed_clusters(queries, index.centres, probes, query_id, vector), "probes")
    visited = [r["__cell"] for r in probed.select("__cell").distinct().collect()]  # a row per centre at most
    codes = index.codes.filter(F.col("cluster_id").isin(visited)).select(
        F.col("cluster_id").alias("__cell"), base_id, "code", "cluster_id")
    candidates = cut_lineage(_search_cells(
        codes, probed.withColumnRenamed(vector, "code"), rerank, base_id, query_id, "code", [base_id, "cluster_id"],
        _best_codes(rerank, base_id, index.centres, index.books)).select(query_id, base_id, "cluster_id"), "candidates")
    kept = [base_id, *[c for c in columns if c != base_id]]
    read = index.vectors.filter(F.col("cluster_id").isin(visited)).select(
        "cluster_id", F.col(vector).alias("__full"), *kept)
    asked = queries.select(query_id, F.col(vector).alias("__asked"))
    met = candidates.join(read, ["cluster_id", base_id]).join(asked, query_id)
    distance = F.round(F.greatest(cosine_distance(F.col("__full"), F.col("__asked")), F.lit(0.0)), DISTANCE_DIGITS)
    window = Window.partitionBy(query_id).orderBy("distance", base_id)
    return met.withColumn("distance", distance).withColumn("rank", F.row_number().over(window)).filter(
        F.col("rank") <= k).select(query_id, "rank", *kept, "distance")
