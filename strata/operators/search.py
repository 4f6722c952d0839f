"""Embeddings and nearest-neighbour search by cosine distance."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import HashingTF, Normalizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, DoubleType, IntegerType, StructField, StructType

from strata.functions.texts import document_content, is_blank, words
from strata.functions.vectors import dot
from strata.operators.ordering import top_rows
from strata.session import cut_lineage
from strata.sources.sinks import overwrite, overwrite_partitioned

DIMENSIONS = 768  # fixed value: size of a text embedding
OK_STATUS = ""
# Rows of a group: some ten megabytes of vectors from each side.
BASE_BLOCK = 1 << 16
QUERY_BLOCK = 1 << 14
QUERIES_AT_ONCE, ROWS_AT_ONCE = 256, 4096  # of a matrix product: eight megabytes
FEW_QUERIES, FEW_BYTES = 1 << 10, 16 << 20  # up to these the queries are sent to the base's tasks
DISTANCE_DIGITS = 12


def embed_texts(
    df: DataFrame,
    text: str = "content",
    dimensions: int = DIMENSIONS,
    embedder: Callable | None = None,
) -> DataFrame:
    """Add ``embedding`` (unit ``array<float>``) and ``status`` (empty when fine).

    The default embedding counts hashed words. ``embedder`` plugs in a model: a
    function from a pandas Series of texts to a Series of float arrays, run in
    Arrow batches on the executors.
    """
    tokens = F.coalesce(words(F.lower(F.col(text))), F.array().cast("array<string>"))
    tokenised = df.withColumn("__words", tokens)
    status = F.when(is_blank(F.col(text)), "empty content").otherwise(OK_STATUS)
    if embedder is not None:
        model = F.pandas_udf(embedder, "array<float>")
        return tokenised.withColumn("embedding", model(F.coalesce(F.col(text), F.lit("")))) \
            .withColumn("status", status).drop("__words")
    counted = HashingTF(inputCol="__words", outputCol="__tf", numFeatures=dimensions)
    unit = Normalizer(inputCol="__tf", outputCol="__unit")
    vectors = unit.transform(counted.transform(tokenised))
    return (
        vectors.withColumn("embedding", vector_to_array("__unit", "float32"))
        .withColumn("status", status)
        .drop("__words", "__tf", "__unit")
    )


def embedded_rows(embedded: DataFrame) -> DataFrame:
    """Rows whose embedding succeeded."""
    return embedded.filter(F.col("status") == OK_STATUS).drop("status")


def mean_vectors(df: DataFrame, key: str, vector: str = "embedding") -> DataFrame:
    """The average vector per key: ``key, embedding array<double>``.

    Means combine on the map side; one running vector per key and task is shuffled.
    """
    dense = array_to_vector(F.transform(vector, lambda x: x.cast("double")))
    return df.groupBy(key).agg(vector_to_array(Summarizer.mean(dense)).alias(vector))


def _unit_rows(matrix: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(matrix, axis=1, keepdims=True)
    return np.divide(matrix, length, out=np.full_like(matrix, np.nan), where=length > 0)


def _one_length(column: pa.ChunkedArray, length: int | None = None) -> None:
    """Raise an error unless all vectors have one length, that of the other side if given."""
    sizes = np.unique(pc.list_value_length(column).to_numpy())
    if len(sizes) > 1 or (length is not None and len(sizes) and sizes[0] != length):
        raise ValueError(f"vectors of different lengths: {sizes.tolist()} and {length or sizes[0]}")


def _unit_vectors(column: pa.ChunkedArray, length: int | None = None) -> np.ndarray:
    """Unit vectors as rows; all must have one length, that of the other side if given."""
    _one_length(column, length)
    column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype("float64")
    return _unit_rows(flat.reshape(len(column), -1)) if len(column) else np.zeros((0, length or 0))


def nearest_columns(distance: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` smallest finite entries of each row: rows, columns and entries, ties by column."""
    count = min(k, distance.shape[1])
    limit = np.partition(distance, count - 1, axis=1)[:, count - 1: count]
    near = distance < limit
    # Of the columns tied at the limit as many as are missing, the first ones.
    tied = (distance == limit) & np.isfinite(distance)
    near |= tied & (np.cumsum(tied, axis=1) <= count - near.sum(1, keepdims=True))
    row, column = np.nonzero(near)
    return row, column, distance[row, column]


def nearest_by_tiles(
    similar: Callable[[int, int], Iterator[tuple[slice, np.ndarray]]], queries: int, rows: int, k: int,
    least: float = 0.0, most: float = 2.0,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` nearest rows of each query: queries, rows and distances, ties by row.

    ``similar`` gives, for a range of rows, one range of queries after the other with their
    similarities, NaN for no match. Only one such tile and ``k`` rows per query are held. Rows come in
    order, so that a later one counts only where it is nearer than the ``k``-th found before it.
    """
    near, place = np.full((queries, k), np.inf), np.zeros((queries, k), np.int64)

    def distances(similarity: np.ndarray) -> np.ndarray:
        return np.clip(np.round(1.0 - similarity, DISTANCE_DIGITS), least, most) + 0.0  # no negative zero

    def put(query: np.ndarray, row: np.ndarray, distance: np.ndarray) -> None:
        """Pairs in order of query, at most ``k`` of each."""
        column = np.arange(len(query)) - np.searchsorted(query, query)
        near[query, column], place[query, column] = distance, row

    step = 0.1 * 10.0**-DISTANCE_DIGITS  # less than half of what rounding can hide
    for first in range(0, rows, ROWS_AT_ONCE):
        for some, similarity in similar(first, min(rows, first + ROWS_AT_ONCE)):
            if not first:
                distance = distances(similarity)
                distance[np.isnan(distance)] = np.inf
                query, row, found = nearest_columns(distance, k)
                put(query + some.start, row, found)
                continue
            worst = near[some].max(axis=1)
            query, row = np.nonzero(similarity > (1.0 - worst + step)[:, None])
            distance = distances(similarity[query, row])
            nearer = distance < worst[query]
            if not nearer.any():
                continue
            query, row, distance = query[nearer] + some.start, row[nearer] + first, distance[nearer]
            again = np.unique(query)
            known = np.isfinite(near[again])
            query = np.concatenate([np.repeat(again, known.sum(1)), query])
            row, distance = np.concatenate([place[again][known], row]), np.concatenate([near[again][known], distance])
            order = np.lexsort((row, distance, query))
            query, row, distance = query[order], row[order], distance[order]
            kept = np.arange(len(query)) - np.searchsorted(query, query) < k
            put(query[kept], row[kept], distance[kept])
    known = np.isfinite(near)
    return np.nonzero(known)[0], place[known], near[known]


def _nearest_in_group(k: int, vector: str, kept: Sequence[str]):
    """The ``k`` nearest rows of one group of base rows for each query of the group."""

    def search(base: pa.Table, queries: pa.Table) -> pa.Table:
        units = _unit_vectors(queries["__vector"])
        _one_length(base[vector], units.shape[1] if len(units) else None)
        # Ids in order, so that ties are broken by id.
        by_id = np.argsort(base[kept[0]].to_numpy(), kind="stable")

        def similar(first: int, last: int) -> Iterator[tuple[slice, np.ndarray]]:
            rows = _unit_vectors(base[vector].take(pa.array(by_id[first: last])))
            for at in range(0, len(units), QUERIES_AT_ONCE):
                yield slice(at, at + QUERIES_AT_ONCE), units[at: at + QUERIES_AT_ONCE] @ rows.T

        query, row, distance = nearest_by_tiles(similar, len(units), len(by_id) if len(units) else 0, k)
        base_rows = pa.array(by_id[row])
        return pa.Table.from_arrays(
            [queries["__query"].take(pa.array(query)),
             pa.array(distance), *[base[c].take(base_rows) for c in kept]],
            names=["__query", "distance", *kept])

    return search


def _blocked(df: DataFrame, number: dict[str, dict[int, int]], mine: str, its: str, row_id: str) -> DataFrame:
    """Rows with ``__mine``, their block in the cell, once for every block of the other side.

    ``number`` has the blocks of both sides by cell; rows of other cells are left out.
    """
    def blocks(side: str):
        return F.create_map(*[F.lit(x) for cell, n in number[side].items() for x in (cell, n)])[F.col("__cell")]

    known = df.filter(F.col("__cell").isin(list(number[mine])))
    return known.withColumns({
        # One type on both sides: co-grouping deals out by a hash, in which 0 as int and as long differ.
        f"__{mine}": F.pmod(F.xxhash64(row_id), blocks(mine)).cast("int"),
        f"__{its}": F.explode(F.sequence(F.lit(0), blocks(its) - 1)),
    })


def _search_cells(base: DataFrame, queries: DataFrame, k: int, base_id: str, query_id: str,
                  vector: str, kept: Sequence[str], search: Callable | None = None) -> DataFrame:
    """Queries against the base rows of the same ``__cell``, compared exactly or by ``search``.

    Both sides of a cell are cut into blocks of bounded size by a hash of their id, and
    every pair of blocks is one group: a matrix product in one task. A side is repeated
    once per block of the other side, so a base is repeated only beyond ``QUERY_BLOCK``
    queries of a cell. Two counts per cell are taken first.
    """
    def blocks(df: DataFrame, size: int) -> dict[int, int]:
        return {r["__cell"]: -(-r["count"] // size) for r in df.groupBy("__cell").count().collect()}

    out = StructType(
        [StructField("__query", queries.schema[query_id].dataType), StructField("distance", DoubleType())]
        + [base.schema[c] for c in kept])
    number = {"q": blocks(queries, QUERY_BLOCK), "b": blocks(base, BASE_BLOCK)}  # a row per cell
    both = number["q"].keys() & number["b"].keys()
    if not both:
        empty = StructType([queries.schema[query_id], StructField("rank", IntegerType()), *out.fields[2:], out["distance"]])
        return base.sparkSession.createDataFrame([], empty)
    number = {side: {cell: n[cell] for cell in sorted(both)} for side, n in number.items()}
    keys = ["__cell", "__b", "__q"]
    left = _blocked(base.select("__cell", vector, *kept), number, "b", "q", base_id).groupBy(*keys)
    # New names throughout, as both sides may be one table.
    asked = queries.select(F.col("__cell").alias("__cell"), F.col(query_id).alias("__query"), F.col(vector).alias("__vector"))
    right = _blocked(asked, number, "q", "b", "__query").groupBy(*keys)
    nearest = left.cogroup(right).applyInArrow(search or _nearest_in_group(k, vector, kept), out)
    return _ranked(nearest, k, base_id, query_id, kept)


def _ranked(nearest: DataFrame, k: int, base_id: str, query_id: str, kept: Sequence[str]) -> DataFrame:
    # k rows per query and block are left; Spark limits them again before the shuffle.
    window = Window.partitionBy("__query").orderBy("distance", base_id)
    ranked = nearest.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= k)
    return ranked.select(F.col("__query").alias(query_id), "rank", *kept, "distance")


def _few(queries: DataFrame, query_id: str, vector: str) -> pa.Table | None:
    """The queries as one table, where they are few and small; else nothing."""
    asked = queries.select(F.col(query_id).alias("__query"), F.col(vector).alias("__vector"))
    found = asked.limit(FEW_QUERIES + 1).toArrow()
    return found if found.num_rows <= FEW_QUERIES and found.nbytes <= FEW_BYTES else None


def _nearest_to_few(base: DataFrame, asked: pa.Table, k: int, base_id: str, query_id: str, query_type: DataType,
                    vector: str, kept: Sequence[str]) -> DataFrame:
    """The base stays where it lies: ``k`` rows per query and batch leave a task's scan, ``k`` per
    query its shuffle."""
    search = _nearest_in_group(k, vector, kept)

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and asked.num_rows:
                yield from search(pa.Table.from_batches([batch]), asked).to_batches()

    out = StructType([StructField("__query", query_type), StructField("distance", DoubleType()),
                      *[base.schema[c] for c in kept]])
    return _ranked(base.select(vector, *kept).mapInArrow(nearest, out), k, base_id, query_id, kept)


def nearest_exact(
    base: DataFrame,
    queries: DataFrame,
    k: int,
    base_id: str,
    query_id: str,
    vector: str = "embedding",
    columns: Sequence[str] = (),
) -> DataFrame:
    """Per query the ``k`` base rows of smallest cosine distance, ranked, ties by id.

    Pairs never become rows. Up to ``FEW_QUERIES`` queries are sent to the tasks of the base,
    which is not shuffled; more are cut into blocks, and neither side passes the driver. Vectors of
    length zero and NULL vectors match nothing; vectors with unequal numbers of elements
    raise an error. Ids are unique.
    """
    kept = [base_id, *[c for c in columns if c != base_id]]
    one = F.lit(0).alias("__cell")
    asked = _few(queries.filter(F.col(vector).isNotNull()), query_id, vector)
    if asked is not None:
        present = base.filter(F.col(vector).isNotNull())
        return _nearest_to_few(present, asked, k, base_id, query_id, queries.schema[query_id].dataType, vector, kept)
    return _search_cells(
        base.filter(F.col(vector).isNotNull()).select(one, vector, *kept),
        queries.filter(F.col(vector).isNotNull()).select(one, query_id, vector),
        k, base_id, query_id, vector, kept)


@dataclass
class ClusterIndex:
    """A base frame with ``cluster_id`` and the centres it was cut by."""

    rows: DataFrame
    centres: np.ndarray


def build_cluster_index(
    base: DataFrame, clusters: int, vector: str = "embedding", seed: int = 42, rounds: int = 10
) -> ClusterIndex:
    """Cut the base into clusters of near vectors (k-means on unit vectors)."""
    length = F.sqrt(dot(F.col(vector), F.col(vector)))
    unit = F.transform(vector, lambda x: x.cast("double") / F.col("__length"))
    prepared = (
        base.withColumn("__length", length)
        .filter(F.col("__length") > 0)
        .withColumn("__unit", array_to_vector(unit))
        .drop("__length")
    )
    means = KMeans(
        k=clusters, seed=seed, maxIter=rounds, featuresCol="__unit", predictionCol="cluster_id"
    )
    model = means.fit(prepared.select("__unit"))
    rows = model.transform(prepared).drop("__unit")
    return ClusterIndex(rows, _unit_rows(np.array(model.clusterCenters(), dtype="float64")))


def cluster_by_centres(base: DataFrame, centres: np.ndarray, base_id: str, vector: str = "embedding") -> ClusterIndex:
    """An index cut by given centres: every vector goes to the nearest one, ties to the first."""
    units = _unit_rows(np.asarray(centres, dtype="float64"))
    nearest = probed_clusters(base, units, 1, base_id, vector).select(base_id, F.col("__cell").alias("cluster_id"))
    return ClusterIndex(base.join(nearest, base_id), units)


def store_index(index: ClusterIndex, path: str) -> str:
    """Write the rows in one folder per cluster, and the centres beside them. A big
    cluster is spread over several files.
    """
    overwrite_partitioned(index.rows, f"{path}/rows", ["cluster_id"])
    centres = [(i, [float(x) for x in c]) for i, c in enumerate(index.centres)]
    spark = index.rows.sparkSession
    frame = spark.createDataFrame(centres, "cluster_id int, centre array<double>")
    overwrite(frame, f"{path}/centres")
    return path


def load_index(spark: SparkSession, path: str) -> ClusterIndex:
    """A stored index; searches read only the folders of the clusters they probe."""
    centres = spark.read.parquet(f"{path}/centres").orderBy("cluster_id").collect()
    rows = spark.read.parquet(f"{path}/rows")
    return ClusterIndex(rows, np.array([r.centre for r in centres], dtype="float64"))


def probed_clusters(
    queries: DataFrame, centres: np.ndarray, probes: int, query_id: str, vector: str = "embedding"
) -> DataFrame:
    """``query_id, vector, __cell``: every query once per cluster it visits, nearest centres first."""
    shared = queries.sparkSession.sparkContext.broadcast(centres)  # one vector per cluster
    schema = StructType([queries.schema[query_id], queries.schema[vector],
                         StructField("__cells", ArrayType(IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = _unit_vectors(pa.chunked_array([batch.column(vector)]), shared.value.shape[1])
            distance = np.round(1.0 - np.nan_to_num(units @ shared.value.T, nan=-2.0), DISTANCE_DIGITS)
            chosen = np.argsort(distance, axis=1, kind="stable")[:, :probes].astype("int32")
            cells = pa.array(list(chosen), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(query_id), batch.column(vector), cells], [query_id, vector, "__cells"])

    known = queries.filter(F.col(vector).isNotNull()).select(query_id, vector)
    return known.mapInArrow(run, schema).select(query_id, vector, F.explode("__cells").alias("__cell"))


def nearest_indexed(
    index: ClusterIndex,
    queries: DataFrame,
    k: int,
    base_id: str,
    query_id: str,
    probes: int,
    vector: str = "embedding",
    columns: Sequence[str] = (),
) -> DataFrame:
    """Approximate search: only the ``probes`` clusters nearest to each query are
    compared, and compared exactly. With as many probes as clusters it is exact.

    Queries meet clusters in a join on the cluster; big clusters and clusters that many
    queries visit are cut into blocks.
    """
    kept = [base_id, *[c for c in columns if c != base_id]]
    probed = cut_lineage(probed_clusters(queries, index.centres, probes, query_id, vector), "probes")
    # At most one row per cluster; folders of clusters that no query visits are not read.
    visited = [r["__cell"] for r in probed.select("__cell").distinct().collect()]
    rows = index.rows.filter(F.col("cluster_id").isin(visited) & F.col(vector).isNotNull())
    return _search_cells(
        rows.select(F.col("cluster_id").alias("__cell"), vector, *kept),
        probed, k, base_id, query_id, vector, kept)


def recall(found: DataFrame, exact: DataFrame, query_id: str, base_id: str) -> DataFrame:
    """Share of the exact neighbours an approximate search found, per query."""
    hits = found.select(query_id, base_id, F.lit(1).alias("__hit"))
    return (
        exact.join(hits, [query_id, base_id], "left")
        .groupBy(query_id)
        .agg(F.avg(F.coalesce(F.col("__hit"), F.lit(0))).alias("recall"))
    )


def top_documents(
    posts: DataFrame, pattern: str, limit: int = 100, max_chars: int | None = None
) -> DataFrame:
    """Documents whose lower-cased tags match, best score first.

    ``posts`` has id, title, body, tags and score. The whole body is kept unless
    ``max_chars`` asks for its beginning only.
    """
    chosen = posts.filter(
        F.lower("tags").rlike(pattern) & F.col("title").isNotNull() & F.col("body").isNotNull()
    )
    best = top_rows(chosen, [F.desc("score"), F.col("id")], limit)
    return best.select(
        F.col("id").cast("string").alias("document_id"),
        "title",
        document_content(F.col("title"), F.col("body"), max_chars).alias("content"),
        "tags",
        "score",
    )


def search_contract(results: DataFrame, query_id: str) -> DataFrame:
    """One row: result count, rows out of distance order, distances outside 0..2."""
    window = Window.partitionBy(query_id).orderBy("rank")  # k rows per query
    before = F.lag("distance").over(window)
    slack = 10.0**-DISTANCE_DIGITS
    return results.withColumn("__before", before).agg(
        F.count(F.lit(1)).alias("results"),
        F.count_if(F.col("distance") < F.col("__before")).alias("out_of_order"),
        F.count_if((F.col("distance") < -slack) | (F.col("distance") > 2 + slack)).alias(
            "out_of_range"
        ),
    )
