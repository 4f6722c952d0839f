"""Semantic retrieval over a document collection."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from strata.operators.quality import Expect, gate
from strata.operators.search import (
    ClusterIndex, build_cluster_index, embed_texts, embedded_rows, load_index, nearest_exact,
    nearest_indexed, search_contract, store_index,
)

TOP_K = 5
COLUMNS = ("title", "tags", "score")


def document_embeddings(documents: DataFrame, embedder: Callable | None = None) -> DataFrame:
    """Documents with their embedding; rows that failed to embed are left out."""
    return embedded_rows(embed_texts(documents, "content", embedder=embedder))


def query_embeddings(
    queries: DataFrame, text: str = "content", embedder: Callable | None = None
) -> DataFrame:
    return embedded_rows(embed_texts(queries, text, embedder=embedder))


def index(embedded: DataFrame, clusters: int, path: str) -> ClusterIndex:
    """Build the index once and store it; ``load_index`` opens it for later searches."""
    return load_index(embedded.sparkSession, store_index(build_cluster_index(embedded, clusters), path))


def search(
    embedded: DataFrame | ClusterIndex, queries: DataFrame, k: int = TOP_K, probes: int = 4
) -> DataFrame:
    """The ``k`` nearest documents per query, exact or through an index."""
    if isinstance(embedded, ClusterIndex):
        return nearest_indexed(
            embedded, queries, k, "document_id", "query_id", probes, columns=COLUMNS
        )
    return nearest_exact(embedded, queries, k, "document_id", "query_id", columns=COLUMNS)


def verify(results: DataFrame) -> DataFrame:
    """Results exist, are in distance order, and distances lie between 0 and 2."""
    return gate(
        search_contract(results, "query_id"),
        {
            "results": Expect(at_least=1),
            "out_of_order": Expect(equals=0),
            "out_of_range": Expect(equals=0),
        },
    )
