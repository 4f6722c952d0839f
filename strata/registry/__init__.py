"""The driver's queries: every operator over the given tables, with its SQL twin.

Each module maps the tables to an operator's input columns and registers the
query together with the SQL that must give the same rows.
"""

from strata.registry import (  # noqa: F401  (registration on import)
    changes, corpus, gameplay, governance, ingest, learning, quality, retrieval, traffic,
    warehouse, weather,
)
from strata.registry.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
