"""Strata: data-job operators for PySpark (ingest, modelling, quality, streams, search)."""

__version__ = "0.1.0"
