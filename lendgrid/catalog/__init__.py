"""Registered queries: each pairs a Spark job over the given tables with plain SQL for the same result."""

from lendgrid.catalog.registry import QUERIES, SQL

from lendgrid.catalog import feature_queries, model_queries, text_queries  # noqa: F401,E402

__all__ = ["QUERIES", "SQL"]
