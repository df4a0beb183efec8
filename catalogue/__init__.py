"""Queries over the given tables, each with its DuckDB counterpart."""

from catalogue import bronze, gold, ingest, market, silver, streams  # noqa: F401  (they register)
from catalogue.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
