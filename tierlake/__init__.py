"""Metadata-driven Lake, Bronze, Silver and Gold pipelines as Spark jobs."""

from tierlake.contract import Contract
from tierlake.names import Layers, TableName
from tierlake.session import configure

__all__ = ["Contract", "Layers", "TableName", "configure"]
