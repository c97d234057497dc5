"""Registered queries and the SQL they are checked against."""

from . import documents, ingestion, retrieval, text  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
