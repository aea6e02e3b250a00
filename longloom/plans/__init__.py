"""Whole queries over the driver's tables."""

from . import generated, golds, relational
from .registry import ORACLE_SQL, QUERIES, get, query

__all__ = ["ORACLE_SQL", "QUERIES", "generated", "get", "golds", "query", "relational"]
