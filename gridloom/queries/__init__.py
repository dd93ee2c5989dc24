"""Queries of the engine's operators over the driver's tables, with SQL where SQL can express them."""

from . import relational, series, spatial
from .base import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "relational", "series", "spatial"]
