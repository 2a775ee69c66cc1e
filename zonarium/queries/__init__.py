"""Queries over the given tables, each with the SQL it is checked against."""

from . import listings, reports, runs, series, storage  # noqa: F401  (they register queries)
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
