"""Registered queries over the given tables, each with the SQL that checks it."""

from catalog.base import ORACLES, QUERIES
from catalog import columns, geography, grouping, inputs, live, scoring, sites, stream  # noqa: F401  (registers)

__all__ = ["ORACLES", "QUERIES"]
