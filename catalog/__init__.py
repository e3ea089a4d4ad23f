"""Queries that run each operator on whole tables, each with the SQL that gives
the same result."""

from catalog import (  # noqa: F401
    audits,
    cleaning,
    documents,
    enriching,
    intervals,
    rules,
    stages,
)
from catalog.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
