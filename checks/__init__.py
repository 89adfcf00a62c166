"""Queries over the test tables, each with an independent SQL statement to compare with."""

from checks import activity, crowded, supply, trailer  # noqa: F401
from checks.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
