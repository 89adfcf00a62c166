"""Null-strict extremes and guarded ratios."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F


def _all_known(cols: tuple[Column, ...]) -> Column:
    return reduce(and_, [c.isNotNull() for c in cols])


def strict_least(*cols: Column) -> Column:
    """Smallest argument, NULL as soon as one argument is NULL (Spark's ``least`` skips NULLs)."""
    return F.when(_all_known(cols), F.least(*cols))


def strict_greatest(*cols: Column) -> Column:
    """Largest argument, NULL as soon as one argument is NULL."""
    return F.when(_all_known(cols), F.greatest(*cols))


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Real division that yields NULL for a zero denominator."""
    return numerator / F.when(denominator != 0, denominator)
