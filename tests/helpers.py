"""Small fixtures and readable results."""

from __future__ import annotations

import datetime as dt


def ts(text: str | None) -> dt.datetime | None:
    return None if text is None else dt.datetime.fromisoformat(text)


def d(text: str | None) -> dt.date | None:
    return None if text is None else dt.date.fromisoformat(text)


def frame(spark, schema: str, *rows):
    return spark.createDataFrame([tuple(r) for r in rows], schema)


def rows(df, *columns):
    """Rows as tuples of the named columns (all by default), sorted with NULLs first."""
    picked = df.select(*columns) if columns else df
    out = [tuple(r) for r in picked.collect()]
    return sorted(out, key=lambda r: [(v is not None, str(type(v)) if v is None else v) for v in r])
