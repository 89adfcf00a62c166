"""Wide to long."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unpivot_groups(
    df: DataFrame, id_columns: Sequence[str], groups: Sequence[tuple[str, Sequence[str]]],
    names: Sequence[str], label: str,
) -> DataFrame:
    """One row per (input row, column group); groups that are entirely NULL give none.

    ``groups`` are (label, columns in the order of ``names``); labels may repeat.
    """
    rows = F.array(
        *[
            F.struct(F.lit(text).alias(label), *[F.col(c).alias(n) for c, n in zip(columns, names, strict=True)])
            for text, columns in groups
        ]
    )
    long = df.select(*id_columns, F.explode(rows).alias("_group"))
    long = long.select(*id_columns, *[F.col("_group")[n].alias(n) for n in (label, *names)])
    return long.filter(reduce(or_, [F.col(n).isNotNull() for n in names]))


def unpivot_columns(
    df: DataFrame, id_columns: Sequence[str], columns: dict[str, str], value: str, label: str
) -> DataFrame:
    """Single-column form: {source column: label}, NULL values left out."""
    return unpivot_groups(df, id_columns, [(text, [c]) for c, text in columns.items()], [value], label)
