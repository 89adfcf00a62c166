"""Dense entity x calendar grids, gap filling and neighbour tests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lanewright.operators.scans import ordered_scan


def dense_grid(facts: DataFrame, entity: str, date: str, calendar: DataFrame, calendar_date: str) -> DataFrame:
    """Every calendar row between an entity's first and last fact date, per entity.

    The range is unrolled per entity and equi-joined to the calendar, so no cross
    product of entities and calendar is formed.
    """
    spans = facts.groupBy(entity).agg(F.min(date).alias("_lo"), F.max(date).alias("_hi")).filter(
        F.col("_lo").isNotNull()
    )
    days = spans.select(entity, F.explode(F.sequence("_lo", "_hi")).alias("_day"))
    return days.join(calendar, days["_day"] == calendar[calendar_date], "inner").drop("_day")


def sparse_on_grid(grid: DataFrame, facts: DataFrame, on: Sequence[str]) -> DataFrame:
    """Facts laid on the grid; days without a fact keep NULLs."""
    return grid.join(facts, list(on), "left")


def forward_fill(df: DataFrame, value: str, keys: Sequence[str], order: Sequence[str], out: str,
                 chunk: Column | None = None) -> DataFrame:
    """Own value, else the last known one before it within ``keys``."""
    return ordered_scan(df, keys, order, chunk=chunk, fill={out: value})


def neighbour_flag(df: DataFrame, value: str, keys: Sequence[str], order: Sequence[str], out: str) -> DataFrame:
    """'Y' for a non-zero row with a zero row right before or after it, else 'N'."""
    around = Window.partitionBy(*keys).orderBy(*order).rowsBetween(-1, 1)
    lowest = F.min(value).over(around)
    own_zero = F.coalesce(F.col(value) == 0, F.lit(False))
    return df.withColumn(out, F.when(~own_zero & (lowest == 0), "Y").otherwise("N"))


def rolling_mean(df: DataFrame, value: str, keys: Sequence[str], order: Sequence[str], rows: int, out: str) -> DataFrame:
    """Mean of the current and the ``rows - 1`` preceding rows."""
    frame = Window.partitionBy(*keys).orderBy(*order).rowsBetween(1 - rows, 0)
    return df.withColumn(out, F.avg(value).over(frame))


def year_over_year(
    df: DataFrame, keys: Sequence[str], year: str, month: str, values: dict[str, str], calendar_aware: bool = False
) -> DataFrame:
    """Last year's value beside this year's, {new column: source column}.

    The default looks twelve rows back, so a missing month shifts the comparison;
    ``calendar_aware`` joins the same month of the previous year instead.
    """
    if not calendar_aware:
        by_month = Window.partitionBy(*keys).orderBy(year, month)
        return df.withColumns({n: F.lag(c, 12).over(by_month) for n, c in values.items()})
    join_keys = [*keys, year, month]
    earlier = df.select(
        *keys, (F.col(year) + 1).alias(year), F.col(month), *[F.col(c).alias(n) for n, c in values.items()]
    )
    return df.join(earlier, join_keys, "left")
