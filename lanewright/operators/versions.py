"""Choice of record versions: latest, first, unambiguous."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lanewright.operators.scans import join_groups


def latest_version(df: DataFrame, keys: Sequence[str], version: str, distinct: bool = True) -> DataFrame:
    """Rows carrying the highest ``version`` of their key; ties stay, exact copies fold into one."""
    newest = df.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(F.max(version).alias("_newest"))
    kept = join_groups(
        df, newest, [(k, f"_k_{k}") for k in keys], "left_semi", nulls_match=True, also=df[version] == newest["_newest"]
    )
    return kept.distinct() if distinct else kept


def first_version(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], where: Column | None = None
) -> DataFrame:
    """First row of every key, among the rows that satisfy ``where``.

    Spark keeps one row per key and task before the shuffle (``WindowGroupLimit``),
    so a hot key costs no more than the number of tasks.
    """
    rows = df if where is None else df.filter(where)
    window = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_rn", F.row_number().over(window)).filter(F.col("_rn") == 1).drop("_rn")


def singleton_only(df: DataFrame, keys: Sequence[str], counted: str) -> DataFrame:
    """Rows of keys whose count of known ``counted`` values is exactly one; others go entirely.

    ``counted`` has to be one of the keys. One aggregation: a key reaches its task as
    one row per map task, however many rows it had.
    """
    if counted not in keys:
        raise ValueError("the counted column must be a key")
    row = F.any_value(F.struct(*[F.col(c) for c in df.columns])).alias("_row")
    grouped = df.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(F.count(counted).alias("_n"), row)
    return grouped.filter(F.col("_n") == 1).select("_row.*")


def first_versions(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], which: dict[str, Column | None],
) -> DataFrame:
    """First row of every key under several conditions at once, {struct column: condition}.

    One aggregation instead of a ranking per condition. The structs hold ``order``;
    a condition no row of the key satisfies gives NULL.
    """
    row = F.struct(*[F.col(c) for c in order])
    return df.groupBy(*keys).agg(
        *[F.min(row if where is None else F.when(where, row)).alias(name) for name, where in which.items()]
    )
