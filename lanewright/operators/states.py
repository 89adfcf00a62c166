"""Statistics kept as states that merge: a new day is added without the days before it.

The state of a column is how often each value occurs per key: one row per (key, value).
States of parts merge by adding counts, in any order, and all figures of a key follow from
them exactly: number, mean, deviation, extremes, distinct values and percentiles.
Values that are measured finely want rounding first, as the state grows with distinct ones.

Distinct ids have a state of their own, bitmaps of 32,768 consecutive ids each: the ids of a
week are the union of its days', so a weekly count follows from daily states, exactly. It
suits ids that are numbered densely; ids far apart take a bitmap each.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanewright.sources import partitions

COUNT = "copies"


def value_counts(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """State of ``column``: its known values per key with their ``copies``."""
    known = df.filter(F.col(column).isNotNull())
    return known.groupBy(*keys, F.col(column).alias("value")).agg(F.count(F.lit(1)).alias(COUNT))


def merged(states: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """The state of all rows that the ``states`` stand for; finer keys are rolled up to ``keys``."""
    rows = [s.select(*keys, "value", COUNT) for s in states]
    return reduce(lambda a, b: a.unionByName(b), rows).groupBy(*keys, "value").agg(F.sum(COUNT).alias(COUNT))


def figures(state: DataFrame, keys: Sequence[str], points: dict[str, float]) -> DataFrame:
    """``n``, ``mean``, ``deviation`` (of the population), ``least``, ``most``, ``distinct`` and percentiles per key.

    A state with finer keys is rolled up first. Percentiles interpolate between neighbours.
    """
    rolled = merged([state], keys)
    value, copies = F.col("value").cast("double"), F.col(COUNT)
    n, total = F.sum(copies), F.sum(value * copies)
    variance = F.greatest(F.sum(value * value * copies) / n - (total / n) * (total / n), F.lit(0.0))
    cuts = F.percentile(value, F.array(*[F.lit(p) for p in points.values()]), copies)
    out = rolled.groupBy(*keys).agg(
        n.alias("n"), (total / n).alias("mean"), F.sqrt(variance).alias("deviation"), F.min("value").alias("least"),
        F.max("value").alias("most"), F.count("value").alias("distinct"), cuts.alias("_cuts"),
    )
    return out.withColumns({name: F.col("_cuts")[i] for i, name in enumerate(points)}).drop("_cuts")


def add_rows(
    spark: SparkSession, path: str, rows: DataFrame, keys: Sequence[str], column: str, by: str, committed_at: dt.datetime,
) -> None:
    """Adds rows to the stored state at ``path``, which is partitioned by ``by``, one of the keys.

    Only the partitions that the rows fall into are read and written; the first call makes the dataset.
    """
    fresh = value_counts(rows, keys, column)
    if not partitions.exists(spark, path):
        partitions.create(fresh, path, by, committed_at)
        return
    partitions.change(spark, path, fresh, lambda held, new: merged([held, new], keys), committed_at)


def distinct_state(
    df: DataFrame, keys: Sequence[str], column: str, within: Sequence[str] | None = None,
) -> DataFrame:
    """Bitmaps of the known ids in ``column``, whole numbers, per key: one row per (key, bucket).

    Ids are dealt to their (key, bucket) before bitmaps are made: a bitmap takes 4 KB however
    few ids it has, so a task makes one after the other and sorts ids only. ``within`` names
    the first keys, to which the state will be rolled up: their days are dealt together, so
    that neither the state nor the roll-up sorts or moves bitmaps.
    """
    known = df.filter(F.col(column).isNotNull()).select(*keys, F.col(column).cast("long").alias("_id")).distinct()
    cut = known.select("*", F.bitmap_bucket_number("_id").alias("bucket")).repartition("bucket", *(within or keys))
    made = cut.groupBy("bucket", *keys).agg(F.bitmap_construct_agg(F.bitmap_bit_position("_id")).alias("bits"))
    return made.select(*keys, "bucket", "bits")


def distinct_merged(states: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """The state of all rows that the ``states`` stand for; finer keys are rolled up to ``keys``."""
    # buckets first: the order in which ``distinct_state`` leaves them
    rows = [s.select(*keys, "bucket", "bits") for s in states]
    return reduce(lambda a, b: a.unionByName(b), rows).groupBy("bucket", *keys).agg(
        F.bitmap_or_agg("bits").alias("bits")
    ).select(*keys, "bucket", "bits")


def distinct_counts(state: DataFrame, keys: Sequence[str], out: str) -> DataFrame:
    """``COUNT(DISTINCT id)`` per key (keys without a known id have no row)."""
    return distinct_merged([state], keys).groupBy(*keys).agg(F.sum(F.bitmap_count("bits")).alias(out))
