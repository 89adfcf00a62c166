"""Operators over event logs: pivots, gap repair, corrections, pairing, segments, precedence."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanewright.functions.nulls import strict_greatest
from lanewright.operators.scans import join_groups, ordered_scan, same_moment
from lanewright.session import staged


def milestone_pivot(
    log: DataFrame, keys: Sequence[str], event: str, ts: str, milestones: dict[str, tuple[str, Sequence[str]]]
) -> DataFrame:
    """One row per key with a column per milestone: (min | max | count_distinct, event types)."""
    aggregate = {"min": F.min, "max": F.max, "count_distinct": F.count_distinct}
    wanted = sorted({t for _, types in milestones.values() for t in types})
    return log.filter(F.col(event).isin(wanted)).groupBy(*keys).agg(
        *[
            aggregate[how](F.when(F.col(event).isin(list(types)), F.col(ts))).alias(name)
            for name, (how, types) in milestones.items()
        ]
    )


def repair_gaps(
    stays: DataFrame, keys: Sequence[str], entry: str, exit: str, first_open: str, last_close: str,
    tie: Sequence[str], pad: str = "1 minute", chunked: bool = True, crowded: bool = False,
) -> DataFrame:
    """Missing entry = previous exit of the same keys + pad; missing exit = next entry - pad.

    Only stays with a door event are repaired (others lose both times); stays
    without any signal are dropped first. Stays are scanned day by day; ``crowded`` is for
    keys that may have any number of stays at one time, or without one (the first tie is a number then).
    """
    seen = stays.filter(F.coalesce(F.col(first_open), F.col(last_close), F.col(exit)).isNotNull())

    def per_day(ts: str) -> list[Column] | None:
        fine = [same_moment(F.col(ts), F.col(tie[0]))] if crowded else []
        return [F.to_date(ts), *fine] if chunked else None

    back = ordered_scan(seen, keys, [exit, *tie], chunk=per_day(exit), prev={"_prev_exit": exit})
    both = ordered_scan(back, keys, [entry, *tie], chunk=per_day(entry), next={"_next_entry": entry})
    step = F.expr(f"INTERVAL {pad}")
    has_door = F.coalesce(F.col(first_open), F.col(last_close)).isNotNull()
    return both.withColumns(
        {
            entry: F.when(has_door, F.coalesce(F.col(entry), F.col("_prev_exit") + step)),
            exit: F.when(has_door, F.coalesce(F.col(exit), F.col("_next_entry") - step)),
        }
    ).drop("_prev_exit", "_next_entry")


def door_window(stays: DataFrame, entry: str, exit: str, first_open: str, last_close: str,
                start: str, end: str) -> DataFrame:
    """Time range in which a load's ready time belongs to a stay.

    From the stay's start (entry or first door event, whichever is later; unknown if
    either is), to its exit, at most 3 days before it; 5 days long if the exit is missing.
    """
    opened = strict_greatest(F.col(entry), F.coalesce(F.col(first_open), F.col(last_close)))
    known_exit = F.col(exit).isNotNull()
    return stays.withColumns(
        {
            start: F.when(known_exit, strict_greatest(opened, F.col(exit) - F.expr("INTERVAL 3 DAYS"))).otherwise(opened),
            end: F.when(known_exit, F.col(exit)).otherwise(opened + F.expr("INTERVAL 5 DAYS")),
        }
    )


def drop_superseded(
    events: DataFrame, key: str, ts: str, source: str, sources: Sequence[str], tie: Sequence[str] = (),
    chunk: Column | None = None,
) -> DataFrame:
    """Events left after corrections: an event followed on its date by one from ``sources`` takes that time.

    An event survives if its own time is among the corrected times of its key; events
    without key always do. "The next event is on the same date" only concerns events of
    one key and date, so the look-ahead works per (key, date), cut further by ``chunk``.
    """
    keyed = events.filter(F.col(key).isNotNull()).withColumn("_day", F.to_date(ts))
    ahead = ordered_scan(keyed, [key, "_day"], [ts, *tie], chunk=chunk, next={"_next_ts": ts, "_next_source": source})
    moved = F.when(F.col("_next_source").isin(list(sources)), F.col("_next_ts")).otherwise(F.col(ts))
    times = ahead.select(F.col(key).alias("_ckey"), moved.alias("_cts")).distinct()
    kept = join_groups(events, times, [(key, "_ckey"), (ts, "_cts")], "left_semi")
    return kept.unionByName(events.filter(F.col(key).isNull()))


def pair_by_position(
    starts: DataFrame, ends: DataFrame, key: str, start_ts: str, end_ts: str,
    start_tie: Sequence[str] = (), end_tie: Sequence[str] = (), chunked: bool = True,
) -> DataFrame:
    """The n-th start of a key beside its n-th end, and the key's last end (when paired).

    Keeps the columns of ``starts`` plus ``end_ts``, ``idx`` and ``last_<end_ts>``.
    """
    def numbered(df: DataFrame, ts: str, tie: Sequence[str], out: str) -> DataFrame:
        return ordered_scan(df, [key], [ts, *tie], chunk=F.to_date(ts) if chunked else None, number=out)

    ends = ends.select(key, end_ts, *end_tie)
    latest = ends.groupBy(F.col(key).alias("_key")).agg(F.max(end_ts).alias(f"last_{end_ts}"))
    right = join_groups(numbered(ends, end_ts, end_tie, "idx"), latest, [(key, "_key")], "inner")
    right = right.select(key, "idx", end_ts, f"last_{end_ts}")
    return numbered(starts, start_ts, start_tie, "idx").join(right, [key, "idx"], "left")


def segments_from_changes(
    log: DataFrame, key: str, ts: str, old: str, new: str, openings: DataFrame, opening_key: str, opening_ts: str,
    tie: Sequence[str] = (), chunk: Column | None = None,
) -> DataFrame:
    """Validity segments (key, value, segment_start, segment_end) from a change log.

    The first runs from the opening time with the old value to a second before the
    first change; then every new value from its change to a second before the next;
    the last stays open.
    """
    second = F.expr("INTERVAL 1 SECOND")
    change = F.col(ts).cast("timestamp_ntz")
    earliest = log.groupBy(F.col(key).alias("_first_key")).agg(F.min(ts).alias("_first_ts"))
    first = (
        log.join(earliest, (log[key] == earliest["_first_key"]) & (log[ts] == earliest["_first_ts"]), "left_semi")
        .join(openings.select(F.col(opening_key).alias("_okey"), F.col(opening_ts).alias("_ots")),
              F.col(key) == F.col("_okey"), "inner")
        .select(key, F.col(old).alias("value"), F.col("_ots").alias("segment_start"),
                (change - second).alias("segment_end"))
    )
    rest = ordered_scan(log, [key], [ts, *tie], chunk=F.to_date(ts) if chunk is None else chunk, next={"_next": ts})
    rest = rest.select(
        key, F.col(new).alias("value"), change.alias("segment_start"),
        (F.col("_next").cast("timestamp_ntz") - second).alias("segment_end"),
    )
    return first.unionByName(rest)


def precedence_union(
    sources: Sequence[tuple[DataFrame, str]], key: str, start: str, end: str
) -> DataFrame:
    """Union of sources in order of trust.

    Rule per source: ``all`` rows; ``absent`` - rows whose key no earlier source has;
    ``absent_or_later`` - also rows that start after the last end any earlier source
    recorded for the key (keys whose ends are all unknown admit none). One row per key, with the
    first source that has it and the ends, answers all rules; where a shared folder is named, each source is
    evaluated once and written there.
    """
    tagged = [df.withColumn("_rank", F.lit(i)) for i, (df, _) in enumerate(sources)]
    rows = staged(reduce(lambda x, y: x.unionByName(y), tagged))
    later = [i for i, (_, rule) in enumerate(sources) if rule == "absent_or_later"]
    ends = [F.max(F.when(F.col("_rank") < i, F.col(end))).alias(f"_end_{i}") for i in later]
    seen = rows.groupBy(F.col(key).alias("_seen")).agg(F.min("_rank").alias("_first"), *ends)
    met = join_groups(rows, seen, [(key, "_seen")], "left")
    # NULL keys meet no source
    absent = F.col("_seen").isNull() | (F.col("_first") >= F.col("_rank"))
    admitted = {"all": F.lit(True), "absent": absent}
    kept = F.lit(False)
    for i, (_, rule) in enumerate(sources):
        if rule not in (*admitted, "absent_or_later"):
            raise ValueError(f"unknown rule {rule!r}")
        ok = admitted[rule] if rule in admitted else absent | (F.col(start) > F.col(f"_end_{i}"))
        kept = kept | ((F.col("_rank") == i) & ok)
    return met.filter(kept).drop("_rank", "_seen", "_first", *[f"_end_{i}" for i in later])


def status_transitions(
    history: DataFrame, key: str, status: str, ts: str, tie: Sequence[str] = (), chunk: Column | None = None
) -> DataFrame:
    """Previous and next status of every change, and the time of the next change (``next_ts``)."""
    return ordered_scan(
        history, [key], [ts, *tie], chunk=F.to_date(ts) if chunk is None else chunk,
        prev={"prev_status": status}, next={"next_status": status, "next_ts": ts},
    )


__all__ = [
    "door_window", "drop_superseded", "milestone_pivot", "pair_by_position", "precedence_union",
    "repair_gaps", "segments_from_changes", "status_transitions",
]
