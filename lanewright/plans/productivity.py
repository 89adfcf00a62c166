"""Technician productivity per day over three activity sources."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanewright.functions import rules
from lanewright.functions.dates import datetime_diff, day
from lanewright.operators.scans import ordered_scan, totals_over
from lanewright.session import staged

WINDOW_DAYS = 90
COLUMNS = [
    "tech_id", "tech_name", "location_id", "activity_date", "activity_type", "workorder_id", "duration_minutes",
    "cumulative_minutes", "activity_seq",
]


def sequenced(df: DataFrame, rank: int, start: str) -> DataFrame:
    """Running minutes (peers share) and position of every activity within its technician-day.

    Technician-days are scanned in hourly chunks, so a crowded day is spread out.
    """
    scanned = ordered_scan(
        df, ["tech_id", "activity_date"], [start, "workorder_id"], chunk=F.date_trunc("hour", F.col(start)),
        number="activity_seq", running={"cumulative_minutes": "duration_minutes"}, running_order=[start],
    )
    return scanned.select(*COLUMNS, F.lit(rank).alias("_source"))


def internal_activity(activity: DataFrame, technicians: DataFrame, now: dt.datetime) -> DataFrame:
    staff = technicians.filter(F.col("employment_type") == "INTERNAL").select("tech_id", "tech_name")
    recent = activity.filter(F.col("activity_date") >= day(now, -WINDOW_DAYS)).drop("tech_name")
    return sequenced(recent.join(staff, "tech_id", "inner"), 1, "start_time")


def site_visits(checkins: DataFrame, now: dt.datetime) -> DataFrame:
    rows = checkins.filter(F.col("checkin_date") >= day(now, -WINDOW_DAYS)).withColumns(
        {
            "activity_date": F.col("checkin_date"),
            "activity_type": F.lit("SITE_VISIT"),
            "duration_minutes": datetime_diff(F.col("checkout_time"), F.col("checkin_time"), "minute"),
        }
    )
    return sequenced(rows, 2, "checkin_time")


def phone_support(calls: DataFrame, now: dt.datetime) -> DataFrame:
    rows = calls.filter(F.col("call_date") >= day(now, -WINDOW_DAYS)).withColumns(
        {
            "activity_date": F.col("call_date"),
            "activity_type": F.lit("PHONE_SUPPORT"),
            "duration_minutes": F.col("call_duration_minutes"),
        }
    )
    return sequenced(rows, 3, "call_time")


def productivity(sources: list[DataFrame], locations: DataFrame, ordered: bool = False) -> DataFrame:
    """All activities with daily totals, the previous cumulative figure and the day's status.

    ``ordered`` sorts by technician, day and position.
    """
    place = locations.select("location_id", "region_name", "district_name")
    rows = reduce(lambda a, b: a.unionByName(b), sources).join(place, "location_id", "inner")
    daily: dict[str, Column] = {
        "total_daily_minutes": F.max("cumulative_minutes"),
        "total_daily_activities": F.max("activity_seq"),
    }
    rows = staged(totals_over(staged(rows), ["tech_id", "activity_date"], daily))
    rows = ordered_scan(
        rows, ["tech_id"], ["activity_date", "activity_seq", "_source", "workorder_id"], chunk=F.col("activity_date"),
        prev={"prev_cumulative": "cumulative_minutes"},
    )
    rows = rows.withColumn("productivity_status", rules.productivity_status(F.col("total_daily_minutes")))
    rows = rows.drop("_source")
    return rows.orderBy("tech_id", "activity_date", "activity_seq") if ordered else rows
