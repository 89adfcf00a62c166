"""Technician activity log from three systems, attributed to provider and person."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanewright.functions import rules
from lanewright.functions.dates import datetime_diff, day, home_date, moment
from lanewright.operators.events import (
    drop_superseded, pair_by_position, precedence_union, segments_from_changes,
)
from lanewright.operators.joins import either_key_join, interval_join
from lanewright.operators.scans import without_match
from lanewright.session import staged

# Sources that correct earlier phone entries, the test user, and the call actions.
CORRECTING_SOURCES = ["xml", "web"]
TEST_USERS = ["testtec"]
CHECK_IN, CHECK_OUT = 1, 2

ACTIVITY_COLUMNS = [
    "activity_id", "provider_id", "provider_name", "user_id", "first_name", "last_name", "full_name", "work_type",
    "check_in_datetime", "check_out_datetime", "tracking_nbr", "src",
]


def _joined(first: Column, last: Column) -> Column:
    return F.concat(first, F.lit(" "), last)


def isp_activity(activity: DataFrame, people: DataFrame, alignment: DataFrame) -> DataFrame:
    """Service-platform visits; the person is found by employee number or user id."""
    person = people.select(
        F.col("employee_id").alias("_employee"), F.col("user_id").alias("_user"), "provider_id", "provider_name",
        F.col("first_name").alias("_first"), F.col("last_name").alias("_last"),
    )
    fallback = alignment.select(
        F.col("user_id").alias("technician_user_id"), F.col("first_name").alias("_a_first"),
        F.col("last_name").alias("_a_last"),
    )
    visits = activity.filter(~F.col("technician_user_id").isin(TEST_USERS)).withColumn(
        "_win", F.col("technician_win_no").cast("string")
    )
    rows = either_key_join(visits, person, [("_win", "_employee"), ("technician_user_id", "_user")])
    rows = rows.join(fallback, "technician_user_id", "left")
    c = F.col
    return rows.select(
        "activity_id", "provider_id", "provider_name", c("technician_user_id").alias("user_id"),
        F.coalesce(c("_first"), c("_a_first")).alias("first_name"),
        F.coalesce(c("_last"), c("_a_last")).alias("last_name"),
        F.coalesce(_joined(c("_first"), c("_last")), _joined(c("_a_first"), c("_a_last"))).alias("full_name"),
        c("activity_type").alias("work_type"),
        c("local_start_time").cast("timestamp_ntz").alias("check_in_datetime"),
        c("local_end_time").cast("timestamp_ntz").alias("check_out_datetime"),
        c("tracking_no").alias("tracking_nbr"),
        F.lit("isp").alias("src"),
    )


def ftm_activity(mobile: DataFrame, people: DataFrame, providers: DataFrame, now: dt.datetime) -> DataFrame:
    """Mobile check-ins of known people; check-outs from today on are not believed."""
    person = people.select(
        F.col("id").alias("user_id"), F.col("provider_id").alias("_p_provider"),
        F.col("provider_name").alias("_p_name"), F.col("user_id").alias("_p_user"),
        F.col("first_name").alias("_first"), F.col("last_name").alias("_last"),
    )
    named = providers.select("provider_id", F.col("provider_name").alias("_v_name"))
    rows = (
        mobile.filter(
            (F.col("tracking_number") > 0)
            & (F.year("check_in_date_time") < 9000)
            & (F.year("check_out_date_time") < 9000)
        )
        .join(person, "user_id", "inner")
        .join(named, "provider_id", "left")
    )
    c = F.col
    out = c("check_out_date_time").cast("timestamp_ntz")
    return rows.select(
        c("record_id_nbr").alias("activity_id"),
        F.coalesce(c("_p_provider"), c("provider_id")).alias("provider_id"),
        F.coalesce(c("_p_name"), c("_v_name")).alias("provider_name"),
        c("_p_user").cast("string").alias("user_id"),
        F.coalesce(c("_first"), c("technician_first_name")).alias("first_name"),
        F.coalesce(c("_last"), c("technician_last_name")).alias("last_name"),
        F.upper(
            F.coalesce(
                _joined(c("_first"), c("_last")), _joined(c("technician_first_name"), c("technician_last_name"))
            )
        ).alias("full_name"),
        F.upper("work_type").alias("work_type"),
        c("check_in_date_time").cast("timestamp_ntz").alias("check_in_datetime"),
        F.when(out < day(home_date(now)).cast("timestamp_ntz"), out).alias("check_out_datetime"),
        c("tracking_number").alias("tracking_nbr"),
        F.lit("ftm").alias("src"),
    ).distinct()


def ivr_activity(calls: DataFrame, now: dt.datetime) -> DataFrame:
    """Phone check-ins paired with check-outs by position, after corrections."""
    calls = calls.select("ivr_id", "tracking_number", "ivr_action", "ivr_date_time", "check_in_source")

    def corrected(action: int) -> DataFrame:
        rows = calls.filter(F.col("ivr_action") == action)
        return drop_superseded(
            rows, "tracking_number", "ivr_date_time", "check_in_source", CORRECTING_SOURCES, tie=["ivr_id"]
        )

    starts = (
        corrected(CHECK_IN)
        .groupBy("tracking_number", F.col("ivr_date_time").alias("check_in"))
        .agg(F.max("ivr_id").alias("ivr_id"))
        .filter(F.col("tracking_number").isNotNull())
    )
    ends = corrected(CHECK_OUT).filter(F.col("tracking_number").isNotNull()).select(
        "tracking_number", F.col("ivr_date_time").alias("check_out"), F.col("ivr_id").alias("out_id")
    )
    pairs = pair_by_position(starts, ends, "tracking_number", "check_in", "check_out", ["ivr_id"], ["out_id"])
    # every tracking number has a row, also those that never checked in
    numbers = calls.select("tracking_number").distinct()
    silent = without_match(numbers, starts, [("tracking_number", "tracking_number")])
    rows = pairs.unionByName(silent, allowMissingColumns=True).withColumnRenamed("tracking_number", "tracking_nbr")
    out = F.coalesce(F.col("check_out"), F.col("last_check_out"))
    # a check-out before its check-in is dropped once the check-in is a week old
    stale = F.coalesce((out < F.col("check_in")) & (F.col("check_in") < moment(now, days=-7)), F.lit(False))
    unknown = F.lit(None).cast("string")
    return rows.select(
        F.col("ivr_id").alias("activity_id"), F.lit(None).cast("long").alias("provider_id"),
        unknown.alias("provider_name"), unknown.alias("user_id"), unknown.alias("first_name"),
        unknown.alias("last_name"), unknown.alias("full_name"), F.lit("Repair").alias("work_type"),
        F.col("check_in").cast("timestamp_ntz").alias("check_in_datetime"),
        F.when(~stale, out).cast("timestamp_ntz").alias("check_out_datetime"),
        "tracking_nbr", F.lit("ivr").alias("src"),
    )


def provider_segments(changes: DataFrame, orders: DataFrame, providers: DataFrame) -> DataFrame:
    """Which provider held a work order when."""
    log = changes.filter(F.upper("change_event") == "PROVIDER").select(
        "tracking_number", "change_time", "old_value", "new_value"
    )
    segments = segments_from_changes(
        log, "tracking_number", "change_time", "old_value", "new_value", orders, "tracking_nbr", "call_date",
        tie=["new_value"],
    )
    named = providers.select("provider_id", "provider_name")
    return segments.withColumn("provider_id", F.col("value").cast("long")).drop("value").join(
        named, "provider_id", "left"
    )


def aligned_people(alignment: DataFrame) -> DataFrame:
    first, last = F.trim("first_name"), F.trim("last_name")
    return alignment.filter(F.trim("user_id") != "").select(
        F.upper(F.replace("user_id", F.lit(" "), F.lit(""))).alias("user_id"),
        F.upper(first).alias("first_name"), F.upper(last).alias("last_name"),
        F.upper(_joined(first, last)).alias("full_name"),
        "org_role", "insource_start_date", "insource_exit_date", "home_location",
    )


def technician_activity(
    isp: DataFrame, ftm: DataFrame, ivr: DataFrame, segments: DataFrame, alignment: DataFrame, workorders: DataFrame
) -> DataFrame:
    """One activity table: sources by precedence, provider at check-in, person, duration."""
    isp, ftm, ivr = (df.select(*ACTIVITY_COLUMNS) for df in (isp, ftm, ivr))
    log = precedence_union(
        [(isp, "all"), (ftm, "absent"), (ivr, "absent_or_later")],
        "tracking_nbr", "check_in_datetime", "check_out_datetime",
    )
    known = workorders.select(
        F.col("tracking_nbr").alias("_wo"), F.col("location_id").alias("_wo_location"), "completion_date"
    ).distinct()
    rows = log.join(known, log["tracking_nbr"] == known["_wo"], "left").filter(
        F.col("_wo").isNotNull() | F.col("tracking_nbr").isNull() | (F.col("tracking_nbr") == 0)
    )
    held = segments.select(
        F.col("tracking_number").alias("_seg_key"), F.col("provider_id").alias("_seg_provider"),
        F.col("provider_name").alias("_seg_name"), "segment_start", "segment_end",
    )
    rows = interval_join(
        staged(rows), staged(held), [("tracking_nbr", "_seg_key")], "check_in_datetime", "segment_start", "segment_end", closed=False
    )
    person = aligned_people(alignment)
    person = person.withColumnsRenamed(
        {"user_id": "_a_user", "first_name": "_a_first", "last_name": "_a_last", "full_name": "_a_full"}
    )
    rows = rows.join(person, rows["user_id"] == person["_a_user"], "left")
    c = F.col
    minutes = datetime_diff(c("check_out_datetime"), c("check_in_datetime"), "minute")
    return rows.select(
        "activity_id",
        F.coalesce(c("_seg_provider"), c("provider_id")).alias("provider_id"),
        F.upper(F.coalesce(c("_seg_name"), c("provider_name"))).alias("provider_name"),
        F.upper("user_id").alias("user_id"),
        F.coalesce(c("_a_first"), F.upper("first_name")).alias("first_name"),
        F.coalesce(c("_a_last"), F.upper("last_name")).alias("last_name"),
        F.coalesce(c("_a_full"), F.upper("full_name")).alias("full_name"),
        "org_role", "insource_start_date", "insource_exit_date", "home_location",
        F.upper("work_type").alias("work_type"),
        "check_in_datetime",
        F.coalesce(c("check_out_datetime"), c("completion_date")).alias("check_out_datetime"),
        rules.activity_minutes(c("check_in_datetime"), c("check_out_datetime"), minutes).alias("activity_minutes"),
        F.nullif(c("tracking_nbr"), F.lit(0)).alias("tracking_nbr"),
        "src",
    )
