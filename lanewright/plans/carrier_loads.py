"""Carrier load tracking: legacy and modern loads merged, volume attached, table refreshed."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanewright.functions.dates import day, moment, to_local
from lanewright.functions.quantities import utilisation
from lanewright.operators.joins import consolidate
from lanewright.plans.trailer_plan import COUNTRY, INVOICE_DAYS, STORE_FREIGHT, store_loads, with_zone
from lanewright.operators.scans import join_groups
from lanewright.session import staged
from lanewright.sources import partitions
from lanewright.sources.datasets import delete_matching, delete_orphans, merge_upsert

# Plan states that count as loads in the modern system.
ACTIVE_PLAN_STATES = ["TENDER_ACCEPTED", "IN_TRANSIT", "DELIVERED"]

LOAD_COLUMNS = [
    "load_id", "trip_id", "trailer_id", "origin_location_id", "dest_location_id", "load_status_code",
    "trip_status_code", "projected_date", "delivery_slot", "ready_ts", "projected_ts", "depart_ts",
]
LANE_KEYS = ["origin_location_id", "dest_location_id", "trailer_id", "projected_date"]
TRACKING_KEYS = ["load_id", "projected_date"]
CANCEL_KEYS = ["load_id", "origin_location_id", "dest_location_id"]
TRACKING_UPDATES = [
    "refresh_ts", "trip_id", "trailer_id", "load_status_code", "trip_status_code", "delivery_slot", "ready_ts",
    "projected_ts", "depart_ts", "total_cases", "total_cube", "total_weight", "trailer_util_pct",
]


def legacy(
    xref: DataFrame, loads: DataFrame, trips: DataFrame, dc_dim: DataFrame, store_dim: DataFrame,
    zones: DataFrame, now: dt.datetime,
) -> DataFrame:
    """Loads of the legacy system, times in the zone of the origin."""
    rows = store_loads(
        xref, loads, trips, dc_dim, store_dim, zones, now,
        status="load_status_code", active_trips_only=False, drop_past_placeholders=False,
    )
    zone = F.col("time_zone_name")
    return rows.select(
        "load_id", "trip_id", F.trim("trailer_id").alias("trailer_id"), "origin_location_id", "dest_location_id",
        "load_status_code", "trip_status_code",
        F.to_date("projected_ts").alias("projected_date"),
        F.hour("projected_ts").cast("long").alias("delivery_slot"),
        to_local(F.col("ready_ts_utc"), zone).alias("ready_ts"),
        "projected_ts",
        F.when(F.col("depart_odom_mile") > 0, to_local(F.col("depart_ts_utc"), zone)).alias("depart_ts"),
    )


def modern(
    plan_data: DataFrame, dc_dim: DataFrame, psn_load: DataFrame, store_dim: DataFrame, zones: DataFrame
) -> DataFrame:
    """Distinct loads of the modern system, times in the zone of the destination."""
    regional = dc_dim.filter(
        (F.col("country_code") == COUNTRY) & (F.col("current_ind") == "Y") & (F.col("dc_type_desc") == "Regional")
    ).select(F.col("dc_nbr").alias("origin_location_id"))
    rows = (
        plan_data.filter(
            F.col("status").isin(ACTIVE_PLAN_STATES)
            & (F.col("origin_location_type") == "DC")
            & (F.col("destination_location_type") == "STORE")
            & (F.col("category") == STORE_FREIGHT)
        )
        .withColumn("load_id", F.col("plan_id").cast("long"))
        .join(regional, "origin_location_id", "inner")
        .join(psn_load.select("load_id", "trailer_id"), "load_id", "left")
    )
    rows = with_zone(rows, "destination_location_id", store_dim, "store_nbr", zones)
    zone = F.col("time_zone_name")
    projected = to_local(F.col("min_due_ts"), zone)
    return rows.select(
        "load_id", F.col("parent_plan_id").alias("trip_id"), F.trim("trailer_id").alias("trailer_id"),
        "origin_location_id", F.col("destination_location_id").alias("dest_location_id"),
        F.col("status").alias("load_status_code"), F.lit(None).cast("string").alias("trip_status_code"),
        F.to_date(projected).alias("projected_date"),
        F.hour(projected).cast("long").alias("delivery_slot"),
        to_local(F.col("trailer_avail_ts"), zone).alias("ready_ts"),
        projected.alias("projected_ts"),
        to_local(F.col("actual_pickup_ts"), zone).alias("depart_ts"),
    ).distinct()


def combined(
    modern_loads: DataFrame, legacy_loads: DataFrame, invoice_summary: DataFrame, now: dt.datetime,
    lineage: str | None = None,
) -> DataFrame:
    """Both systems merged, with invoiced volume and trailer utilisation."""
    loads = consolidate(modern_loads, legacy_loads, LANE_KEYS, LOAD_COLUMNS, lineage, "load_id")
    volume = (
        invoice_summary.filter(F.col("invoice_date") >= day(now, -INVOICE_DAYS))
        .groupBy(F.col("load_id").alias("_load"))
        .agg(
            F.sum("case_qty").alias("total_cases"),
            F.sum("cube_qty").alias("total_cube"),
            F.sum("weight_qty").alias("total_weight"),
        )
    )
    rows = join_groups(loads, volume, [("load_id", "_load")], "left").drop("_load")
    return rows.withColumn("trailer_util_pct", utilisation(F.col("total_cube")))


def _tracking_columns(target: list[str], stamped: list[str]) -> tuple[list[str], list[str]]:
    """Columns of a tracking table that an upsert updates, and those it inserts."""
    updates = [c for c in [*TRACKING_UPDATES, "data_source"] if c in target and c in stamped]
    return updates, [c for c in target if c in stamped]


def refresh_tracking(
    target: DataFrame, source: DataFrame, cancelled: DataFrame, now: dt.datetime, drop_orphans: bool = False
) -> DataFrame:
    """Tracking table after upsert and deletions; optionally without rows whose date moved away."""
    source = staged(source)
    stamped = source.withColumn("refresh_ts", moment(now))
    merged = merge_upsert(target, stamped, TRACKING_KEYS, *_tracking_columns(target.columns, stamped.columns))
    kept = delete_matching(merged, cancelled, CANCEL_KEYS)
    return delete_orphans(kept, source, "load_id", "projected_date") if drop_orphans else kept


def refresh_stored_tracking(
    path: str, source: DataFrame, cancelled: DataFrame, now: dt.datetime, drop_orphans: bool = False
) -> DataFrame:
    """The same on a dataset partitioned by projected date, of which only touched dates are rewritten; ``source`` is read often."""
    spark, stamped = source.sparkSession, source.withColumn("refresh_ts", moment(now))
    if not partitions.exists(spark, path):
        kept = delete_matching(stamped, cancelled, CANCEL_KEYS)
        partitions.create(kept, path, "projected_date", now)
        return partitions.read(spark, path)
    target = partitions.read(spark, path).columns
    partitions.upsert(spark, path, stamped, TRACKING_KEYS, *_tracking_columns(target, stamped.columns), now)
    partitions.delete_matching(spark, path, cancelled, CANCEL_KEYS, now)
    if drop_orphans:
        partitions.delete_orphans(spark, path, source, "load_id", "projected_date", now)
    return partitions.read(spark, path)
