"""Store trailer plan: forecast, loads, yard activity, volume, refresh, dashboard.

Every stage is a function from DataFrames to a DataFrame; ``jobs.run_trailer_plan``
chains them over stored staging tables. ``now`` is the run time (UTC civil time).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lanewright.functions import rules
from lanewright.functions.dates import datetime_diff, datetime_trunc, day, moment, to_local
from lanewright.functions.nulls import strict_greatest
from lanewright.functions.quantities import non_breakpack_cases, pack_volume
from lanewright.operators.calendar import dense_grid, forward_fill, neighbour_flag
from lanewright.operators.events import door_window, milestone_pivot, repair_gaps
from lanewright.operators.joins import by_priority, consolidate, date_window_or_ids, interval_join
from lanewright.operators.scans import count_distinct_over, join_groups, totals_over
from lanewright.operators.versions import first_versions, latest_version, singleton_only
from lanewright.session import staged
from lanewright.sources import partitions
from lanewright.sources.datasets import delete_matching, merge_upsert

# Scope of the plan.
COUNTRY = "US"
OFFSHORE_STATES = ["AK", "HI", "PR"]
STORE_TRIP_TYPES = ["STORE", "CONSOLIDATED"]
STORE_FREIGHT = "STR"
FLEET_CARRIERS = ["INTERNAL", "CARRIER_A", "CARRIER_B"]
OUTS_CODES = ["O", "R", "M", "F"]
LOOKBACK_DAYS = 420
INVOICE_DAYS = 365

GATE_IN, GATE_OUT = "TRAILER_GATE_IN", "TRAILER_GATE_OUT"
DOOR_OPEN, DOOR_CLOSE = "OUTBOUND_TRAILER_DOOR_OPEN", "OUTBOUND_TRAILER_DOOR_CLOSE"

LOAD_COLUMNS = [
    "load_id", "trip_id", "trailer_id", "orig_loc_id", "dest_loc_id", "load_status", "projected_date",
    "delivery_slot", "ready_ts", "projected_ts", "door_open_count", "first_trailer_door_open_ts",
    "last_trailer_door_close_ts", "begin_trip_ts", "end_trip_ts",
]
PLAN_KEYS = ["load_id", "run_date"]
CANCEL_KEYS = ["load_id", "orig_loc_id", "dest_loc_id"]
PLAN_UPDATES = [
    "refresh_time", "trip_id", "trailer_id", "orig_loc_id", "dest_loc_id", "delivery_slot", "case_qty",
    "cube_qty", "weight_qty", "trlr_util_pct", "ready_ts", "projected_ts", "begin_trip_ts", "end_trip_ts",
    "load_status", "daily_plan", "must_ship_flag", "ready_flag", "carry_over_flag", "pull_forward_flag",
    "over_plan_flag", "capped_flag",
]


def with_zone(rows: DataFrame, on: str, locations: DataFrame, number: str, zones: DataFrame) -> DataFrame:
    """Add the time zone of the current domestic location named in ``on``.

    Location and zone join one after the other: each is a plain scan whose size Spark
    knows when it decides whether to broadcast.
    """
    scope = locations.filter((F.col("country_code") == COUNTRY) & (F.col("current_ind") == "Y"))
    located = rows.join(scope.select(F.col(number).alias(on), "time_zone_code"), on, "left")
    return located.join(zones, "time_zone_code", "left").drop("time_zone_code")


# -- stage 1 ---------------------------------------------------------------------------------


def forecast_current(
    calendar: DataFrame, forecast: DataFrame, now: dt.datetime, ordered: bool = False
) -> DataFrame:
    """Latest forecast per location on a gap-free calendar, with must-ship days.

    Missing days take the plan of the last known same weekday. A (location, day) has
    one row after version choice, so the windows are bounded by the calendar.
    ``ordered`` sorts by location and day.
    """
    keys = ["location_id", "cap_calendar_date"]
    latest = latest_version(forecast, keys, "run_datetime")
    week = calendar.select(
        F.col("calendar_date").alias("cap_calendar_date"),
        F.col("year_wk_nbr").alias("cap_year_wk_nbr"),
        F.col("year_nbr").alias("cap_year_nbr"),
        F.col("week_nbr").alias("cap_week_nbr"),
        F.col("week_day_name").alias("cap_week_day_name"),
    )
    delivery = calendar.select(
        F.date_sub("calendar_date", 7).alias("cap_calendar_date"),
        F.col("calendar_date").alias("del_calendar_date"),
        F.col("year_wk_nbr").alias("del_year_wk_nbr"),
    )
    grid = dense_grid(forecast, "location_id", "cap_calendar_date", week, "cap_calendar_date")
    laid = grid.join(latest, keys, "left").join(delivery, "cap_calendar_date", "inner")
    laid = laid.withColumn("_weekday", F.dayofweek("cap_calendar_date"))
    order = ["cap_calendar_date"]
    filled = forward_fill(laid, "delivery_type_code", ["location_id"], order, "_type")
    filled = forward_fill(filled, "daily_cap", ["location_id", "_weekday"], order, "daily_plan")
    filled = neighbour_flag(filled, "daily_plan", ["location_id"], order, "must_ship_flag")
    rows = filled.select(
        F.coalesce("run_datetime", moment(now)).alias("run_datetime"),
        "location_id",
        F.col("_type").alias("delivery_type_code"),
        "cap_calendar_date", "cap_year_wk_nbr", "cap_year_nbr", "cap_week_nbr", "cap_week_day_name",
        "del_calendar_date", "del_year_wk_nbr",
        "daily_plan",
        F.when(F.col("daily_plan") > 0, 1).otherwise(0).alias("daily_flag"),
        "must_ship_flag",
    )
    return rows.orderBy("location_id", "cap_calendar_date") if ordered else rows


def forecast_filled(forecast: DataFrame) -> DataFrame:
    """Condensed form for a forecast that already has one row per location and calendar day."""
    rows = forecast.withColumn("_weekday", F.dayofweek("calendar_date"))
    rows = forward_fill(rows, "daily_cap", ["location_id", "_weekday"], ["calendar_date"], "daily_plan")
    rows = neighbour_flag(rows, "daily_plan", ["location_id"], ["calendar_date"], "must_ship_flag")
    return rows.select("location_id", "calendar_date", "daily_plan", "must_ship_flag")


# -- stage 2 ---------------------------------------------------------------------------------


def assigned_versions(history: DataFrame) -> DataFrame:
    """First history row per (load, creation) with any trailer, and with a real one."""
    where = (
        ~F.col("load_status").isin("CANCEL")
        & (F.trim("freight_category_code") == STORE_FREIGHT)
        & F.col("trailer_id").isNotNull()
    )
    return first_versions(
        history.filter(where), ["load_id", "create_ts_utc"], ["last_change_ts_utc", "ready_ts_utc", "trailer_id"],
        {"_any": None, "_real": rules.real_trailer(F.col("trailer_id"))},
    )


def selected_ready(trailer_id: Column, estimated: Column, current: Column, first_change: Column) -> Column:
    """UTC ready time: a value never updated since creation is replaced by the first change, if later."""
    unchanged = F.abs(datetime_diff(estimated, current, "second")) <= 2
    return F.when(
        rules.real_trailer(trailer_id),
        F.when(unchanged, strict_greatest(current, first_change)).otherwise(current),
    )


def store_loads(
    xref: DataFrame, loads: DataFrame, trips: DataFrame, dc_dim: DataFrame, store_dim: DataFrame,
    zones: DataFrame, now: dt.datetime, *, status: str, active_trips_only: bool, drop_past_placeholders: bool,
) -> DataFrame:
    """Loads with their trips from regional DCs to continental stores, and the DC's zone.

    Dimension filters come first so that the joins carry a handful of columns; the two
    filters the trailer plan has and the carrier extract lacks are arguments.
    """
    projected = F.to_date("projected_ts")
    trip_rows = trips.filter(
        (projected >= day(now, -LOOKBACK_DAYS)) & F.trim("trip_type_code").isin(STORE_TRIP_TYPES)
    )
    if active_trips_only:
        trip_rows = trip_rows.filter(~F.trim("trip_status_code").isin("CANCEL"))
    load_rows = loads.filter(
        F.col("trailer_id").isNotNull()
        & ~F.upper(F.trim("trailer_id")).like("%DUMMY%")
        & (F.trim("freight_category_code") == STORE_FREIGHT)
        & ~F.trim(status).isin("CANCEL")
    )
    origin = dc_dim.filter(
        (F.col("country_code") == COUNTRY) & (F.col("current_ind") == "Y") & (F.col("dc_type_desc") == "Regional")
    ).select(F.col("dc_nbr").alias("origin_location_id"), "time_zone_code")
    stores = store_dim.filter(
        (F.col("country_code") == COUNTRY) & ~F.col("state_prov_code").isin(OFFSHORE_STATES)
    ).select(F.col("store_nbr").alias("dest_location_id"))
    rows = (
        xref.select("load_id", "trip_id")
        .join(load_rows, "load_id", "inner")
        .join(trip_rows, "trip_id", "inner")
        .join(origin, "origin_location_id", "inner")
        .join(zones, "time_zone_code", "left")
        .join(stores, "dest_location_id", "inner")
        .drop("time_zone_code")
    )
    if drop_past_placeholders:
        rows = rows.filter((projected >= day(now)) | rules.real_trailer(F.col("trailer_id")))
    return rows


def legacy_loads(
    xref: DataFrame, loads: DataFrame, trips: DataFrame, history: DataFrame, dc_dim: DataFrame,
    store_dim: DataFrame, zones: DataFrame, now: dt.datetime,
) -> DataFrame:
    """Distinct load list of the legacy system in local time, with ready-time candidates."""
    rows = store_loads(
        xref, loads, trips, dc_dim, store_dim, zones, now,
        status="load_status", active_trips_only=True, drop_past_placeholders=True,
    )
    versions = assigned_versions(history).select(
        "load_id", "create_ts_utc", F.col("_any.ready_ts_utc").alias("_est_ready"),
        F.col("_real.ready_ts_utc").alias("_first_ready"), F.col("_real.last_change_ts_utc").alias("_first_change"),
    )
    rows = rows.join(versions, ["load_id", "create_ts_utc"], "left")
    zone = F.col("time_zone_name")
    ready = selected_ready(F.col("trailer_id"), F.col("_est_ready"), F.col("ready_ts_utc"), F.col("_first_change"))
    return rows.select(
        "load_id", "trip_id", F.trim("trailer_id").alias("trailer_id"), "origin_location_id", "dest_location_id",
        "load_status", "trip_status_code",
        F.to_date("projected_ts").alias("projected_date"),
        F.hour("projected_ts").cast("long").alias("delivery_slot"),
        to_local(F.col("_est_ready"), zone).alias("est_ready_ts"),
        to_local(F.col("_first_ready"), zone).alias("orig_ready_ts"),
        to_local(F.col("ready_ts_utc"), zone).alias("cur_ready_ts"),
        to_local(F.col("_first_change"), zone).alias("adj_ready_ts"),
        to_local(ready, zone).alias("ready_ts"),
        "projected_ts",
        F.when(F.col("depart_odom_mile") > 0, to_local(F.col("depart_ts_utc"), zone)).alias("depart_ts"),
    ).distinct()


# -- stage 3 ---------------------------------------------------------------------------------


def door_timestamps(operations: DataFrame, store_dim: DataFrame, now: dt.datetime) -> DataFrame:
    """One row per trailer stay with gate and door times, gaps between stays repaired."""
    stores = store_dim.filter((F.col("country_code") == COUNTRY) & (F.col("current_ind") == "Y")).select(
        F.col("store_nbr").cast("string").alias("gate_out_destinations")
    )
    trips = (
        operations.filter(
            (F.col("operation_type") == GATE_OUT)
            & (F.to_date("entity_operation_ts") >= day(now, -LOOKBACK_DAYS))
            & F.trim(F.upper("carrier_id")).isin(FLEET_CARRIERS)
        )
        .join(stores, "gate_out_destinations", "left_semi")
        .select("trip_id", "gate_out_destinations")
        .distinct()
    )
    events = operations.select("dc_number", "trip_id", "trailer_id", "operation_type", "entity_operation_ts").join(
        trips, "trip_id", "inner"
    ).select(
        F.col("dc_number").cast("long").alias("dc_nbr"),
        F.col("gate_out_destinations").try_cast("long").alias("store_nbr"),
        "trip_id", "trailer_id", "operation_type", "entity_operation_ts",
    )
    keys = ["dc_nbr", "store_nbr", "trip_id", "trailer_id"]
    stays = milestone_pivot(
        events, keys, "operation_type", "entity_operation_ts",
        {
            "door_open_count": ("count_distinct", [DOOR_OPEN]),
            "gate_in_ts": ("min", [GATE_IN, DOOR_OPEN]),
            "first_trailer_door_open_ts": ("min", [DOOR_OPEN]),
            "last_trailer_door_close_ts": ("max", [DOOR_CLOSE]),
            "gate_out_ts": ("max", [GATE_OUT, DOOR_CLOSE]),
        },
    )
    # Pivoted rows are already unique per key: a further group-by would change nothing.
    return repair_gaps(
        staged(stays), ["dc_nbr", "trailer_id"], "gate_in_ts", "gate_out_ts",
        "first_trailer_door_open_ts", "last_trailer_door_close_ts", tie=["trip_id", "store_nbr"],
    )


# -- stage 4 ---------------------------------------------------------------------------------


def stop_times(status_stops: DataFrame, code: str, place: str, location: str, out: str) -> DataFrame:
    """Earliest status time per (load, location) for one status code and location type."""
    return (
        status_stops.filter((F.trim("ship_status_code") == code) & (F.trim("location_type_code") == place))
        .groupBy(F.expr("try_cast(load_id AS BIGINT)").alias("load_id"), F.col("location_id").alias(location))
        .agg(F.min("status_ts_utc").alias(out))
    )


def load_activity(
    loads: DataFrame, doors: DataFrame, status_stops: DataFrame, consolidated: DataFrame, movements: DataFrame,
    dc_dim: DataFrame, zones: DataFrame, now: dt.datetime,
) -> DataFrame:
    """Loads with their door stay and the best departure and arrival; ambiguous loads dropped."""
    departs = stop_times(status_stops, "AF", "DC", "origin_location_id", "_stop_depart")
    arrives = stop_times(status_stops, "X1", "STORE", "dest_location_id", "_stop_arrive")
    delivered = consolidated.filter(
        ~F.col("load_status").isin("CANCEL")
        & (F.trim("freight_category_code") == STORE_FREIGHT)
        & (F.trim("dest_loc_type_code") == "STORE")
        & (F.col("load_ready_date") > day(now, -INVOICE_DAYS))
    ).select(
        "load_id", F.col("dest_loc_id").alias("dest_location_id"), F.trim("trailer_id").alias("trailer_id"),
        F.col("actual_delivery_ts").cast("timestamp_ntz").alias("_cnsld_arrive"),
    )
    moved = movements.groupBy(
        "trip_id", "load_id", F.trim("trailer_id").alias("trailer_id"), "origin_loc_id", "dest_loc_id"
    ).agg(
        F.max("actual_orig_depart_ts_utc").alias("_move_depart"),
        F.max("actual_dest_arrival_ts_utc").alias("_move_arrive"),
    ).drop("origin_loc_id", "dest_loc_id")
    stays = door_window(
        doors, "gate_in_ts", "gate_out_ts", "first_trailer_door_open_ts", "last_trailer_door_close_ts",
        "_from", "_to",
    ).select(
        F.col("dc_nbr").alias("_dc"), F.col("trailer_id").alias("_trailer"), "_from", "_to", "door_open_count",
        "first_trailer_door_open_ts", "last_trailer_door_close_ts", "gate_out_ts",
    )
    # stays last at most 5 days, so each load looks at the stays of its own time bucket only
    rows = interval_join(
        loads, stays, [("origin_location_id", "_dc"), ("trailer_id", "_trailer")], "ready_ts", "_from", "_to",
        bucket_hours=120,
    )
    # joins by load come last and next to each other: the distinct below needs no further shuffle
    rows = (
        with_zone(rows, "origin_location_id", dc_dim, "dc_nbr", zones)
        .join(departs, ["load_id", "origin_location_id"], "left")
        .join(arrives, ["load_id", "dest_location_id"], "left")
        .join(delivered, ["load_id", "dest_location_id", "trailer_id"], "left")
        .join(moved, ["load_id", "trip_id", "trailer_id"], "left")
    )
    zone = F.col("time_zone_name")
    begin = F.coalesce(to_local(F.col("_stop_depart"), zone), to_local(F.col("_move_depart"), zone), F.col("depart_ts"))
    finish = F.coalesce(to_local(F.col("_stop_arrive"), zone), F.col("_cnsld_arrive"), to_local(F.col("_move_arrive"), zone))
    # source labels follow the recorded times, also where the zone is unknown
    _, begin_src = by_priority(
        [("load_status_stop", F.col("_stop_depart")), ("trip_movement", F.col("_move_depart")),
         ("trip_table", F.col("depart_ts"))], "_", "begin_trip_src",
    )
    _, end_src = by_priority(
        [("load_status_stop", F.col("_stop_arrive")), ("load_consolidated", F.col("_cnsld_arrive")),
         ("trip_movement", F.col("_move_arrive"))], "_", "end_trip_src",
    )
    final = rows.select(
        "load_id", "trip_id", "trailer_id",
        F.col("origin_location_id").alias("orig_loc_id"), F.col("dest_location_id").alias("dest_loc_id"),
        "load_status", "trip_status_code", "projected_date", "delivery_slot", "orig_ready_ts",
        rules.corrected_ready(
            F.col("ready_ts"), F.col("adj_ready_ts"), F.col("last_trailer_door_close_ts")
        ).alias("ready_ts"),
        "projected_ts", "door_open_count", "first_trailer_door_open_ts", "last_trailer_door_close_ts", "gate_out_ts",
        datetime_trunc(begin, "second").alias("begin_trip_ts"), begin_src,
        datetime_trunc(finish, "second").alias("end_trip_ts"), end_src,
    ).distinct()
    return singleton_only(
        final.withColumn("_day", F.to_date("projected_ts")), ["load_id", "_day"], "load_id"
    ).drop("_day")


# -- stage 5 ---------------------------------------------------------------------------------


def invoice_line_volume(lines: DataFrame, items: DataFrame, pick_classes: DataFrame, now: dt.datetime) -> DataFrame:
    """Whole packs, non-breakpack cases, cube, weight and automated cube per invoice."""
    item = items.withColumnRenamed("mds_fam_id", "item_nbr")
    pick = pick_classes.select(F.substring("pick_type_code", 1, 4).alias("label_type_code"), "pack_type")
    rows = (
        lines.filter((F.to_date("invoice_date") >= day(now, -INVOICE_DAYS)) & ~F.col("outs_code").isin(OUTS_CODES))
        .join(item, "item_nbr", "inner")
        .join(pick, "label_type_code", "left")
    )
    qty, label = F.col("tot_whpk_ship_qty"), F.col("label_type_code")
    girth = F.col("whpk_length_qty") + F.col("whpk_width_qty") + F.col("whpk_height_qty")
    cube = pack_volume(qty, F.col("whpk_cube_qty"), F.col("whpk_qty"), F.col("vnpk_qty"), F.col("vnpk_cube_qty"))
    weight = pack_volume(qty, F.col("whpk_weight_qty"), F.col("whpk_qty"), F.col("vnpk_qty"), F.col("vnpk_weight_qty"))
    automated = F.substring(F.trim(label), 1, 3) == "AUT"
    return rows.groupBy("invoice_nbr", "invoice_date").agg(
        F.sum(qty).alias("tot_whpk_ship_qty"),
        F.sum(non_breakpack_cases(qty, F.col("pack_type"), label, girth)).alias("non_brpk_case_qty"),
        F.sum(cube).alias("cube_qty"),
        F.sum(weight).alias("weight_qty"),
        F.sum(F.when(automated, cube).otherwise(F.lit(0.0))).alias("auto_cube_qty"),
    )


def invoice_volume(headers: DataFrame, line_volume: DataFrame) -> DataFrame:
    """Volume per (load, trip, trailer, lane), dated by its first invoice."""
    return (
        headers.withColumn("trailer_id", F.trim("trailer_id"))
        .join(line_volume, ["invoice_nbr", "invoice_date"], "inner")
        .groupBy("load_id", "trip_id", "trailer_id", "ship_from_dc_nbr", "ship_to_store_nbr")
        .agg(
            F.min("invoice_date").alias("invoice_date"),
            F.sum(F.col("non_brpk_case_qty") + F.coalesce("breakpack_case_cnt", F.lit(0))).alias("case_qty"),
            F.sum("cube_qty").alias("cube_qty"),
            F.sum("weight_qty").alias("weight_qty"),
            F.sum("auto_cube_qty").alias("auto_cube_qty"),
        )
        .withColumn("src", F.lit("INVOICE_LINE"))
    )


def consolidated_loads(modern: DataFrame, legacy: DataFrame) -> DataFrame:
    """Loads of both systems, the modern one winning field by field."""
    return consolidate(
        modern, legacy, ["orig_loc_id", "dest_loc_id", "trailer_id", "projected_date"], LOAD_COLUMNS
    )


def load_quantities(loads: DataFrame, invoices: DataFrame) -> DataFrame:
    """Loads with the volume invoiced on their trailer and lane, by date window or load and trip."""
    base = loads.withColumns(
        {
            "_trailer": F.trim("trailer_id"),
            "_from": F.date_sub(F.to_date("ready_ts"), 1),
            "_to": F.col("projected_date"),
        }
    )
    facts = invoices.select(
        F.trim("trailer_id").alias("_i_trailer"), F.col("ship_from_dc_nbr").alias("_i_from"),
        F.col("ship_to_store_nbr").alias("_i_to"), F.col("load_id").alias("_i_load"),
        F.col("trip_id").alias("_i_trip"), F.to_date("invoice_date").alias("invoice_date"),
        "case_qty", "cube_qty", "weight_qty", "auto_cube_qty",
    )
    matched = date_window_or_ids(
        base, facts, [("_trailer", "_i_trailer"), ("orig_loc_id", "_i_from"), ("dest_loc_id", "_i_to")],
        "invoice_date", "_from", "_to", ids=[("load_id", "_i_load"), ("trip_id", "_i_trip")],
    )
    return matched.groupBy(*LOAD_COLUMNS).agg(
        F.max("invoice_date").alias("invoice_date"),
        # the source dialect rounds when it casts to integer, Spark truncates
        F.sum(F.round("case_qty").cast("long")).alias("tot_case_ship_qty"),
        F.sum("cube_qty").alias("tot_cube_qty"),
        F.sum("weight_qty").alias("tot_weight_qty"),
        F.sum("auto_cube_qty").alias("auto_cube_qty"),
    )


# -- stages 6 and 7 --------------------------------------------------------------------------


def refresh_plan(target: DataFrame, staged: DataFrame, cancelled: DataFrame) -> DataFrame:
    """Plan after merging the staged rows and deleting cancelled loads."""
    merged = merge_upsert(target, staged, PLAN_KEYS, PLAN_UPDATES, [*PLAN_KEYS, *PLAN_UPDATES])
    return delete_matching(merged, cancelled, CANCEL_KEYS)


def refresh_stored_plan(
    spark: SparkSession, path: str, staged: DataFrame, cancelled: DataFrame, now: dt.datetime
) -> DataFrame:
    """The same on a dataset partitioned by run date, of which only touched dates are rewritten."""
    if partitions.exists(spark, path):
        partitions.upsert(spark, path, staged, PLAN_KEYS, PLAN_UPDATES, [*PLAN_KEYS, *PLAN_UPDATES], now)
        partitions.delete_matching(spark, path, cancelled, CANCEL_KEYS, now)
    else:
        partitions.create(delete_matching(staged, cancelled, CANCEL_KEYS), path, "run_date", now)
    return partitions.read(spark, path)


# -- stage 9 ---------------------------------------------------------------------------------


def dashboard_rows(plan: DataFrame) -> DataFrame:
    """Plan rows of the last 60 days with believable volume, utilisation group and status."""
    rows = plan.filter((F.col("date_difference") <= 60) | F.col("date_difference").isNull())
    too_big = F.coalesce(F.col("cube_qty") > rules.CUBE_CEILING, F.lit(False))
    times = ("ready_ts", "projected_ts", "begin_trip_ts", "end_trip_ts")
    return rows.select(
        "run_date", "orig_loc_id", "dest_loc_id", F.col("dest_loc_id").alias("store_nbr"),
        F.to_date("projected_ts").alias("projected_date"), "projected_year_wk_nbr", "refresh_time", "must_ship_flag",
        "load_id", "trip_id", F.trim("trailer_id").alias("trailer_id"),
        *[datetime_trunc(F.col(c), "second").alias(c) for c in times],
        "case_qty",
        F.when(~too_big, F.col("cube_qty")).alias("cube_qty"),
        "weight_qty",
        F.when(~too_big, F.col("trlr_util_pct")).alias("trlr_util_pct"),
        rules.utilisation_group(F.col("cube_qty"), F.col("trlr_util_pct")).alias("trlr_util_pct_grp"),
        "ready_flag", "carry_over_flag", "pull_forward_flag", "over_plan_flag", "trailer_fcst", "daily_plan",
        rules.trailer_status(
            F.col("carry_over_flag"), F.col("over_plan_flag"), F.col("pull_forward_flag"), F.col("end_trip_ts")
        ).alias("trailer_status"),
    )


def current_runs(rows: DataFrame) -> DataFrame:
    """``current_ind``: the row belongs to the latest run of its load, trip and trailer."""
    latest = totals_over(rows, ["load_id", "trip_id", "trailer_id"], {"_last_run": F.max("run_date")})
    flag = F.coalesce(F.col("run_date") == F.col("_last_run"), F.lit(False))
    return latest.withColumn("current_ind", flag).drop("_last_run")


def daily_rollup(rows: DataFrame) -> DataFrame:
    """Distinct trailers and carry-overs per store, day and plan; bounded by the calendar, so windowed."""
    counted = rows.groupBy(
        "store_nbr", "projected_date", "projected_year_wk_nbr",
        F.coalesce("trailer_fcst", F.lit(0)).alias("trailer_fcst"),
        F.coalesce("daily_plan", F.lit(0)).alias("daily_plan"),
    ).agg(
        F.count_distinct("load_id").alias("trailer_count"),
        F.count_distinct(F.when(F.col("carry_over_flag"), F.col("load_id"))).alias("carry_over_count"),
    )
    by_day = Window.partitionBy("store_nbr").orderBy("projected_date", "daily_plan", "trailer_fcst")
    return counted.withColumn("next_day_plan", F.lead("daily_plan", 1).over(by_day))


def weekly_rollup(daily: DataFrame) -> DataFrame:
    return daily.groupBy("store_nbr", "projected_year_wk_nbr").agg(
        F.sum("daily_plan").alias("weekly_plan"),
        F.sum("trailer_fcst").alias("weekly_fcst"),
        F.sum("trailer_count").alias("weekly_actl"),
    )


def weekly_distinct(rows: DataFrame, daily: DataFrame) -> DataFrame:
    """Weekly figures whose actual counts each load once per week rather than once per day."""
    plan = weekly_rollup(daily).drop("weekly_actl")
    actual = rows.groupBy("store_nbr", "projected_year_wk_nbr").agg(F.count_distinct("load_id").alias("weekly_actl"))
    return plan.join(actual, ["store_nbr", "projected_year_wk_nbr"], "left")


def dashboard_base(plan: DataFrame, stores: DataFrame, dc_dim: DataFrame, distinct_weeks: bool = False) -> DataFrame:
    """Dashboard table: plan rows with location names, daily and weekly figures and compliance."""
    rows = dashboard_rows(plan)
    daily = daily_rollup(rows)
    weekly = weekly_distinct(rows, daily) if distinct_weeks else weekly_rollup(daily)
    store = stores.filter((F.col("current_ind") == "Y") & (F.col("country_code") == COUNTRY)).select(
        F.col("store_nbr").alias("dest_loc_id"), F.col("city_name").alias("store_city"),
        F.col("state_prov_code").alias("store_state"), F.col("region_nbr").alias("store_region_nbr"),
        F.col("region_name").alias("store_region_name"),
    )
    dc = dc_dim.select(F.col("dc_nbr").alias("orig_loc_id"), "dc_name", "dc_region_name", "dc_sub_type_desc")
    # the counts run over rows that found their store and DC; a store-day shares one store
    counted = rows.join(dc, "orig_loc_id", "left_semi").select("store_nbr", "projected_date", "load_id", "daily_plan")
    actual = counted.groupBy(F.col("store_nbr").alias("_store"), F.col("projected_date").alias("_day")).agg(
        F.count_distinct("load_id").alias("daily_actl"), F.max("daily_plan").alias("_max_plan")
    )
    joined = (
        current_runs(rows)
        .join(store, "dest_loc_id", "inner")
        .join(dc, "orig_loc_id", "inner")
        .join(
            daily.select("store_nbr", "projected_date", "next_day_plan", "carry_over_count"),
            ["store_nbr", "projected_date"], "left",
        )
        .withColumn("total_carry_overs", F.coalesce("carry_over_count", F.lit(0)))
        .drop("carry_over_count")
    )
    weekly = weekly.withColumnsRenamed({"store_nbr": "_w_store", "projected_year_wk_nbr": "_week"})
    joined = join_groups(joined, weekly, [("store_nbr", "_w_store"), ("projected_year_wk_nbr", "_week")], "left")
    joined = join_groups(
        joined, actual, [("store_nbr", "_store"), ("projected_date", "_day")], "inner", nulls_match=True
    ).drop("_store", "_day", "_w_store", "_week")
    return joined.withColumn(
        "plan_compliance_flag",
        rules.plan_compliance(
            F.col("projected_date"), F.to_date("refresh_time"), F.col("daily_actl"), F.col("_max_plan")
        ),
    ).drop("_max_plan")


def dashboard_summary(rows: DataFrame, daily: DataFrame, now: dt.datetime) -> DataFrame:
    """Condensed dashboard: daily and weekly actuals, compliance up to today, utilisation bucket.

    ``daily`` has a row per store, week and load with plan and forecast; a load counts once a week.
    """
    weekly = daily.groupBy(F.col("store_nbr").alias("_store"), F.col("year_wk_nbr").alias("_week")).agg(
        F.sum("daily_plan").alias("weekly_plan"),
        F.sum("forecast").alias("weekly_forecast"),
        F.count_distinct("load_id").alias("weekly_actual"),
    )
    counted = count_distinct_over(rows, ["store_nbr", "projected_date"], "load_id", "daily_actual")
    joined = join_groups(counted, weekly, [("store_nbr", "_store"), ("year_wk_nbr", "_week")], "left")
    return joined.drop("_store", "_week").withColumns(
        {
            "plan_compliance_flag": rules.plan_compliance(
                F.col("projected_date"), day(now), F.col("daily_actual"), F.col("daily_plan")
            ),
            "utilization_bucket": rules.utilisation_bucket(F.col("cube_qty"), F.col("trlr_util_pct")),
        }
    )


def attribution_levels(summary: DataFrame) -> DataFrame:
    """Category, area and reason of every store-day from the short attribution rules."""
    c = F.col
    return summary.withColumns(
        {
            f"compliance_l{n}": rules.compliance_attribution_simple(
                c("daily_plan"), c("daily_actual"), c("carry_over_count"), c("must_ship_flag"), c("available"), F.lit(n)
            )
            for n in (1, 2, 3)
        }
    )
