"""Load volume from invoice items, compared with the lane's average."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanewright.functions import rules
from lanewright.functions.dates import datetime_diff, day, moment
from lanewright.functions.quantities import utilisation, variable_weight_packs
from lanewright.operators.scans import exact_percentiles

WINDOW_DAYS = 90
MIN_LANE_LOADS = 5


def invoice_items(headers: DataFrame, lines: DataFrame, items: DataFrame, now: dt.datetime) -> DataFrame:
    """Packs, units, cube, weight, cost and retail per invoice."""
    head = headers.filter(F.col("invoice_date") >= day(now, -WINDOW_DAYS))
    line = lines.filter(
        (F.col("invoice_date") >= day(now, -WINDOW_DAYS)) & ~F.col("outs_code").isin("O", "R", "M", "F")
    )
    item = items.filter(F.col("current_ind") == "Y").select(
        F.col("mds_fam_id").alias("item_nbr"), "vnpk_qty", "whpk_cube_qty", "whpk_weight_qty"
    )
    rows = head.join(line, ["invoice_nbr", "invoice_date"], "inner").join(item, "item_nbr", "inner")
    packs = variable_weight_packs(F.col("each_ship_qty"), F.col("variable_wt_qty"), F.col("vnpk_qty"))
    return rows.groupBy(
        "invoice_nbr", "invoice_date", "load_id", F.col("ship_from_dc_nbr").alias("origin_dc"),
        F.col("ship_to_location_nbr").alias("dest_location"),
    ).agg(
        F.sum("whpk_ship_qty").alias("total_whpk_qty"),
        F.sum("each_ship_qty").alias("total_unit_qty"),
        F.sum(packs).alias("total_vnpk_qty"),
        F.sum(F.col("whpk_ship_qty") * F.col("whpk_cube_qty")).alias("total_cube"),
        F.sum(F.col("whpk_ship_qty") * F.col("whpk_weight_qty")).alias("total_weight"),
        F.sum("ext_cost_amt").alias("total_cost"),
        F.sum("ext_retail_amt").alias("total_retail"),
    )


def load_summary(loads: DataFrame, movements: DataFrame, invoices: DataFrame, now: dt.datetime) -> DataFrame:
    """Recent loads with movement times, invoiced volume, utilisation and transit hours."""
    recent = loads.filter(
        ~F.col("load_status_code").isin("CANCEL", "REJECT") & (F.col("ready_ts") >= moment(now, days=-WINDOW_DAYS))
    )
    moved = movements.select("load_id", "trip_id", "actual_depart_ts", "actual_arrival_ts")
    volume = invoices.drop("invoice_nbr", "invoice_date", "origin_dc", "dest_location")
    return (
        recent.join(moved, ["load_id", "trip_id"], "left")
        .join(volume, "load_id", "left")
        .withColumns(
            {
                "trailer_util_pct": utilisation(F.col("total_cube")),
                "transit_hours": datetime_diff(F.col("actual_arrival_ts"), F.col("actual_depart_ts"), "hour"),
            }
        )
    )


def lane_metrics(summary: DataFrame) -> DataFrame:
    """Delivered volume per lane with at least five loads; the median is that of the origin."""
    delivered = summary.filter(F.col("actual_arrival_ts").isNotNull())
    lanes = (
        delivered.groupBy("origin_location_id", "dest_location_id")
        .agg(
            F.count_distinct("load_id").alias("load_count"),
            F.avg("trailer_util_pct").alias("avg_utilization"),
            F.avg("transit_hours").alias("avg_transit_hours"),
            F.sum("total_cube").alias("total_lane_cube"),
            F.sum("total_weight").alias("total_lane_weight"),
        )
        .filter(F.col("load_count") >= MIN_LANE_LOADS)
    )
    # utilisation takes any value, so its median is found in slices of a thousandth
    medians = exact_percentiles(
        delivered, ["origin_location_id"], "trailer_util_pct", {"median_utilization": 0.5},
        chunk=F.floor(F.col("trailer_util_pct") * 1000),
    )
    return lanes.join(medians, "origin_location_id", "left")


def load_performance(summary: DataFrame, calendar: DataFrame, ordered: bool = False) -> DataFrame:
    """Every load beside its lane's figures and fiscal calendar; ``ordered``: latest first."""
    lane = lane_metrics(summary).select(
        "origin_location_id", "dest_location_id", F.col("load_count").alias("lane_load_count"),
        F.col("avg_utilization").alias("lane_avg_utilization"), F.col("avg_transit_hours").alias("lane_avg_transit"),
    )
    fiscal = calendar.select(
        F.col("calendar_date").alias("_day"), "fiscal_year_week_nbr", "fiscal_year_nbr", "fiscal_week_nbr",
        "day_of_week_name",
    )
    rows = (
        summary.join(lane, ["origin_location_id", "dest_location_id"], "left")
        .withColumn(
            "utilization_performance", rules.versus_lane(F.col("trailer_util_pct"), F.col("lane_avg_utilization"))
        )
        .withColumn("_day", F.to_date("ready_ts"))
        .join(fiscal, "_day", "inner")
        .drop("_day")
    )
    return rows.orderBy(F.desc("ready_ts")) if ordered else rows
