"""Imports: shipment lines, container tracking, inbound receipts, lead times."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanewright.functions import rules
from lanewright.functions.dates import day
from lanewright.functions.nulls import safe_ratio
from lanewright.functions.quantities import allocate
from lanewright.operators.calendar import rolling_mean, year_over_year
from lanewright.operators.scans import join_groups, totals_over

# Import facilities, order states, look-back periods and minimum sample.
IMPORT_SITES = rules.STORAGE_SITES + rules.FLOW_SITES
PO_STATES = [800, 1200, 1400, 1500]
LINE_STATES = [700, 1000, 1100, 1200]
TRACKING_DAYS = 180
RECEIPT_WEEKS = 65
LEAD_TIME_DAYS = 365 * 3
MIN_SHIPMENTS = 10

SHIPMENT_KEYS = [
    "booking_po_nbr", "distribution_po_nbr", "order_date", "po_type_code", "event_code", "event_desc", "item_nbr",
    "dept_nbr", "channel_method_desc", "planned_dest_location_nbr", "planned_dest_location_type",
    "actual_dest_location_nbr", "actual_dest_location_type", "cancel_date", "orig_port_arrival_date",
    "port_arrival_date", "eta_date", "actual_arrival_date", "po_mabd", "in_store_date", "po_close_date",
]
MILESTONES = [
    "empty_pickup_ts", "gate_in_origin_ts", "vessel_departure_ts", "transship_arrival_ts", "transship_departure_ts",
    "vessel_arrival_ts", "customs_release_ts", "available_for_pickup_ts", "gate_out_port_ts", "facility_arrival_ts",
    "empty_return_ts",
]
# Container state by latest milestone reached.
CONTAINER_STATES = [
    ("empty_return_ts", "COMPLETED"), ("facility_arrival_ts", "AT_FACILITY"), ("gate_out_port_ts", "IN_DRAYAGE"),
    ("customs_release_ts", "AWAITING_PICKUP"), ("vessel_arrival_ts", "AT_PORT"),
    ("vessel_departure_ts", "IN_TRANSIT"),
]
LANE = ["origin_country_code", "origin_port_code", "dest_port_code", "dest_facility_nbr"]
LANE_MONTH = [*LANE, "ship_year", "ship_month"]


def shipment_lines(shipments: DataFrame, now: dt.datetime) -> DataFrame:
    """Shipment lines rolled up, each beside the quantity of its whole booking and item."""
    rows = shipments.filter(F.col("actual_dest_location_nbr").isin(IMPORT_SITES) & (F.col("order_qty") > 0))
    lines = rows.groupBy(*SHIPMENT_KEYS).agg(
        F.min("actual_ship_date").alias("ship_date_actual"),
        F.min("est_idc_receipt_date").alias("idc_date_expected"),
        F.min("est_rdc_receipt_date").alias("rdc_date_expected"),
        F.min("est_in_store_date").alias("store_date_expected"),
        F.sum("order_qty").alias("vnpk_ord_qty"),
    )
    booking = rows.groupBy(F.col("booking_po_nbr").alias("_b"), F.col("item_nbr").alias("_i")).agg(
        F.sum("order_qty").alias("total_vnpk_ord_qty")
    )
    lines = join_groups(lines, booking, [("booking_po_nbr", "_b"), ("item_nbr", "_i")], "inner", nulls_match=True)
    c = F.col
    return lines.select(
        *SHIPMENT_KEYS[:13],
        c("cancel_date").alias("ship_date_planned"), c("cancel_date").alias("ship_date_expected"),
        "ship_date_actual", "orig_port_arrival_date", c("port_arrival_date").alias("port_date_planned"),
        F.coalesce(c("eta_date"), c("port_arrival_date")).alias("port_date_expected"),
        F.when(c("actual_arrival_date") < day(now), c("actual_arrival_date")).alias("port_date_actual"),
        "idc_date_expected", c("po_mabd").alias("rdc_date_planned"), "rdc_date_expected",
        c("in_store_date").alias("store_date_planned"), "store_date_expected",
        c("po_close_date").alias("close_date"), "total_vnpk_ord_qty", "vnpk_ord_qty",
    )


def container_tracking(containers: DataFrame, now: dt.datetime, ordered: bool = False) -> DataFrame:
    """Recent containers with milestone durations and the latest milestone's state; ``ordered``: latest first."""
    recent = containers.filter(
        (F.col("vessel_departure_ts") >= day(now, -TRACKING_DAYS)) & F.col("container_id").isNotNull()
    )
    c = F.col
    rows = recent.select(
        "container_id", "booking_po_nbr", "vessel_name", "voyage_nbr", "origin_port_code", "origin_port_name",
        "dest_port_code", "dest_port_name", "container_size_code", "container_type_code", *MILESTONES,
        F.datediff("vessel_arrival_ts", "vessel_departure_ts").alias("ocean_transit_days"),
        F.datediff("gate_out_port_ts", "vessel_arrival_ts").alias("port_dwell_days"),
        F.datediff("facility_arrival_ts", "gate_out_port_ts").alias("drayage_days"),
        rules.milestone_status([(c(ts), state) for ts, state in CONTAINER_STATES], "PENDING").alias("container_status"),
        "teu_count", "total_cartons", "total_units", "total_cube_ft", "total_weight_lbs",
    )
    return rows.orderBy(F.desc("vessel_departure_ts")) if ordered else rows


def received_by_date(receiver_lines: DataFrame, receivers: DataFrame) -> DataFrame:
    """Received packs per order line and date, beside the line's total."""
    headers = receivers.select("oms_po_nbr", "receiver_nbr", "received_date")
    daily = (
        receiver_lines.filter(F.col("vnpk_rcv_qty") > 0)
        .join(headers, ["oms_po_nbr", "receiver_nbr"], "left")
        .groupBy("oms_po_nbr", "po_line_nbr", "received_date")
        .agg(F.sum("vnpk_rcv_qty").alias("vnpk_rcv_qty"))
    )
    return totals_over(daily, ["oms_po_nbr", "po_line_nbr"], {"tot_vnpk_rcv_qty": F.sum("vnpk_rcv_qty")})


def booking_receipts(
    order_lines: DataFrame, orders: DataFrame, sub_orders: DataFrame, received: DataFrame
) -> DataFrame:
    """Order lines split over their receipt dates in proportion to what arrived on each."""
    lines = order_lines.filter(F.col("po_line_status_cd").isin(LINE_STATES) & (F.col("vnpk_ord_qty") > 0))
    live = orders.filter(F.col("po_status_cd").isin(PO_STATES)).select("oms_po_nbr")
    rows = (
        lines.join(live, "oms_po_nbr", "inner")
        .join(sub_orders.select("oms_po_nbr"), "oms_po_nbr", "inner")
        .join(received, ["oms_po_nbr", "po_line_nbr"], "left")
        .filter((F.col("received_date") > F.col("order_date")) | F.col("received_date").isNull())
    )
    return rows.select(
        "oms_po_nbr", "distribution_po_nbr", "booking_po_nbr", "po_line_nbr", "order_date", "po_type_code",
        "event_abbr", "item_nbr", "mds_fam_id", "order_dept_nbr", "dc_nbr", "mabd_date", "received_date",
        allocate(F.col("vnpk_ord_qty"), F.col("vnpk_rcv_qty"), F.col("tot_vnpk_rcv_qty")).alias("vnpk_ord_qty"),
        F.coalesce("vnpk_rcv_qty", F.lit(0.0)).alias("vnpk_rcv_qty"),
    )


def facility_volume(receipts: DataFrame) -> DataFrame:
    """Receipts of the import facilities with channel and planned dates."""
    mabd = F.col("mabd_date")
    return receipts.filter(F.col("dc_nbr").isin(IMPORT_SITES)).select(
        "booking_po_nbr", "distribution_po_nbr", "order_date", "po_type_code", "event_abbr", "item_nbr", "mds_fam_id",
        "order_dept_nbr", "dc_nbr", rules.channel_method(F.col("dc_nbr")).alias("channel_method_desc"),
        F.date_sub(mabd, 5).alias("idc_date_planned"), mabd.alias("rdc_date_planned"),
        F.date_add(mabd, 2).alias("store_date_planned"), F.col("received_date").alias("idc_date_actual"),
        "vnpk_ord_qty", "vnpk_rcv_qty",
    )


def import_inbound(volume: DataFrame, items: DataFrame, now: dt.datetime) -> DataFrame:
    """Received import volume of the last 65 weeks in units, cube and retail."""
    item = items.filter(
        (F.col("country_code") == "US") & (F.col("current_ind") == "Y") & ~F.col("dept_nbr").isin(rules.SERVICE_DEPTS)
    ).select(
        "item_nbr", "acctg_dept_nbr", "dept_category_nbr", "vnpk_qty", "vnpk_cube_qty", "vnpk_weight_qty",
        "base_unit_retail_amt",
    )
    recent = volume.filter(F.col("idc_date_actual") >= day(now, -RECEIPT_WEEKS * 7))
    out = recent.join(item, "item_nbr", "inner")
    extended = {}
    for kind in ("ord", "rcv"):
        packs = F.col(f"vnpk_{kind}_qty")
        units = packs * F.col("vnpk_qty")
        extended[f"unit_{kind}_qty"] = units
        extended[f"cube_{kind}_qty"] = packs * F.col("vnpk_cube_qty")
        extended[f"retail_{kind}_qty"] = units * F.col("base_unit_retail_amt")
    return out.withColumns(extended)


def shipment_milestones(shipments: DataFrame, now: dt.datetime) -> DataFrame:
    """Shipments of three years with the days spent in each leg."""
    rows = shipments.filter(
        (F.col("ship_date") >= day(now, -LEAD_TIME_DAYS))
        & F.col("available_date").isNotNull()
        & F.col("order_date").isNotNull()
    )
    return rows.select(
        "booking_po_nbr", "item_nbr", *LANE, "order_date", "ship_date", "port_arrival_date", "customs_clear_date",
        "facility_arrival_date", "available_date",
        F.datediff("ship_date", "order_date").alias("order_to_ship_days"),
        F.datediff("port_arrival_date", "ship_date").alias("ocean_transit_days"),
        F.datediff("customs_clear_date", "port_arrival_date").alias("port_dwell_days"),
        F.datediff("facility_arrival_date", "customs_clear_date").alias("inland_transit_days"),
        F.datediff("available_date", "order_date").alias("total_lead_time_days"),
        F.year("ship_date").alias("ship_year"), F.month("ship_date").alias("ship_month"),
        F.weekofyear("ship_date").alias("ship_week"),
    )


def lane_metrics(milestones: DataFrame) -> DataFrame:
    """Lead-time statistics per trade lane and month with at least ten shipments.

    Shipments are first counted per distinct lead time, so percentiles and deviation
    work on one row per lane, month and number of days.
    """
    legs = {
        "avg_order_to_ship": "order_to_ship_days", "avg_ocean_transit": "ocean_transit_days",
        "avg_port_dwell": "port_dwell_days", "avg_inland_transit": "inland_transit_days",
    }
    per_length = milestones.groupBy(*LANE_MONTH, "total_lead_time_days").agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.sum(c).alias(f"_s_{n}") for n, c in legs.items()],
        *[F.count(c).alias(f"_c_{n}") for n, c in legs.items()],
    )
    days, n = F.col("total_lead_time_days"), F.col("_n")
    exact = "decimal(38,0)"
    # n * sum(x^2) - sum(x)^2 in whole numbers: no rounding before the root
    spread = F.sum("_n").cast(exact) * F.sum(days * days * n).cast(exact) - F.sum(days * n).cast(exact) * F.sum(
        days * n
    ).cast(exact)
    points = {"p50_lead_time": 0.50, "p75_lead_time": 0.75, "p90_lead_time": 0.90, "p95_lead_time": 0.95}
    stats = per_length.groupBy(*LANE_MONTH).agg(
        F.sum("_n").alias("shipment_count"),
        (F.sum(days * n) / F.sum("_n")).alias("avg_lead_time"),
        F.min(days).alias("min_lead_time"),
        F.max(days).alias("max_lead_time"),
        F.percentile(days, F.array(*[F.lit(p) for p in points.values()]), n).alias("_p"),
        *[safe_ratio(F.sum(f"_s_{k}"), F.sum(f"_c_{k}")).alias(k) for k in legs],
        (F.sqrt(spread.cast("double")) / F.sum("_n")).alias("stddev_lead_time"),
    )
    return stats.filter(F.col("shipment_count") >= MIN_SHIPMENTS).select(
        *LANE_MONTH, "shipment_count", "avg_lead_time", "min_lead_time", "max_lead_time",
        *[F.col("_p")[i].alias(k) for i, k in enumerate(points)], *legs, "stddev_lead_time",
    )


def lead_time_trends(metrics: DataFrame, calendar_aware: bool = False, ordered: bool = False) -> DataFrame:
    """Lane months beside last year's, with rolling mean, trend and grade (one row per lane and month).

    ``ordered`` sorts by country and facility, latest month first.
    """
    rows = year_over_year(
        metrics, LANE, "ship_year", "ship_month",
        {"avg_lead_time_ly": "avg_lead_time", "p90_lead_time_ly": "p90_lead_time"}, calendar_aware,
    )
    rows = rolling_mean(rows, "avg_lead_time", LANE, ["ship_year", "ship_month"], 3, "rolling_3mo_avg")
    value, last_year = F.col("avg_lead_time"), F.col("avg_lead_time_ly")
    rows = rows.withColumns(
        {
            "avg_lead_time_yoy_change": value - last_year,
            "avg_lead_time_yoy_pct": F.round(safe_ratio(value - last_year, last_year) * 100, 1),
            "lead_time_trend": rules.lead_time_trend(value, last_year),
            "lane_performance": rules.lane_performance(F.col("p90_lead_time")),
        }
    )
    if not ordered:
        return rows
    return rows.orderBy("origin_country_code", "dest_facility_nbr", F.desc("ship_year"), F.desc("ship_month"))
