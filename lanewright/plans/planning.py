"""Integrated planning: open and received purchase orders, outbound shipments."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanewright.functions import rules
from lanewright.functions.dates import day
from lanewright.functions.nulls import safe_ratio
from lanewright.functions.quantities import (
    extend_quantity, round_up_packs, variable_weight_units, vendor_key,
)
from lanewright.operators.joins import interval_join
from lanewright.operators.scans import totals_over

# Look-back periods and the transfer order type.
FIRST_DATE_DAYS = 21
OPEN_DAYS = 30
LINE_DAYS = 21
TRANSFER_TYPE = 23
TRANSFER_DAYS = 210
LABEL_DAYS = 180

OPEN_COLUMNS = {
    "part_no": "part_no", "po_nbr": "po_no", "po_type": "po_type", "channel_mthd_cd": "channel_mthd_cd",
    "channel_mthd_desc": "channel_mthd_desc", "event_code": "event_code", "event_code_desc": "event_code_desc",
    "order_date": "order_date", "ship_date": "ship_date", "idc_date_actual": "receipt_date",
    "port_date_planned": "latest_port_date", "idc_date_planned": "est_dest_arrival_date",
    "from_location_no": "from_location_no", "from_location_type": "from_location_type", "vendor_name": "vendor_name",
    "to_location_no_actual": "to_location_no", "to_location_type_actual": "to_location_type", "item_nbr": "item_no",
    "mds_fam_id": "legacy_item_no", "acctg_dept_nbr": "acct_dept", "order_dept_nbr": "order_dept",
}
RECEIVED_COLUMNS = {
    "part_no": "part_no", "po_nbr": "po_no", "po_type": "po_type", "channel_mthd_cd": "channel_mthd_cd",
    "channel_mthd_desc": "channel_mthd_desc", "event_code": "event_code", "event_code_desc": "event_code_desc",
    "order_date": "order_date", "ship_date": "ship_date", "store_date_planned": "in_store_date",
    "store_date_expected": "est_in_store_date", "close_date": "close_date", "rdc_date_planned": "mabd",
    "orig_port_date": "orig_port_date", "port_date_planned": "port_date", "port_date_expected": "eta_date",
    "port_date_actual": "arrival_date", "idc_date_planned": "idc_date", "from_location_no": "from_location_no",
    "vendor_name": "vendor_name", "to_location_no_actual": "to_location_no",
    "to_location_no_planned": "to_location_no_planned", "item_nbr": "item_no", "mds_fam_id": "legacy_item_no",
    "acctg_dept_nbr": "acct_dept", "order_dept_nbr": "order_dept", "dept_category_nbr": "dept_catg_nbr",
    "from_location_type": "from_location_type", "idc_date_actual_new": "receipt_date",
}


def planning_items(items: DataFrame) -> DataFrame:
    """Current domestic merchandise (service departments left out)."""
    return items.filter(is_planned())


def is_planned() -> Column:
    return (F.col("country_code") == "US") & (F.col("current_ind") == "Y") & ~F.col("dept_nbr").isin(rules.SERVICE_DEPTS)


def receipt_positions(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Order lines with item attributes, vendor location, e-commerce flag and extended quantities."""
    item = planning_items(items).select(
        "item_nbr", "mds_fam_id", "acctg_dept_nbr", "dept_category_nbr", "buying_region_code", "conveyable_ind",
        "vendor_nbr", "vendor_dept_nbr", "vendor_seq_nbr", "vendor_name", "vnpk_qty", "vnpk_cube_qty",
        "vnpk_weight_qty", "base_unit_retail_amt",
    )
    c = F.col
    rows = orders.join(item, "item_nbr", "inner")
    extended = [
        column
        for kind in ("ord", "rcv")
        for column in extend_quantity(
            c(f"vnpk_{kind}_qty"), c("vnpk_qty"), c("vnpk_cube_qty"), c("vnpk_weight_qty"),
            c("base_unit_retail_amt"), f"{kind}_qty",
        )
    ]
    return rows.select(
        *orders.columns,
        "mds_fam_id", "acctg_dept_nbr", "dept_category_nbr", "conveyable_ind", "vendor_name",
        rules.ecommerce_indicator(c("buying_region_code"), c("event_code")).alias("ecommerce_ind"),
        vendor_key(c("vendor_nbr"), c("vendor_dept_nbr"), c("vendor_seq_nbr")).alias("from_location_no"),
        F.lit("VENDOR").alias("from_location_type"),
        *extended,
    )


def offset_receipts(positions: DataFrame, lanes: DataFrame, now: dt.datetime, until_yesterday: bool) -> DataFrame:
    """Positions with booking totals, shifted receipt date and filled-in receipts.

    Flagged bookings less than half received move to their first date, other flagged
    ones back by the lane's lead time. Flagged lines without receipts whose first date
    is recent count as received; ``until_yesterday`` also bounds that date from above.
    """
    lane = lanes.select(
        F.col("from_location_nbr").alias("to_location_no_actual"), F.col("to_location_nbr").alias("dc_nbr"),
        F.coalesce("lead_time", F.lit(0)).cast("int").alias("_lead"),
    )
    c = F.col
    rows = positions.join(lane, ["to_location_no_actual", "dc_nbr"], "left").withColumn(
        "_lead", F.coalesce("_lead", F.lit(0))
    )
    rows = rows.withColumn("_shifted", F.date_sub("idc_date_actual", c("_lead")))
    rows = totals_over(
        rows, ["bk_po_nbr", "mds_fam_id"],
        {
            "min_idc_date": F.min("_shifted"),
            "tot_vnpk_ord_qty": F.sum("vnpk_ord_qty"),
            "tot_vnpk_rcv_qty": F.sum("vnpk_rcv_qty"),
        },
    )
    rows = rows.withColumn(
        "new_receipt_flag",
        rules.receipt_offset_flag(
            c("ecommerce_ind"), c("to_location_no_actual"), c("po_type"), c("channel_mthd_desc")
        ),
    )
    flagged = c("new_receipt_flag") == "Y"
    first_date = F.coalesce(c("min_idc_date"), c("idc_date_planned"))
    recent = first_date >= day(now, -FIRST_DATE_DAYS)
    under_half = safe_ratio(c("tot_vnpk_rcv_qty"), c("tot_vnpk_ord_qty")) < 0.5
    in_time = recent & (first_date <= day(now, -1)) if until_yesterday else recent

    def filled(kind: str, tested: str) -> Column:
        missing = flagged & (c(tested) == 0) & in_time
        return F.when(missing, c(f"{kind}_ord_qty")).otherwise(c(f"{kind}_rcv_qty"))

    # open orders test the received units throughout, received orders each quantity itself
    tested = {k: "unit_rcv_qty" if until_yesterday else f"{k}_rcv_qty" for k in ("unit", "vnpk", "retail", "cube")}
    return rows.withColumns(
        {
            "idc_date_actual_new": F.when(flagged & recent & under_half, first_date)
            .when(flagged, c("_shifted"))
            .otherwise(c("idc_date_actual")),
            **{f"{k}_rcv_qty_new": filled(k, t) for k, t in tested.items()},
        }
    ).drop("_lead", "_shifted")


def open_orders(positions: DataFrame, lanes: DataFrame, now: dt.datetime) -> DataFrame:
    """Quantity still to come per order line and its attributes."""
    rows = offset_receipts(positions, lanes, now, until_yesterday=True)
    rows = rows.filter(F.col("idc_date_planned") > day(now, -OPEN_DAYS)).withColumn(
        "ship_date", F.coalesce("ship_date_actual", "ship_date_expected")
    )
    return rows.groupBy(*[F.col(c).alias(n) for c, n in OPEN_COLUMNS.items()]).agg(
        F.sum(F.col("unit_ord_qty") - F.col("unit_rcv_qty_new")).alias("po_units"),
        F.sum(F.col("vnpk_ord_qty") - F.col("vnpk_rcv_qty_new")).alias("po_cases"),
    )


def last_complete_day(calendar: DataFrame, now: dt.datetime) -> DataFrame:
    """One row: last day of the fiscal week that holds the day three days ago."""
    week = calendar.filter(F.col("calendar_date") == day(now, -3)).select("year_wk_nbr")
    return calendar.join(week, "year_wk_nbr", "left_semi").agg(F.max("calendar_date").alias("calendar_date"))


def within_window(rows: DataFrame, date: str, start: DataFrame, calendar: DataFrame, now: dt.datetime) -> DataFrame:
    """Rows dated from the control table's start date to the last complete fiscal week.

    Both bounds are scalar subqueries: Spark runs them once and fails if the control
    table has more than one row.
    """
    lower = start.select("calendar_date").scalar()
    upper = last_complete_day(calendar, now).scalar()
    return rows.filter((F.col(date) >= lower) & (F.col(date) <= upper))


def received_orders(
    positions: DataFrame, lanes: DataFrame, start: DataFrame, calendar: DataFrame, now: dt.datetime,
    adjusted: bool = False,
) -> DataFrame:
    """Received volume in the planning window per order line and shifted receipt date.

    Value and cube are the recorded ones; ``adjusted`` uses the filled-in ones.
    """
    rows = offset_receipts(positions, lanes, now, until_yesterday=False)
    rows = within_window(rows, "idc_date_actual_new", start, calendar, now)
    rows = rows.withColumn("ship_date", F.coalesce("ship_date_actual", "ship_date_expected"))
    suffix = "_new" if adjusted else ""
    out = rows.groupBy(*[F.col(c).alias(n) for c, n in RECEIVED_COLUMNS.items()]).agg(
        F.sum("unit_rcv_qty_new").alias("po_units"),
        F.sum("vnpk_rcv_qty_new").alias("po_vndrpk"),
        F.sum(f"retail_rcv_qty{suffix}").alias("po_dollars"),
        F.sum(f"cube_rcv_qty{suffix}").alias("po_cube"),
    )
    no_date = F.lit(None).cast("date")
    return out.withColumns(
        {
            "event_code": F.trim("event_code"), "invoice_date": no_date, "first_rcpt_date": no_date,
            "last_rcpt_date": no_date, "fiscal_rcpt_date": no_date, "po_rdc_rcpt": F.col("mabd"),
            "est_fiscal_rcpt_date": F.col("idc_date"), "to_location_type": F.lit("DC"),
        }
    )


OUTBOUND_KEYS = [
    "part_no", "ship_week_no", "from_location_no", "to_location_no", "receipt_week_no", "legacy_item_no", "item_no",
    "dept_no", "dept_category_no", "vnpk_qty", "whpk_qty", "whpk_cube_qty", "whpk_cube_uom_code",
]


def _shipped(rows: DataFrame) -> DataFrame:
    """Units, packs, cube and value per outbound key. ``_pack``: the item's own pack size."""
    c = F.col
    each, weight, pack = c("each_ship_qty"), c("variable_wt_qty"), c("_pack")
    cents = each.cast("decimal(18,2)").cast("double")
    packs = F.when(weight > 1, round_up_packs(each, weight)).otherwise(safe_ratio(cents, pack))
    return rows.groupBy(*OUTBOUND_KEYS).agg(
        F.coalesce(F.sum(variable_weight_units(each, weight, pack)), F.lit(0.0)).alias("total_ship_units"),
        F.sum(packs).alias("tot_vnpk_ship_qty"),
        F.sum("tot_whpk_ship_qty").alias("total_whpk_ship_qty"),
        (F.sum("tot_whpk_ship_qty") * c("whpk_cube_qty")).alias("total_cube_qty_in_cf"),
        F.sum(packs * c("_pack_cube")).alias("total_vnpk_cube_qty_in_cf"),
        F.sum("ext_cost_amt").alias("ext_cost_amt"),
        F.sum("ext_retail_amt").alias("ext_retail_amt"),
    )


def _outbound_items(items: DataFrame) -> DataFrame:
    def at_least_one(name: str) -> Column:
        return F.when(F.col(name) == 0, F.lit(1.0)).otherwise(F.col(name)).alias(name)

    return items.select(
        F.col("mds_fam_id").alias("legacy_item_no"), F.col("item_nbr").alias("item_no"),
        F.col("acctg_dept_nbr").alias("dept_no"), F.col("dept_category_nbr").alias("dept_category_no"),
        F.col("vnpk_qty").alias("_pack"), F.col("vnpk_cube_qty").alias("_pack_cube"),
        at_least_one("vnpk_qty"), at_least_one("whpk_qty"), "whpk_cube_qty", "whpk_cube_uom_code", "_planned",
    )


def _invoiced(headers: DataFrame, lines: DataFrame, now: dt.datetime) -> DataFrame:
    """Lines of the last three weeks with their header; the header date equals the line date."""
    period = F.col("invoice_date").between(day(now, -LINE_DAYS), day(now))
    return (
        headers.filter(period)
        .join(lines.filter(period), ["invoice_nbr", "invoice_date"], "inner")
        .withColumnRenamed("item_nbr", "legacy_item_no")
    )


def _labelled_orders(orders: DataFrame) -> DataFrame:
    """Orders with the label dates that may belong to them: 180 days from the order date."""
    return orders.select(
        F.col("po_nbr").alias("_po"), "po_type", "xfer_whse_nbr", F.col("order_date").alias("_ordered"),
        F.date_add("order_date", LABEL_DAYS - 1).alias("_label_until"),
    )


def _ordered_lines(headers: DataFrame, lines: DataFrame, orders: DataFrame, now: dt.datetime, how: str = "left") -> DataFrame:
    """Invoiced lines beside the orders that their labels may belong to."""
    return interval_join(
        _invoiced(headers, lines, now), _labelled_orders(orders), [("po_nbr", "_po")], "label_date", "_ordered", "_label_until",
        how=how, bucket_hours=24 * 60,
    ).drop("_label_until")


def _storage_part() -> Column:
    """Lane, day and place of a line sent by a storage facility; NULL for others."""
    sender = F.col("ship_from_dc_nbr")
    return F.when(
        sender.isin(rules.STORAGE_SITES),
        F.struct(
            F.lit("PART-2").alias("part_no"), sender.alias("lane_from"), F.col("ship_to_store_nbr").alias("lane_to"),
            F.col("invoice_date").alias("day"), rules.rerouted_site(F.col("po_type"), sender).alias("shown"),
        ),
    )


def _is_transfer(now: dt.datetime, ordered: str) -> Column:
    return (
        (F.col("po_type") == TRANSFER_TYPE)
        & F.col(ordered).between(day(now, -TRANSFER_DAYS), day(now))
        & F.col("xfer_whse_nbr").isin(rules.STORAGE_SITES)
    )


def _transfer_part(now: dt.datetime) -> Column:
    """The same of a line whose order is a transfer between warehouses; NULL for others."""
    sender = F.col("xfer_whse_nbr")
    return F.when(
        _is_transfer(now, "_ordered"),
        F.struct(
            F.lit("PART-3").alias("part_no"), sender.alias("lane_from"), F.col("ship_from_dc_nbr").alias("lane_to"),
            F.col("_ordered").alias("day"), sender.alias("shown"),
        ),
    )


def _shipments(rows: DataFrame, parts: Sequence[Column], items: DataFrame, lanes: DataFrame, calendar: DataFrame) -> DataFrame:
    """Totals of the parts that each line belongs to.

    A line is read once for all parts and its items come last, when the lines of no part are gone.
    The storage part knows the planned items only; in the other, item history rows multiply lines.
    """
    kept = ["legacy_item_no", "each_ship_qty", "variable_wt_qty", "tot_whpk_ship_qty", "ext_cost_amt", "ext_retail_amt"]
    each = rows.select(*kept, F.explode(F.array_compact(F.array(*parts))).alias("_part")).select(
        *kept, "_part.part_no", F.col("_part.lane_from").alias("_lane_from"),
        F.col("_part.lane_to").alias("to_location_no"), F.col("_part.day").alias("_sent"), F.col("_part.shown").alias("from_location_no"),
    )
    lane = lanes.select(
        F.col("from_location_nbr").alias("_lane_from"), F.col("to_location_nbr").alias("to_location_no"),
        F.coalesce("lead_time", F.lit(0)).cast("int").alias("_lead"),
    )
    weeks = calendar.select("calendar_date", "year_wk_nbr")
    dated = (
        each.join(lane, ["_lane_from", "to_location_no"], "inner")
        .withColumn("_receipt_day", F.date_add("_sent", F.col("_lead")))
        .join(weeks.select(F.col("calendar_date").alias("_sent"), F.col("year_wk_nbr").alias("ship_week_no")), "_sent", "inner")
        .join(
            weeks.select(F.col("calendar_date").alias("_receipt_day"), F.col("year_wk_nbr").alias("receipt_week_no")),
            "_receipt_day", "inner",
        )
    )
    item = _outbound_items(items.withColumn("_planned", F.coalesce(is_planned(), F.lit(False))))
    return _shipped(dated.join(item, "legacy_item_no", "inner").filter((F.col("part_no") != "PART-2") | F.col("_planned")))


def storage_shipments(
    headers: DataFrame, lines: DataFrame, items: DataFrame, orders: DataFrame, lanes: DataFrame, calendar: DataFrame,
    now: dt.datetime,
) -> DataFrame:
    """Shipments from storage facilities, re-routed order types shown under the flow facility."""
    shipped = headers.filter(F.col("ship_from_dc_nbr").isin(rules.STORAGE_SITES))
    return _shipments(_ordered_lines(shipped, lines, orders, now), [_storage_part()], items, lanes, calendar)


def transfer_shipments(
    headers: DataFrame, lines: DataFrame, items: DataFrame, orders: DataFrame, lanes: DataFrame, calendar: DataFrame,
    now: dt.datetime,
) -> DataFrame:
    """Transfer orders between warehouses, dated by their order; item history rows multiply lines."""
    transfers = orders.filter(_is_transfer(now, "order_date"))
    rows = _ordered_lines(headers, lines, transfers, now, how="inner")
    return _shipments(rows, [_transfer_part(now)], items, lanes, calendar)


def outbound_volume(
    headers: DataFrame, lines: DataFrame, items: DataFrame, orders: DataFrame, lanes: DataFrame, calendar: DataFrame,
    now: dt.datetime, distinct: bool = True,
) -> DataFrame:
    """Storage and transfer shipments as one table; invoiced lines are joined with their orders once for both.

    The branches never share a row (``part_no`` differs) and each is unique by its
    grouping, so ``distinct=False`` gives the same rows without the last shuffle.
    """
    parts = [_storage_part(), _transfer_part(now)]
    both = _shipments(_ordered_lines(headers, lines, orders, now), parts, items, lanes, calendar)
    return both.distinct() if distinct else both
