"""Scheduled jobs: the pipelines run end to end over stored tables.

Every stage is written as a table of the warehouse folder and read back by the next
one, so a stage is computed once, a rerun can start from any of them, and losing an
executor never costs more than the stage in progress. ``tables`` maps the source
table names to DataFrames.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from lanewright.plans import (
    alignment, carrier_loads, imports, load_items, planning, productivity, technician_activity, trailer_plan, workorders,
)
from lanewright.sources import partitions
from lanewright.sources.datasets import (
    append_rows, committed_at, current_version, publish_always, quality_row, read_current, snapshot, write_version,
)

Tables = Mapping[str, DataFrame]


class Warehouse:
    """Folder of versioned tables, all stamped with one run time."""

    def __init__(self, spark: SparkSession, folder: str, now: dt.datetime):
        self.spark, self.folder, self.now = spark, folder.rstrip("/"), now

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def store(self, name: str, df: DataFrame, cluster_by: tuple[str, ...] = ()) -> DataFrame:
        write_version(df, self.path(name), self.now, cluster_by)
        return self.read(name)

    def read(self, name: str) -> DataFrame:
        by_part = partitions.exists(self.spark, self.path(name))
        return (partitions.read if by_part else read_current)(self.spark, self.path(name))

    def has(self, name: str) -> bool:
        return current_version(self.spark, self.path(name)) is not None


def run_trailer_plan(tables: Tables, warehouse: Warehouse) -> DataFrame:
    """Forecast, load staging, plan refresh and dashboard; returns the dashboard table.

    ``trailer_plan_staged`` (the day's plan rows) and ``cancelled_loads`` are inputs.
    """
    t, now, store = tables, warehouse.now, warehouse.store
    store("delivery_forecast_current",
          trailer_plan.forecast_current(t["calendar_dim"], t["delivery_forecast_adjusted"], now),
          ("location_id", "cap_calendar_date"))
    loads = store("trailer_plan_legacy_loads", trailer_plan.legacy_loads(
        t["trip_load_xref"], t["loads"], t["trips"], t["load_update_history"], t["dc_dim"], t["store_dim"],
        t["time_zone_lookup"], now))
    doors = store("trailer_plan_door_timestamps",
                  trailer_plan.door_timestamps(t["trailer_operations"], t["store_dim"], now))
    activity = store("trailer_plan_activity", trailer_plan.load_activity(
        loads, doors, t["load_status_stop"], t["sc_load_consolidated"], t["trip_movement"], t["dc_dim"],
        t["time_zone_lookup"], now))
    both = store("trailer_plan_loads", trailer_plan.consolidated_loads(t["trailer_plan_modern_tms"], activity))
    lines = trailer_plan.invoice_line_volume(t["invoice_line"], t["item_current_adj"], t["pick_code_class"], now)
    invoices = store("trailer_plan_invoices", trailer_plan.invoice_volume(t["invoice_header"], lines))
    store("trailer_plan_quantities", trailer_plan.load_quantities(both, invoices))
    plan = trailer_plan.refresh_stored_plan(warehouse.spark, warehouse.path("trailer_plan"), t["trailer_plan_staged"], t["cancelled_loads"], now)
    return store("trailer_plan_dashboard_base", trailer_plan.dashboard_base(plan, t["store_dim_cur"], t["dc_dim"]))


def run_carrier_loads(tables: Tables, warehouse: Warehouse, lineage: bool = False) -> DataFrame:
    """Load tracking from both systems; with ``lineage`` also the source label and orphan removal."""
    t, now, store = tables, warehouse.now, warehouse.store
    legacy = store("carrier_loads_legacy", carrier_loads.legacy(
        t["trip_load_xref"], t["loads"], t["trips"], t["dc_dim"], t["store_dim"], t["time_zone_lookup"], now))
    modern = store("carrier_loads_modern", carrier_loads.modern(
        t["plan_data"], t["dc_dim"], t["psn_load"], t["store_dim"], t["time_zone_lookup"]))
    combined = store("carrier_loads_combined", carrier_loads.combined(
        modern, legacy, t["invoice_summary"], now, lineage="data_source" if lineage else None))
    return carrier_loads.refresh_stored_tracking(
        warehouse.path("carrier_load_tracking"), combined, t["cancelled_loads"], now, drop_orphans=lineage)


def run_technician_activity(tables: Tables, warehouse: Warehouse, project: str, dataset: str) -> DataFrame:
    """Activity table clustered by tracking number; its quality row, under the names of its
    catalog, is published even if the build fails."""
    t, now, store, name = tables, warehouse.now, warehouse.store, "technician_activity"

    def build() -> DataFrame:
        isp = store("activity_isp", technician_activity.isp_activity(
            t["technician_activity"], t["service_people"], t["tech_alignment"]))
        ftm = store("activity_ftm", technician_activity.ftm_activity(
            t["field_tech_mobile"], t["service_people"], t["service_providers"], now))
        ivr = store("activity_ivr", technician_activity.ivr_activity(t["workorder_ivr"], now))
        held = store("provider_segments", technician_activity.provider_segments(
            t["workorder_change_history"], t["workorder"], t["service_providers"]))
        return store(name, technician_activity.technician_activity(
            isp, ftm, ivr, held, t["tech_alignment"], t["workorders"]), ("tracking_nbr",))

    def publish() -> None:
        if warehouse.has(name):
            written = committed_at(warehouse.spark, warehouse.path(name))
            row = quality_row(warehouse.read(name), "activity_id", project, dataset, name, written, now)
            append_rows(row, warehouse.path("table_qa"))

    return publish_always(build, publish)


def run_imports(tables: Tables, warehouse: Warehouse) -> DataFrame:
    """Shipment lines, containers and receipts of imports; returns the inbound volume."""
    t, now, store = tables, warehouse.now, warehouse.store
    store("import_shipment_lines", imports.shipment_lines(t["shipments"], now))
    store("container_tracking", imports.container_tracking(t["containers"], now))
    received = store("import_received", imports.received_by_date(t["receiver_lines"], t["receivers"]))
    receipts = store("import_receipts", imports.booking_receipts(
        t["order_lines"], t["purchase_orders"], t["sub_orders"], received))
    return store("import_inbound", imports.import_inbound(imports.facility_volume(receipts), t["items"], now))


def run_lead_times(tables: Tables, warehouse: Warehouse) -> DataFrame:
    """Milestones of shipments, lanes' monthly figures and their trends."""
    milestones = warehouse.store("shipment_milestones", imports.shipment_milestones(tables["shipments"], warehouse.now))
    metrics = warehouse.store("lane_lead_times", imports.lane_metrics(milestones))
    return warehouse.store("lead_time_trends", imports.lead_time_trends(metrics))


def run_planning(tables: Tables, warehouse: Warehouse) -> DataFrame:
    """Open and received orders from the receipt positions, and the outbound volume, which is returned."""
    t, now, store = tables, warehouse.now, warehouse.store
    positions = store("receipt_positions", planning.receipt_positions(t["order_positions"], t["planning_items"]))
    store("open_orders", planning.open_orders(positions, t["lanes"], now))
    store("received_orders", planning.received_orders(positions, t["lanes"], t["planning_start"], t["calendar_dim"], now))
    return store("outbound_volume", planning.outbound_volume(
        t["invoice_header"], t["invoice_line"], t["outbound_items"], t["orders"], t["outbound_lanes"], t["calendar_dim"], now))


def run_load_items(tables: Tables, warehouse: Warehouse) -> DataFrame:
    """Items on loads, the loads' summary, their lanes' figures; returns loads beside their lanes."""
    t, now, store = tables, warehouse.now, warehouse.store
    invoices = store("load_item_invoices", load_items.invoice_items(t["invoice_header"], t["invoice_line"], t["items"], now))
    summary = store("load_summary", load_items.load_summary(t["loads"], t["trip_movement"], invoices, now))
    store("load_lane_metrics", load_items.lane_metrics(summary))
    return store("load_performance", load_items.load_performance(summary, t["fiscal_calendar"]))


def run_work_orders(tables: Tables, warehouse: Warehouse) -> DataFrame:
    """Work orders with their dimensions, their age, and the weekly summary, which is returned."""
    t, now, store = tables, warehouse.now, warehouse.store
    store("enriched_workorders", workorders.enriched_workorders(
        t["workorders"], t["locations"], t["assignments"], t["technicians"], t["managers"], t["equipment"], t["vendors"],
        t["fiscal_calendar"], now))
    aged = store("workorder_ageing", workorders.ageing(t["workorders"], t["status_history"], now))
    return store("weekly_ageing", workorders.weekly_ageing(aged))


def run_productivity(tables: Tables, warehouse: Warehouse) -> DataFrame:
    """What technicians did, from three sources, each stored with its running minutes."""
    t, now, store = tables, warehouse.now, warehouse.store
    sources = [
        store("productivity_internal", productivity.internal_activity(t["activity"], t["technicians"], now)),
        store("productivity_visits", productivity.site_visits(t["checkins"], now)),
        store("productivity_calls", productivity.phone_support(t["calls"], now)),
    ]
    return store("technician_productivity", productivity.productivity(sources, t["locations"]), ("tech_id",))


def run_alignment(tables: Tables, warehouse: Warehouse) -> DataFrame:
    """Technicians of every location as rows."""
    return warehouse.store("technician_alignment", alignment.technician_alignment(tables["locations"]), ("location_id",))


def backup_core_data(warehouse: Warehouse, core_data: DataFrame, ttl_days: int = 720) -> str:
    """Dated copy of the core table; returns its path."""
    return snapshot(core_data, warehouse.path("core_data"), warehouse.now, ttl_days)
