"""Jobs over stored tables: staging, refresh, quality row, backup."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from checks import QUERIES
from checks import activity as activity_checks
from checks import supply as supply_checks
from checks import trailer as trailer_checks
from checks.registry import _build
from checks.shared import DC_DIM, EVENTS_NOW, PLAN_NOW, STORE_DIM, ZONES
from lanewright.plans import imports, jobs, planning, workorders
from lanewright.sources import datasets
from tests.helpers import rows

SF_DIR = "/root/testdata/sf0.001"


def tables(spark, **texts):
    known = {}
    for name, text in texts.items():
        known[name] = _build(spark, SF_DIR, text, known)
    return known


def test_carrier_loads_job(spark, tmp_path):
    t = trailer_checks
    found = tables(
        spark, trip_load_xref=t.XREF, loads=t.CARRIER_LOADS, trips=t.TRIPS, dc_dim=DC_DIM, store_dim=STORE_DIM, time_zone_lookup=ZONES,
        plan_data=t.PLAN_DATA, psn_load=t.PSN, invoice_summary=t.INVOICE_SUMMARY,
    )
    found["loads"] = found["loads"].drop("load_status")
    found["cancelled_loads"] = spark.createDataFrame([], "load_id long, origin_location_id long, dest_location_id long")
    first = jobs.run_carrier_loads(found, jobs.Warehouse(spark, str(tmp_path), PLAN_NOW), lineage=True)
    before = first.count()
    assert before > 0
    # a second run finds everything in place: same rows, new refresh time
    later = PLAN_NOW + dt.timedelta(hours=6)
    again = jobs.run_carrier_loads(found, jobs.Warehouse(spark, str(tmp_path), later), lineage=True)
    assert again.count() == before and again.filter(F.col("refresh_ts") != F.lit(later).cast("timestamp_ntz")).count() == 0
    assert datasets.current_version(spark, str(tmp_path / "carrier_load_tracking")) == 2
    gone = again.select("load_id", "origin_location_id", "dest_location_id").limit(5)
    found["cancelled_loads"] = datasets.read_current(spark, datasets.snapshot(gone, str(tmp_path / "cancel"), later))
    fewer = jobs.run_carrier_loads(found, jobs.Warehouse(spark, str(tmp_path), later), lineage=True)
    assert fewer.count() < before


def test_technician_job_publishes_quality_even_on_failure(spark, tmp_path):
    a = activity_checks
    found = tables(
        spark, technician_activity=a.ISP, field_tech_mobile=a.FTM, workorder_ivr=a.CALLS, service_people=a.PEOPLE, service_providers=a.PROVIDERS,
        tech_alignment=a.ALIGNMENT, workorder_change_history=a.CHANGE_LOG, workorders=a.WORKORDERS,
    )
    found["workorder"] = found["workorders"]
    warehouse = jobs.Warehouse(spark, str(tmp_path), EVENTS_NOW)
    built = jobs.run_technician_activity(found, warehouse, "project", "dataset")
    stats = spark.read.parquet(warehouse.path("table_qa"))
    row = stats.first()
    assert row.record_cnt == built.filter("activity_id IS NOT NULL").count() and row.last_update_dt == EVENTS_NOW
    broken = dict(found, workorder_ivr=found["workorder_ivr"].drop("ivr_id"))
    with pytest.raises(Exception, match="ivr_id"):
        jobs.run_technician_activity(broken, jobs.Warehouse(spark, str(tmp_path), EVENTS_NOW + dt.timedelta(days=1)), "project", "dataset")
    assert spark.read.parquet(warehouse.path("table_qa")).count() == 2


def test_trailer_plan_job(spark, tmp_path):
    t = trailer_checks
    texts = dict(
        trip_load_xref=t.XREF, loads=t.LOADS, trips=t.TRIPS, load_update_history=t.HISTORY, dc_dim=DC_DIM, store_dim=STORE_DIM, time_zone_lookup=ZONES,
        trailer_operations=t.OPERATIONS, load_status_stop=t.STOPS, sc_load_consolidated=t.CONSOLIDATED, trip_movement=t.MOVEMENTS,
        invoice_line=t.LINES, item_current_adj=t.ITEMS, pick_code_class=t.PICKS, invoice_header=t.HEADERS, delivery_forecast_adjusted=t.FORECAST,
        calendar_dim=t.EVENT_CALENDAR.spark, trailer_plan_staged=t.PLAN, store_dim_cur=t.STORES,
    )
    found = tables(spark, **texts)
    found["loads"] = found["loads"].drop("load_status_code")
    found["dc_dim"] = found["dc_dim"].unionByName(
        found["dc_dim"].filter("dc_nbr = 0").withColumns({"dc_nbr": F.lit(-1).cast("long"), "current_ind": F.lit("N")}))
    found["trailer_plan_modern_tms"] = spark.createDataFrame(
        [], "load_id long, trip_id long, trailer_id string, orig_loc_id long, dest_loc_id long, load_status string, projected_date date, delivery_slot long, "
        "ready_ts timestamp_ntz, projected_ts timestamp_ntz, door_open_count long, first_trailer_door_open_ts timestamp_ntz, "
        "last_trailer_door_close_ts timestamp_ntz, begin_trip_ts timestamp_ntz, end_trip_ts timestamp_ntz")
    # one plan row per load and run date
    staged = found["trailer_plan_staged"].dropDuplicates(["load_id", "run_date"]).withColumns(
        {"delivery_slot": F.lit(6).cast("long"), "load_status": F.lit("OPEN"), "capped_flag": F.lit(False)})
    found["trailer_plan_staged"] = staged
    found["cancelled_loads"] = staged.filter("load_id < 10").select("load_id", "orig_loc_id", "dest_loc_id")
    warehouse = jobs.Warehouse(spark, str(tmp_path), PLAN_NOW)
    dashboard = jobs.run_trailer_plan(found, warehouse)
    plan = warehouse.read("trailer_plan")
    assert plan.count() == staged.filter("load_id >= 10").count()
    assert 0 < dashboard.count() and "plan_compliance_flag" in dashboard.columns
    for name in ("delivery_forecast_current", "trailer_plan_activity", "trailer_plan_quantities"):
        assert warehouse.read(name).count() > 0
    found["trailer_plan_staged"] = staged.withColumn("load_status", F.lit("DONE"))
    jobs.run_trailer_plan(found, jobs.Warehouse(spark, str(tmp_path), PLAN_NOW + dt.timedelta(days=1)))
    assert [r[0] for r in warehouse.read("trailer_plan").select("load_status").distinct().collect()] == ["DONE"]


def test_backup(spark, tmp_path):
    path = jobs.backup_core_data(jobs.Warehouse(spark, str(tmp_path), dt.datetime(2024, 1, 31, 5)), spark.range(3))
    assert path.endswith("core_data_20240130") and datasets.read_current(spark, path).count() == 3


def inputs(spark, name):
    """The input tables of a registered query."""
    run = QUERIES[name]
    texts = dict(zip(run.__code__.co_freevars, run.__closure__))["inputs"].cell_contents
    known = {}
    for key, source in texts.items():
        known[key] = _build(spark, SF_DIR, source.spark if hasattr(source, "spark") else source, known)
    return known


def same(a, b):
    assert a.columns == b.columns and a.count() == b.count()
    assert a.exceptAll(b).isEmpty()


def test_lead_time_job(spark, tmp_path):
    t = inputs(spark, "yoy_trend")
    got = jobs.run_lead_times(t, jobs.Warehouse(spark, str(tmp_path), supply_checks.LEAD_NOW))
    same(got, imports.lead_time_trends(imports.lane_metrics(imports.shipment_milestones(t["shipments"], supply_checks.LEAD_NOW))))
    assert got.count() > 0


def test_productivity_and_alignment_jobs(spark, tmp_path):
    t, warehouse = inputs(spark, "productivity"), jobs.Warehouse(spark, str(tmp_path), EVENTS_NOW)
    got = jobs.run_productivity(t, warehouse)
    assert got.count() > 0 and got.count() == sum(warehouse.read(f"productivity_{n}").count() for n in ("internal", "visits", "calls"))
    same(got, QUERIES["productivity"](spark, SF_DIR).select(*got.columns))
    wide = inputs(spark, "alignment")["wide"]
    same(jobs.run_alignment({"locations": wide}, warehouse), QUERIES["alignment"](spark, SF_DIR))


def test_import_job(spark, tmp_path):
    t = inputs(spark, "allocate_received")
    t["order_lines"] = t["order_lines"].withColumn("vnpk_ord_qty", F.col("vnpk_ord_qty").cast("double"))
    t |= {"purchase_orders": t["pos"], "sub_orders": t["subs"], "items": inputs(spark, "import_inbound")["items"],
          "shipments": inputs(spark, "window_over_agg")["shipments"], "containers": inputs(spark, "milestone_ladder")["containers"]}
    warehouse = jobs.Warehouse(spark, str(tmp_path), supply_checks.IMPORT_NOW)
    got = jobs.run_imports(t, warehouse)
    received = imports.received_by_date(t["receiver_lines"], t["receivers"])
    receipts = imports.booking_receipts(t["order_lines"], t["pos"], t["subs"], received)
    assert warehouse.read("import_receipts").count() == receipts.count() > 0
    assert got.count() == imports.import_inbound(imports.facility_volume(receipts), t["items"], supply_checks.IMPORT_NOW).count()
    assert warehouse.read("import_shipment_lines").count() > 0 and warehouse.has("container_tracking")


def test_planning_job(spark, tmp_path):
    t, out, now = inputs(spark, "received_window"), inputs(spark, "outbound_union"), supply_checks.PLANNING_NOW
    t |= {"order_positions": supply_checks._doubles(t["base"]), "planning_items": t["items"], "planning_start": t["start"],
          "calendar_dim": t["calendar"], "invoice_header": out["headers"], "invoice_line": out["lines"], "outbound_items": out["items"],
          "orders": out["pos"], "outbound_lanes": out["lanes"]}
    warehouse = jobs.Warehouse(spark, str(tmp_path), now)
    got = jobs.run_planning(t, warehouse)
    assert warehouse.read("received_orders").count() == QUERIES["received_window"](spark, SF_DIR).count() > 0
    assert warehouse.read("receipt_positions").count() > 0 and warehouse.has("open_orders")
    direct = planning.outbound_volume(out["headers"], out["lines"], out["items"], out["pos"], out["lanes"], out["calendar"], now)
    assert got.columns == direct.columns and got.count() == direct.count()


def test_load_item_job(spark, tmp_path):
    t, lane = inputs(spark, "load_items"), inputs(spark, "lane_metrics")
    t |= {"invoice_header": t["headers"], "invoice_line": t["lines"], "loads": lane["loads"], "trip_movement": lane["moves"],
          "fiscal_calendar": lane["calendar"]}
    warehouse = jobs.Warehouse(spark, str(tmp_path), supply_checks.LOAD_NOW)
    got = jobs.run_load_items(t, warehouse)
    assert warehouse.read("load_item_invoices").count() > 0 and warehouse.read("load_summary").count() > 0
    assert "load_id" in got.columns and warehouse.has("load_lane_metrics")


def test_work_order_job(spark, tmp_path):
    t, age = inputs(spark, "workorder_sla"), inputs(spark, "weekly_percentiles")
    ids = age["workorders"]
    # the ageing orders with the columns that the enrichment wants
    wide = t["workorders"]
    first = {c: F.lit(wide.first()[c]).cast(wide.schema[c].dataType) for c in wide.columns if c not in ids.columns}
    t["workorders"], t["status_history"], t["fiscal_calendar"] = ids.withColumns(first), age["history"], t["calendar"]
    now = dt.datetime(1995, 12, 20)
    warehouse = jobs.Warehouse(spark, str(tmp_path), now)
    got = jobs.run_work_orders(t, warehouse)
    same(got, workorders.weekly_ageing(workorders.ageing(ids, age["history"], now)))
    assert warehouse.has("enriched_workorders") and got.count() > 0


def test_outbound_parts_make_the_whole(spark):
    out, now = inputs(spark, "outbound_union"), supply_checks.PLANNING_NOW
    tables = out["headers"], out["lines"], out["items"], out["pos"], out["lanes"], out["calendar"], now
    parts = planning.storage_shipments(*tables).unionByName(planning.transfer_shipments(*tables))
    keys = planning.OUTBOUND_KEYS + ["total_whpk_ship_qty", "ext_cost_amt"]
    assert rows(parts, *keys) == rows(planning.outbound_volume(*tables), *keys)
