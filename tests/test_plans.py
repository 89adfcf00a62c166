"""Pipelines on hand-made rows: the edge cases the large tables do not reach."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lanewright.plans import (
    alignment, carrier_loads, imports, load_items, planning, productivity, technician_activity, trailer_plan, workorders,
)
from tests.helpers import d, frame, rows, ts

NOW = dt.datetime(2024, 3, 15, 12)


def calendar(spark, first="2024-01-01", days=120):
    start = dt.date.fromisoformat(first)
    out = []
    for i in range(days):
        x = start + dt.timedelta(days=i)
        out.append((x, x.year * 100 + int(x.strftime("%U")), x.year, int(x.strftime("%U")), x.strftime("%A")))
    return frame(spark, "calendar_date date, year_wk_nbr long, year_nbr long, week_nbr long, week_day_name string", *out)


def test_forecast(spark):
    schema = "run_datetime timestamp_ntz, location_id long, cap_calendar_date date, delivery_type_code string, daily_cap long"
    run1, run2 = ts("2024-03-01 00:00:00"), ts("2024-03-02 00:00:00")
    facts = frame(
        spark, schema,
        (run1, 1, d("2024-03-04"), None, None), (run1, 1, d("2024-03-05"), "A", 9), (run2, 1, d("2024-03-05"), "B", 4),
        (run1, 1, d("2024-03-06"), None, 0), (run1, 1, d("2024-03-07"), "C", 3), (run1, 1, d("2024-03-13"), None, 6),
        (run1, 2, d("2024-03-04"), "Z", 1),
    )
    got = trailer_plan.forecast_current(calendar(spark), facts, NOW)
    one = rows(got.filter("location_id = 1"), "cap_calendar_date", "daily_plan", "daily_flag", "must_ship_flag", "delivery_type_code")
    assert [(r[0].day, *r[1:]) for r in one] == [
        (4, None, 0, "N", None), (5, 4, 1, "Y", "B"), (6, 0, 0, "N", "B"), (7, 3, 1, "Y", "C"), (8, None, 0, "N", "C"),
        (9, None, 0, "N", "C"), (10, None, 0, "N", "C"), (11, None, 0, "N", "C"), (12, 4, 1, "N", "C"), (13, 6, 1, "N", "C")]
    row = got.filter("location_id = 2").first()
    assert (row.run_datetime, row.del_calendar_date, row.cap_week_day_name) == (run1, d("2024-03-11"), "Monday")
    assert got.filter("location_id = 1 AND cap_calendar_date = DATE '2024-03-08'").first().run_datetime == NOW


ZONES = "time_zone_code string, time_zone_name string"


def dims(spark):
    dc = frame(
        spark, "dc_nbr long, country_code string, current_ind string, time_zone_code string, dc_type_desc string, dc_name string, "
        "dc_region_name string, dc_sub_type_desc string",
        (10, "US", "Y", "C", "Regional", "Ten", "R", "G"), (10, "US", "N", "E", "Regional", "Old", "R", "G"),
        (11, "US", "Y", "E", "Import", "Eleven", "R", "G"), (12, "CA", "Y", "E", "Regional", "Twelve", "R", "G"),
    )
    store = frame(
        spark, "store_nbr long, country_code string, current_ind string, state_prov_code string, time_zone_code string, "
        "city_name string, region_nbr long, region_name string",
        (20, "US", "Y", "TX", "C", "Austin", 1, "South"), (21, "US", "Y", "HI", "H", "Hilo", 2, "West"), (22, "US", "Y", "TX", None, "Waco", 1, "South"),
    )
    return dc, store, frame(spark, ZONES, ("C", "America/Chicago"), ("E", "America/New_York"))


LOADS = ("load_id long, trailer_id string, origin_location_id long, dest_location_id long, load_status string, ready_ts_utc timestamp_ntz, "
         "create_ts_utc timestamp_ntz, freight_category_code string")
TRIPS = ("trip_id long, trip_status_code string, projected_ts timestamp_ntz, depart_odom_mile double, depart_ts_utc timestamp_ntz, "
         "trip_type_code string")
HISTORY = ("load_id long, trailer_id string, create_ts_utc timestamp_ntz, ready_ts_utc timestamp_ntz, last_change_ts_utc timestamp_ntz, "
           "load_status string, freight_category_code string")


def test_legacy_loads(spark):
    dc, store, zones = dims(spark)
    ready, create = ts("2024-03-10 20:00:00"), ts("2024-03-01 00:00:00")
    spec = {  # trailer, origin, destination, status
        1: (" T1 ", 10, 20, "OPEN "), 2: ("P-1", 10, 20, "OPEN"), 3: ("p-9 ", 10, 20, "OPEN"), 4: ("xDummy1", 10, 20, "OPEN"),
        5: (None, 10, 20, "OPEN"), 6: ("T6", 11, 20, "OPEN"), 7: ("T7", 10, 21, "OPEN"), 8: ("T8", 10, 20, "CANCEL"),
        9: ("T9", 10, 20, "OPEN"), 10: ("T10", 10, 20, "OPEN"), 11: ("T11", 12, 20, "OPEN"),
    }
    loads = frame(spark, LOADS, *[(k, t, o, s, st, ready, create, " STR") for k, (t, o, s, st) in spec.items()])
    past, future = ts("2024-03-12 06:30:00"), ts("2024-03-16 06:30:00")
    trips = frame(spark, TRIPS, *[
        (100 + k, "CANCEL " if k == 10 else "OPEN", future if k == 3 else past, 0.0 if k == 9 else 5.0, ts("2024-03-11 00:00:00"), "STORE ")
        for k in spec])
    xref = frame(spark, "load_id long, trip_id long", *[(k, 100 + k) for k in spec])
    history = frame(
        spark, HISTORY,
        (1, "P-0", create, ts("2024-03-10 20:00:02"), ts("2024-03-02 00:00:00"), "OPEN", "STR "),
        (1, "T1", create, ts("2024-03-10 19:00:00"), ts("2024-03-11 01:00:00"), "OPEN", "STR"),
        (9, "T9", create, ts("2024-03-10 20:00:03"), ts("2024-03-11 01:00:00"), "OPEN", "STR"),
        (9, "T9", create, ts("2024-03-10 20:00:00"), ts("2024-03-01 01:00:00"), "CANCEL", "STR"),
    )
    got = trailer_plan.legacy_loads(xref, loads, trips, history, dc, store, zones, NOW)
    assert rows(got, "load_id", "trailer_id", "delivery_slot") == [(1, "T1", 6), (3, "p-9", 6), (9, "T9", 6)]
    by_load = {r.load_id: r for r in got.collect()}
    # created two seconds off and never updated: the first change with a real trailer counts
    assert by_load[1].ready_ts == by_load[1].adj_ready_ts == ts("2024-03-10 20:00:00")
    assert by_load[1].est_ready_ts == ts("2024-03-10 15:00:02") and by_load[1].cur_ready_ts == ts("2024-03-10 15:00:00")
    assert by_load[9].ready_ts == ts("2024-03-10 15:00:00")
    assert by_load[3].ready_ts is None and by_load[3].orig_ready_ts is None
    assert by_load[9].depart_ts is None and by_load[1].depart_ts == ts("2024-03-10 19:00:00")


def test_unknown_first_change_leaves_no_ready_time(spark):
    df = frame(spark, "t string, e timestamp_ntz, c timestamp_ntz, f timestamp_ntz",
               ("T", ts("2024-01-01 00:00:01"), ts("2024-01-01 00:00:00"), None), ("T", None, ts("2024-01-01 00:00:00"), None))
    got = df.select(trailer_plan.selected_ready(*[F.col(c) for c in "tecf"])).collect()
    assert [r[0] for r in got] == [None, ts("2024-01-01 00:00:00")]


def test_ambiguous_stay_drops_the_load(spark):
    dc, _, zones = dims(spark)
    ready = ts("2024-03-10 10:00:00")
    loads = frame(
        spark, "load_id long, trip_id long, trailer_id string, origin_location_id long, dest_location_id long, load_status string, "
        "trip_status_code string, projected_date date, delivery_slot long, orig_ready_ts timestamp_ntz, adj_ready_ts timestamp_ntz, "
        "ready_ts timestamp_ntz, projected_ts timestamp_ntz, depart_ts timestamp_ntz",
        *[(n, n, t, 10, 20, "OPEN", "OPEN", d("2024-03-11"), 6, ready, ready, ready, ts("2024-03-11 06:00:00"), None)
          for n, t in ((1, "A"), (2, "B"), (3, "C"))],
    )
    doors = frame(
        spark, "dc_nbr long, store_nbr long, trip_id long, trailer_id string, door_open_count long, gate_in_ts timestamp_ntz, "
        "first_trailer_door_open_ts timestamp_ntz, last_trailer_door_close_ts timestamp_ntz, gate_out_ts timestamp_ntz",
        (10, 20, 1, "A", 1, ts("2024-03-09 00:00:00"), ts("2024-03-09 01:00:00"), ts("2024-03-09 09:00:00"), ts("2024-03-11 00:00:00")),
        (10, 20, 8, "A", 1, ts("2024-03-09 00:00:00"), ts("2024-03-09 01:00:00"), ts("2024-03-09 08:00:00"), None),
        (10, 20, 2, "B", 2, ts("2024-03-09 00:00:00"), None, ts("2024-03-10 12:00:00"), ts("2024-03-13 10:00:00.5")),
        (10, 20, 9, "B", 3, ts("2024-03-01 00:00:00"), None, ts("2024-03-10 09:00:00"), ts("2024-03-13 10:00:00")),
    )
    stops = frame(spark, "load_id string, location_id long, status_ts_utc timestamp_ntz, ship_status_code string, location_type_code string",
                  ("2", 10, ts("2024-03-10 23:00:00.9"), "AF ", "DC"), ("2", 10, ts("2024-03-10 22:00:00.9"), "AF", "DC "), ("x", 20, ts("2024-03-11 00:00:00"), "X1", "STORE"))
    cnsld = frame(spark, "load_id long, trailer_id string, origin_loc_id long, dest_loc_id long, load_status string, load_ready_date date, "
                  "actual_delivery_ts timestamp_ntz, freight_category_code string, dest_loc_type_code string",
                  (2, " B", 10, 20, "OPEN", d("2024-03-01"), ts("2024-03-12 01:02:03.4"), "STR", "STORE "))
    moves = frame(spark, "trip_id long, load_id long, trailer_id string, origin_loc_id long, dest_loc_id long, actual_orig_depart_ts_utc timestamp_ntz, "
                  "actual_dest_arrival_ts_utc timestamp_ntz", (3, 3, "C ", 10, 20, None, ts("2024-03-12 12:00:00")))
    got = trailer_plan.load_activity(loads, doors, stops, cnsld, moves, dc, zones, NOW)
    by_load = {r.load_id: r for r in got.collect()}
    assert sorted(by_load) == [2, 3]
    assert by_load[2].door_open_count == 3 and by_load[2].ready_ts == ready
    assert (by_load[2].begin_trip_ts, by_load[2].begin_trip_src) == (ts("2024-03-10 17:00:00"), "load_status_stop")
    assert (by_load[2].end_trip_ts, by_load[2].end_trip_src) == (ts("2024-03-12 01:02:03"), "load_consolidated")
    assert (by_load[3].begin_trip_ts, by_load[3].begin_trip_src, by_load[3].door_open_count) == (None, None, None)
    assert (by_load[3].end_trip_ts, by_load[3].end_trip_src) == (ts("2024-03-12 07:00:00"), "trip_movement")


def test_case_quantity_is_rounded_when_cast(spark):
    ready = ts("2024-03-10 10:00:00")
    load = (1, 1, "T", 10, 20, "OPEN", d("2024-03-12"), 6, ready, ready, 1, ready, ready, ready, ready)
    loads = frame(spark, "load_id long, trip_id long, trailer_id string, orig_loc_id long, dest_loc_id long, load_status string, projected_date date, "
                  "delivery_slot long, ready_ts timestamp_ntz, projected_ts timestamp_ntz, door_open_count long, first_trailer_door_open_ts timestamp_ntz, "
                  "last_trailer_door_close_ts timestamp_ntz, begin_trip_ts timestamp_ntz, end_trip_ts timestamp_ntz", load)
    invoices = frame(spark, "load_id long, trip_id long, trailer_id string, ship_from_dc_nbr long, ship_to_store_nbr long, invoice_date date, case_qty double, "
                     "cube_qty double, weight_qty double, auto_cube_qty double",
                     (5, 5, "T ", 10, 20, d("2024-03-09"), 2.5, 1.0, 1.0, 0.0), (1, 1, "T", 10, 20, d("2023-01-01"), 1.4, 2.0, 2.0, 0.0),
                     (1, 9, "T", 10, 20, d("2023-01-01"), 100.0, 2.0, 2.0, 0.0))
    row = trailer_plan.load_quantities(loads, invoices).first()
    assert (row.tot_case_ship_qty, row.tot_cube_qty, row.invoice_date) == (4, 3.0, d("2024-03-09"))


def test_weekly_actual_variants(spark):
    schema = "store_nbr long, projected_date date, projected_year_wk_nbr long, trailer_fcst long, daily_plan long, load_id long, carry_over_flag boolean"
    plan = frame(spark, schema, (1, d("2024-03-11"), 1, 2, 1, 5, True), (1, d("2024-03-12"), 1, None, 3, 5, False), (1, d("2024-03-12"), 1, None, 3, 6, None))
    daily = trailer_plan.daily_rollup(plan)
    assert rows(daily, "projected_date", "trailer_count", "carry_over_count", "next_day_plan", "trailer_fcst") == [
        (d("2024-03-11"), 1, 1, 3, 2), (d("2024-03-12"), 2, 0, None, 0)]
    assert rows(trailer_plan.weekly_rollup(daily)) == [(1, 1, 4, 2, 3)]
    assert rows(trailer_plan.weekly_distinct(plan, daily), "weekly_plan", "weekly_fcst", "weekly_actl") == [(4, 2, 2)]


def test_attribution_levels(spark):
    df = frame(spark, "daily_plan long, daily_actual long, carry_over_count long, must_ship_flag string, available long", (1, 0, 0, "Y", 0))
    assert rows(trailer_plan.attribution_levels(df), "compliance_l1", "compliance_l2", "compliance_l3") == [("UNDER", "DC_HANDOFF", "Must Ship Missed")]


def test_modern_loads_without_zone_or_trailer(spark):
    dc, store, zones = dims(spark)
    plans = frame(
        spark, "plan_id string, parent_plan_id long, origin_location_id long, destination_location_id long, origin_location_type string, "
        "destination_location_type string, status string, category string, min_due_ts timestamp_ntz, trailer_avail_ts timestamp_ntz, actual_pickup_ts timestamp_ntz",
        ("7", 70, 10, 20, "DC", "STORE", "DELIVERED", "STR", ts("2024-03-11 03:00:00"), None, ts("2024-03-11 05:00:00")),
        ("8", 80, 10, 22, "DC", "STORE", "IN_TRANSIT", "STR", ts("2024-03-11 03:00:00"), None, None),
        ("9", 90, 11, 20, "DC", "STORE", "IN_TRANSIT", "STR", ts("2024-03-11 03:00:00"), None, None),
    )
    psn = frame(spark, "load_id long, trailer_id string", (7, " T7 "))
    got = carrier_loads.modern(plans, dc, psn, store, zones)
    assert rows(got, "load_id", "trailer_id", "projected_date", "delivery_slot", "depart_ts") == [
        (7, "T7", d("2024-03-10"), 22, ts("2024-03-11 00:00:00")), (8, None, None, None, None)]


def test_identity_match(spark):
    activity = frame(
        spark, "activity_id long, technician_user_id string, technician_win_no long, activity_type string, local_start_time timestamp_ntz, "
        "local_end_time timestamp_ntz, tracking_no long",
        *[(n, u, w, "x", None, None, 1) for n, u, w in ((1, "u9", 1), (2, "u2", 99), (3, "u1", 1), (4, "zz", 99), (5, None, 1), (6, "testtec", 1))],
    )
    people = frame(spark, "id long, employee_id string, user_id string, provider_id long, provider_name string, first_name string, last_name string",
                   (1, "1", "u1", 5, "P5", "Ann", "A"), (2, "2", "u2", 6, "P6", None, "B"))
    aligned = frame(spark, "user_id string, first_name string, last_name string", ("zz", "Zed", "Z"), ("u2", "Bob", "Bee"))
    got = technician_activity.isp_activity(activity, people, aligned)
    assert rows(got, "activity_id", "provider_id", "first_name", "last_name", "full_name") == [
        (1, 5, "Ann", "A", "Ann A"), (2, 6, "Bob", "B", "Bob Bee"), (3, 5, "Ann", "A", "Ann A"), (4, None, "Zed", "Z", "Zed Z")]


def test_phone_pairs(spark):
    schema = "ivr_id long, tracking_number long, ivr_action long, ivr_date_time timestamp_ntz, check_in_source string"
    calls = frame(
        spark, schema,
        (1, 1, 1, ts("2024-03-01 08:00:00"), "phone"), (2, 1, 1, ts("2024-03-01 09:00:00"), "xml"), (3, 1, 2, ts("2024-03-01 12:00:00"), "phone"),
        (4, 1, 1, ts("2024-03-02 08:00:00"), "phone"), (5, 1, 1, ts("2024-03-03 08:00:00"), "xml"),
        (6, 2, 1, ts("2024-03-09 12:00:01"), "phone"), (7, 2, 2, ts("2024-03-09 08:00:00"), "phone"),
        (8, 3, 1, ts("2024-03-07 11:00:00"), "phone"), (9, 3, 2, ts("2024-03-07 08:00:00"), "phone"),
        (10, None, 1, ts("2024-03-07 11:00:00"), "phone"), (11, 4, 2, ts("2024-03-07 11:00:00"), "phone"),
    )
    got = technician_activity.ivr_activity(calls, NOW)
    assert rows(got, "tracking_nbr", "activity_id", "check_out_datetime") == [
        (None, None, None), (1, 2, ts("2024-03-01 12:00:00")), (1, 4, None), (1, 5, None), (2, 6, ts("2024-03-09 08:00:00")), (3, 8, None), (4, None, None)]


def test_mobile_visits(spark):
    mobile = frame(
        spark, "record_id_nbr long, user_id long, provider_id long, technician_first_name string, technician_last_name string, work_type string, "
        "check_in_date_time timestamp_ntz, check_out_date_time timestamp_ntz, tracking_number long",
        (1, 1, 5, "f", "l", "fix", ts("2024-03-14 08:00:00"), ts("2024-03-14 09:00:00"), 7), (1, 1, 5, "f", "l", "fix", ts("2024-03-14 08:00:00"), ts("2024-03-14 09:00:00"), 7),
        (2, 1, 5, "f", "l", "fix", ts("2024-03-14 08:00:00"), ts("2024-03-15 00:00:00"), 7), (3, 1, 5, "f", "l", "fix", ts("2024-03-14 08:00:00"), ts("9999-01-01 00:00:00"), 7),
        (4, 1, 5, "f", "l", "fix", ts("2024-03-14 08:00:00"), None, 7), (5, 1, 5, "f", "l", "fix", ts("2024-03-14 08:00:00"), ts("2024-03-14 09:00:00"), 0),
        (6, 2, 5, "f", "l", "fix", ts("2024-03-14 08:00:00"), ts("2024-03-14 09:00:00"), 7), (7, 3, 5, "f", "l", "fix", ts("2024-03-14 08:00:00"), ts("2024-03-14 09:00:00"), 7),
    )
    people = frame(spark, "id long, employee_id string, user_id string, provider_id long, provider_name string, first_name string, last_name string",
                   (1, "1", "u1", None, None, None, "B"), (2, "2", "u2", 9, "nine", "Bo", "C"))
    providers = frame(spark, "provider_id long, provider_name string", (5, "five"))
    got = technician_activity.ftm_activity(mobile, people, providers, NOW)
    assert rows(got, "activity_id", "provider_name", "full_name", "work_type", "check_out_datetime") == [
        (1, "five", "F L", "FIX", ts("2024-03-14 09:00:00")), (2, "five", "F L", "FIX", None), (6, "nine", "BO C", "FIX", ts("2024-03-14 09:00:00"))]


def test_activity_finish(spark):
    schema = ("activity_id long, provider_id long, provider_name string, user_id string, first_name string, last_name string, full_name string, "
              "work_type string, check_in_datetime timestamp_ntz, check_out_datetime timestamp_ntz, tracking_nbr long, src string")
    start = ts("2024-03-01 08:00:00")

    def visit(n, key, out, user="u1"):
        return (n, 1, "one", user, "f", "l", "f l", "fix", start, out, key, "isp")

    isp = frame(spark, schema, visit(1, 7, None), visit(2, 7, ts("2024-03-01 08:00:00")), visit(3, 7, ts("2024-03-01 07:59:00")),
                visit(4, 7, ts("2024-03-02 08:00:00")), visit(5, 7, ts("2024-03-02 08:01:00")), visit(6, 0, None), visit(7, None, None), visit(8, 99, None, "U1"))
    none = frame(spark, schema)
    held = frame(spark, "tracking_number long, provider_id long, provider_name string, segment_start timestamp_ntz, segment_end timestamp_ntz",
                 (7, 3, "three", ts("2024-02-01 00:00:00"), None))
    people = frame(spark, "user_id string, first_name string, last_name string, org_role string, insource_start_date date, insource_exit_date date, home_location long",
                   ("u 1", " ann ", "b", "GM", None, None, 4), ("  ", "x", "y", "GM", None, None, 5))
    orders = frame(spark, "tracking_nbr long, location_id long, completion_date timestamp_ntz", (7, 1, ts("2024-03-09 00:00:00")), (99, 1, None))
    got = technician_activity.technician_activity(isp, none, none, held, people, orders)
    done = ts("2024-03-09 00:00:00")
    assert rows(got, "activity_id", "activity_minutes", "check_out_datetime", "tracking_nbr", "provider_name", "first_name") == [
        (1, None, done, 7, "THREE", "F"), (2, 0, start, 7, "THREE", "F"), (3, None, ts("2024-03-01 07:59:00"), 7, "THREE", "F"),
        (4, 1440, ts("2024-03-02 08:00:00"), 7, "THREE", "F"), (5, None, ts("2024-03-02 08:01:00"), 7, "THREE", "F"),
        (6, None, None, None, "ONE", "F"), (7, None, None, None, "ONE", "F"), (8, None, None, 99, "ONE", "ANN")]


def test_assignment_ends_at_midnight(spark):
    work = ("workorder_id long, location_id long, workorder_type_code string, workorder_type_desc string, priority_code string, status_code string, "
            "status_desc string, created_ts timestamp_ntz, scheduled_ts timestamp_ntz, started_ts timestamp_ntz, completed_ts timestamp_ntz, "
            "closed_ts timestamp_ntz, equipment_id long, vendor_id long, parts_cost double, labor_cost double")

    def order(n, created):
        return (n, 1, "GM", "g", "E", "OPEN", "o", ts(created), None, None, None, None, None, None, None, 5.0)

    orders = frame(spark, work, order(1, "2024-03-01 00:00:00"), order(2, "2024-03-10 00:00:00"), order(3, "2024-03-10 00:00:01"), order(4, "2023-09-17 11:59:59"))
    place = frame(spark, ", ".join(f"{c} string" for c in workorders.LOCATION_COLUMNS) + ", current_ind string",
                  ("1", "n", "S") + ("x",) * 12 + ("Y",)).withColumn("location_id", F.lit(1).cast("long"))
    assigned = frame(spark, "location_id long, service_type_code string, tech_id long, effective_start_date date, effective_end_date date",
                     (1, "GM", 7, d("2024-03-01"), d("2024-03-10")))
    tech = frame(spark, "tech_id long, tech_name string, tech_type string, employment_status string, manager_id long", (7, "Ann", "GM", "A", 1))
    boss = frame(spark, "manager_id long, manager_name string", (1, "Boss"))
    equipment = frame(spark, "equipment_id long, equipment_type string, equipment_category string, manufacturer string, model_number string, install_date date")
    vendors = frame(spark, "vendor_id long, vendor_name string, vendor_type string")
    cal = calendar(spark, "2023-09-01", 250).select(
        "calendar_date", F.col("year_nbr").alias("fiscal_year"), F.lit(1).alias("fiscal_quarter"), F.lit(1).alias("fiscal_month"),
        F.col("week_nbr").alias("fiscal_week"), F.col("week_day_name").alias("day_of_week_name"))
    got = workorders.enriched_workorders(orders, place, assigned, tech, boss, equipment, vendors, cal, NOW)
    assert rows(got, "workorder_id", "tech_name", "tech_manager", "service_provider", "total_cost", "tech_type_desc") == [
        (1, "Ann", "Boss", "Internal", 5.0, "General Maintenance"), (2, "Ann", "Boss", "Internal", 5.0, "General Maintenance"),
        (3, None, None, "Internal", 5.0, "Specialist")]


def test_ageing_weights(spark):
    orders = frame(spark, "workorder_id long, location_id long, priority_code string, status_code string, created_ts timestamp_ntz, completed_ts timestamp_ntz, assigned_tech_id long",
                   (1, 1, "E", "X", ts("2024-03-04 00:59:00"), ts("2024-03-04 01:01:00"), 1), (2, 1, "E", "X", ts("2024-03-04 00:00:00"), ts("2024-03-04 10:00:00"), 1),
                   (3, 1, "E", "CANCELLED", ts("2024-03-04 00:00:00"), None, 1), (4, 1, "E", "X", ts("2024-03-05 00:00:00"), None, 1))
    history = frame(spark, "workorder_id long, status_code string, status_ts timestamp_ntz", (1, "A", ts("2024-03-04 00:59:00")), (1, "B", ts("2024-03-04 01:01:00")),
                    (1, "A", ts("2024-03-04 02:59:00")), (2, "A", ts("2024-03-04 02:59:00")))
    aged = workorders.ageing(orders, history, NOW)
    assert rows(aged, "workorder_id", "total_hours", "age_bucket", "total_status_hours", "status_change_count", "status_rows") == [
        (1, 1, "0-1 Days", 2, 2, 3), (2, 10, "0-1 Days", None, 1, 1), (4, 252, "8-14 Days", None, 0, 1)]
    assert workorders.ageing(orders, history, NOW, per_status_row=True).count() == 5
    weekly = workorders.weekly_ageing(aged)
    assert rows(weekly, "age_bucket", "workorder_count", "avg_hours_to_complete", "median_hours") == [("0-1 Days", 2, 3.25, 1.0), ("8-14 Days", 1, 252.0, 1.0)]
    assert workorders.weekly_ageing(aged, by_week=True).count() == 1


def test_alignment_slots(spark):
    names = [c for _, p in alignment.TECH_SLOTS for c in (p, f"{p}_uid", f"{p}_status", f"{p}_phone")]
    schema = "location_id long, location_type_code string, " + ", ".join(f"{c} string" for c in names) + ", gm_mgr string, hvacr_mgr string, landscape_mgr string"

    def place(n, kind, **filled):
        return (n, kind, *[filled.get(c) for c in names], "G", None, "L")

    df = frame(spark, schema, place(1, "S", gm_tech="a", food_eqpt_tech_phone="555", hvacr_pm_tech="h", landscape_tech_one="l1", landscape_tech_four="l4"),
               place(2, "S"), place(3, "G", gm_tech="x"), place(4, None, gm_tech="x"))
    got = alignment.technician_alignment(df)
    assert rows(got, "location_id", "tech_type", "tech_name", "tech_phone", "tech_manager") == [
        (1, "Food Equipment", None, "555", "G"), (1, "GM", "a", None, "G"), (1, "HVAC/R PM", "h", None, None),
        (1, "Landscape", "l1", None, "L"), (1, "Landscape", "l4", None, "L")]


def test_productivity_peers_share(spark):
    base = "tech_id long, tech_name string, location_id long, activity_date date, activity_type string, workorder_id long, duration_minutes long, start_time timestamp_ntz"
    day = d("2024-03-01")
    activity = frame(spark, base, (1, "a", 1, day, "x", 1, 100, ts("2024-03-01 08:00:00")), (1, "a", 1, day, "x", 2, 140, ts("2024-03-01 08:00:00")),
                     (1, "a", 1, day, "x", 3, None, ts("2024-03-01 09:00:00")), (2, "b", 1, day, "x", 4, 500, ts("2024-03-01 09:00:00")))
    staff = frame(spark, "tech_id long, tech_name string, employment_type string", (1, "Ann", "INTERNAL"), (2, "Bo", "VENDOR"))
    rows_ = productivity.internal_activity(activity, staff, NOW)
    place = frame(spark, "location_id long, region_name string, district_name string", (1, "R", "D"))
    got = productivity.productivity([rows_], place)
    assert rows(got, "workorder_id", "cumulative_minutes", "activity_seq", "prev_cumulative", "productivity_status", "tech_name") == [
        (1, 240, 1, None, "HALF_DAY", "Ann"), (2, 240, 2, 240, "HALF_DAY", "Ann"), (3, 240, 3, 240, "HALF_DAY", "Ann")]


def test_lane_needs_five_loads(spark):
    schema = "load_id long, origin_location_id long, dest_location_id long, trailer_util_pct double, transit_hours long, total_cube double, total_weight double, actual_arrival_ts timestamp_ntz"
    t = ts("2024-03-01 00:00:00")
    df = frame(spark, schema, *[(n, 1, 1, 0.5, 2, 1.0, 1.0, t) for n in range(4)], *[(n, 1, 2, 0.7, 2, 1.0, 1.0, t) for n in range(10, 15)], (99, 1, 1, 0.9, 2, 1.0, 1.0, None))
    got = load_items.lane_metrics(df)
    assert rows(got, "dest_location_id", "load_count", "median_utilization") == [(2, 5, 0.7)]


def test_receipts_split_over_dates(spark):
    lines = frame(
        spark, "oms_po_nbr long, distribution_po_nbr long, booking_po_nbr long, po_line_nbr long, order_date date, po_type_code string, event_abbr string, item_nbr long, "
        "mds_fam_id long, order_dept_nbr long, dc_nbr long, mabd_date date, po_line_status_cd long, vnpk_ord_qty double",
        *[(n, 1, 1, 1, d("2024-01-01"), "p", "e", 1, 1, 1, 6060, d("2024-02-10"), 1000, 12.0) for n in (1, 2, 3)])
    orders = frame(spark, "oms_po_nbr long, po_status_cd long", (1, 800), (2, 1500), (3, 900))
    subs = frame(spark, "oms_po_nbr long", (1,), (2,), (3,))
    received = imports.received_by_date(
        frame(spark, "oms_po_nbr long, po_line_nbr long, receiver_nbr long, vnpk_rcv_qty double", (1, 1, 1, 2.0), (1, 1, 2, 4.0), (1, 1, 1, 0.0)),
        frame(spark, "oms_po_nbr long, receiver_nbr long, received_date date", (1, 1, d("2024-02-01")), (1, 2, d("2024-02-02"))))
    receipts = imports.booking_receipts(lines, orders, subs, received)
    assert rows(receipts, "oms_po_nbr", "received_date", "vnpk_ord_qty", "vnpk_rcv_qty") == [
        (1, d("2024-02-01"), 4.0, 2.0), (1, d("2024-02-02"), 8.0, 4.0), (2, None, 12.0, 0.0)]
    volume = imports.facility_volume(receipts)
    assert rows(volume.limit(1), "channel_method_desc", "idc_date_planned", "store_date_planned") == [("STORAGE", d("2024-02-05"), d("2024-02-12"))]
    items = frame(spark, "item_nbr long, country_code string, current_ind string, dept_nbr long, acctg_dept_nbr long, dept_category_nbr long, vnpk_qty double, "
                  "vnpk_cube_qty double, vnpk_weight_qty double, base_unit_retail_amt double", (1, "US", "Y", 1, 1, 1, 2.0, 0.5, 1.0, 3.0))
    # lines never received have no actual date and stay out
    assert rows(imports.import_inbound(volume, items, NOW), "unit_ord_qty", "retail_rcv_qty") == [(8.0, 12.0), (16.0, 24.0)]


def test_lane_statistics(spark):
    schema = ("booking_po_nbr long, item_nbr long, origin_country_code string, origin_port_code string, dest_port_code string, dest_facility_nbr long, order_date date, "
              "ship_date date, port_arrival_date date, customs_clear_date date, facility_arrival_date date, available_date date")
    order = d("2024-01-01")

    def shipment(lane, days):
        return (1, 1, lane, "p", "q", 1, order, d("2024-01-05"), None, d("2024-01-20"), d("2024-01-25"), order + dt.timedelta(days=days))

    df = frame(spark, schema, *[shipment("A", n) for n in range(10, 20)], *[shipment("B", 5) for _ in range(9)])
    got = imports.lane_metrics(imports.shipment_milestones(df, NOW)).collect()
    assert len(got) == 1 and got[0].shipment_count == 10
    row = got[0]
    assert (row.avg_lead_time, row.min_lead_time, row.max_lead_time, row.p50_lead_time) == (14.5, 10, 19, 14.5)
    assert row.p90_lead_time == pytest.approx(18.1) and row.stddev_lead_time == pytest.approx(8.25**0.5)
    assert (row.avg_order_to_ship, row.avg_ocean_transit, row.avg_inland_transit) == (4.0, None, 5.0)


def positions(spark, *data):
    """po, booking, e-commerce, ordered, received, planned date, actual date"""
    schema = "po_nbr long, bk_po_nbr long, ecommerce_ind string, vnpk_ord_qty double, vnpk_rcv_qty double, idc_date_planned date, idc_date_actual date"
    df = frame(spark, schema, *[(a, b, e, o, r, d(p), d(x)) for a, b, e, o, r, p, x in data])
    c = F.col
    return df.withColumns(
        {
            "mds_fam_id": F.lit(1), "to_location_no_actual": F.lit(1).cast("long"), "dc_nbr": F.lit(2).cast("long"), "po_type": F.lit(33),
            "channel_mthd_desc": F.lit("FLOW"), "unit_ord_qty": c("vnpk_ord_qty") * 2, "unit_rcv_qty": c("vnpk_rcv_qty") * 2,
            "retail_ord_qty": c("vnpk_ord_qty"), "retail_rcv_qty": c("vnpk_rcv_qty"), "cube_ord_qty": c("vnpk_ord_qty"), "cube_rcv_qty": c("vnpk_rcv_qty"),
        }
    )


def test_receipt_offset(spark):
    lanes = frame(spark, "from_location_nbr long, to_location_nbr long, lead_time long", (1, 2, 3))
    df = positions(
        spark,
        (1, 1, "Y", 100.0, 49.0, "2024-03-01", "2024-03-10"), (2, 2, "Y", 100.0, 50.0, "2024-03-01", "2024-03-10"), (3, 3, "N", 100.0, 0.0, "2024-03-01", "2024-03-10"),
        (4, 4, "Y", 0.0, 0.0, "2024-03-01", "2024-03-10"), (5, 5, "Y", 10.0, 0.0, "2024-02-23", None), (6, 6, "Y", 10.0, 0.0, "2024-02-22", None),
        (7, 7, "Y", 10.0, 0.0, "2024-03-14", None), (8, 8, "Y", 10.0, 0.0, "2024-03-15", None),
    )
    opened = planning.offset_receipts(df, lanes, NOW, until_yesterday=True)
    assert rows(opened, "po_nbr", "idc_date_actual_new", "vnpk_rcv_qty_new", "unit_rcv_qty_new") == [
        (1, d("2024-03-07"), 49.0, 98.0), (2, d("2024-03-07"), 50.0, 100.0), (3, d("2024-03-10"), 0.0, 0.0), (4, d("2024-03-07"), 0.0, 0.0),
        (5, d("2024-02-23"), 10.0, 20.0), (6, None, 0.0, 0.0), (7, d("2024-03-14"), 10.0, 20.0), (8, d("2024-03-15"), 0.0, 0.0)]
    received = planning.offset_receipts(df, lanes, NOW, until_yesterday=False)
    assert [r[1] for r in rows(received, "po_nbr", "vnpk_rcv_qty_new")] == [49.0, 50.0, 0.0, 0.0, 10.0, 0.0, 10.0, 10.0]


def test_offset_uses_the_whole_booking(spark):
    lanes = frame(spark, "from_location_nbr long, to_location_nbr long, lead_time long", (1, 2, None))
    df = positions(spark, (1, 1, "Y", 10.0, 0.0, "2024-03-01", "2024-03-12"), (2, 1, "Y", 10.0, 9.0, "2024-03-01", "2024-03-05"), (3, None, "Y", 1.0, 0.0, "2024-03-01", "2024-03-09"))
    got = planning.offset_receipts(df, lanes, NOW, until_yesterday=True)
    assert rows(got, "po_nbr", "idc_date_actual_new", "tot_vnpk_ord_qty") == [(1, d("2024-03-05"), 20.0), (2, d("2024-03-05"), 20.0), (3, d("2024-03-09"), 1.0)]


def test_received_window_bounds(spark):
    cal = calendar(spark)
    # 12 March 2024 lies in the week from Sunday the 10th to Saturday the 16th
    assert planning.last_complete_day(cal, NOW).first()[0] == d("2024-03-16")
    start = frame(spark, "calendar_date date", (d("2024-03-01"),))
    df = frame(spark, "x date", *[(d(x),) for x in ("2024-02-29", "2024-03-01", "2024-03-16", "2024-03-17")])
    assert [r[0] for r in rows(planning.within_window(df, "x", start, cal, NOW))] == [d("2024-03-01"), d("2024-03-16")]
    two = start.unionAll(start)
    with pytest.raises(Exception, match="SCALAR_SUBQUERY"):
        planning.within_window(df, "x", two, cal, NOW).collect()


def test_outbound_branches(spark):
    headers = frame(spark, "invoice_nbr long, invoice_date date, ship_from_dc_nbr long, ship_to_store_nbr long",
                    (1, d("2024-03-10"), 6060, 50), (2, d("2024-02-22"), 6060, 50), (3, d("2024-03-10"), 50, 6))
    schema = ("invoice_nbr long, invoice_date date, item_nbr long, po_nbr long, label_date date, each_ship_qty double, variable_wt_qty double, "
              "tot_whpk_ship_qty double, ext_cost_amt decimal(18,2), ext_retail_amt decimal(18,2)")
    from decimal import Decimal as D
    lines = frame(spark, schema, (1, d("2024-03-10"), 9, 43, d("2024-03-01"), 10.0, 1.0, 2.0, D(1), D(2)), (1, d("2024-03-10"), 9, 43, d("2023-08-30"), 10.0, 1.01, 2.0, D(1), D(2)),
                  (2, d("2024-02-22"), 9, 43, d("2024-03-01"), 10.0, 1.0, 2.0, D(1), D(2)), (3, d("2024-03-10"), 9, 23, d("2024-03-01"), 10.0, 1.0, 2.0, D(1), D(2)))
    items = frame(spark, "item_nbr long, mds_fam_id long, acctg_dept_nbr long, dept_nbr long, dept_category_nbr long, country_code string, current_ind string, "
                  "vnpk_qty double, whpk_qty double, whpk_cube_qty double, vnpk_cube_qty double, whpk_cube_uom_code string",
                  (90, 9, 1, 1, 1, "US", "Y", 0.0, 0.0, 1.5, 2.0, "CF"))
    orders = frame(spark, "po_nbr long, po_type long, xfer_whse_nbr long, order_date date", (43, 43, None, d("2024-02-26")), (23, 23, 6061, d("2024-03-01")))
    lanes = frame(spark, "from_location_nbr long, to_location_nbr long, lead_time long", (6060, 50, 7), (6061, 50, None))
    got = planning.outbound_volume(headers, lines, items, orders, lanes, calendar(spark), NOW)
    assert rows(got, "part_no", "from_location_no", "to_location_no", "ship_week_no", "receipt_week_no", "total_ship_units", "tot_vnpk_ship_qty", "vnpk_qty") == [
        ("PART-2", 6060, 50, 202410, 202411, 0.0, 10.0, 1.0), ("PART-2", 7089, 50, 202410, 202411, 10.0, None, 1.0),
        ("PART-3", 6061, 50, 202408, 202408, 10.0, None, 1.0)]


@pytest.mark.parametrize("lag, kept", [(-1, False), (0, True), (179, True), (180, False)])
def test_label_window(spark, lag, kept):
    orders = planning._labelled_orders(frame(spark, "po_nbr long, po_type long, xfer_whse_nbr long, order_date date", (1, 43, 1, d("2024-01-01"))))
    row = orders.first()
    label = d("2024-01-01") + dt.timedelta(days=lag)
    assert (row["_ordered"] <= label <= row["_label_until"]) is kept
