"""Report order: off by default, as asked with ``ordered=True``."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from checks import supply, trailer
from checks.registry import _build
from lanewright.plans import imports, trailer_plan

SF_DIR = "/root/testdata/sf0.001"


def table_of(spark, text):
    return _build(spark, SF_DIR, text.spark if hasattr(text, "spark") else text, {})


def test_forecast_order(spark):
    forecast, days = table_of(spark, trailer.FORECAST), table_of(spark, trailer.EVENT_CALENDAR)
    got = trailer_plan.forecast_current(days, forecast, trailer.EVENTS_NOW, ordered=True)
    keys = [(r.location_id, r.cap_calendar_date) for r in got.select("location_id", "cap_calendar_date").collect()]
    assert keys == sorted(keys) and len(keys) > 100


def test_container_and_trend_order(spark):
    containers = table_of(spark, supply.CONTAINERS)
    seen = [r[0] for r in imports.container_tracking(containers, dt.datetime(1995, 5, 1), ordered=True).select("vessel_departure_ts").collect()]
    assert seen == sorted(seen, reverse=True) and seen
    metrics = imports.lane_metrics(imports.shipment_milestones(table_of(spark, supply.WIDE_LANES), supply.LEAD_NOW))
    trends = imports.lead_time_trends(metrics, ordered=True).select("origin_country_code", "dest_facility_nbr", "ship_year", "ship_month")
    keys = [(c, f, -y, -m) for c, f, y, m in trends.collect()]
    assert keys == sorted(keys)


@pytest.mark.parametrize("name", ["forecast_fill", "milestone_ladder", "workorder_sla"])
def test_reports_are_unsorted_by_default(spark, name):
    plan = entry.queries()[name](spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert not any(line.lstrip(" :+-").startswith("Sort ") for line in plan.split("\n"))


def test_filters_and_columns_reach_the_scan(spark):
    days = F.lit(dt.date(2024, 1, 10))
    events = spark.read.parquet(f"{SF_DIR}/events.parquet")
    plan = events.filter(F.col("ts") >= days).select("user_id", "ts").groupBy("user_id").count()
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in text and "props" not in text.split("ReadSchema")[1]
