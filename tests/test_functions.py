import datetime as dt

import pytest
from pyspark.sql import functions as F

from lanewright.functions import quantities, rules
from lanewright.functions.dates import (
    datetime_diff, datetime_trunc, day, epoch_seconds, moment, to_local, week_sunday,
)
from lanewright.functions.nulls import safe_ratio, strict_greatest, strict_least
from tests.helpers import d, frame, rows, ts


def one(spark, schema, row, column):
    return frame(spark, schema, row).select(column.alias("x")).first()[0]


@pytest.mark.parametrize("row, least, greatest", [((1.0, 2.0), 1.0, 2.0), ((None, 2.0), None, None), ((3.0, None), None, None)])
def test_strict_extremes(spark, row, least, greatest):
    a, b = F.col("a"), F.col("b")
    assert one(spark, "a double, b double", row, strict_least(a, b)) == least
    assert one(spark, "a double, b double", row, strict_greatest(a, b)) == greatest


def test_safe_ratio(spark):
    df = frame(spark, "a long, b long", (1, 2), (1, 0), (None, 2), (1, None))
    assert [r[0] for r in df.select(safe_ratio(F.col("a"), F.col("b"))).collect()] == [0.5, None, None, None]


@pytest.mark.parametrize(
    "end, start, unit, expected",
    [
        ("2024-01-01 01:01:00", "2024-01-01 00:59:00", "hour", 1),
        ("2024-01-01 00:59:00", "2024-01-01 01:01:00", "hour", -1),
        ("2024-01-01 00:01:00", "2024-01-01 00:00:59", "minute", 1),
        ("2024-01-01 00:00:01", "2024-01-01 00:00:00.999", "second", 1),
        ("2024-01-02 00:00:00", "2024-01-01 23:59:59", "day", 1),
        ("2024-01-01 00:00:00", "2023-12-31 23:59:59", "year", 1),
        ("1969-12-31 23:30:00", "1969-12-31 22:59:00", "hour", 1),
        (None, "2024-01-01 00:00:00", "hour", None),
    ],
)
def test_datetime_diff_counts_boundaries(spark, end, start, unit, expected):
    row = (ts(end), ts(start))
    assert one(spark, "e timestamp_ntz, s timestamp_ntz", row, datetime_diff(F.col("e"), F.col("s"), unit)) == expected


def test_truncation_stays_civil(spark):
    df = frame(spark, "t timestamp_ntz", (ts("2024-03-10 02:30:15.750"),)).select(datetime_trunc(F.col("t"), "second").alias("t"))
    assert dict(df.dtypes)["t"] == "timestamp_ntz"
    assert df.first()[0] == ts("2024-03-10 02:30:15")


def test_week_of_year_starts_on_sunday(spark):
    days = [dt.date(1995, 1, 1) + dt.timedelta(days=i) for i in range(0, 365 * 12, 3)]
    df = frame(spark, "d date", *[(x,) for x in days]).select("d", week_sunday(F.col("d")).alias("w"))
    assert all(r["w"] == int(r["d"].strftime("%U")) for r in df.collect())


def test_to_local_uses_the_zone_of_the_row(spark):
    df = frame(
        spark, "t timestamp_ntz, z string",
        (ts("2024-01-15 12:00:00"), "America/Chicago"), (ts("2024-07-15 12:00:00"), "America/Chicago"),
        (ts("2024-07-15 12:00:00"), "America/Phoenix"), (ts("2024-07-15 12:00:00"), None),
    )
    got = [r[0] for r in df.select(to_local(F.col("t"), F.col("z"))).collect()]
    assert got == [ts("2024-01-15 06:00:00"), ts("2024-07-15 07:00:00"), ts("2024-07-15 05:00:00"), None]


def test_as_of_literals(spark):
    df = spark.range(1).select(
        day(dt.datetime(2024, 1, 31, 8), -1), moment(dt.datetime(2024, 1, 31, 8), hours=2), moment(dt.date(2024, 1, 31)),
        epoch_seconds(moment(dt.date(1970, 1, 2))),
    )
    assert tuple(df.first()) == (d("2024-01-30"), ts("2024-01-31 10:00:00"), ts("2024-01-31 00:00:00"), 86400)


def test_pack_volume(spark):
    schema = "q double, wu double, wq double, vq double, vu double"
    f = quantities.pack_volume(*[F.col(c) for c in ("q", "wu", "wq", "vq", "vu")])
    # by vendor pack: 10 * 2 / 4 * 3 = 15
    assert one(spark, schema, (10.0, 1.0, 2.0, 4.0, 3.0), f) == 10.0
    assert one(spark, schema, (10.0, 2.0, 2.0, 4.0, 3.0), f) == 15.0
    assert one(spark, schema, (10.0, None, 2.0, 4.0, 3.0), f) == 15.0
    assert one(spark, schema, (10.0, 1.0, 2.0, None, 3.0), f) is None
    assert one(spark, schema, (10.0, 1.0, 2.0, 0.0, 3.0), f) is None


def test_non_breakpack_cases(spark):
    schema = "q double, p string, l string, g double"
    f = quantities.non_breakpack_cases(*[F.col(c) for c in ("q", "p", "l", "g")])
    assert one(spark, schema, (5.0, "CASEPACK", "X", 1.0), f) == 5.0
    assert one(spark, schema, (5.0, None, "FDSC", 52.0), f) == 0.0
    assert one(spark, schema, (5.0, None, "FDSC", 53.0), f) == 5.0
    assert one(spark, schema, (5.0, "BREAKPACK", None, None), f) == 0.0


@pytest.mark.parametrize("cube, expected", [(2600.0, 1.0), (2601.0, 1.0), (1300.0, 0.5), (None, None)])
def test_utilisation(spark, cube, expected):
    assert one(spark, "c double", (cube,), quantities.utilisation(F.col("c"))) == expected


@pytest.mark.parametrize(
    "each, weight, pack, packs, units",
    [(10.0, 1.0, 4.0, 2.5, 10.0), (10.0, 1.01, 4.0, 10.0, 40.0), (10.0, 4.0, 6.0, 3.0, 18.0), (8.0, 4.0, 6.0, 2.0, 12.0),
     (10.0, None, 0.0, None, 10.0), (2.5, None, 2.0, 1.25, 3.0)],
)
def test_variable_weight(spark, each, weight, pack, packs, units):
    schema, row = "e double, w double, p double", (each, weight, pack)
    cols = [F.col(c) for c in ("e", "w", "p")]
    assert one(spark, schema, row, quantities.variable_weight_packs(*cols)) == packs
    assert one(spark, schema, row, quantities.variable_weight_units(*cols)) == units


def test_allocate(spark):
    f = quantities.allocate(F.col("o"), F.col("p"), F.col("t"))
    schema = "o double, p double, t double"
    assert one(spark, schema, (10.0, 1.0, 4.0), f) == 2.5
    assert one(spark, schema, (10.0, None, None), f) == 10.0
    assert one(spark, schema, (10.0, 0.0, 0.0), f) == 10.0


def test_vendor_key_and_extension(spark):
    assert one(spark, "n long", (12,), quantities.vendor_key(F.col("n"), F.lit(34), F.lit(5))) == 12345
    df = spark.range(1).select(*quantities.extend_quantity(F.lit(2.0), F.lit(6.0), F.lit(0.5), F.lit(3.0), F.lit(1.5), "q"))
    assert df.first().asDict() == {"unit_q": 12.0, "cube_q": 1.0, "wgt_q": 6.0, "retail_q": 18.0}


FULL_SCHEMA = (
    "daily_plan long, daily_actl long, weekend boolean, notice boolean, available long, next_available long, "
    "must_ship string, carry long, next_plan long, l7_under boolean, l7_util double, req_type string, req_reason string"
)
FULL = {
    "compliant_weekend": (2, 2, True, True, 0, 0, "N", 2, 1, False, 0.9, None, "why"),
    "compliant_notice": (2, 2, False, True, 0, 0, "N", 2, 1, False, 0.9, None, "why"),
    "compliant": (2, 2, True, True, 0, 0, "N", 1, 1, False, 0.9, None, "why"),
    "under_request": (2, 0, None, None, 1, 0, "Y", 0, 1, None, None, "UNDER", "why"),
    "under_available": (2, 0, None, None, 1, 0, "Y", 0, 1, None, None, None, "why"),
    "under_must_ship": (2, 0, None, None, None, None, "Y", 0, 1, None, None, "UNDER", "why"),
    "under_buffer": (2, 0, None, None, 0, 0, "N", 0, 1, None, None, None, "why"),
    "over_unplanned": (0, 1, None, None, None, None, None, None, None, None, None, None, None),
    "over_no_carry": (1, 2, None, None, None, None, None, 0, 1, None, None, None, None),
    "over_after_under": (1, 2, None, None, None, None, None, 0, 0, True, None, None, None),
    "over_low_util": (1, 2, None, None, None, None, None, 1, None, False, 0.7, None, None),
    "over_low_forecast": (1, 2, None, None, None, None, None, 1, None, False, None, None, None),
}


def full_attribution(df, level):
    c = F.col
    return df.select(
        rules.compliance_attribution(
            c("daily_plan"), c("daily_actl"), c("weekend"), c("notice"), c("available"), c("next_available"), F.lit(1),
            c("must_ship"), c("carry"), c("next_plan"), c("l7_under"), c("l7_util"), F.lit(True), c("req_type"),
            c("req_reason"), F.lit(level),
        )
    )


@pytest.mark.parametrize("level", [1, 2, 3, 4])
def test_attribution_rules(spark, level):
    got = [r[0] for r in full_attribution(frame(spark, FULL_SCHEMA, *FULL.values()), level).collect()]
    labels = [rules.FULL_LABELS[n] for n in FULL]
    expected = [t[level - 1] if level <= len(t) else "why" for t in labels]
    assert got == expected


def test_attribution_without_rule(spark):
    partly = (3, 1, True, True, 1, 0, "Y", 2, 1, False, 0.9, "UNDER", "why")
    nothing = (None,) * 13
    waits = (2, 0, None, None, 0, 1, "N", 0, 1, None, None, None, None)
    got = full_attribution(frame(spark, FULL_SCHEMA, partly, nothing, waits), 1).collect()
    assert [r[0] for r in got] == [None, None, None]


def test_simple_attribution(spark):
    df = frame(
        spark, "p long, a long, c long, m string, t long",
        (1, 1, 0, "N", 0), (2, 1, 0, "Y", 3), (2, 1, 0, "Y", None), (0, 1, 5, "N", 0), (1, 2, 0, "N", 0), (1, 2, 1, "N", 0),
    )
    for level in (1, 2, 3, 4):
        cols = [F.col(x) for x in "pacmt"]
        got = [r[0] for r in df.select(rules.compliance_attribution_simple(*cols, F.lit(level))).collect()]
        assert got == [t[level - 1] for t in rules.SIMPLE_LABELS.values()] + [None]


@pytest.mark.parametrize(
    "cube, util, group, bucket",
    [(4050.0, 0.25, "0% - 25%", "0-25%"), (4051.0, 0.25, "OTHER", "INVALID"), (None, 0.5, "25% - 50%", "25-50%"),
     (1.0, 0.75, "50% - 75%", "50-75%"), (1.0, 0.85, "75% - 85%", "75-85%"), (1.0, 0.86, "FULL", "FULL (85%+)"),
     (1.0, None, "OTHER", "FULL (85%+)")],
)
def test_utilisation_buckets(spark, cube, util, group, bucket):
    df = frame(spark, "c double, u double", (cube, util))
    c, u = F.col("c"), F.col("u")
    assert tuple(df.select(rules.utilisation_group(c, u), rules.utilisation_bucket(c, u)).first()) == (group, bucket)


@pytest.mark.parametrize(
    "flags, status",
    [((True, True, True, None), "CARRY OVER - OVER CAP"), ((False, True, True, None), "PULL FORWARD - OVER CAP"),
     ((True, False, True, None), "CARRY OVER"), ((False, True, False, None), "OVER CAP"),
     ((False, None, True, None), "PULL FORWARD"), ((None, None, None, "2024-01-01"), "DELIVERED"),
     ((False, False, False, None), "ON PROCESS")],
)
def test_trailer_status(spark, flags, status):
    carry, over, pull, end = flags
    df = frame(spark, "c boolean, o boolean, p boolean, e string", (carry, over, pull, end))
    assert df.select(rules.trailer_status(F.col("c"), F.col("o"), F.col("p"), F.col("e"))).first()[0] == status


def test_ready_correction(spark):
    t = [ts(f"2024-01-01 0{h}:00:00") for h in range(6)]
    df = frame(
        spark, "r timestamp_ntz, a timestamp_ntz, c timestamp_ntz",
        (t[1], t[3], t[2]), (t[1], t[1], t[2]), (t[1], t[2], t[2]), (t[3], t[4], t[2]), (t[1], None, t[2]), (t[1], t[3], None),
    )
    got = [r[0] for r in df.select(rules.corrected_ready(F.col("r"), F.col("a"), F.col("c"))).collect()]
    assert got == [t[3], t[2], t[1], t[3], t[1], t[1]]


@pytest.mark.parametrize("minutes, expected", [(-1, None), (0, 0), (1440, 1440), (1441, None)])
def test_activity_minutes(spark, minutes, expected):
    start = dt.datetime(2024, 1, 1)
    df = frame(spark, "i timestamp_ntz, o timestamp_ntz", (start, start + dt.timedelta(minutes=minutes)))
    i, o = F.col("i"), F.col("o")
    assert df.select(rules.activity_minutes(i, o, datetime_diff(o, i, "minute"))).first()[0] == expected


@pytest.mark.parametrize(
    "priority, hours, done, expected",
    [("E", 4, True, "MET"), ("E", 5, True, "MISSED"), ("E", 5, False, "IN_PROGRESS"), ("U", 24, False, "MET"),
     ("U", 25, True, "MISSED"), ("R", 72, True, "MET"), ("R", 73, True, "MISSED"), ("P", 1, True, "MISSED"),
     ("E", None, False, "IN_PROGRESS"), ("E", None, True, "MISSED")],
)
def test_service_level(spark, priority, hours, done, expected):
    df = frame(spark, "p string, h long, c string", (priority, hours, "x" if done else None))
    assert df.select(rules.sla_status(F.col("p"), F.col("h"), F.col("c"))).first()[0] == expected


def test_grades_and_buckets(spark):
    days = frame(spark, "x long", *[(v,) for v in (1, 3, 7, 14, 30, 31)])
    assert [r[0] for r in days.select(rules.age_bucket(F.col("x"))).collect()] == [
        "0-1 Days", "2-3 Days", "4-7 Days", "8-14 Days", "15-30 Days", "30+ Days"]
    p90 = frame(spark, "x double", *[(v,) for v in (45.0, 60.0, 75.0, 76.0)])
    assert [r[0] for r in p90.select(rules.lane_performance(F.col("x"))).collect()] == [
        "EXCELLENT", "GOOD", "FAIR", "NEEDS_IMPROVEMENT"]
    trend = frame(spark, "v double, l double", (89.0, 100.0), (100.0, 100.0), (111.0, 100.0), (1.0, None))
    assert [r[0] for r in trend.select(rules.lead_time_trend(F.col("v"), F.col("l"))).collect()] == [
        "DECREASING", "STABLE", "INCREASING", "STABLE"]
    lane = frame(spark, "v double, l double", (0.9, 0.8), (0.6, 0.8), (0.65, 0.8), (0.5, None))
    assert [r[0] for r in lane.select(rules.versus_lane(F.col("v"), F.col("l"))).collect()] == [
        "ABOVE_AVG", "BELOW_AVG", "AT_AVG", "AT_AVG"]
    spent = frame(spark, "x long", *[(v,) for v in (480, 240, 1, 0, None)])
    assert [r[0] for r in spent.select(rules.productivity_status(F.col("x"))).collect()] == [
        "FULL_DAY", "HALF_DAY", "PARTIAL", "NO_ACTIVITY", "NO_ACTIVITY"]


def test_facility_rules(spark):
    df = frame(spark, "t long, s long", (43, 6060), (45, 6061), (46, 6088), (43, 7042), (43, 7078), (43, 7067), (40, 6060),
               (None, 6060), (43, 1))
    got = [r[0] for r in df.select(rules.rerouted_site(F.col("t"), F.col("s"))).collect()]
    assert got == [7089, 7086, 7093, 7085, 7094, 8695, 6060, 6060, 1]
    df = frame(spark, "e string, s long, t long, c string", ("Y", 1, 1, "X"), ("N", 7092, 1, "X"), ("N", 1, 40, "FLOW"),
               ("N", 1, 42, "FLOW"), ("N", 1, 42, "STORAGE"), (None, None, None, None))
    flags = [r[0] for r in df.select(rules.receipt_offset_flag(*[F.col(c) for c in "estc"])).collect()]
    assert flags == ["Y", "Y", "Y", "Y", "N", "N"]
    assert rows(frame(spark, "s long", (6060,), (9631,), (5,)).select(rules.channel_method(F.col("s")).alias("c"))) == [
        ("FLOW",), ("OTHER",), ("STORAGE",)]


def test_attribution_is_registrable_as_sql_function(spark):
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION half_full(x DOUBLE) RETURNS STRING RETURN IF(x > 0.5, 'Y', 'N')")
    assert spark.sql("SELECT half_full(0.6)").first()[0] == "Y"
