import datetime as dt
import random
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lanewright.operators import calendar, events, joins, reshape, scans, versions
from tests.helpers import d, frame, rows, ts


def log(spark, n=400, seed=3):
    """Rows with NULL keys, NULL times, equal times and one key holding most rows."""
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        key = rnd.choice(["hot", "hot", "hot", "b", None, "c"])
        at = None if rnd.random() < 0.05 else dt.datetime(2024, 1, 1) + dt.timedelta(hours=rnd.randrange(200))
        out.append((key, at, i, rnd.choice([None, rnd.randrange(50)])))
    return frame(spark, "k string, t timestamp_ntz, id long, v long", *out)


def test_chunked_scan_equals_plain_windows(spark):
    df = log(spark)
    options = dict(number="n", running={"s": "v"}, running_order=["t"], prev={"p": "v", "pt": "t"}, next={"x": "id"}, fill={"f": "v"})
    plain = scans.ordered_scan(df, ["k"], ["t", "id"], **options)
    chunked = scans.ordered_scan(df, ["k"], ["t", "id"], chunk=F.to_date("t"), **options)
    assert plain.columns == chunked.columns
    assert rows(plain, "id", "n", "s", "p", "pt", "x", "f") == rows(chunked, "id", "n", "s", "p", "pt", "x", "f")


@pytest.mark.parametrize("fine", [False, True])
@pytest.mark.parametrize("sides", [{"prev": {"p": "v", "pt": "t"}}, {"next": {"v": "v"}}, {"prev": {"p": "id"}, "next": {"q": "v", "qt": "t"}}])
def test_neighbours_equal_plain_windows(spark, sides, fine):
    df = log(spark)
    chunks = [F.to_date("t"), scans.same_moment(F.col("t"), F.col("id"))]
    plain = scans.ordered_scan(df, ["k"], ["t", "id"], **sides)
    cut = scans.ordered_scan(df, ["k"], ["t", "id"], chunk=chunks if fine else chunks[0], **sides)
    assert plain.columns == cut.columns
    assert rows(plain) == rows(cut)


def test_chunked_scan_spreads_a_key(spark):
    scanned = scans.ordered_scan(log(spark), ["k"], ["t", "id"], chunk=F.to_date("t"), number="n")
    plan = scanned._jdf.queryExecution().optimizedPlan().toString()
    # windows by key and chunk, and one by key alone, which sees the chunks' first and last rows
    by = re.findall(r"\], \[(_key#\d+(?:, _chunk#\d+)?)\], \[", plan)
    assert sorted("_chunk" in x for x in by) == [False, True, True]
    alone = plan[plan.index(next(x for x in by if "_chunk" not in x) + "], ["):]
    assert "Filter" in alone.split("Window")[0]


def test_totals_over_groups_nulls(spark):
    df = log(spark)
    got = scans.totals_over(df, ["k"], {"total": F.sum("v"), "ids": F.count_distinct("v")})
    w = Window.partitionBy("k")
    expected = df.select("id", F.sum("v").over(w).alias("total"), F.size(F.collect_set("v").over(w)).cast("long").alias("ids"))
    assert rows(got, "id", "total", "ids") == rows(expected)


def test_exact_percentiles_with_weights(spark):
    df = frame(spark, "g string, v double, n long", ("a", 1.0, 3), ("a", 10.0, 1), ("a", None, 5), ("b", 2.0, 1), ("b", 3.0, 1))
    got = scans.exact_percentiles(df, ["g"], "v", {"p50": 0.5, "p90": 0.9}, weight="n")
    assert [(g, a, round(b, 6)) for g, a, b in rows(got)] == [("a", 1.0, 7.3), ("b", 2.5, 2.9)]


def test_latest_version_keeps_ties_once(spark):
    df = frame(spark, "k string, v long, x string", ("a", 1, "p"), ("a", 2, "q"), ("a", 2, "q"), ("a", 2, "r"),
               (None, 5, "s"), (None, 4, "t"), ("n", None, "u"))
    assert rows(versions.latest_version(df, ["k"], "v")) == [(None, 5, "s"), ("a", 2, "q"), ("a", 2, "r")]
    assert len(rows(versions.latest_version(df, ["k"], "v", distinct=False))) == 4


def test_first_version(spark):
    df = frame(spark, "k string, t long, x string", ("a", 1, "P-1"), ("a", 2, "T"), ("a", 3, "U"), ("b", 9, "P-2"))
    assert rows(versions.first_version(df, ["k"], ["t"])) == [("a", 1, "P-1"), ("b", 9, "P-2")]
    assert rows(versions.first_version(df, ["k"], ["t"], ~F.col("x").like("P-%"))) == [("a", 2, "T")]
    plan = versions.first_version(df, ["k"], ["t"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    both = versions.first_versions(df, ["k"], ["t", "x"], {"any": None, "real": ~F.col("x").like("P-%")})
    assert rows(both, "k", "any.x", "real.x") == [("a", "P-1", "T"), ("b", "P-2", None)]


def test_singleton_only_drops_all_rows_of_a_key(spark):
    df = frame(spark, "load long, day string, x long", (1, "a", 1), (1, "b", 2), (1, "b", 3), (2, None, 4), (None, "a", 5))
    assert rows(versions.singleton_only(df, ["load", "day"], "load")) == [(1, "a", 1), (2, None, 4)]
    with pytest.raises(ValueError):
        versions.singleton_only(df, ["day"], "load")


def test_dense_grid_and_fill(spark):
    days = frame(spark, "cal date", *[(dt.date(2024, 1, 1) + dt.timedelta(days=i),) for i in range(31)])
    facts = frame(spark, "loc long, day date, cap long", (1, d("2024-01-02"), None), (1, d("2024-01-04"), 5), (1, d("2024-01-12"), 7))
    grid = calendar.dense_grid(facts, "loc", "day", days.withColumnRenamed("cal", "day"), "day")
    laid = calendar.sparse_on_grid(grid, facts, ["loc", "day"]).withColumn("dow", F.dayofweek("day"))
    assert laid.count() == 11
    filled = calendar.forward_fill(laid, "cap", ["loc", "dow"], ["day"], "plan")
    plan = {r["day"].day: r["plan"] for r in filled.collect()}
    assert plan == {2: None, 3: None, 4: 5, 5: None, 6: None, 7: None, 8: None, 9: None, 10: None, 11: 5, 12: 7}


def test_neighbour_flag(spark):
    df = frame(spark, "k long, day long, plan long", (1, 1, 3), (1, 2, 0), (1, 3, 4), (1, 4, 5), (1, 5, None), (1, 6, 2),
               (2, 1, 0), (2, 2, 0), (3, 1, None), (3, 2, 0))
    got = calendar.neighbour_flag(df, "plan", ["k"], ["day"], "flag")
    assert rows(got, "k", "day", "flag") == [
        (1, 1, "Y"), (1, 2, "N"), (1, 3, "Y"), (1, 4, "N"), (1, 5, "N"), (1, 6, "N"), (2, 1, "N"), (2, 2, "N"),
        (3, 1, "Y"), (3, 2, "N")]


def test_year_over_year_is_positional_unless_asked(spark):
    months = [(2020, m) for m in range(1, 13)] + [(2021, m) for m in range(2, 13)]
    df = frame(spark, "lane string, y int, m int, v double", *[("a", y, m, float(100 * y + m)) for y, m in months])
    by_row = {(r.y, r.m): r.ly for r in calendar.year_over_year(df, ["lane"], "y", "m", {"ly": "v"}).collect()}
    by_month = {(r.y, r.m): r.ly for r in calendar.year_over_year(df, ["lane"], "y", "m", {"ly": "v"}, True).collect()}
    assert by_row[(2021, 2)] == 202001.0 and by_month[(2021, 2)] == 202002.0
    assert by_row[(2020, 5)] is None and by_month[(2020, 5)] is None


def brute_intervals(points, intervals, closed):
    out = []
    for key, at, pid in points:
        hits = [
            name for k, start, end, name in intervals
            if key is not None and at is not None and k == key and start is not None and start <= at
            and (end is None or (at <= end if closed else at < end))
        ]
        out += [(pid, h) for h in hits] or [(pid, None)]
    return sorted(out, key=str)


@pytest.mark.parametrize("closed", [True, False])
@pytest.mark.parametrize("bucket_hours", [None, 48])
def test_interval_join_against_brute_force(spark, closed, bucket_hours):
    rnd = random.Random(11)
    base = dt.datetime(2020, 1, 1)
    points = [(rnd.choice(["hot", "hot", "b", None]), None if i % 37 == 0 else base + dt.timedelta(minutes=rnd.randrange(600000)), i)
              for i in range(300)]
    intervals = []
    for i in range(120):
        start = base + dt.timedelta(minutes=rnd.randrange(600000))
        length = rnd.choice([0, 30, 59, 60, 61, 960, 5000, 20000, 300000, -10, None])
        end = None if length is None else start + dt.timedelta(minutes=length)
        if bucket_hours and end is None:
            end = start
        intervals.append((rnd.choice(["hot", "b", "c", None]), start, end, i))
    intervals.append(("hot", points[1][1] or base, points[1][1] or base, 999))
    left = frame(spark, "k string, at timestamp_ntz, pid long", *points)
    right = frame(spark, "rk string, s timestamp_ntz, e timestamp_ntz, name long", *intervals)
    got = joins.interval_join(left, right, [("k", "rk")], "at", "s", "e", closed=closed, bucket_hours=bucket_hours)
    assert sorted([tuple(r) for r in got.select("pid", "name").collect()], key=str) == brute_intervals(points, intervals, closed)
    inner = joins.interval_join(left, right, [("k", "rk")], "at", "s", "e", closed=closed, bucket_hours=bucket_hours, how="inner")
    assert inner.count() == sum(h is not None for _, h in brute_intervals(points, intervals, closed))


def test_interval_join_never_loops(spark):
    left = frame(spark, "k string, at timestamp_ntz", ("a", ts("2024-01-01 00:00:00")))
    right = frame(spark, "rk string, s timestamp_ntz, e timestamp_ntz", ("a", ts("2024-01-01 00:00:00"), None))
    plan = joins.interval_join(left, right, [("k", "rk")], "at", "s", "e")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("closed", [True, False])
def test_span_totals(spark, closed):
    rnd = random.Random(9)

    def moment(none):
        return None if rnd.random() < none else dt.datetime(2024, 1, 1) + dt.timedelta(hours=rnd.randrange(100))

    spans = [(i, rnd.choice(["a", "a", "b", None]), moment(0.1), moment(0.3)) for i in range(120)] * 2
    points = [(rnd.choice(["a", "a", "a", "b", "c", None]), moment(0.1), rnd.choice([None, rnd.randrange(9)])) for _ in range(300)]
    got = joins.span_totals(
        frame(spark, "id long, k string, b timestamp_ntz, e timestamp_ntz", *spans), frame(spark, "k string, t timestamp_ntz, v long", *points),
        [("k", "k")], "b", "e", "t", "v", closed=closed)
    expected = []
    for i, k, b, e in spans:
        held = [(t, v) for pk, t, v in points if k is not None and pk == k and b is not None and t is not None and t >= b
                and (e is None or (t <= e if closed else t < e))]
        known = [v for _, v in held if v is not None]
        expected.append((i, k, b, e, len(held), sum(known) if held else None, max((t for t, _ in held), default=None)))
    assert rows(got) == sorted(expected, key=lambda r: [(v is not None, str(type(v)) if v is None else v) for v in r])


@pytest.mark.parametrize("closed", [True, False])
def test_asof_join(spark, closed):
    rnd = random.Random(11)
    base = dt.datetime(2024, 1, 1)
    points = [(i, rnd.choice(["hot", "hot", "b", "c", None]), None if rnd.random() < 0.1 else base + dt.timedelta(hours=rnd.randrange(200)))
              for i in range(300)]
    spans = []
    for k in ("hot", "b", None):
        cuts = sorted(rnd.sample(range(200), 40))
        for n, (a, b) in enumerate(zip(cuts, cuts[1:])):
            spans.append((len(spans), k, base + dt.timedelta(hours=a), None if n == 38 else base + dt.timedelta(hours=rnd.randint(a, b - 1) if closed else rnd.randint(a, b))))
    p = frame(spark, "id long, k string, t timestamp_ntz", *points)
    s = frame(spark, "sid long, sk string, b timestamp_ntz, e timestamp_ntz", *spans)
    got = joins.asof_join(p, s, [("k", "sk")], "t", "b", "e", closed=closed)
    contained = joins.interval_join(p, s, [("k", "sk")], "t", "b", "e", closed=closed)
    assert got.columns == ["id", "k", "t", "sid", "b", "e"]
    assert rows(got) == rows(contained, *got.columns) and got.filter("sid IS NOT NULL").count() > 50
    last = joins.asof_join(p, s.drop("e"), [("k", "sk")], "t", "b")
    assert last.count() == 300 and last.filter("sid IS NULL AND k = 'hot' AND t >= (DATE'2024-01-09')").count() == 0


def test_interval_join_with_many_open_spans(spark):
    points = [(i, "hot" if i % 3 else "b", dt.datetime(2024, 1, 1) + dt.timedelta(hours=i % 50)) for i in range(150)]
    spans = [(100 + i, "hot", dt.datetime(2024, 1, 1) + dt.timedelta(hours=7 * i), None if i % 4 else dt.datetime(2024, 1, 2)) for i in range(12)]
    got = joins.interval_join(
        frame(spark, "id long, k string, t timestamp_ntz", *points), frame(spark, "sid long, sk string, b timestamp_ntz, e timestamp_ntz", *spans),
        [("k", "sk")], "t", "b", "e")
    expected = []
    for i, k, t in points:
        met = [s for s, sk, b, e in spans if sk == k and t >= b and (e is None or t <= e)]
        expected += [(i, s) for s in met or [None]]
    assert rows(got, "id", "sid") == sorted(expected, key=lambda r: (r[0], r[1] is not None, r[1] or 0))


def test_either_key_join(spark):
    left = frame(spark, "id long, win string, usr string", (1, "1", "x"), (2, "9", "u2"), (3, "1", "u1"), (4, "9", "zz"), (5, None, None))
    right = frame(spark, "emp string, ru string, name string", ("1", "u1", "A"), ("7", "u2", "B"), ("1", None, "C"))
    got = joins.either_key_join(left, right, [("win", "emp"), ("usr", "ru")])
    assert rows(got, "id", "name") == [(1, "A"), (1, "C"), (2, "B"), (3, "A"), (3, "C"), (4, None), (5, None)]
    inner = joins.either_key_join(left, right, [("win", "emp"), ("usr", "ru")], how="inner")
    assert inner.count() == 5
    assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()


def test_consolidate(spark):
    modern = frame(spark, "load long, o long, t string, x string", (1, 1, "T1", None), (2, 1, "T2", "m"), (3, 1, None, "m3"))
    legacy = frame(spark, "load long, o long, t string, x string", (10, 1, "T1", "l"), (11, 2, "T9", "l9"), (12, 1, None, "l3"))
    got = joins.consolidate(modern, legacy, ["o", "t"], ["load", "o", "t", "x"], "src", "load")
    assert rows(got) == [
        (1, 1, "T1", "l", "BOTH"), (2, 1, "T2", "m", "MODERN"), (3, 1, None, "m3", "MODERN"), (11, 2, "T9", "l9", "LEGACY"),
        (12, 1, None, "l3", "LEGACY")]


def test_consolidate_keeps_many_to_many_matches(spark):
    a = frame(spark, "load long, o long", (1, 1), (2, 1))
    b = frame(spark, "load long, o long", (7, 1), (8, 1), (9, 1))
    assert joins.consolidate(a, b, ["o"], ["load", "o"]).count() == 6


def test_by_priority(spark):
    df = frame(spark, "a long, b long", (1, 2), (None, 2), (None, None))
    value, label = joins.by_priority([("A", F.col("a")), ("B", F.col("b"))], "v", "src")
    assert rows(df.select(value, label)) == [(None, None), (1, "A"), (2, "B")]


def test_date_window_or_ids(spark):
    base = frame(spark, "load long, trip long, trailer string, lo date, hi date",
                 (1, 1, "T", d("2024-01-01"), d("2024-01-20")), (2, 2, "T", d("2024-02-01"), d("2024-02-02")),
                 (3, 3, "T", None, d("2024-01-05")), (4, 4, "Z", d("2024-01-01"), d("2024-01-02")))
    facts = frame(spark, "fl long, ft long, ftr string, day date, q long",
                  (1, 1, "T", d("2024-01-01"), 1), (9, 9, "T", d("2024-01-20"), 10), (9, 9, "T", d("2024-01-21"), 100),
                  (2, 2, "T", d("2023-06-01"), 1000), (3, 3, "T", d("2024-01-03"), 10000), (2, 2, "Q", d("2024-02-01"), 5))
    got = joins.date_window_or_ids(base, facts, [("trailer", "ftr")], "day", "lo", "hi", [("load", "fl"), ("trip", "ft")])
    totals = rows(got.groupBy("load").agg(F.sum("q").alias("q")))
    # the January window of load 1 also holds the fact of load 3
    assert totals == [(1, 10011), (2, 1000), (3, 10000), (4, None)]


def stays(spark, *data):
    schema = "dc long, trailer string, trip long, gi timestamp_ntz, op timestamp_ntz, cl timestamp_ntz, go timestamp_ntz"
    return frame(spark, schema, *[(1, "T", n, *[ts(x and f"2024-01-{x}") for x in times]) for n, times in enumerate(data, 1)])


@pytest.mark.parametrize("chunked", [True, False])
def test_repair_gaps(spark, chunked):
    df = stays(
        spark,
        ("01 08:00:00", "01 09:00:00", "01 10:00:00", "01 11:00:00"),
        (None, None, "03 10:00:00", "03 11:00:00"),
        ("05 08:00:00", "05 09:00:00", None, None),
        ("07 08:00:00", None, None, "07 09:00:00"),
        ("08 08:00:00", None, None, None),
    )
    got = events.repair_gaps(df, ["dc", "trailer"], "gi", "go", "op", "cl", ["trip"], chunked=chunked)
    assert rows(got, "trip", "gi", "go") == [
        (1, ts("2024-01-01 08:00:00"), ts("2024-01-01 11:00:00")),
        (2, ts("2024-01-01 11:01:00"), ts("2024-01-03 11:00:00")),
        (3, ts("2024-01-05 08:00:00"), ts("2024-01-07 07:59:00")),
        (4, None, None),
    ]


def test_door_window(spark):
    df = stays(
        spark,
        ("01 08:00:00", "01 09:00:00", None, "02 00:00:00"), ("01 08:00:00", "01 09:00:00", None, "09 00:00:00"),
        ("01 08:00:00", None, "01 12:00:00", None), (None, "01 09:00:00", None, "02 00:00:00"),
    )
    got = events.door_window(df, "gi", "go", "op", "cl", "lo", "hi")
    assert rows(got, "trip", "lo", "hi") == [
        (1, ts("2024-01-01 09:00:00"), ts("2024-01-02 00:00:00")), (2, ts("2024-01-06 00:00:00"), ts("2024-01-09 00:00:00")),
        (3, ts("2024-01-01 12:00:00"), ts("2024-01-06 12:00:00")), (4, None, ts("2024-01-02 00:00:00"))]


def test_drop_superseded(spark):
    df = frame(
        spark, "k long, t timestamp_ntz, src string, id long",
        (1, ts("2024-01-01 08:00:00"), "phone", 1), (1, ts("2024-01-01 09:00:00"), "xml", 2),
        (1, ts("2024-01-02 08:00:00"), "phone", 3), (1, ts("2024-01-03 08:00:00"), "web", 4),
        (None, ts("2024-01-01 08:00:00"), "phone", 5), (None, ts("2024-01-01 09:00:00"), "xml", 6),
    )
    got = events.drop_superseded(df, "k", "t", "src", ["xml", "web"], ["id"])
    assert [r[0] for r in rows(got, "id")] == [2, 3, 4, 5, 6]


@pytest.mark.parametrize("chunked", [True, False])
def test_pair_by_position(spark, chunked):
    starts = frame(spark, "k long, i timestamp_ntz, a long", (1, ts("2024-01-01 08:00:00"), 1), (1, ts("2024-01-05 08:00:00"), 2),
                   (1, ts("2024-01-09 08:00:00"), 3), (2, ts("2024-01-01 08:00:00"), 4))
    ends = frame(spark, "k long, o timestamp_ntz", (1, ts("2024-01-01 09:00:00")), (1, ts("2024-01-04 09:00:00")))
    got = events.pair_by_position(starts, ends, "k", "i", "o", ["a"], chunked=chunked)
    last = ts("2024-01-04 09:00:00")
    assert rows(got, "a", "o", "last_o") == [
        (1, ts("2024-01-01 09:00:00"), last), (2, last, last), (3, None, None), (4, None, None)]


def test_segments_do_not_overlap(spark):
    changes = frame(spark, "k long, t timestamp_ntz, old string, new string", (1, ts("2024-01-02 00:00:00"), "a", "b"),
                    (1, ts("2024-01-05 00:00:00"), "b", "c"), (2, ts("2024-01-03 00:00:00"), "x", "y"), (3, ts("2024-01-03 00:00:00"), "p", "q"))
    opening = frame(spark, "ok long, call timestamp_ntz", (1, ts("2024-01-01 00:00:00")), (2, ts("2024-01-01 00:00:00")), (4, ts("2024-01-01 00:00:00")))
    got = events.segments_from_changes(changes, "k", "t", "old", "new", opening, "ok", "call")
    assert rows(got, "k", "segment_start", "segment_end", "value") == [
        (1, ts("2024-01-01 00:00:00"), ts("2024-01-01 23:59:59"), "a"), (1, ts("2024-01-02 00:00:00"), ts("2024-01-04 23:59:59"), "b"),
        (1, ts("2024-01-05 00:00:00"), None, "c"), (2, ts("2024-01-01 00:00:00"), ts("2024-01-02 23:59:59"), "x"),
        (2, ts("2024-01-03 00:00:00"), None, "y"), (3, ts("2024-01-03 00:00:00"), None, "q")]
    # the second before a change belongs to nobody
    points = frame(spark, "pk long, at timestamp_ntz", (1, ts("2024-01-01 23:59:58")), (1, ts("2024-01-01 23:59:59.5")), (1, ts("2024-01-02 00:00:00")))
    held = joins.interval_join(points, got, [("pk", "k")], "at", "segment_start", "segment_end", closed=False)
    assert [r[0] for r in held.orderBy("at").select("value").collect()] == ["a", None, "b"]


def test_precedence_union(spark):
    schema = "id long, k long, i timestamp_ntz, o timestamp_ntz"
    t = [ts(f"2024-01-0{n} 00:00:00") for n in range(1, 8)]
    isp = frame(spark, schema, (1, 10, t[0], t[1]), (2, 11, t[0], None))
    ftm = frame(spark, schema, (3, 10, t[2], t[5]), (4, 20, t[2], t[3]), (5, None, t[2], t[3]))
    ivr = frame(spark, schema, (6, 10, t[4], t[4]), (7, 10, t[6], t[6]), (8, 20, t[4], t[4]), (9, 30, t[0], t[0]), (10, 11, t[6], t[6]), (11, None, None, None))
    got = events.precedence_union([(isp, "all"), (ftm, "absent"), (ivr, "absent_or_later")], "k", "i", "o")
    # ftm rows count for the last end even when the union leaves them out
    assert [r[0] for r in rows(got, "id")] == [1, 2, 4, 5, 7, 8, 9, 11]
    with pytest.raises(ValueError):
        events.precedence_union([(isp, "all"), (ftm, "other")], "k", "i", "o")


def test_status_transitions(spark):
    df = frame(spark, "w long, s string, t timestamp_ntz", (1, "OPEN", ts("2024-01-01 00:59:00")), (1, "WORK", ts("2024-01-01 01:01:00")),
               (1, "DONE", ts("2024-02-01 00:00:00")), (2, "OPEN", ts("2024-01-01 00:00:00")))
    got = events.status_transitions(df, "w", "s", "t")
    assert rows(got, "w", "s", "prev_status", "next_status") == [
        (1, "DONE", "WORK", None), (1, "OPEN", None, "WORK"), (1, "WORK", "OPEN", "DONE"), (2, "OPEN", None, None)]


def test_milestone_pivot(spark):
    df = frame(spark, "k long, e string, t long", (1, "open", 5), (1, "open", 5), (1, "open", 7), (1, "in", 3), (1, "other", 9), (2, "other", 1))
    got = events.milestone_pivot(df, ["k"], "e", "t", {"n": ("count_distinct", ["open"]), "lo": ("min", ["in", "open"]), "hi": ("max", ["open"])})
    assert rows(got, "k", "n", "lo", "hi") == [(1, 2, 3, 7)]


def test_unpivot(spark):
    df = frame(spark, "id long, a string, ap string, b string, bp string, c string, cp string",
               (1, "x", None, None, None, None, "555"), (2, None, None, None, None, None, None))
    got = reshape.unpivot_groups(df, ["id"], [("A", ["a", "ap"]), ("B", ["b", "bp"]), ("B", ["c", "cp"])], ["name", "phone"], "label")
    assert rows(got, "id", "label", "name", "phone") == [(1, "A", "x", None), (1, "B", None, "555")]
    single = reshape.unpivot_columns(df, ["id"], {"a": "A", "b": "B"}, "v", "label")
    assert rows(single) == [(1, "A", "x")]
