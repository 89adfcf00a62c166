"""Statistics from merged states against those of all rows."""

import datetime as dt
import random
import statistics

from pyspark.sql import functions as F

from lanewright.operators import states
from lanewright.sources import partitions
from tests.helpers import d, frame, rows

NOW = dt.datetime(2024, 1, 31)
SCHEMA = "lane string, day date, hours long"


def shipments(spark, days, n, seed):
    rnd = random.Random(seed)
    return frame(spark, SCHEMA, *[(rnd.choice(["a", "a", "b", None]), d(f"2024-01-{rnd.choice(days):02d}"),
                                   rnd.choice([None, *range(9)])) for _ in range(n)])


def test_increments_equal_all_rows(spark, tmp_path):
    path, points = str(tmp_path / "state"), {"p50": 0.5, "p90": 0.9}
    parts = [shipments(spark, [1, 2, 3], 200, 1), shipments(spark, [3, 4], 100, 2), shipments(spark, [1], 30, 3)]
    for part in parts:
        states.add_rows(spark, path, part, ["lane", "day"], "hours", "day", NOW)
    assert rows(partitions.history(spark, path), "version", "rewritten") == [(1, 3), (2, 2), (3, 1)]
    held = partitions.read(spark, path)
    every = parts[0].unionByName(parts[1]).unionByName(parts[2])
    whole = states.value_counts(every, ["lane", "day"], "hours")
    assert rows(held, "lane", "day", "value", "copies") == rows(whole, "lane", "day", "value", "copies")
    for keys in (["lane"], ["lane", "day"]):
        got = {tuple(r[k] for k in keys): r for r in states.figures(held, keys, points).collect()}
        values = {}
        for r in every.collect():
            if r.hours is not None:
                values.setdefault(tuple(r[k] for k in keys), []).append(r.hours)
        assert set(got) == set(values)
        for key, own in values.items():
            r, own = got[key], sorted(own)
            assert (r.n, r.least, r.most, r["distinct"]) == (len(own), own[0], own[-1], len(set(own)))
            assert abs(r["mean"] - statistics.fmean(own)) < 1e-9 and abs(r.deviation - statistics.pstdev(own)) < 1e-6
            for name, p in points.items():
                at = p * (len(own) - 1)
                low = own[int(at)]
                assert abs(r[name] - (low + (own[min(int(at) + 1, len(own) - 1)] - low) * (at - int(at)))) < 1e-9


def test_no_rows(spark):
    none = shipments(spark, [1], 5, 1).limit(0)
    assert states.figures(states.value_counts(none, ["lane"], "hours"), ["lane"], {"p": 0.5}).count() == 0


def test_distinct_ids_roll_up(spark):
    rnd = random.Random(4)
    rows_ = [(rnd.choice(["a", "b", None]), rnd.randrange(14), rnd.choice([None, rnd.randrange(300), rnd.randrange(10**6), -rnd.randrange(99)]))
             for _ in range(3000)]
    df = frame(spark, "store string, day int, load long", *rows_).withColumn("week", (F.col("day") / 7).cast("int"))
    halves = [states.distinct_state(df.filter(f"load % 2 {sign} 0"), ["store", "week", "day"], "load") for sign in ("=", "<>")]
    daily = states.distinct_merged(halves, ["store", "week", "day"])
    for keys in (["store", "week", "day"], ["store", "week"], ["store"]):
        expected = df.filter("load IS NOT NULL").groupBy(*keys).agg(F.count_distinct("load").alias("n"))
        assert rows(states.distinct_counts(daily, keys, "n")) == rows(expected)


def test_roll_up_moves_no_bitmaps(spark):
    df = spark.range(5000).selectExpr("id % 3 AS store", "id % 4 AS week", "id % 28 AS day", "id * 7 % 900 AS load")
    state = states.distinct_state(df, ["store", "week", "day"], "load", within=["store", "week"])
    counts = states.distinct_counts(state, ["store", "week"], "n")
    assert rows(counts) == rows(df.groupBy("store", "week").agg(F.count_distinct("load").alias("n")))
    plan = states.distinct_merged([state], ["store", "week"])._jdf.queryExecution().sparkPlan().toString()
    final = states.distinct_merged([state], ["store", "week"])._jdf.queryExecution().executedPlan().toString()
    assert "bitmap_or_agg" in plan and final.count("Exchange hashpartitioning") == 2
