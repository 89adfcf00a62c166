"""Hot keys: joins are split by Spark, scans and aggregations never gather a key."""

import contextlib
import datetime as dt

import pytest
from pyspark.sql import functions as F

from checks import QUERIES
from lanewright.operators import events, joins, scans
from lanewright.plans import trailer_plan
from lanewright.session import SETTINGS
from lanewright.sources import datasets

SF_DIR = "/root/testdata/sf0.01"
SMALL = {
    "spark.sql.shuffle.partitions": "64",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8KB",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}


@contextlib.contextmanager
def settings(spark, **values):
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture
def lines(spark):
    """A third of the rows under key 0, a third under NULL, in many map tasks."""
    df = spark.read.parquet(f"{SF_DIR}/lineitem.parquet").repartition(16)
    key = F.when(F.col("l_returnflag") == "R", F.lit(0)).when(F.col("l_returnflag") == "A", F.col("l_orderkey") + 1)
    return df.select(
        key.alias("k"), F.col("l_shipdate").alias("at"), F.monotonically_increasing_id().alias("id"),
        F.col("l_quantity").alias("units"), F.col("l_shipdate").cast("date").alias("day"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("line"))


def executed(df) -> str:
    df.toArrow()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_group_results_join_back_split(spark, lines):
    with settings(spark, **SMALL):
        assert "skew=true" in executed(scans.totals_over(lines, ["k"], {"n": F.sum("units")}))


def test_upsert_splits_a_hot_target_key(spark, lines):
    source = spark.createDataFrame([(0, 5.0), (7, 6.0), (-1, 7.0)], "k long, units double")
    with settings(spark, **SMALL):
        merged = datasets.merge_upsert(lines, source, ["k"], ["units"], ["k", "units"])
        assert "skew=true" in executed(merged)
        assert merged.filter("units = 5.0 AND k = 0").count() == lines.filter("k = 0").count()


def test_precedence_splits_a_hot_key(spark, lines):
    visits = lines.select("id", "k", F.col("at").alias("i"), (F.col("at") + F.expr("INTERVAL 1 HOUR")).alias("o"))
    trusted = visits.filter("id % 2 = 0").withColumn("i", F.col("i") - F.expr("INTERVAL 9000 DAYS"))
    with settings(spark, **SMALL):
        out = events.precedence_union([(trusted, "all"), (visits, "absent_or_later")], "k", "i", "o")
        assert "skew=true" in executed(out)


def test_short_windows_split_one_day_of_a_hot_key(spark, lines):
    """A third of all points under one key on one day: the bucket's points are split over tasks."""
    points = lines.withColumn("at", F.expr("if(k = 0, timestamp_ntz'2024-01-05 10:00:00', cast(at as timestamp_ntz))"))
    stays = spark.createDataFrame(
        [(0, dt.datetime(2024, 1, 5, 9), dt.datetime(2024, 1, 5, 12)), (0, dt.datetime(2024, 1, 4), dt.datetime(2024, 1, 5, 10)),
         (7, dt.datetime(1995, 1, 1), dt.datetime(1995, 1, 5))], "sk long, b timestamp_ntz, e timestamp_ntz")
    with settings(spark, **SMALL):
        out = joins.interval_join(points, stays, [("k", "sk")], "at", "b", "e", bucket_hours=120)
        assert "skew=true" in executed(out)
        assert out.filter("k = 0 AND b IS NOT NULL").count() == 2 * points.filter("k = 0").count()


def test_either_key_splits_a_hot_value(spark, lines):
    people = spark.createDataFrame([(0, -1, "a"), (0, -2, "b"), (5, -3, "c")], "emp long, other long, name string")
    with settings(spark, **SMALL):
        out = joins.either_key_join(lines.select("k", "line"), people, [("k", "emp"), ("line", "other")])
        assert "skew=true" in executed(out)
        hot = lines.filter("k = 0").count()
        assert out.filter("k = 0").count() == 2 * hot and out.filter("k IS NULL").count() == lines.filter("k IS NULL").count()


def test_consolidation_splits_either_side(spark, lines):
    few = spark.createDataFrame([(0, "a"), (0, "b"), (5, "c"), (None, "d")], "k long, note string")
    many = lines.select("k", "id")
    with settings(spark, **SMALL):
        for primary, secondary in ((few, many), (many, few)):
            out = joins.consolidate(primary, secondary, ["k"], ["k", "id", "note"])
            assert "skew=true" in executed(out)
            hot, null = many.filter("k = 0").count(), many.filter("k IS NULL").count()
            assert out.filter("k = 0").count() == 2 * hot and out.filter("k IS NULL").count() == null + 1


def test_scan_shuffles_the_detail_once(spark, lines):
    with settings(spark, **SMALL, **{"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        out = scans.ordered_scan(
            lines, ["k"], ["at", "id"], chunk=F.to_date("at"), number="n", prev={"p": "id"}, fill={"f": "units"}, running={"s": "units"})
        plan = executed(out)
        shuffles = [x for x in plan.split("\n") if "Exchange hashpartitioning" in x and "ReusedExchange" not in x]
        assert len(shuffles) == 3 and "ReusedExchange" in plan and "SortAggregate" not in plan, plan
        assert plan.count("FileScan") == 1
        sizes = out.groupBy(F.spark_partition_id()).count().agg(F.max("count"), F.sum("count")).first()
        assert sizes[0] < sizes[1] / 5


@pytest.mark.parametrize("at", ["TIMESTAMP_NTZ'2024-01-05 10:00:00'", "cast(null as timestamp_ntz)"])
def test_neighbours_of_one_moment_are_spread(spark, lines, at):
    """All rows of the hot key at one time, or without one: no task has more than a small part of them."""
    moment = lines.withColumn("at", F.expr(f"if(k = 0, {at}, cast(at as timestamp_ntz))"))
    chunks = [F.to_date("at"), scans.same_moment(F.col("at"), F.col("line"))]
    neighbours = dict(prev={"p": "id"}, next={"q": "units"})
    with settings(spark, **SMALL, **{"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        out = scans.ordered_scan(moment, ["k"], ["at", "line"], chunk=chunks, **neighbours)
        plan = executed(out)
        assert "ReusedExchange" in plan and "SortAggregate" not in plan
        hot = out.filter("k = 0").groupBy(F.spark_partition_id()).count().agg(F.max("count"), F.sum("count")).first()
        assert hot[0] < hot[1] / 5
        plain = scans.ordered_scan(moment, ["k"], ["at", "line"], **neighbours)
        assert out.exceptAll(plain).count() == 0 and out.count() == plain.count()


def test_repair_of_gaps_shuffles_little(spark):
    stays = spark.range(1000).selectExpr(
        "id % 7 as dc", "cast(id % 5 as string) as trailer", "id as trip",
        *(f"timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, id % 9, {h}) as {c}" for h, c in enumerate(("gi", "op", "cl", "go"))))
    with settings(spark, **SMALL):
        plan = executed(events.repair_gaps(stays, ["dc", "trailer"], "gi", "go", "op", "cl", ["trip"]))
    shuffles = [x for x in plan.split("\n") if "Exchange " in x and "ReusedExchange" not in x]
    assert len(shuffles) <= 5 and "SortAggregate" not in plan, plan


def test_first_versions_combine_before_the_shuffle(spark):
    history = spark.read.parquet(f"{SF_DIR}/lineitem.parquet").select(
        F.lit(1).cast("long").alias("load_id"), F.lit("T").alias("trailer_id"), F.lit(dt.date(2020, 1, 1)).cast("timestamp_ntz").alias("create_ts_utc"),
        F.col("l_shipdate").alias("ready_ts_utc"), F.col("l_shipdate").alias("last_change_ts_utc"), F.lit("OPEN").alias("load_status"),
        F.lit("STR").alias("freight_category_code"))
    plan = trailer_plan.assigned_versions(history)._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan


def test_small_increment_never_shuffles_the_target(spark):
    target = spark.read.parquet(f"{SF_DIR}/orders.parquet").select("o_orderkey", "o_orderstatus")
    source = spark.read.parquet(f"{SF_DIR}/supplier.parquet").select(
        F.col("s_suppkey").alias("o_orderkey"), F.lit("X").alias("o_orderstatus"))
    merged = datasets.merge_upsert(target, source, ["o_orderkey"], ["o_orderstatus"], ["o_orderkey", "o_orderstatus"])
    plan = executed(merged)
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") >= 2
    assert merged.filter("o_orderstatus = 'X'").count() == source.count() and merged.count() == target.count()


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString().splitlines()


def test_technicians_in_charge_are_joined_last(spark):
    """A work order has many technicians: no later join shuffles the rows that this makes."""
    with settings(spark, **SMALL):
        joined = [line for line in plan_of(QUERIES["workorder_sla"](spark, SF_DIR)) if "Join " in line]
    assert "_k_location_id" in joined[0]


def test_work_orders_are_worked_out_before_they_meet_their_technicians(spark):
    """What a work order has by itself is computed once, not for each technician in charge."""
    with settings(spark, **SMALL, **{"spark.sql.debug.maxToStringFields": "500"}):
        above = plan_of(QUERIES["workorder_sla"](spark, SF_DIR))[0]
    assert above.startswith("Project") and "sla_status" in above
    assert "CASE WHEN" not in above and above.count("(") == 1  # what no technician is called


def test_merge_compares_distinct_target_keys(spark):
    target = spark.read.parquet(f"{SF_DIR}/lineitem.parquet").selectExpr("l_orderkey AS k", "l_partkey AS v")
    source = spark.range(5, 9).selectExpr("id AS k", "id AS v")

    def sides():
        lines = plan_of(datasets.merge_upsert(target, source, ["k"], ["v"], ["k", "v"]))
        at = next(i for i, line in enumerate(lines) if "Join LeftSemi" in line)
        return "".join(lines[at - 2 : at]), lines[at + 1]

    with settings(spark, **SMALL):
        assert "Aggregate" in sides()[1]
    # a small source is still compared where the target's rows are, before any shuffle of them
    assert "Aggregate" not in sides()[1] and "Aggregate" in sides()[0]


def test_hot_partitions_are_split_early():
    least = SETTINGS["spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes"]
    assert int(least.removesuffix("MB")) <= 64


def test_outbound_reads_its_lines_once(spark):
    plan = plan_of(QUERIES["outbound_union_all"](spark, SF_DIR))
    assert sum("Relation [l_orderkey" in line for line in plan) == 1


def test_partitions_are_filled_to_half_of_what_spark_would():
    size = SETTINGS["spark.sql.adaptive.advisoryPartitionSizeInBytes"]
    assert int(size.removesuffix("MB")) <= 32
