"""Datasets by partition: what a change reads and writes, and that it equals a whole rewrite."""

import datetime as dt
import os
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lanewright.sources import datasets, partitions
from tests.helpers import d, frame, rows

NOW = dt.datetime(2024, 1, 31, 6)
KEYS, UPDATE, INSERT = ["load_id", "day"], ["status"], ["load_id", "day", "status"]


def target(spark):
    return spark.range(120).select(
        F.col("id").alias("load_id"), F.expr("if(id % 12 = 11, null, date'2024-01-01' + cast(id % 12 as int))").alias("day"),
        F.lit("OLD").alias("status"), F.expr("concat('n', id)").alias("note"),
    )


def increment(spark, day="2024-01-04"):
    return frame(spark, "load_id long, day date, status string", (3, d(day), "NEW"), (15, d(day), "NEW"), (900, d(day), "NEW"))


def files(path):
    return {str(p): os.stat(p).st_mtime_ns for p in Path(path).rglob("*.parquet")}


@pytest.fixture
def path(spark, tmp_path):
    partitions.create(target(spark), str(tmp_path / "plan"), "day", NOW)
    return str(tmp_path / "plan")


def test_one_day_increment_touches_that_day(spark, path, monkeypatch):
    before, scans = files(path), []
    plain = partitions._scan
    monkeypatch.setattr(partitions, "_scan", lambda *a: scans.append(plain(*a)) or scans[-1])
    partitions.upsert(spark, path, increment(spark), KEYS, UPDATE, INSERT, NOW)
    # the only scan of the dataset lists that day's folder
    assert len(scans) == 1 and all("/day=2024-01-04/" in f for f in scans[0].inputFiles())
    after = files(path)
    assert {f: t for f, t in after.items() if f in before} == before
    assert all("/day=2024-01-04/" in f for f in set(after) - set(before)) and set(after) > set(before)
    expected = datasets.merge_upsert(target(spark), increment(spark), KEYS, UPDATE, INSERT)
    assert rows(partitions.read(spark, path), *expected.columns) == rows(expected)
    assert rows(partitions.history(spark, path), "version", "rewritten", F.size("parts")) == [(1, 12, 12), (2, 1, 12)]


def test_filter_prunes_folders(spark, path):
    partitions.upsert(spark, path, increment(spark), KEYS, UPDATE, INSERT, NOW)
    day = partitions.read(spark, path).filter(F.col("day") == d("2024-01-04"))
    scan = next(x for x in day._jdf.queryExecution().executedPlan().toString().split("\n") if "FileScan" in x)
    assert "PartitionFilters: [isnotnull(day" in scan and "2024-01-04" in scan
    assert sorted(r.status for r in day.collect()) == ["NEW"] * 3 + ["OLD"] * 8


def test_null_keys_and_new_days(spark, path):
    source = frame(spark, "load_id long, day date, status string", (11, None, "NEW"), (None, d("2024-02-01"), "NEW"), (5, d("2024-02-01"), "NEW"))
    partitions.upsert(spark, path, source, KEYS, UPDATE, INSERT, NOW)
    expected = datasets.merge_upsert(target(spark), source, KEYS, UPDATE, INSERT)
    assert rows(partitions.read(spark, path), *expected.columns) == rows(expected)


def test_ambiguous_source_changes_nothing(spark, path):
    before = rows(partitions.read(spark, path))
    twice = increment(spark).unionByName(increment(spark))
    with pytest.raises(PySparkException, match="more than one source row"):
        partitions.upsert(spark, path, twice, KEYS, UPDATE, INSERT, NOW)
    assert rows(partitions.read(spark, path)) == before and partitions.history(spark, path).count() == 1


def test_older_version_stays_readable(spark, path):
    first = partitions.read(spark, path)
    partitions.upsert(spark, path, increment(spark), KEYS, UPDATE, INSERT, NOW)
    assert rows(first) == rows(target(spark), *first.columns)
    gone = partitions.purge(spark, path)
    assert len(gone) == 1 and gone[0].endswith("day=2024-01-04")
    assert partitions.read(spark, path).count() == 121


@pytest.mark.parametrize("keys", [["load_id"], ["load_id", "day"]])
def test_delete_matching(spark, path, keys):
    before = files(path)
    cancelled = frame(spark, "load_id long, day date, why string", (3, d("2024-01-04"), "x"), (15, d("2024-01-04"), "y"),
                      (4, d("2024-01-20"), "z"), (None, d("2024-01-02"), "u"))
    expected = datasets.delete_matching(target(spark), cancelled, keys)
    partitions.delete_matching(spark, path, cancelled, keys, NOW)
    assert rows(partitions.read(spark, path), *expected.columns) == rows(expected)
    days = {f.split("/day=")[1][:10] for f in set(files(path)) - set(before)}
    assert days == ({"2024-01-04", "2024-01-05"} if keys == ["load_id"] else {"2024-01-04"})


def test_emptied_partition_and_dataset(spark, path):
    partitions.delete_matching(spark, path, target(spark).filter("load_id % 12 = 3"), ["load_id"], NOW)
    assert "2024-01-04" not in [p.value for p in partitions.history(spark, path).filter("version = 2").first().parts]
    partitions.delete_matching(spark, path, target(spark), ["load_id"], NOW)
    assert partitions.read(spark, path).count() == 0 and partitions.read(spark, path).columns == target(spark).columns
    partitions.upsert(spark, path, increment(spark), KEYS, UPDATE, INSERT, NOW)
    assert partitions.read(spark, path).count() == 3


def test_delete_without_match_keeps_the_version(spark, path):
    partitions.delete_matching(spark, path, frame(spark, "load_id long", (777,)), ["load_id"], NOW)
    assert partitions.history(spark, path).count() == 1


def test_delete_orphans(spark, path):
    refreshed = frame(spark, "load_id long, day date", (3, d("2024-01-05")), (5, d("2024-01-01")), (5, d("2024-01-06")), (11, d("2024-01-01")))
    expected = datasets.delete_orphans(target(spark), refreshed, "load_id", "day")
    before = files(path)
    partitions.delete_orphans(spark, path, refreshed, "load_id", "day", NOW)
    assert rows(partitions.read(spark, path), *expected.columns) == rows(expected)
    assert {f.split("/day=")[1][:10] for f in set(files(path)) - set(before)} == {"2024-01-04"}


def test_number_as_partition_and_refused_columns(spark, tmp_path):
    df = frame(spark, "k int, s string, ts timestamp", (-1, "a b", None), (2, "", None), (None, None, None))
    partitions.create(df, str(tmp_path / "n"), "k", NOW, cluster_by=["s"])
    assert rows(partitions.read(spark, str(tmp_path / "n"))) == rows(df)
    with pytest.raises(ValueError, match="dates or whole numbers"):
        partitions.create(df, str(tmp_path / "s"), "s", NOW)
    with pytest.raises(ValueError, match="has to be a key"):
        partitions.upsert(spark, str(tmp_path / "n"), df, ["s"], ["ts"], ["k"], NOW)
    with pytest.raises(Exception, match="already exists"):
        partitions.create(df, str(tmp_path / "n"), "k", NOW)


def test_empty_start(spark, tmp_path):
    path = str(tmp_path / "e")
    assert not partitions.exists(spark, path)
    partitions.create(target(spark).limit(0), path, "day", NOW)
    assert partitions.exists(spark, path) and partitions.read(spark, path).count() == 0
