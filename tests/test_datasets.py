import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lanewright import session
from lanewright.session import clear_staged, staged
from lanewright.sources import datasets
from tests.helpers import d, frame, rows

NOW = dt.datetime(2024, 1, 31, 6)
TARGET = "load_id long, day date, status string, cube double, note string"


def target(spark):
    return frame(spark, TARGET, (1, d("2024-01-01"), "OLD", 1.0, "a"), (2, d("2024-01-01"), "OLD", 2.0, "b"),
                 (2, d("2024-01-02"), "OLD", 3.0, "c"), (None, d("2024-01-01"), "OLD", 4.0, "d"), (1, d("2024-01-01"), "OLD", 9.0, "copy"))


def source(spark, *extra):
    return frame(spark, "load_id long, day date, status string, cube double", (1, d("2024-01-01"), "NEW", None),
                 (3, d("2024-01-03"), "NEW", 7.0), (None, d("2024-01-01"), "NEW", 8.0), *extra)


KEYS, UPDATE, INSERT = ["load_id", "day"], ["status", "cube"], ["load_id", "day", "status", "cube"]


def test_merge_upsert(spark):
    got = datasets.merge_upsert(target(spark), source(spark), KEYS, UPDATE, INSERT)
    assert got.schema.names == target(spark).schema.names
    expected = [
        (None, d("2024-01-01"), "NEW", 8.0, None), (None, d("2024-01-01"), "OLD", 4.0, "d"),
        (1, d("2024-01-01"), "NEW", None, "a"), (1, d("2024-01-01"), "NEW", None, "copy"),
        (2, d("2024-01-01"), "OLD", 2.0, "b"), (2, d("2024-01-02"), "OLD", 3.0, "c"), (3, d("2024-01-03"), "NEW", 7.0, None)]
    assert rows(got) == expected
    again = datasets.merge_upsert(got, source(spark), KEYS, UPDATE, INSERT)
    # NULL keys match nothing, so only that source row is added again
    assert again.filter("load_id IS NOT NULL").count() == got.filter("load_id IS NOT NULL").count()


def test_merge_refuses_ambiguous_sources(spark):
    doubled = source(spark, (1, d("2024-01-01"), "NEWER", 1.0))
    with pytest.raises(PySparkException, match="more than one source row"):
        datasets.merge_upsert(target(spark), doubled, KEYS, UPDATE, INSERT).collect()
    # readers of the count, or of the keys alone, must not pass by the check
    with pytest.raises(PySparkException, match="more than one source row"):
        datasets.merge_upsert(target(spark), doubled, KEYS, UPDATE, INSERT).count()
    with pytest.raises(PySparkException, match="more than one source row"):
        datasets.merge_upsert(target(spark), doubled, KEYS, UPDATE, INSERT).select(KEYS[0]).collect()
    # duplicates that match no target row are inserted, as MERGE does
    unmatched = source(spark, (3, d("2024-01-03"), "TWICE", 1.0))
    assert datasets.merge_upsert(target(spark), unmatched, KEYS, UPDATE, INSERT).filter("load_id = 3").count() == 2


def test_delete_matching(spark):
    cancelled = frame(spark, "load_id long, day date, why string", (2, d("2024-01-02"), "x"), (None, d("2024-01-01"), "y"))
    got = datasets.delete_matching(target(spark), cancelled, KEYS)
    assert [r[0] for r in rows(got, "note")] == ["a", "b", "copy", "d"]


def test_delete_orphans(spark):
    refreshed = frame(spark, "load_id long, day date", (2, d("2024-01-02")), (2, d("2024-01-05")), (7, d("2024-01-01")))
    undated = target(spark).unionByName(frame(spark, TARGET, (2, None, "OLD", 0.0, "undated")))
    got = datasets.delete_orphans(undated, refreshed, "load_id", "day")
    assert [r[0] for r in rows(got, "note")] == ["a", "c", "copy", "d", "undated"]


def test_versions_and_snapshots(spark, tmp_path):
    path = str(tmp_path / "plan")
    assert datasets.current_version(spark, path) is None
    with pytest.raises(FileNotFoundError):
        datasets.read_current(spark, path)
    assert datasets.write_version(target(spark), path, NOW, cluster_by=["load_id"]) == 1
    merged = datasets.merge_upsert(datasets.read_current(spark, path), source(spark), KEYS, UPDATE, INSERT)
    assert datasets.write_version(merged, path, NOW) == 2
    assert datasets.read_current(spark, path).count() == 7
    assert rows(datasets.commits(spark, path), "version") == [(1,), (2,)]

    copy = datasets.snapshot(target(spark), str(tmp_path / "core_data"), NOW)
    assert copy.endswith("core_data_20240131")
    assert datasets.read_current(spark, copy).count() == 5
    due = NOW + dt.timedelta(days=720)
    assert datasets.expired(spark, [copy, path], due - dt.timedelta(seconds=1)) == []
    assert datasets.expired(spark, [copy, path], due) == [copy]


def test_failed_write_leaves_the_dataset(spark, tmp_path):
    path = str(tmp_path / "plan")
    datasets.write_version(target(spark), path, NOW)
    broken = target(spark).withColumn("status", F.raise_error(F.lit("no")).cast("string"))
    with pytest.raises(PySparkException):
        datasets.write_version(broken, path, NOW)
    assert datasets.current_version(spark, path) == 1
    assert datasets.write_version(target(spark).limit(1), path, NOW) == 2
    assert datasets.read_current(spark, path).count() == 1


def test_quality_row_and_append(spark, tmp_path):
    df = frame(spark, "activity_id long", (1,), (1,), (2,), (3,), (3,), (None,), (None,))
    row = datasets.quality_row(df, "activity_id", "p", "s", "activity", NOW, NOW + dt.timedelta(hours=1))
    got = row.first()
    assert (got.record_cnt, got.duplicate_records, got.table_name, got.last_update_dt) == (5, 2, "activity", NOW)
    path = str(tmp_path / "qa")
    datasets.append_rows(row, path)
    datasets.append_rows(row, path)
    assert spark.read.parquet(path).count() == 2
    empty = datasets.quality_row(df.limit(0), "activity_id", "p", "s", "activity", None, NOW).first()
    assert (empty.record_cnt, empty.duplicate_records) == (0, 0)


def test_publish_always():
    done = []
    assert datasets.publish_always(lambda: 5, lambda: done.append("ok")) == 5

    def fail():
        raise RuntimeError("build")

    with pytest.raises(RuntimeError, match="build"):
        datasets.publish_always(fail, lambda: done.append("after error"))
    assert done == ["ok", "after error"]


def test_staged(spark, tmp_path, monkeypatch):
    df = target(spark)
    monkeypatch.setattr(session, "shared_folder", lambda _: None)
    assert staged(df) is df
    monkeypatch.setattr(session, "shared_folder", lambda _: str(tmp_path))
    assert rows(staged(df)) == rows(df) and staged(df).schema == df.schema
    clear_staged(spark)
    assert not list(tmp_path.glob("staged*"))


def test_writers_do_not_overwrite_each_other(spark, tmp_path, monkeypatch):
    path, now = str(tmp_path / "t"), dt.datetime(2024, 1, 1)
    datasets.write_version(spark.range(3), path, now)
    monkeypatch.setattr(datasets, "current_version", lambda *_: 0)  # a writer that started before that commit
    with pytest.raises(Exception, match="exist"):
        datasets.write_version(spark.range(9), path, now)
    monkeypatch.undo()
    assert datasets.read_current(spark, path).count() == 3
    datasets.write_version(spark.range(5), path, now)
    assert len(datasets.purge(spark, path)) == 2
    assert datasets.read_current(spark, path).count() == 5
