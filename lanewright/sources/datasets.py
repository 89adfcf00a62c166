"""Versioned parquet datasets: replace, append, snapshot, upsert, delete, quality rows.

Parquet tables have no MERGE or DELETE. Changes are expressed as DataFrames of the
new content and written as a new version; a row in the dataset's commit log makes it
current. Readers of the previous version are never disturbed, and a failed write
leaves the dataset as it was.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable, Sequence
from functools import reduce
from typing import TypeVar

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanewright.functions.dates import home_date
from lanewright.operators.scans import join_groups, without_match

Result = TypeVar("Result")

_COMMIT_SCHEMA = "version long, committed_at timestamp_ntz, expires_at timestamp_ntz, folder string"


def commits(spark: SparkSession, path: str) -> DataFrame:
    """Commit log: one small row per version ever written."""
    try:
        return spark.read.schema(_COMMIT_SCHEMA).json(f"{path}/commits")
    except AnalysisException:
        return spark.createDataFrame([], _COMMIT_SCHEMA)


def current_version(spark: SparkSession, path: str) -> int | None:
    return commits(spark, path).agg(F.max("version")).first()[0]


def committed_at(spark: SparkSession, path: str) -> dt.datetime | None:
    """When the current version was committed."""
    return commits(spark, path).agg(F.max_by("committed_at", "version")).first()[0]


def add_commit(spark: SparkSession, path: str, row: dict) -> None:
    """Adds a version's row to the log; fails if another writer has committed that version."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    place = hadoop.Path(f"{path}/commits/v{row['version']:08d}.json")
    out = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(place, False)
    out.write(bytearray(json.dumps(row).encode()))
    out.close()


def write_version(
    df: DataFrame, path: str, committed_at: dt.datetime, cluster_by: Sequence[str] = (),
    expires_at: dt.datetime | None = None,
) -> int:
    """Write ``df`` as the new current version of ``path`` and return its number.

    ``cluster_by`` lays the rows out in ranges of those columns, sorted; a hash of the
    row as last range column lets one frequent value span several files.
    """
    spark = df.sparkSession
    version = (current_version(spark, path) or 0) + 1
    if cluster_by:
        spread = F.xxhash64(*[F.col(c) for c in df.columns])
        df = df.repartitionByRange(*[F.col(c) for c in cluster_by], spread).sortWithinPartitions(*cluster_by)
    folder = f"v{version:08d}-{uuid.uuid4().hex[:12]}"  # of this writer alone
    df.write.parquet(f"{path}/{folder}")
    add_commit(spark, path, {
        "version": version, "committed_at": committed_at.isoformat(), "expires_at": expires_at and expires_at.isoformat(), "folder": folder,
    })
    return version


def read_current(spark: SparkSession, path: str) -> DataFrame:
    folder = commits(spark, path).agg(F.max_by("folder", "version")).first()[0]
    if folder is None:
        raise FileNotFoundError(f"no committed version in {path}")
    return spark.read.parquet(f"{path}/{folder}")


def append_rows(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def snapshot_path(base: str, as_of: dt.date) -> str:
    return f"{base}_{as_of:%Y%m%d}"


def snapshot(df: DataFrame, base: str, taken_at: dt.datetime, ttl_days: int = 720) -> str:
    """Copy named after the home-zone day, ``<base>_yyyymmdd``, that expires after ``ttl_days``; returns its path."""
    path = snapshot_path(base, home_date(taken_at))
    write_version(df, path, taken_at, expires_at=taken_at + dt.timedelta(days=ttl_days))
    return path


def purge(spark: SparkSession, path: str) -> list[str]:
    """Deletes the folders of all versions but the current one, and of writers that never committed; returns them.

    For a job that runs when no reader is left that opened an older version, and no writer is at work.
    """
    keep = commits(spark, path).agg(F.max_by("folder", "version")).first()[0]
    base = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    gone = [s.getPath() for s in files.listStatus(base) if s.getPath().getName() not in (keep, "commits")]
    for folder in gone if keep else []:
        files.delete(folder, True)
    return [g.getName() for g in gone] if keep else []


def expired(spark: SparkSession, paths: Sequence[str], as_of: dt.datetime) -> list[str]:
    """Snapshots whose expiry has passed, for the job that removes them."""
    def is_past(path: str) -> bool:
        last = commits(spark, path).agg(F.max_by("expires_at", "version")).first()[0]
        return last is not None and last <= as_of

    return [p for p in paths if is_past(p)]


def merge_upsert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], update: Sequence[str], insert: Sequence[str],
) -> DataFrame:
    """Content of ``target`` after updating matched rows and inserting the others.

    Matched target rows take the ``update`` columns of their source row; target rows
    without source and columns not listed stay. Source rows without target are added
    with the ``insert`` columns. A target row matched by several source rows fails the
    job. NULL keys match nothing.
    """
    taken = sorted(set(update))
    once = source.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(
        F.count(F.lit(1)).alias("_n"), F.any_value(F.struct(*[F.col(c) for c in taken])).alias("_new")
    )
    ambiguous = F.raise_error(F.lit("more than one source row matches a target row")).cast("boolean")
    kept = []
    for name in target.columns:
        if name not in taken:
            kept.append(target[name])
            continue
        new = once["_new"][name].cast(target.schema[name].dataType)
        value = F.when(once["_n"].isNotNull(), new).otherwise(target[name])
        kept.append(value.alias(name))
    met = join_groups(target, once, [(k, f"_k_{k}") for k in keys], "left")
    # a filter, so that a reader of other columns, or of the count, runs the check too
    updated = met.filter(F.when(once["_n"] > 1, ambiguous).otherwise(True)).select(*kept)
    # Only the target keys the source names take part, so a small increment never shuffles the target:
    # Spark then moves the join before the distinct. Otherwise a hot key of the target comes as one row.
    named = source.select(*[F.col(k).alias(f"_s_{k}") for k in keys])
    present = join_groups(target.select(*keys).distinct(), named, [(k, f"_s_{k}") for k in keys], "left_semi")
    fresh = without_match(source, present, [(k, k) for k in keys]).select(
        *[
            (F.col(f.name) if f.name in set(insert) else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in target.schema.fields
        ]
    )
    return updated.unionByName(fresh)


def delete_matching(target: DataFrame, cancelled: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``target`` without the rows whose keys are on the ``cancelled`` list (NULL keys stay)."""
    return without_match(target, cancelled, [(k, k) for k in keys])


def delete_orphans(target: DataFrame, source: DataFrame, key: str, date: str) -> DataFrame:
    """``target`` without rows dated outside the range their key was refreshed with.

    Keys that were not refreshed and rows without a date stay.
    """
    ranges = source.groupBy(F.col(key).alias("_key")).agg(F.min(date).alias("_lo"), F.max(date).alias("_hi"))
    outside = ~target[date].between(ranges["_lo"], ranges["_hi"])
    return join_groups(target, ranges, [(key, "_key")], "left_anti", also=outside)


def quality_row(
    df: DataFrame, key: str, project: str, dataset: str, table: str, last_update: dt.datetime | None, run_at: dt.datetime
) -> DataFrame:
    """One row: known keys, number of keys that occur more than once, table name and times."""
    per_key = df.groupBy(key).agg(F.count(key).alias("_n"))
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("record_cnt"),
        F.count(F.when(F.col("_n") > 1, 1)).alias("duplicate_records"),
    ).select(
        F.lit(project).alias("project_name"),
        F.lit(dataset).alias("dataset_name"),
        F.lit(table).alias("table_name"),
        F.lit(None if last_update is None else last_update.isoformat(sep=" ")).cast("timestamp_ntz").alias("last_update_dt"),
        "record_cnt",
        "duplicate_records",
        F.lit(run_at.isoformat(sep=" ")).cast("timestamp_ntz").alias("run_dt"),
    )


def catalog(spark: SparkSession, folder: str) -> DataFrame:
    """One row per dataset below ``folder``: name, current version, first and last commit.

    One read over the commit rows of all datasets, versioned or by partition.
    """
    rows = spark.read.schema(_COMMIT_SCHEMA).json(f"{folder}/*/commits").select(
        F.element_at(F.split("_metadata.file_path", "/"), -3).alias("table_name"), "version", "committed_at", "expires_at"
    )
    return rows.groupBy("table_name").agg(
        F.max("version").alias("version"), F.min("committed_at").alias("created_at"),
        F.max_by("committed_at", "version").alias("last_update_dt"), F.max_by("expires_at", "version").alias("expires_at"),
    )


def quality_table(
    spark: SparkSession, folder: str, keys: dict[str, str], project: str, dataset: str, run_at: dt.datetime,
) -> DataFrame:
    """A quality row for each of the datasets ``keys`` ({name: key column}) below ``folder``, with its last commit's time."""
    rows = [
        quality_row(read_current(spark, f"{folder}/{name}"), key, project, dataset, name, None, run_at).drop("last_update_dt")
        for name, key in keys.items()
    ]
    every = reduce(lambda a, b: a.unionByName(b), rows)
    return every.join(catalog(spark, folder).select("table_name", "last_update_dt"), "table_name", "left")


def publish_always(build: Callable[[], Result], publish: Callable[[], None]) -> Result:
    """Run ``build``, then ``publish`` whether it succeeded or not; a build error is re-raised."""
    try:
        return build()
    finally:
        publish()
