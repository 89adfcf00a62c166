"""Datasets partitioned by a date or number: a change reads and writes the partitions it touches.

A writer's files lie in ``<path>/_writer=<name>/<by>=<value>``; the commit row of a version
names, for each partition, the writer whose folder is current. A change writes the touched
partitions into a folder of its own and commits the map with these entries replaced, so the
others are neither read nor written, readers of older versions are not disturbed, and a
failed write leaves the dataset as it was. A read is one scan over the current folders, in
which a filter on the partition column prunes folders.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegralType, StringType, StructField, StructType

from lanewright.operators.scans import join_groups, without_match
from lanewright.sources.datasets import add_commit, merge_upsert

#: Spark's folder name for NULL (a fixed value).
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
WRITER = "_writer"
_STATE = "version long, committed_at timestamp_ntz, by string, columns string, rewritten long, parts array<struct<value:string,writer:string>>"


def history(spark: SparkSession, path: str) -> DataFrame:
    """Commit rows: version, time, and how many partitions it rewrote or dropped (``parts`` is the map)."""
    return spark.read.schema(_STATE).json(f"{path}/commits")


def _state(spark: SparkSession, path: str) -> tuple[int, str, StructType, dict[str | None, str]]:
    """Number, partition column, columns and partition map of the current version."""
    base = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/commits")
    names = [s.getPath().getName() for s in _files(spark, base).listStatus(base) if s.getPath().getName().startswith("v")]
    last = spark.read.schema(_STATE).json(f"{path}/commits/{max(names)}").first()
    return last.version, last.by, StructType.fromJson(json.loads(last.columns)), {p.value: p.writer for p in last.parts}


def _files(spark: SparkSession, place):
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _folder(by: str, value: str | None) -> str:
    return f"{by}={NULL_PARTITION if value is None else value}"


def _write(df: DataFrame, path: str, version: int, by: str, cluster_by: Sequence[str]) -> dict[str | None, str]:
    """Writes the rows' partitions into a new writer's folder and returns its part of the map."""
    spark = df.sparkSession
    if not isinstance(df.schema[by].dataType, DateType | IntegralType):
        raise ValueError("a partition column holds dates or whole numbers")
    writer = f"v{version:08d}-{uuid.uuid4().hex[:12]}"
    # ranges, so that a task has few partitions; the row's hash lets a large one span tasks
    spread = F.xxhash64(*[F.col(c) for c in df.columns])
    laid = df.repartitionByRange(F.col(by), *[F.col(c) for c in cluster_by], spread).sortWithinPartitions(by, *cluster_by)
    laid.write.partitionBy(by).parquet(f"{path}/{WRITER}={writer}")
    base = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{WRITER}={writer}")
    found = [unquote(s.getPath().getName()).partition("=") for s in _files(spark, base).listStatus(base) if s.isDirectory()]
    return {None if value == NULL_PARTITION else value: writer for _, _, value in found}


def _commit(spark: SparkSession, path: str, version: int, at: dt.datetime, by: str, columns: StructType, parts: dict, rewritten: int) -> None:
    listed = [{"value": v, "writer": w} for v, w in sorted(parts.items(), key=lambda p: (p[0] is not None, p[0] or ""))]
    add_commit(spark, path, {
        "version": version, "committed_at": at.isoformat(), "by": by, "columns": columns.json(), "rewritten": rewritten, "parts": listed,
    })


def create(df: DataFrame, path: str, by: str, committed_at: dt.datetime, cluster_by: Sequence[str] = ()) -> None:
    """First version of a dataset partitioned by ``by`` (fails if ``path`` has one)."""
    parts = _write(df, path, 1, by, cluster_by)
    _commit(df.sparkSession, path, 1, committed_at, by, df.schema, parts, len(parts))


def exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` has a dataset by partition."""
    base = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/commits")
    return _files(spark, base).exists(base) and not history(spark, path).filter("by IS NOT NULL").isEmpty()


def read(spark: SparkSession, path: str) -> DataFrame:
    """The current rows, in one scan; a filter on the partition column reads those folders only."""
    _, by, columns, parts = _state(spark, path)
    return _scan(spark, path, by, columns, parts)


def _scan(spark: SparkSession, path: str, by: str, columns: StructType, parts: dict) -> DataFrame:
    if not parts:
        return spark.createDataFrame([], columns)
    folders = [f"{path}/{WRITER}={writer}/{_folder(by, value)}" for value, writer in parts.items()]
    schema = StructType([*columns.fields, StructField(WRITER, StringType())])
    return spark.read.schema(schema).option("basePath", path).parquet(*folders).select(*columns.names)


def _values(rows: DataFrame, by: str) -> list[str | None]:
    """The partitions that rows fall into, as folder values; a list as long as the partitions touched."""
    return [r[0] for r in rows.select(F.col(by).cast("string")).distinct().collect()]


def _replace(spark: SparkSession, path: str, state: tuple, touched: list, rows: DataFrame, at: dt.datetime, cluster_by: Sequence[str]) -> None:
    version, by, columns, parts = state
    kept = {v: w for v, w in parts.items() if v not in set(touched)}
    fresh = _write(rows, path, version + 1, by, cluster_by) if touched else {}
    _commit(spark, path, version + 1, at, by, columns, kept | fresh, len(touched))


def change(
    spark: SparkSession, path: str, source: DataFrame, combine: Callable[[DataFrame, DataFrame], DataFrame],
    committed_at: dt.datetime, cluster_by: Sequence[str] = (),
) -> None:
    """A new version in which every partition that ``source`` has rows of is ``combine(its rows, source)``."""
    state = _state(spark, path)
    _, by, columns, parts = state
    touched = _values(source, by)
    target = _scan(spark, path, by, columns, {v: w for v, w in parts.items() if v in set(touched)})
    _replace(spark, path, state, touched, combine(target, source), committed_at, cluster_by)


def upsert(
    spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str], update: Sequence[str], insert: Sequence[str],
    committed_at: dt.datetime, cluster_by: Sequence[str] = (),
) -> None:
    """``datasets.merge_upsert`` of ``source`` as a new version; the partition column has to be a key.

    Only partitions that ``source`` has rows for can change: these are read, merged and
    written. NULL keys match nothing, so such rows are added.
    """
    by = _state(spark, path)[1]
    if by not in keys or by in update:
        raise ValueError(f"{by} has to be a key that stays")
    change(spark, path, source, lambda target, rows: merge_upsert(target, rows, keys, update, insert), committed_at, cluster_by)


def delete_matching(
    spark: SparkSession, path: str, cancelled: DataFrame, keys: Sequence[str], committed_at: dt.datetime, cluster_by: Sequence[str] = (),
) -> None:
    """A new version without the rows whose ``keys`` are on the ``cancelled`` list (NULL keys stay).

    The list names the partitions if it has their column; else a scan of the key columns finds them.
    """
    same = [(k, f"_c_{k}") for k in keys]
    listed = cancelled.select(*[F.col(k).alias(c) for k, c in same]).distinct()
    by = _state(spark, path)[1]
    rows = read(spark, path)
    if by in keys:
        wanted = [r[0] for r in cancelled.select(by).filter(F.col(by).isNotNull()).distinct().collect()]
        rows = rows.filter(F.col(by).isin(wanted))
    hit = join_groups(rows.select(*dict.fromkeys([*keys, by])), listed, same, "left_semi")
    _rewrite(spark, path, hit, committed_at, cluster_by, lambda part: without_match(part, cancelled, [(k, k) for k in keys]))


def delete_orphans(
    spark: SparkSession, path: str, source: DataFrame, key: str, date: str, committed_at: dt.datetime, cluster_by: Sequence[str] = (),
) -> None:
    """A new version without rows dated outside the range their key was refreshed with.

    A scan of key and date finds the partitions that hold such rows.
    """
    ranges = source.groupBy(F.col(key).alias("_key")).agg(F.min(date).alias("_lo"), F.max(date).alias("_hi"))

    def outside(rows: DataFrame) -> Column:
        return ~rows[date].between(ranges["_lo"], ranges["_hi"])

    by = _state(spark, path)[1]
    thin = read(spark, path).select(*dict.fromkeys([key, date, by]))
    hit = join_groups(thin, ranges, [(key, "_key")], "left_semi", also=outside(thin))
    _rewrite(spark, path, hit, committed_at, cluster_by,
             lambda part: join_groups(part, ranges, [(key, "_key")], "left_anti", also=outside(part)))


def _rewrite(spark: SparkSession, path: str, hit: DataFrame, at: dt.datetime, cluster_by: Sequence[str], change) -> None:
    """Replaces the partitions that ``hit`` has rows of by ``change`` of them; none: no new version."""
    state = _state(spark, path)
    _, by, columns, parts = state
    if touched := _values(hit, by):
        part = _scan(spark, path, by, columns, {v: w for v, w in parts.items() if v in set(touched)})
        _replace(spark, path, state, touched, change(part), at, cluster_by)


def purge(spark: SparkSession, path: str) -> list[str]:
    """Deletes the folders that the current version does not name; for a job that runs when no older reader or writer is left."""
    *_, by, _, parts = _state(spark, path)
    base = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files, gone = _files(spark, base), []
    for writer in (s.getPath() for s in files.listStatus(base) if s.getPath().getName().startswith(f"{WRITER}=")):
        own = {_folder(by, v) for v, w in parts.items() if writer.getName() == f"{WRITER}={w}"}
        stale = [s.getPath() for s in files.listStatus(writer) if s.isDirectory() and unquote(s.getPath().getName()) not in own]
        for folder in [writer] if not own else stale:
            files.delete(folder, True)
            gone.append(f"{writer.getName()}/{folder.getName()}" if own else writer.getName())
    return gone
