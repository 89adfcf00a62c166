"""Results that several steps read, written to the folder all machines share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """This application's part of the folder named by ``spark.checkpoint.dir``.

    Where that is unset, a session on one machine (``local[...]``, as in tests) gets a new
    folder there; on a cluster it is an error, as its machines share no other folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.conf.get("spark.master", "").startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        folder = _own_folder()
    return f"{folder.rstrip('/')}/corpus-{spark.sparkContext.applicationId}"


@lru_cache(maxsize=1)
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="checkpoints-")


#: Names of the folders within folders that ``settled`` is at work in, outermost first.
_inside: list[str] = []


def new_path(spark: SparkSession) -> str:
    """A path of its own in the shared folder."""
    return "/".join([shared_folder(spark), *_inside, uuid.uuid4().hex])


def settled(spark: SparkSession, build: Callable[[], DataFrame]) -> DataFrame:
    """What ``build`` returns, stored; all that it has stored on the way is deleted."""
    name = uuid.uuid4().hex
    folder = "/".join([shared_folder(spark), *_inside, name])
    try:
        _inside.append(name)
        try:
            result = build()
        finally:
            _inside.pop()
        return stored(result)
    finally:
        _delete(spark, folder)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame) -> DataFrame:
    """The rows of ``df`` written as Parquet and read back; a lost executor costs a read only."""
    path = new_path(df.sparkSession)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def passing(df: DataFrame) -> Iterator[DataFrame]:
    """The rows of ``df``, stored until the block ends."""
    spark, path = df.sparkSession, new_path(df.sparkSession)
    try:
        df.write.option("compression", "zstd").parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        _delete(spark, path)


@contextmanager
def lean(spark: SparkSession) -> Iterator[None]:
    """Within the block an execution's shuffle files go as soon as it has ended, not when the driver next collects garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def clear(spark: SparkSession) -> None:
    """Deletes what ``stored`` wrote in this application; results that still read it must be written first."""
    _delete(spark, shared_folder(spark))
