"""Spark session settings the library relies on, and staging of intermediate results."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Civil times are TIMESTAMP_NTZ; comparing and truncating them goes through the
# session zone, so the session has to run in UTC.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot key of a join even where the next step then needs a shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # a hot key of well packed rows takes many times its shuffled size once it is sorted
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64MB",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # narrow rows take some 25 times their shuffled size in a task's sorts and aggregates
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32MB",
    "spark.ui.enabled": "false",
}

# what may still be set on a running session
_RUNTIME = [name for name in SETTINGS if name.startswith("spark.sql.")]

def build_session(app: str, master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **settings}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def configure(spark: SparkSession) -> SparkSession:
    """Apply the SQL settings to a session somebody else built."""
    for name in _RUNTIME:
        spark.conf.set(name, SETTINGS[name])
    return spark


def shared_folder(spark: SparkSession) -> str | None:
    """Folder that all machines share: the one the session names in ``spark.checkpoint.dir``, or none."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return folder.rstrip("/") if folder else None


def staged(df: DataFrame) -> DataFrame:
    """Write an intermediate result to the shared folder and read it back.

    For results several later steps read: they are computed once, a lost executor costs a
    re-read instead of a recomputation, and the reader prunes columns and sees real sizes.
    Only a session that names a shared folder stages; others, on any master, do not.
    """
    folder = shared_folder(df.sparkSession)
    if folder is None:
        return df
    path = f"{folder}/staged-{df.sparkSession.sparkContext.applicationId}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_staged(spark: SparkSession) -> None:
    """Deletes what this application has staged, once the results that read it are written."""
    if folder := shared_folder(spark):
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/staged-{spark.sparkContext.applicationId}")
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
