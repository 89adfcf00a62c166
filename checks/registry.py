"""Registration of queries with the SQL they are compared to.

A query names its inputs as SELECT statements over the test tables, written in the
part of SQL that Spark and the comparison engine share ({orders} stands for a table).
Spark builds them as DataFrames and hands them to the library; the comparison SQL has
them as common table expressions and expresses the operator on its own.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from lanewright.session import configure

_TABLE = re.compile(r"\{(\w+)\}")


@dataclass(frozen=True)
class Source:
    """Input whose text differs between the two engines."""

    spark: str
    other: str


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; its schema is read from the files once per process."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def _build(spark: SparkSession, sf_dir: str, text: str, known: dict[str, DataFrame]) -> DataFrame:
    names = set(_TABLE.findall(text))
    frames = {n: known[n] if n in known else table(spark, sf_dir, n) for n in names}
    return spark.sql(text, **frames)


def check(name: str, sql: str | None = None, **inputs: str | Source):
    """Register the decorated builder under ``name``.

    Inputs are built in the order given and may refer to earlier ones; the builder
    receives them as keyword arguments.
    """

    def register(build: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            frames: dict[str, DataFrame] = {}
            for key, source in inputs.items():
                text = source.spark if isinstance(source, Source) else source
                frames[key] = _build(spark, sf_dir, text, frames)
            return build(**frames)

        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            parts = [
                f"{key} AS ({_TABLE.sub(r'\1', s.other if isinstance(s, Source) else s)})" for key, s in inputs.items()
            ]
            body = sql.strip()
            if parts and body.upper().startswith("WITH "):
                SQL[name] = "WITH " + ", ".join(parts) + ", " + body[5:]
            else:
                SQL[name] = ("WITH " + ", ".join(parts) + " " if parts else "") + body
        return build

    return register
