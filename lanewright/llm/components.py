"""Connected components of an edge list, by alternating star steps."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from lanewright.llm.shared import stored

#: Edges that a task contracts at a time.
EDGES = 1 << 18


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b), root being the smallest node it reaches.

    Large star: a node's greater neighbours are tied to the least of its neighbourhood.
    Small star: its lesser neighbours, and itself, to the least of them. Edges shrink to
    stars in a number of rounds that grows with the logarithm of the longest path. The
    steps are joins and grouped minima, so a node of any degree is split or pre-aggregated.
    Before they are written, the edges that a task has at hand become stars, which saves rounds.
    """
    kind = edges.schema["a"].dataType.simpleString()
    now, seen = stored(_ordered(edges.select("a", "b").mapInArrow(_stars, f"a {kind}, b {kind}"))), None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").select("b", "m").toDF("a", "b")
        large = _ordered(large)  # a < b: b's lesser neighbours are a
        least = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(least, "b")
        small = small.select(F.col("a"), F.col("m").alias("b")).unionByName(least.select(F.col("b").alias("a"), F.col("m").alias("b")))
        told = Observation()
        after = _ordered(small).mapInArrow(_stars, now.schema)
        after = stored(after.observe(told, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")))
        is_ = told.get
        if is_ == seen:
            break
        now, seen = after, is_
    # every edge now joins a root and one of its nodes
    roots = after.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("root"))
    return roots.unionByName(after.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())


def _ordered(edges: DataFrame) -> DataFrame:
    """Distinct edges with the lesser node first, without loops."""
    return edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stars (least node, node) that join what the edges of a piece join, pieces of ``EDGES`` or one batch."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= EDGES:
            yield _star_forest(held)
            held, size = [], 0
    if size:
        yield _star_forest(held)


def _star_forest(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    edges = pa.Table.from_batches(batches).drop_null()
    ends = np.concatenate([edges.column(c).to_numpy() for c in "ab"])
    names, place = np.unique(ends, return_inverse=True)
    a, b = place[: edges.num_rows], place[edges.num_rows :]
    root, before = np.arange(len(names)), None
    while before is None or (root != before).any():
        before = root.copy()
        least = np.minimum(root[a], root[b])
        # a root that meets a lesser one goes below it, then every node goes to its root's root
        np.minimum.at(root, before[a], least)
        np.minimum.at(root, before[b], least)
        while (root[root] != root).any():
            root = root[root]
    child = np.flatnonzero(root != np.arange(len(names)))
    return pa.RecordBatch.from_arrays([pa.array(names[root[child]]), pa.array(names[child])], names=["a", "b"])
