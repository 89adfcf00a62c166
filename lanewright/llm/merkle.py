"""Merkle manifest of a dataset: digests of rows, a tree per group, proofs, and their folding.

Rows of a group, in order, are the leaves of its tree; every ``FAN`` consecutive nodes
become one, the digest of their digests. The groups' roots, in the groups' order, are the
leaves of the last tree, whose root stands for the dataset.

Rows are numbered by one range partitioning (a number within each partition, and each
partition's offset), so a group of any size is spread. ``BLOCK`` consecutive nodes are a
superblock: a round reduces every superblock of a tree to one node, until each tree is one.
Then the way back: the nodes outside a superblock that its rows' proofs need (the siblings
on the way from the superblock's root to the dataset's, its outer path) are cogrouped with
the superblock's own nodes, and one function reduces these again, joins the proofs and
folds them. No task holds more than a superblock and one outer path.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lanewright.llm.shared import stored

#: Nodes that become one.
FAN = 8
#: Levels of a superblock and its nodes.
LEVELS = 3
BLOCK = FAN**LEVELS
PATH = "array<struct<before:string,after:string>>"


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def leaf(columns: Iterable[Column]) -> Column:
    """Digest of a row: each value as its number of UTF-8 bytes, a colon and its text; ``-`` for null."""
    def field(c: Column) -> Column:
        text = c.cast("string")
        return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))

    return F.sha2(F.concat(*map(field, columns)), 256)


def height(size: int) -> int:
    """Levels from ``size`` leaves to the root."""
    levels = 0
    while size > 1:
        size, levels = -(-size // FAN), levels + 1
    return levels


def reduced(nodes: list[str], levels: int) -> list[list[str]]:
    """The nodes and the ``levels`` above them."""
    out = [nodes]
    for _ in range(levels):
        below = out[-1]
        out.append([digest("".join(below[i : i + FAN])) for i in range(0, len(below), FAN)])
    return out


def siblings(levels: list[list[str]], at: int) -> list[tuple[str, str]]:
    """For each level below the last, the run's digests before and after the node above leaf ``at``, joined."""
    path = []
    for nodes in levels[:-1]:
        start = at - at % FAN
        path.append(("".join(nodes[start:at]), "".join(nodes[at + 1 : start + FAN])))
        at //= FAN
    return path


def folded(claim: str, path: Iterable[tuple[str, str]]) -> str:
    """The root that a leaf and its siblings give."""
    for before, after in path:
        claim = digest(before + claim + after)
    return claim


def numbered(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``pos``, the row's number in its group from 0 by ``order``, and ``size``, the group's rows.

    Rows that are equal in group and order are spread over partitions, too, and numbered in any order.
    """
    count = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [group, *order, "_spread"]
    ranged = rows.withColumn("_spread", F.monotonically_increasing_id()).repartitionByRange(count, *by)
    ranged = ranged.sortWithinPartitions(*by).drop("_spread")
    # partition and number of the row in it, in 31 and 33 bits
    ranged = stored(ranged.withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    sizes = ranged.groupBy(F.col(group).alias("_group"), part.alias("_part")).agg(
        F.min("_at").alias("_first"), F.count("*").alias("_n")
    )  # a row for each partition and group in it
    whole = Window.partitionBy("_group")
    before = F.sum("_n").over(whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_n")
    offsets = sizes.select("_group", "_part", "_first", before.alias("_before"), F.sum("_n").over(whole).alias("size"))
    met = ranged.join(offsets, (ranged[group] == offsets["_group"]) & (part == offsets["_part"]))
    return met.withColumn("pos", F.expr("_before + _at - _first")).drop("_at", "_group", "_part", "_first", "_before")


def rounds(nodes: DataFrame) -> list[DataFrame]:
    """``nodes`` (tree, pos, size, digest), and the superblocks' roots round by round, until each tree is one node."""
    tiers = [nodes]
    largest = nodes.agg(F.max("size")).first()[0] or 0

    def reduce(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("pos")
        size = int(group["size"].iat[0])
        root = reduced(group["digest"].tolist(), min(LEVELS, height(size)))[-1][0]
        at = (group["tree"].iat[0], int(group["pos"].iat[0]) // BLOCK, -(-size // BLOCK), root)
        return pd.DataFrame([at], columns=["tree", "pos", "size", "digest"])

    while largest > 1:
        now = tiers[-1].select("tree", "pos", "size", "digest")
        above = now.groupBy("tree", F.expr(f"pos div {BLOCK}")).applyInPandas(reduce, now.schema)
        tiers.append(stored(above))
        largest = -(-largest // BLOCK)
    return tiers


def joined(nodes: DataFrame, outer: DataFrame, schema: str, finish) -> DataFrame:
    """``finish(node rows, their path lists, outer row)`` for every superblock and its outer path."""
    def run(own: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values("pos")
        levels = reduced(own["digest"].tolist(), min(LEVELS, height(int(own["size"].iat[0]))))
        up = above.iloc[0]
        beyond = [(x["before"], x["after"]) for x in up["path"]]
        return finish(own, [siblings(levels, at) for at in range(len(own))], beyond, up)

    left = nodes.groupBy("tree", F.expr(f"pos div {BLOCK}").alias("_block"))
    right = outer.groupBy("tree", F.col("pos").alias("_block"))
    return left.cogroup(right).applyInPandas(run, schema)


def outer_paths(tiers: list[DataFrame], outer: DataFrame) -> DataFrame:
    """(tree, pos, path, subroot, root) of the nodes of ``tiers[0]``, given those of its last tier."""
    schema = f"tree string, pos bigint, path {PATH}, subroot string, root string"

    def finish(own, paths, beyond, up):
        out = own[["tree", "pos"]].copy()
        out["path"] = [[{"before": a, "after": b} for a, b in path + beyond] for path in paths]
        out["subroot"], out["root"] = up["subroot"], up["root"]
        return out

    for nodes in reversed(tiers[:-1]):
        outer = stored(joined(nodes.select("tree", "pos", "size", "digest"), outer, schema, finish))
    return outer


def manifest(rows: DataFrame, id: str = "doc_id", group: str = "lang", leaf: str = "leaf", claim: str | None = None) -> DataFrame:
    """One row per row of ``rows``: ``id``, ``leaf``, ``subroot``, ``root``, ``proof``, ``folded_root``.

    Leaves of a group ascend by ``id`` (null first; repeated ids by digest), groups by their
    UTF-8 bytes (null is a group, the first one). ``subroot`` is the root of the group's tree, ``root`` that of
    the subroots' tree; a single leaf is its tree's root. ``proof`` joins the digests of the
    leaf's siblings, level by level, from left to right (empty if it has none).
    ``folded_root`` is what the digest in ``claim`` (default: the leaf; also where it is null) gives with those
    siblings: ``root``, unless the claim is another row's. Other columns are left out; no rows give no rows.
    """
    kind = rows.schema[id].dataType.simpleString()
    told = (rows[claim] if claim else F.lit(None)).cast("string")
    # "" stands for the null group, "=..." for the others, in the same order
    tree = F.coalesce(F.concat(F.lit("="), rows[group].cast("string")), F.lit(""))
    leaves = numbered(rows.select(tree.alias("tree"), rows[id].alias("id"), rows[leaf].alias("digest"), told.alias("claim")),
                      "tree", ["id", "digest"])
    # pandas would turn whole numbers beside nulls into floats, but leaves a struct alone
    leaves = leaves.withColumn("id", F.struct("id"))
    tiers = rounds(leaves)
    tops = tiers[-1].select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest")
    groups = rounds(stored(numbered(tops, "tree", ["name"])))
    root = groups[-1].select("tree", "pos", F.expr(f"cast(array() as {PATH})").alias("path"),
                             F.lit("").alias("subroot"), F.col("digest").alias("root"))
    way = outer_paths(groups, root)
    named = groups[0].join(way, ["tree", "pos"])
    outer = named.select(F.col("name").alias("tree"), F.lit(0).cast("bigint").alias("pos"), "path",
                         F.col("digest").alias("subroot"), "root")
    if len(tiers) > 1:
        outer = outer_paths(tiers[1:], outer)

    def finish(own, paths, beyond, up):
        known: dict[str, str] = {}
        out, last = own[["id"]].copy(), "".join(a + b for a, b in beyond)
        out["leaf"], out["subroot"], out["root"] = own["digest"], up["subroot"], up["root"]
        out["proof"] = ["".join(a + b for a, b in path) + last for path in paths]
        roots = []
        for path, told in zip(paths, own["claim"].fillna(own["digest"])):
            told = folded(told, path)
            # from the superblock's root on, most rows fold alike
            if (top := known.get(told)) is None:
                top = known[told] = folded(told, beyond)
            roots.append(top)
        out["folded_root"] = roots
        return out

    # a tree of one leaf has no superblock's root above: its outer path is its own
    schema = f"id struct<id:{kind}>, leaf string, subroot string, root string, proof string, folded_root string"
    found = joined(leaves, outer, schema, finish)
    return found.select(F.col("id.id").alias(id), *found.columns[1:])
