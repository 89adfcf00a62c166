"""Manifests against a plain tree, on one list of rows."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from lanewright.llm import merkle, queries
from tests.compare import differences
from tests.llm.tables import duck


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h("".join(levels[-1][i : i + 8])) for i in range(0, len(levels[-1]), 8)])
    return levels


def path(levels, at):
    out = []
    for nodes in levels[:-1]:
        run = at // 8 * 8
        out.append((nodes[run:at], nodes[at + 1 : run + 8]))
        at //= 8
    return out


def plain(rows):
    """(id, leaf, subroot, root, proof, folded) of rows (id, group, leaf, claim)."""
    groups = sorted({r[1] for r in rows}, key=lambda g: (g is not None, (g or "").encode()))
    order = {g: sorted((r for r in rows if r[1] == g), key=lambda r: (r[0] is not None, r[0] or 0, r[2])) for g in groups}
    trees = [tree([r[2] for r in order[g]]) for g in groups]
    top = tree([t[-1][0] for t in trees]) if rows else None
    out = []
    for k, g in enumerate(groups):
        for at, (i, _, own, claim) in enumerate(order[g]):
            way = path(trees[k], at) + path(top, k)
            node = claim or own
            for before, after in way:
                node = h("".join([*before, node, *after]))
            proof = "".join("".join([*before, *after]) for before, after in way)
            out.append((i, own, trees[k][-1][0], top[-1][0], proof, node))
    return sorted(out, key=str)


def found(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, lang string, leaf string, claim string").repartition(3)
    return sorted(map(tuple, merkle.manifest(df, claim="claim").collect()), key=str)


@pytest.mark.parametrize("sizes", [{"a": 1}, {"a": 8}, {"a": 9, None: 3}, {"a": 513, "b": 1, "": 70}, {"a": 5000},
                                   {str(k): 1 + k % 5 for k in range(100)}])
def test_trees(spark, sizes):
    rng = random.Random(1)
    ids = rng.sample(range(2**60, 2**60 + 10**6), sum(sizes.values()))
    rows = []
    for group, n in sizes.items():
        rows += [(ids.pop(), group, h(str(len(rows) + k)), h(f"other {k}") if rng.random() < 0.2 else None) for k in range(n)]
    assert found(spark, rows) == plain(rows)


def test_equal_and_null_ids(spark):
    rows = [(k % 3 or None, "a", h(str(k % 7)), None) for k in range(60)] + [(None, None, h("x"), h("x"))] * 20
    assert found(spark, rows) == plain(rows)


def test_hot_group_is_spread(spark):
    df = spark.range(20_000).select(F.lit(7).alias("id"), F.lit("g").alias("tree"), F.lit("x").alias("digest"))
    pos = merkle.numbered(df, "tree", ["id", "digest"])
    assert pos.agg(F.count_distinct("pos"), F.min("pos"), F.max("pos"), F.min("size"), F.max("size")).first() == (20_000, 0, 19_999, 20_000, 20_000)
    assert len(pos.inputFiles()) > 4


def test_empty_and_clashing(spark):
    df = spark.createDataFrame([("x", "a", "p", 1), ("y", "b", "q", 2)], "name string, kind string, mine string, pos int")
    df = df.selectExpr("*", "1 as size", "2 as tree", "3 as digest", "4 as path", "5 as root")
    got = merkle.manifest(df, "name", "kind", "mine")
    assert got.columns == ["name", "leaf", "subroot", "root", "proof", "folded_root"]
    root = h("pq")
    assert sorted(map(tuple, got.collect())) == [("x", "p", "p", root, "q", root), ("y", "q", "q", root, "p", root)]
    assert merkle.manifest(df.limit(0), "name", "kind", "mine").count() == 0


def test_leaf(spark):
    rows = [(1, "é", None, "a:b"), (None, "", "-", None), (-5, "x" * 100000, "y", "")]
    df = spark.createDataFrame(rows, "a long, b string, c string, d string")
    got = [r[0] for r in df.select(merkle.leaf([df.a, df.b, df.c, df.d])).collect()]
    assert got == [h("".join(map(field, r))) for r in rows]


def test_query_rows(spark, tmp_path):
    rng = random.Random(2)
    rows = [(rng.choice([i, i, None]), rng.choice(["s", None]), rng.choice(["en", "de", None, "É"]), i % 50,
             rng.choice([None, "", "Ab" * (i % 9), "x", "ÄQ"])) for i in range(700)]
    spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    lowered = {i: i + 32 for i in range(65, 91)}
    leaves = []
    for i, source, lang, n, text in rows:
        claim = h("".join(map(field, (i, source, lang, n, text and text.translate(lowered)))))
        changed = i is not None and zlib.crc32(str(i).encode()) % 3 == 0
        leaves.append((i, lang, h("".join(map(field, (i, source, lang, n, text)))), claim if changed else None))
    expected = [(i, leaf, sub, root, h(proof), top, top == root) for i, leaf, sub, root, proof, top in plain(leaves)]
    got = [tuple(r) for r in queries.op12_merkle(spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)
    assert 0 < sum(r[6] for r in got) < len(got)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    wrong = differences(queries.op12_merkle(spark, sf), duck(sf), queries.SQL["op12_merkle"])
    assert not wrong, "\n".join(wrong)
