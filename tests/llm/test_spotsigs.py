"""Spot signatures against a plain version and against SQL; order of the next document."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from lanewright.llm import queries, spotsigs
from tests.compare import differences
from tests.llm.tables import duck


def plain(text):
    words = re.findall(r"[^\W_]+", text.lower())
    common = {*spotsigs.ANCHORS, *spotsigs.COMMON}
    found = set()
    for k, w in enumerate(words):
        chain = [x for x in words[k + 1 :] if x not in common][: spotsigs.CHAIN]
        if w in spotsigs.ANCHORS and len(chain) == spotsigs.CHAIN:
            found.add(hashlib.md5(" ".join(["", *chain]).encode()).hexdigest()[:8])
    whole = f" {' '.join(words)} " if words else text
    return sorted(found) or [hashlib.md5(f"={whole}".encode()).hexdigest()[:8]]


TEXTS = ["", "...", "the", "The cat is on the mat, and the dog that was there", "the the the cat sat", "Der Hund und die Katze und der Vogel",
         "no anchors here", "the cat", "Été que les garçons", "the a1 b2 the", "is " * 50 + "end it all", "one\n\nthe two\tthree"]


def test_signatures(spark):
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(TEXTS)], "doc_id long, text string")
    got = {r.doc_id: r.fingerprint for r in spotsigs.fingerprints(rows).collect()}
    assert got == {k: plain(t) for k, t in enumerate(TEXTS)}


def test_next_document(spark, monkeypatch):
    monkeypatch.setattr(spotsigs, "CHUNK", 3)
    ids = [None, -20, -7, -7, 0, 1, 2, 3, 4, 5, 100, 101, 5000, 90_000, 90_000, 10**12]
    rows = [(i, f"t{k:02d}") for k, i in enumerate(ids)]
    frame = spark.createDataFrame(rows, "id long, text string")
    got = sorted(((r.text, r.next_text) for r in spotsigs.with_next(frame, ["text"]).collect()))
    texts = [t for _, t in rows]
    assert got == list(zip(texts, [*texts[1:], texts[0]]))


@pytest.mark.parametrize("size", [3, 512])
def test_next_document_by_number(spark, monkeypatch, size):
    """Ids that are strings, lie far apart, or are mostly null."""
    monkeypatch.setattr(spotsigs, "CHUNK", size)
    for kind, ids in (("string", [None, None, "", "-7", "10", "2", "2", "a", "é"]), ("long", [k * 10**15 for k in range(20)]), ("long", [None] * 20 + [5])):
        rows = [(i, f"t{k:02d}") for k, i in enumerate(ids)]
        frame = spark.createDataFrame(rows, f"id {kind}, text string").repartition(4)
        got = sorted((r.text, r.next_text) for r in spotsigs.with_next(frame, ["text"]).collect())
        texts = [t for _, t in rows]
        assert got == list(zip(texts, [*texts[1:], texts[0]]))
    assert spotsigs.with_next(frame.limit(0), ["text"]).count() == 0


def test_string_ids(spark):
    rows = [("b", "The cat is on the mat"), ("a", "and the dog that was there"), (None, None)]
    got = {r.name: r.edited for r in spotsigs.robustness(spark.createDataFrame(rows, "name string, text string"), "name").collect()}
    assert got == {None: "", "a": "and the dog that was The ca"[:20] + "The ca", "b": rows[0][1][:16]}


def test_frames(spark):
    rows = [(1, "The cat is on the mat, and the dog that was there"), (1, "The cat is on the mat, and the dog that was there"),
            (2, None), (3, ""), (None, "É" * 9), (4, "the " * 2_000 + "end of it")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as n_chars", "'x' as print", "2 as id")
    got = spotsigs.robustness(docs).collect()
    assert len(got) == len(rows)
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    expected = []
    for k, (i, t) in enumerate(ordered):
        t, after = t or "", ordered[(k + 1) % len(ordered)][1] or ""
        edited = t[: len(t) - len(t) // 4] + after[: len(t) // 4]
        a, b, c = set(plain(t)), set(plain(edited)), set(plain(after))
        expected.append((i, len(t), edited, sorted(a), sorted(b), len(a & b) / len(a | b), len(a & c) / len(a | c)))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, expected))
    assert spotsigs.robustness(docs.limit(0)).count() == 0
    one = spotsigs.robustness(docs.filter("doc_id = 2")).collect()
    assert [(r.edited, r.near_edited, r.near_next) for r in one] == [("", 1.0, 1.0)]


def test_pruned_likeness(spark):
    row = spark.range(1).select(
        spotsigs.likeness(F.expr("array('a','b','c','d','e')"), F.expr("array('a','b','c','d')"), 0.8).alias("a"),
        spotsigs.likeness(F.expr("array('a','b','c','d','e')"), F.expr("array('a','b','c')"), 0.8).alias("b"),
    ).first()
    assert tuple(row) == (0.8, 0.0)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    found = differences(queries.op8_spotsigs(spark, sf), duck(sf), queries.SQL["op8_spotsigs"])
    assert not found, "\n".join(found)
