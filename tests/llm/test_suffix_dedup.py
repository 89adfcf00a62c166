"""Repeated strings against a plain count of all of them."""

import random
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lanewright.llm import queries
from lanewright.llm import suffix_dedup as op
from lanewright.llm.shared import shared_folder
from lanewright.llm.sieve import LOG2, Sieve
from tests.compare import differences
from tests.llm.tables import duck


def brute(texts, length):
    texts = [(t or "").encode() for t in texts]
    seen = Counter(t[k : k + length] for t in texts for k in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 1, dtype=bool)
        for k in range(len(t) - length + 1):
            if seen[t[k : k + length]] > 1:
                gone[k : k + length] = True
        edges = np.flatnonzero(np.diff(np.concatenate([[False], gone]).astype(int)))
        out.append((len(t), list(zip(edges[::2].tolist(), edges[1::2].tolist())), bytes(b for b, g in zip(t, gone) if not g)))
    return out


def corpus(seed):
    rng = random.Random(seed)
    letters = "abcdefgh é"

    def some(n):
        return "".join(rng.choices(letters, k=n))

    passages = [some(n) for n in (30, 39, 40, 41, 60, 200)]
    texts = ["", None, "a", "a" * 39, "a" * 40, "ab" * 60, "x" * 500]
    for _ in range(40):
        body = [some(rng.randrange(0, 80)) for _ in range(3)]
        texts.append(body[0] + rng.choice(passages) + body[1] + rng.choice(passages) + body[2])
    base = some(400)
    for _ in range(12):
        copy = list(base)
        for _ in range(rng.randrange(4)):
            copy[rng.randrange(len(copy))] = "z"
        texts.append("".join(copy))
    return texts + [base, base]


@pytest.mark.parametrize("seed,log2", [(0, 14), (2, 8)])
def test_against_counting(spark, seed, log2):
    texts = corpus(seed)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_bytes, [tuple(s) for s in r.spans], bytes(r.kept)) for r in op.repeats(docs, length=40, log2=log2).collect()}
    assert got == dict(enumerate(brute(texts, 40)))


def test_segments(monkeypatch):
    rng = random.Random(9)
    text = bytes(rng.choices(b"abc", k=3000))
    whole = list(op.Radix(40).anchors(text))
    monkeypatch.setattr(op, "SEGMENT", 256)
    cut = list(op.Radix(40).anchors(text))
    place = [np.repeat(np.concatenate([a.at for a in x]), np.concatenate([a.high - a.low + 1 for a in x])) for x in (whole, cut)]
    assert place[0].tolist() == place[1].tolist() and len(place[0]) == 2961


def test_anchors_do_not_depend_on_the_company(monkeypatch):
    monkeypatch.setattr(op, "SEGMENT", 64)
    rng = random.Random(4)
    text, radix = bytes(rng.choices(b"abc", k=400)), op.Radix(40)

    def groups(before):
        ends = np.array([len(before), len(before) + len(text)])
        every = [(a.at[k] - len(before), a.low[k] - len(before), a.high[k] - len(before), a.gram[k])
                 for a in radix.anchors(before + text, ends) for k in range(len(a.at))]
        return [g for g in every if g[1] >= 0]

    alone = groups(b"")
    assert sum(high - low + 1 for _, low, high, _ in alone) == 361
    for n in range(1, 130, 7):
        assert groups(bytes(rng.choices(b"abc", k=n))) == alone


def test_texts_in_another_order(spark):
    """Texts of many segments that a join's shuffle brings into other batches than the passes saw."""
    rng = random.Random(5)
    passages = ["".join(rng.choices("abcdefgh", k=70)) for _ in range(60)]
    texts = [
        "".join(rng.choice(passages)[rng.randrange(30) : rng.randrange(36, 70)] + str(rng.random()) for _ in range(100))
        for _ in range(70)
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = {r.doc_id: (r.n_bytes, [tuple(s) for s in r.spans], bytes(r.kept)) for r in op.repeats(docs, length=40).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == dict(enumerate(brute(texts, 40)))


@settings(max_examples=200, deadline=None)
@given(st.text("ab", min_size=12, max_size=60), st.integers(0, 20), st.integers(0, 20))
def test_equal_strings_have_equal_anchors(text, left, right):
    data, radix = text.encode(), op.Radix(12)
    other = b"c" * left + data + b"d" * right

    def distance(t):
        return np.concatenate([np.repeat(a.at, a.high - a.low + 1) - np.arange(a.low[0], a.high[-1] + 1) for a in radix.anchors(t)])

    assert distance(data).tolist() == distance(other)[left : left + len(data) - 11].tolist()


def test_sieve_loses_nothing(spark):
    keys = spark.range(4000).selectExpr("xxhash64(id) a", "xxhash64(id, 1) b", "id % 3 = 0 as member")
    rows = keys.toPandas()
    for log2 in (20, 8):
        sieve = Sieve.of(keys.filter("member"), log2)
        passed = sieve.holds(rows.a.to_numpy(), rows.b.to_numpy())
        assert passed[rows.member].all()
    assert passed.all() and not Sieve.of(keys.limit(0), 20).holds(rows.a.to_numpy(), rows.b.to_numpy()).any()


def test_sieves_have_room_for_their_keys(spark):
    """A sieve of a fixed size is full at some corpus size, and then all suffixes go on to the last digit."""
    assert Sieve.log2_for(1000) == LOG2 and 8 <= 2 ** Sieve.log2_for(50_000_000) / 50_000_000 < 16
    rows = spark.range(40_000).selectExpr("xxhash64(id) AS a", "xxhash64(id, 1) AS b", "id < 20000 AS member")
    sieve = Sieve.sized(rows.filter("member"), least=8)
    rows = rows.toPandas()
    passed = sieve.holds(rows.a.to_numpy(), rows.b.to_numpy())
    assert passed[rows.member].all() and passed[~rows.member].mean() < 0.05


def test_what_the_passes_move_goes(spark):
    """After the passes only the strings' places are on disk: no shuffle files, no keys, no strings."""
    rows = spark.createDataFrame([(t,) for t in corpus(3)], "text string").repartition(3)
    disk = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()

    def there():
        names = disk.getAllFiles().mkString(" ").split()
        folder = Path(shared_folder(spark).removeprefix("file://"))
        return {x for x in names if "shuffle_" in x}, {str(x) for x in folder.rglob("part-*.parquet")}

    before = there()
    places = op.sort_passes(rows, 40)[1]
    shuffled, stored = (after - was for after, was in zip(there(), before))
    assert not shuffled
    assert stored == {x.removeprefix("file://") for x in places.inputFiles()}


def test_frames(spark):
    text = "".join(random.Random(1).choices("abcdefgh ", k=900))
    rows = [(1, text), (1, text), (2, None), (None, "short"), (4, "start " + text[100:600])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as spans", "2 as kept", "3 as id")
    got = sorted(((r.doc_id, r.n_bytes, len(r.kept)) for r in op.repeats(docs).collect()), key=str)
    assert got == sorted([(1, 900, 0), (1, 900, 0), (2, 0, 0), (None, 5, 5), (4, 506, 6)], key=str)
    assert op.repeats(docs.limit(0)).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    found = differences(queries.op4_suffix_dedup(spark, sf), duck(sf), queries.SQL["op4_suffix_dedup"])
    assert not found, "\n".join(found)


@pytest.mark.parametrize("reach", [1, 2, 3, 8, 13, 31])
def test_least_of_each_window(reach):
    radix = op.Radix(40)
    radix.reach = reach
    for n in (reach, reach + 1, reach + 50):
        values = np.random.default_rng(n).integers(0, 99, n).astype(np.uint64)
        assert radix.least(values).tolist() == [values[k : k + reach].min() for k in range(n - reach + 1)]


def test_segments_look_only_at_the_ends_near_them(monkeypatch):
    radix, seen, real = op.Radix(40), [], np.clip
    radix.segment = 1000
    data = bytes(random.Random(2).choices(range(97, 105), k=60_000))
    ends = np.arange(60, 60_001, 60)
    monkeypatch.setattr(np, "clip", lambda x, *a, **k: seen.append(len(x)) or real(x, *a, **k))
    found = list(radix.anchors(data, ends))
    inside = np.concatenate([op.spread(a.low, a.high) for a in found])
    assert sorted(set(inside.tolist())) == [k for k in range(60_000) if k % 60 <= 20]
    assert sum(seen) < 6 * len(ends)  # every segment looked at every end: 60 times as many
