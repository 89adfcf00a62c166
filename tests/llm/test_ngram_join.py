"""Near copies against comparing all pairs; components against plain search; the prefix rules."""

import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lanewright.llm import ngram_join as op
from lanewright.llm import queries
from lanewright.llm import components as components_module
from lanewright.llm.components import components
from lanewright.llm.shared import stored
from tests.compare import differences
from tests.llm.tables import duck


def shingles(text):
    w = [x for x in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\x0b", " ").split() if x]
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    return sorted(((i, len(sets[k]), least.get(find(k))) for k, (i, _) in enumerate(rows)), key=str)


def corpus(rng, groups=12, alone=60):
    vocab = [f"w{k}" for k in range(400)]
    line = "this line stands in very many of the documents here"
    texts = []
    for _ in range(groups):
        base = rng.choices(vocab, k=rng.choice([4, 6, 12, 40, 150]))
        for _ in range(rng.choice([2, 5, 40])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3, 6])):
                k = rng.randrange(len(copy))
                copy[k : k + rng.choice([0, 1, 1])] = [rng.choice(vocab)] * rng.choice([0, 1, 2])
            texts.append(" ".join(copy) or "x")
    texts += [" ".join(rng.choices(vocab, k=rng.randrange(1, 120))) + " " + line for _ in range(alone)]
    texts += [line] * 5 + [line + " now", line + " then", "", " \t\n", "A b C", "a B c"]
    rng.shuffle(texts)
    return [(k * 3, t) for k, t in enumerate(texts)]


@pytest.mark.parametrize("seed", range(3))
def test_against_all_pairs(spark, seed, monkeypatch):
    monkeypatch.setattr(op, "BLOCK_ROWS", 7)  # several blocks a group
    rows = corpus(random.Random(seed))
    if seed == 2:
        monkeypatch.setattr(op, "SIEVE_LOG2", 8)  # a sieve that lets nearly everything through
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in op.similar(docs).collect()), key=str)
    assert got == brute(rows)
    kept = op.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for i, _, c in got})


sets = st.sets(st.integers(0, 60), min_size=1, max_size=60)


@settings(max_examples=2000, deadline=None)
@given(sets, sets, st.integers(0, 9), st.data())
def test_linked_sets_meet_under_every_order(a, b, drop, data):
    b = (a - set(data.draw(st.lists(st.sampled_from(sorted(a)), max_size=drop)))) | set(list(b)[: drop // 2])
    if 100 * len(a & b) < 80 * len(a | b):
        return
    order = np.random.default_rng(len(a) * 61 + len(b)).permutation(61)
    df = np.random.default_rng(len(a)).integers(2, 5, 61)
    first = [sorted(x, key=lambda t: order[t])[: op.prefix_length(len(x), 80)] for x in (a, b)]
    common = set(first[0]) & set(first[1])
    assert len(common) >= max(op.shared_needed(len(a), 80), op.shared_needed(len(b), 80))
    offers = []
    for x, f in zip((a, b), first):
        extra = [t for t in f if t in common or t % 2]  # some other documents share more of the prefix
        ranked = sorted(extra, key=lambda t: (df[t], order[t]))
        offers.append(set(ranked[: len(extra) - op.shared_needed(len(x), 80) + 1]))
    assert offers[0] & offers[1]
    second = [op.second_prefix(np.array(sorted(x), dtype=np.uint64), 80) for x in (a, b)]
    assert second[0] & second[1]


@pytest.mark.parametrize("seed", range(2))
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(-300, 300), rng.randrange(-300, 300)) for _ in range(250)] + [(k, k + 1) for k in range(1000, 1100)]
    near = {}
    for a, b in edges:
        if a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    expected = {}
    for node in near:
        seen, todo = {node}, [node]
        while todo:
            todo += [x for x in near[todo.pop()] if not (x in seen or seen.add(x))]
        expected[node] = min(seen)
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert len(got) == len(expected) and {r.node: r.root for r in got} == expected
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_frames(spark):
    text = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(5, text), (5, text), (3, text.upper()), (None, text), (None, "alone in the world"), (7, None), (8, ""), (9, "x " * 100_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as component_id", "2 as n", "3 as owner")
    got = sorted((tuple(r) for r in op.similar(docs).collect()), key=str)
    assert got == sorted([(5, 8, 3), (5, 8, 3), (3, 8, 3), (None, 8, 3), (None, 1, None), (7, 0, 7), (8, 0, 8), (9, 1, 9)], key=str)
    assert op.similar(docs.limit(0)).count() == 0
    assert sorted(str(r.doc_id) for r in op.keep_one(docs).collect()) == ["3", "7", "8", "9", "None"]
    clashing = docs.selectExpr("*", "4 as _row", "5 as _row_")
    assert op.keep_one(clashing).columns == clashing.columns and op.keep_one(clashing).count() == 5


def test_keep_one_decides_by_row(spark):
    a, b, c = (" ".join(f"{x}{k}" for k in range(20)) for x in "abc")
    rows = [(1, b), (5, a), (6, a), (5, b), (2, c), (2, c), (3, c), (None, "null one"), (None, "null one"), (4, ""), (4, "")]
    docs = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, place long").repartition(3)
    got = sorted(((r.doc_id, r.text) for r in op.keep_one(docs).collect()), key=str)
    assert got == sorted([(1, b), (5, a), (2, c), (None, "null one"), (4, ""), (4, "")], key=str)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    found = differences(queries.op9_ngram_join(spark, sf), duck(sf), queries.SQL["op9_ngram_join"])
    assert not found, "\n".join(found)


def near_group(size, start, shared=60, own=40):
    """Sets of one group of which hardly two are linked: all share ``shared`` tokens."""
    return [np.unique(np.concatenate([np.arange(shared), start + k * own + np.arange(own)])).astype(np.uint64) for k in range(size)]


@pytest.mark.parametrize("dense", [0, 8, 128])
def test_common_counts(dense, monkeypatch):
    monkeypatch.setattr(op, "DENSE", dense)
    monkeypatch.setattr(op, "COLUMNS", 7)
    monkeypatch.setattr(op, "PAIRS", 50)
    rng = np.random.default_rng(dense)
    left, right = ([np.unique(rng.choice(90, rng.integers(40, 90))).astype(np.uint64) for _ in range(n)] for n in (9, 14))
    right += [left[0], np.arange(1000, 1010, dtype=np.uint64)]
    same = np.array([[len(np.intersect1d(a, b)) for b in right] for a in left])
    both = np.array([[len(np.union1d(a, b)) for b in right] for a in left])
    assert (op.common_counts(left, right) == same).all()
    assert (op.links_between(left, right, 60) == (100 * same >= 60 * both)).all()


def test_group_without_links_moves_once_for_each_large_block(spark, monkeypatch):
    sets = near_group(900, 1000)
    rows = [(7, k, len(x), x.tobytes()) for k, x in enumerate(sets)]
    frame = spark.createDataFrame([(b, k, n, bytearray(x)) for b, k, n, x in rows], "blob long, owner long, n long, tokens binary")

    def counted(percent):
        return lambda group: pa.table({"blob": pa.array([7]), "a": pa.array([group.num_rows]), "b": pa.array([0])})

    monkeypatch.setattr(op, "_compare", counted)
    group = frame.select("blob", "owner", "n")
    moved = sum(r.a for r in op._in_blocks(group, group, frame, 80).collect())
    assert 1800 <= moved <= 3600  # each document as a left and a right one, in 64s it was 27,000


def test_components_of_edges_at_hand_take_two_rounds(spark, monkeypatch):
    written = []
    monkeypatch.setattr(components_module, "stored", lambda df: written.append(1) or stored(df))
    edges = spark.createDataFrame([(k, k + 1) for k in range(300)], "a long, b long").coalesce(1)
    assert {(r.node, r.root) for r in components(edges).collect()} == {(k, 0) for k in range(301)}
    assert len(written) <= 3
