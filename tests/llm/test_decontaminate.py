"""Suffix-array search against plain window search."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st

from lanewright.llm import decontaminate as op
from lanewright.llm import queries
from tests.compare import differences
from tests.llm.tables import duck

EMPTY = "doc_id long, text string"


def brute(texts, items, window):
    wanted = []
    for name, text in items:
        w = op.word_list((text or "").encode())
        if w:
            n = min(window, len(w))
            wanted.append((name, n, {tuple(w[k : k + n]) for k in range(len(w) - n + 1)}))
    out = []
    for text in texts:
        w, hit, names = op.word_list((text or "").encode()), set(), set()
        for name, n, windows in wanted:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit |= set(range(k, k + n))
                    names.add(name)
        out.append((len(w), hit, sorted(names)))
    return out


def check(texts, items, window):
    block = op.Items([n for n, _ in items], [(t or "").encode() for _, t in items], window)
    got = op.hits([(t or "").encode() for t in texts], block)
    for one, (words, hit, names) in zip(got, brute(texts, items, window), strict=True):
        assert one.words == words
        assert {k for a, b in one.spans for k in range(a, b)} == hit
        assert sorted(one.items) == names


words = st.lists(st.sampled_from("a b c d e".split()), max_size=30).map(" ".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(words, max_size=6), st.lists(words, max_size=5), st.integers(1, 6))
def test_any(texts, items, window):
    check(texts, [(str(k), t) for k, t in enumerate(items)], window)


def test_many_words():
    """More words than fit several times into a key, and long items."""
    rng = random.Random(3)
    vocab = [f"w{k}" for k in range(70_000)]
    items = [(str(k), " ".join(rng.choices(vocab, k=rng.randrange(1, 3000)))) for k in range(40)]
    texts = []
    for k in range(60):
        body = rng.choices(vocab, k=300)
        _, source = rng.choice(items)
        w = source.split()
        a = rng.randrange(len(w))
        body[100:100] = w[a : a + rng.randrange(1, 60)]
        texts.append(" ".join(body))
    check(texts, items, 10)


def test_long_text_is_cut_at_words(monkeypatch):
    monkeypatch.setattr(op, "PIECE", 16)
    text = "One two, three four five six seven eight nine ten eleven twelve" + "x" * 50 + " end é"
    assert [w for p in op.byte_cuts(text.encode()) for w in op.word_list(p)] == op.word_list(text.encode())
    check([text], [("i", "three four five six seven eight nine ten eleven twelve" + "x" * 50)], 4)


def test_frames(spark, monkeypatch):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"
    rows = [(1, f"so {item.upper()}! end"), (1, f"so {item.upper()}! end"), (2, None), (3, ""), (None, "alpha beta"),
            (4, "short item here"), (5, ("x " * 40_000) + item)]
    docs = spark.createDataFrame(rows, EMPTY).selectExpr("*", "1 as n_words", "2 as spans", "3 as items")
    bench = spark.createDataFrame([("a", item), ("a", item), ("b", "short item"), ("c", None), ("d", "")], "item_id string, text string")
    got = sorted((r.doc_id or -1, r.n_words, [tuple(s) for s in r.spans], r["items"], r.longest) for r in op.contamination(docs, bench).collect())
    assert got == [(-1, 2, [], [], 0), (1, 13, [(1, 12)], ["a"], 11), (1, 13, [(1, 12)], ["a"], 11), (2, 0, [], [], 0),
                   (3, 0, [], [], 0), (4, 3, [(0, 2)], ["b"], 2), (5, 40_011, [(40_000, 40_011)], ["a"], 11)]
    monkeypatch.setattr(op, "BLOCK_BYTES", 1)  # an item a block
    assert sorted((r.doc_id or -1, r.n_words, [tuple(s) for s in r.spans], r["items"], r.longest) for r in op.contamination(docs, bench).collect()) == got
    clean = op.decontaminate(docs, bench)
    assert clean.columns == docs.columns
    assert sorted(str(r.doc_id) for r in clean.collect()) == ["2", "3", "None"]
    longest = {(r.item_id, r.item_offset): (r.n_words, r.doc_offset) for r in op.longest_matches(docs, bench).collect()}
    assert longest[("a", 0)][0] == 11 and longest[("a", 1)][0] == 10 and longest[("b", 0)] == (2, 0)
    none = op.contamination(docs, bench.limit(0))
    assert none.filter("size(spans) > 0").count() == 0 and none.count() == len(rows)
    assert op.contamination(docs.limit(0), bench).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    found = differences(queries.op1_decontaminate(spark, sf), duck(sf), queries.SQL["op1_decontaminate"])
    assert not found, "\n".join(found)
