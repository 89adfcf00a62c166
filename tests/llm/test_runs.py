"""Recompression's runs against plain comparison of words."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lanewright.llm import queries, runs
from tests.compare import differences
from tests.llm.tables import duck


def plain(words, least=24, times=3):
    """Every maximal stretch of words that equal the words p before, with the least p."""
    out = {}
    for p in range(1, len(words) // times + 1):
        i = 0
        while i + p < len(words):
            j = i
            while j + p < len(words) and words[j] == words[j + p]:
                j += 1
            if j > i and j + p - i >= max(least, times * p):
                out.setdefault((i, j + p - i), p)
            i = max(j, i + 1)
    return sorted(((s, l, p) for (s, l), p in out.items()), key=lambda r: (r[0], r[2]))


def kept(words, found):
    gone = {i for s, l, p in found for i in range(s + p, s + l)}
    return [w for i, w in enumerate(words) if i not in gone]


def check(texts, least=24, times=3):
    for words, (n, found, rest) in zip(texts, runs.texts_runs([" ".join(w).encode() for w in texts], least, times)):
        expected = plain(words, least, times)
        assert n == len(words)
        assert [(r["start"], r["length"], r["period"]) for r in found] == expected
        assert rest.decode() == " ".join(kept(words, expected))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=90), max_size=5), st.sampled_from([(24, 3), (6, 2), (1, 2), (9, 4)]))
def test_few_words(texts, limits):
    check(texts, *limits)


def test_planted_runs():
    rng = random.Random(3)
    texts = []
    for _ in range(200):
        words = [str(rng.randrange(rng.choice([2, 30, 1000]))) for _ in range(rng.randrange(400))]
        for _ in range(rng.randrange(5) if words else 0):
            start, period = rng.randrange(len(words)), rng.randint(1, 60)
            for i in range(start + period, rng.randint(start, len(words))):
                words[i] = words[i - period]
        texts.append(words)
    check(texts)


def test_extensions():
    """The grammar's extensions, both ways, against plain comparison, at all pairs of places."""
    rng = random.Random(4)
    for size in (1, 2, 7, 40):
        word = [rng.randrange(2) for _ in range(size)] * 3
        symbols = np.array([-1, *word, -2], dtype=np.int64)
        ahead = runs.Grammar(symbols)
        assert len(ahead.symbols[-1]) == 3
        x, y = (a.ravel() + 1 for a in np.meshgrid(range(len(word)), range(len(word)), indexing="ij"))
        x, y = x[x < y], y[x < y]
        got = ahead.extension(x.copy(), y.copy())
        back = ahead.mirrored().extension(len(symbols) - y, len(symbols) - x)
        for a, b, forth, to in zip(x.tolist(), y.tolist(), got.tolist(), back.tolist()):
            expected = 0
            while symbols[a + expected] == symbols[b + expected]:
                expected += 1
            assert forth == expected
            expected = 0
            while symbols[a - 1 - expected] == symbols[b - 1 - expected]:
                expected += 1
            assert to == expected


@pytest.mark.parametrize("words", [["a"] * 60000, [str(i % 700) for i in range(50000)], ["a", "b"] * 30000 + ["c"]])
def test_long_texts(words):
    (n, found, rest), = runs.texts_runs([" ".join(words).encode()], 24, 3)
    period = len(set(words) - {"c"})
    assert [(r["start"], r["length"], r["period"]) for r in found] == [(0, n - ("c" in words), period)]
    assert rest.decode().split() == words[:period] + ["c"] * ("c" in words)


def test_frames(spark):
    again = " ".join(["x", "y"] * 20)
    rows = [(1, again), (1, again), (2, None), (3, ""), (None, " \x0b\n"), (5, "a\x0bb\xa0c  d\x1ce")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as runs", "2 as n_words", "3 as id")
    got = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in runs.periodic_runs(docs).collect()]
    one = (1, 40, [(0, 40, 2)], "x y")
    expected = [one, one, (2, 0, [], ""), (3, 0, [], ""), (None, 0, [], ""), (5, 3, [], "a b\xa0c d\x1ce")]
    assert sorted(got, key=str) == sorted(expected, key=str)
    assert runs.periodic_runs(docs.limit(0)).count() == 0
    renamed = runs.periodic_runs(docs.selectExpr("cast(doc_id as string) as name", "text as body", "text"), "name", "body")
    assert renamed.columns == ["name", "n_words", "runs", "collapsed"] and renamed.count() == 6


def test_query_rows(spark, tmp_path):
    """Whole query against a plain version, nulls and long texts included."""
    rng = random.Random(6)
    rows = [(i, rng.choice(["", " "]) + "  ".join(rng.choice("abcdefgh") * 3 for _ in range(rng.randrange(300)))) for i in range(150)]
    rows += [(151, None), (152, ""), (153, "\n"), (None, "z " * 30), (7, "w " * 30)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    expected = []
    for i, text in rows:
        words = (text or "").encode().split()
        h = zlib.crc32(str(i).encode()) if i is not None else 1
        if h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[k] if k < a else words[a + (k - a) % p] for k in range(n)]
        words = [w.decode() for w in words]
        found = plain(words)
        best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2])) if found else (None, None, None)
        lines = "".join(f"{s},{l},{p}\n" for s, l, p in found)
        expected.append((i, len(found), *best, 1000 * best[1] // best[2] if found else None,
                         *(hashlib.sha256(x.encode()).hexdigest() for x in (lines, " ".join(kept(words, found))))))
    got = [tuple(r) for r in queries.op11_runs(spark, str(tmp_path)).collect()]
    assert sum(r[1] > 0 for r in got) >= 10
    assert sorted(got, key=str) == sorted(expected, key=str)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    found = differences(queries.op11_runs(spark, sf), duck(sf), queries.SQL["op11_runs"])
    assert not found, "\n".join(found)
