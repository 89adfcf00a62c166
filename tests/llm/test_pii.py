"""Personal data: fixed patterns against plain patterns, the field on notations it has to add."""

import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lanewright.llm import pii, queries


def plain(text):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 12 <= len(d) <= 19:
            twice = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(d))]
            if sum(x - 9 if x > 9 else x for x in twice) % 10 == 0:
                out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return [(a, b, pii.KINDS[k]) for a, k, b in sorted(out)]


def ordered(spans):
    return sorted(spans, key=lambda s: (s[0], pii.KINDS.index(s[2])))


@settings(max_examples=800, deadline=None)
@given(st.lists(st.sampled_from(["a", "b.c", "@", ".", "1", "255", "300", "0001", "4111111111111111", " ", "-", "+", "(", "é", "_", "12", "%", "@x.y"]), max_size=16).map("".join))
def test_base(text):
    assert ordered(pii.base_spans(text)) == plain(text)


@pytest.fixture(scope="module")
def field():
    rng = random.Random(1)
    texts = []
    for _ in range(120):
        datum = rng.choice(["ann.b@mail.example.com", "10.2.3.4", "4111111111111111", f"+1 ({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}", "9807915762804491"])
        texts.append(f"the word and {datum} more of it")
    return pii.trained(texts)


def test_field_adds_other_notations(field):
    for text, kind in [("call (212) 555-0142 now", "phone"), ("of ann.lee at mail dot example dot com then", "email"),
                       ("so 212-555-0188 it", "phone"), ("write bob (at) host (dot) org today", "email")]:
        _, spans = pii.all_spans(text, field)
        assert [s[2] for s in spans] == [kind], (text, spans)


def test_long_stretches_keep_entities_at_every_place(field):
    """Lists of numbers without white space, and data far from white space."""
    numbers = [f"212-555-{k:04d}" for k in range(300)]
    for start in ("", "x", "xxxxxx"):
        text = "of " + start + ("," if start else "") + ",".join(numbers) + " it"
        found = {text[a:b] for a, b, _ in pii.all_spans(text, field)[1]}
        assert found == set(numbers)
    for text in ["of " + "x" * 500 + ",212-555-0142 it", "of " + "ab," * 50 + "212-555-0142," + "ab," * 50 + " it"]:
        assert [text[a:b] for a, b, _ in pii.all_spans(text, field)[1]] == ["212-555-0142"], text


def test_parts_cover_a_stretch():
    for n in (0, 1, 99, 100, 131, 132, 133, 232, 233, 1000):
        text = "1," * (n // 2) + "1" * (n % 2)
        got = list(pii.parts(text, 0, len(text)))
        assert [p for _, _, a, b in got for p in range(a, b)] == list(range(len(text)))
        assert all(s == max(0, a - pii.AROUND_TOKENS) and (e >= b + pii.AROUND_TOKENS or e == len(text)) for s, e, a, b in got)


def test_field_leaves_other_numbers(field):
    for text in ["on 2024-03-15 12:30:45 it", "version 12.4.10293 of", "number 48201734 there", "1,204,500 of them",
                 "token 04dbebab91ab85687d33eeaaf9ac699e1188f962 it", "look at 12345678 now", "sum 9807915762804490 it"]:
        assert pii.all_spans(text, field)[1] == ordered(pii.base_spans(text)), text


def test_best_segmentation_is_the_best_of_all(field):
    """Against every segmentation of short stretches; probabilities sum over all of them."""
    for text in ["212-555-0142", "a@b.com 4111111111111111"]:
        stretch = pii.Stretch(text, 0, len(text))
        numbers = [field.number(f) for _, _, f in stretch.segments]
        scores = field.scores(stretch, numbers)

        def ways(i, y):
            if i == len(stretch.marks):
                yield 0.0, []
                return
            for s, rest in ways(i + 1, 0):
                yield s + field.moves[y, 0], rest
            for k, (a, b, _) in enumerate(stretch.segments):
                if a == i:
                    for z in range(1, 5):
                        for s, rest in ways(b, z):
                            yield s + field.moves[y, z] + scores[k, z], [(a, b, z), *rest]

        every = list(ways(0, 0))
        assert field.best(stretch) == max(every, key=lambda w: w[0])[1]
        total = np.logaddexp.reduce([s for s, _ in every])
        sure = field.marginals(stretch, numbers)
        for k, (a, b, _) in enumerate(stretch.segments):
            for z in range(1, 5):
                p = np.exp(np.logaddexp.reduce([s for s, w in every if (a, b, z) in w] or [-np.inf]) - total)
                assert abs(p - sure[k, z]) < 1e-6


def test_long_texts_are_linear(field):
    for text in ["a" * 300_000 + "@", "1" * 300_000, "1." * 3_000, "+" + " " * 300_000, "a@" * 3_000, "at " * 50_000, "1 " * 3_000]:
        pii.all_spans(text, field)


def test_frames(spark, field):
    rows = [(1, "é a.b@c.de"), (1, "é a.b@c.de"), (2, None), (3, ""), (None, "call (212) 555-0142 now")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as spans", "1 as kind")
    got = sorted(((r.doc_id, [tuple(s) for s in r.spans]) for r in pii.find(docs, field=field).collect()), key=str)
    mail = [(2, 10, "email", True)]
    assert got == sorted([(1, mail), (1, mail), (2, []), (3, []), (None, [(5, 19, "phone", False)])], key=str)
    assert pii.find(docs.limit(0)).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = dict(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    rows = queries.op10_pii(spark, sf).collect()
    assert len(rows) == len(docs)
    for r in rows:
        expected = plain(docs[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, b, k in expected).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for *_, k in expected) for kind in pii.KINDS]
        assert {f"{k}:{a}:{b}" for a, b, k in expected} <= set(r.spans.split(","))
