"""Secret scan: fixed patterns against a plain scan, the token test on made-up strings."""

import hashlib
import random
import re
import string

import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from lanewright.llm import queries, secrets

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
PLAIN = {
    "assign": (r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 8),
    "access": (r"AKIA[A-Z0-9]+", 0, 16),
    "hex": (r"[0-9a-f]+", 0, 32),
}


def plain(text):
    out = [(m.start(), k, m.end()) for k, (p, g, least) in enumerate(PLAIN.values()) for m in re.finditer(p, text) if len(m[g]) >= least]
    return [(a, b, list(PLAIN)[k]) for a, k, b in sorted(out)]


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(["token", "ToKen", "secret", " = ", ":", '"', "abcdef0123456789", "AKIA", "ABCDEFGHIJKL", "0" * 33, "é", "ſecret", " ", "api_key", "=", "xyz.w-v_"]), max_size=14).map("".join))
def test_base(text):
    got = sorted(secrets.base_spans(text), key=lambda s: (s[0], secrets.KINDS.index(s[2])))
    assert got == plain(text)


def test_random_strings_are_found():
    rng = random.Random(2)
    found = 0
    for _ in range(300):
        run = "".join(rng.choices(string.ascii_letters + string.digits, k=rng.randrange(24, 60)))
        found += any(k == "random" for *_, k in secrets.spans(f"so it is {run} then", PATH))
    assert found >= 295


def test_words_digests_and_identifiers_are_left():
    digest = hashlib.sha1(b"x").hexdigest()
    for text in ["internationalization2024report and more", "see commit 9fceb02d0ae598e95dc970b74767f19372d61af8x1 there",
                 "id 123e4567-e89b-12d3-a456-426614174000.", "2024-03-15/2024-04-15/2024-05-15", "some_long_function_name_2_of_module_3",
                 "NotificationServiceConfiguration2Handler", "AB" * 30, "1" * 60, hashlib.sha256(b"y").hexdigest().upper()]:
        assert not [s for s in secrets.spans(text, PATH) if s[2] == "random"], text
    assert [s[2] for s in secrets.spans(f"git {digest}", PATH)] == ["hex"]


def test_added_spans_stay_apart_from_base():
    run = "aB3xK9qLm2Zt7Rw4Yp8Nc1Vd6"
    assert [s[2] for s in secrets.spans(f"token = {run}", PATH)] == ["assign"]
    assert [s[2] for s in secrets.spans(f"key {run}", PATH)] == ["random"]
    assert secrets.masked(f"a token = {run}, {run} b", PATH) == "a <secret>, <secret> b"
    assert secrets.masked("nothing here", PATH) == "nothing here"


def test_long_runs_are_linear():
    assert secrets.spans("0" * 500_000 + "g", PATH)[0] == (0, 500_000, "hex")
    secrets.spans("a1" * 300_000, PATH)


def test_frames(spark):
    run = "aB3xK9qLm2Zt7Rw4Yp8Nc1Vd6"
    rows = [(1, f"é token={run}", 99), (1, f"é token={run}", 99), (2, None, 5), (3, "", 0), (None, run, 25)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars int").selectExpr("*", "'z' as spans", "1 as start")
    got = sorted(((r.doc_id, [tuple(s) for s in r.spans]) for r in secrets.scan(docs).collect()), key=str)
    assert got == sorted([(1, [(2, 33, "assign")]), (1, [(2, 33, "assign")]), (2, []), (3, []), (None, [(0, 25, "random")])], key=str)
    clean = secrets.mask(docs)
    assert clean.columns == docs.columns and dict(clean.dtypes) == dict(docs.dtypes)
    assert sorted(((r.doc_id, r.text, r.n_chars) for r in clean.collect()), key=str) == sorted(
        [(1, "é <secret>", 10), (1, "é <secret>", 10), (2, None, 5), (3, "", 0), (None, "<secret>", 8)], key=str)
    assert secrets.scan(docs.limit(0)).count() == 0 and secrets.mask(docs.limit(0)).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = dict(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    rows = queries.op2_secrets(spark, sf).collect()
    assert len(rows) == len(docs)
    for r in rows:
        expected = plain(docs[r.doc_id])
        text = ",".join(f"{k}:{a}:{b}" for a, b, k in expected)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == kind for *_, k in expected) for kind in PLAIN]
        own = [tuple(s.split(":")) for s in r.spans.split(",") if s]
        assert {(k, str(a), str(b)) for a, b, k in expected} <= set(own)
