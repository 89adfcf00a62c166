"""Speculate-and-verify encoding against the tokenizers library and against plain merging."""

import hashlib
import random
import unicodedata

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lanewright.llm import bpe, queries

MINE = bpe.vocabulary(bpe.default_vocabulary())
LIBRARY = Tokenizer.from_file(bpe.default_vocabulary())
LIBRARY.no_padding()
LIBRARY.no_truncation()


def same(text):
    packed = MINE.encode([text])[0]
    expected = LIBRARY.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(packed, "<u4").tolist() == expected, repr(text)
    assert MINE.decode(packed) == LIBRARY.decode(expected, skip_special_tokens=False)


@pytest.mark.parametrize(
    "text",
    ["", " ", "That it's 2024, isn't IT?", "ΣΑΣ İstanbul", "été café", "a<|endoftext|>B<|startoftext|>",
     "<|endoftext|>", "<|endoftext |>", "x" * 3000, "\U0001f600\U0001f600 你好", "a b c\x1cd\x85e", "### $$$ &&&",
     "aaaa aaaaa aaaaaa", "''s 'S 'Ll", "\x00\x01", "́ ́a", "line\nline\r\n\tline"],
)
def test_cases(text):
    same(text)


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    same(text)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abenrstio'éü ", max_size=80))
def test_words(text):
    same(text)


def test_every_letter():
    """Single characters of the basic planes, apart from letters newer than the library's tables."""
    wrong = []
    for start in range(0, 0x30000, 64):
        chars = [c for c in map(chr, range(start, start + 64)) if unicodedata.category(c) not in ("Cs", "Cn")]
        for c, packed in zip(chars, MINE.encode(chars)):
            if np.frombuffer(packed, "<u4").tolist() != LIBRARY.encode(c, add_special_tokens=False).ids:
                wrong.append(c)
    assert not wrong, [hex(ord(c)) for c in wrong]


def test_pairs_against_merging():
    rng = random.Random(5)
    names = [i for i, n in enumerate(MINE.names[:49406]) if n.endswith(bpe.WORD_END)]
    starts = [i for i, n in enumerate(MINE.names[:49406]) if not n.endswith(bpe.WORD_END)]
    a, b = [rng.choice(starts) for _ in range(3000)], [rng.choice(names) for _ in range(3000)]
    fits = MINE.compatible(np.array(a), np.array(b))
    whole = [MINE.merged(MINE.names[x] + MINE.names[y][:-4]) for x, y in zip(a, b)]
    assert [w == [x, y] for w, x, y in zip(whole, a, b)] == fits.tolist()


def test_frames(spark):
    rows = [(1, "That it."), (1, "That it."), (2, None), (3, ""), (None, "word " * 5000), (5, "é" * 70000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as ids", "2 as n_tokens")
    got = [(r.doc_id, bytes(r.ids), r.text) for r in bpe.decode(bpe.encode(docs)).collect()]
    expected = []
    for i, text in rows:
        ids = LIBRARY.encode(text or "", add_special_tokens=False).ids
        expected.append((i, np.array(ids, "<u4").tobytes(), LIBRARY.decode(ids, skip_special_tokens=False)))
    assert sorted(got, key=str) == sorted(expected, key=str)
    assert bpe.decode(bpe.encode(docs.limit(0))).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = dict(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    for row in queries.op7_bpe(spark, sf).collect():
        ids = LIBRARY.encode(docs[row.doc_id], add_special_tokens=False).ids
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(LIBRARY.decode(ids, skip_special_tokens=False).encode()).hexdigest()
