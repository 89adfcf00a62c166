"""Blocks of ids, and files of them against the tokenizers library."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lanewright.llm import queries, token_files

PATH = token_files.default_vocabulary()
LIBRARY = Tokenizer.from_file(PATH)
LIBRARY.no_padding()
LIBRARY.no_truncation()


def check(ids):
    ids = np.array(ids, dtype="<u4")
    block = token_files.pack(ids)
    assert token_files.unpack(block).tolist() == ids.tolist()
    return block


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 49408), st.integers(0, 2**32 - 1)), max_size=300))
def test_round_trip(ids):
    check(ids)


@pytest.mark.parametrize("ids", [[], [0], [2**32 - 1], [1] * 100_000, list(range(70_000)), [7] * 50 + [2**31] + [1, 2] * 40])
def test_cases(ids):
    check(ids)


def test_sizes():
    assert len(check([5] * 1_000_000)) < 1_000_000 / 15  # a run is one word a group
    small = [k % 7 for k in range(6000)]
    assert len(check(small)) < 6000 // 15 * 8  # 15 ids of 4 bits a word (7 is the mark of an escape)
    small[::100] = [40_000] * 60  # rare large ids are escapes, and widen no word
    assert len(check(small)) < 6000 // 15 * 8 + 60 * 4


def test_any_part():
    rng = random.Random(2)
    ids = [rng.choice([3, 3, 3, rng.randrange(50_000), rng.randrange(2**32)]) for _ in range(20_000)] + [9] * 500
    block = check(ids)
    for _ in range(300):
        first, count = rng.randrange(len(ids) + 5), rng.randrange(600)
        assert token_files.unpack(block, first, count).tolist() == ids[first : first + count]


TEXTS = [
    "", " ", None, "That it's 2024, isn't IT?", "ΣΑΣ İstanbul", "été café", "a<|endoftext|>B <|startoftext|>", "<|endoftext |>",
    "x" * 3000, "\U0001f600\U0001f600 你好", "a b c\x1cd\x85e\xa0f", "### $$$ &&&", "''s 'S 'Ll", "\x00\x01", "́ ́a",
    "line\nline\r\n\tline", "\U00016d40\U00010d50 \U000105c0x", "<| |>", "ﬀ ǅ ß ẞ",
]


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=50))
def test_any_text(text):
    expected = LIBRARY.encode(text, add_special_tokens=False).ids
    ids, counts = token_files.encoder(PATH).encode(pa.array([text, None, text]))
    assert ids.tolist() == expected * 2 and counts.tolist() == [len(expected), 0, len(expected)]


def test_small_memory(monkeypatch):
    monkeypatch.setattr(token_files, "KNOWN_WORDS", 3)
    encoder = token_files.Encoder(PATH)
    for text in TEXTS * 3:
        expected = LIBRARY.encode(text or "", add_special_tokens=False).ids
        assert encoder.encode(pa.array([text], pa.string()))[0].tolist() == expected


def plain(rows, end):
    """(id, start, n, ids) of (id, text), in order of ids."""
    out, start = [], 0
    for i, text in rows:
        ids = [*LIBRARY.encode(text or "", add_special_tokens=False).ids, end]
        out.append((i, start, len(ids), ids))
        start += len(ids)
    return out


def test_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_IDS", 40)
    rows = [(None, "first of all"), *((3 * k - 20, text) for k, text in enumerate(TEXTS)), (500, "long " * 30_000), (501, "end")]
    docs = spark.createDataFrame(random.Random(1).sample(rows, len(rows)), "doc_id long, text string")
    docs = docs.selectExpr("*", "1 as id", "2 as hash", "3 as part", "4 as ids").repartition(5)
    token_files.write(docs, f"{tmp_path}/files", end=77)
    got = token_files.read(spark, f"{tmp_path}/files").orderBy("start").collect()
    assert [(r.doc_id, r.start, r.n_tokens, np.frombuffer(r.ids, "<u4").tolist()) for r in got] == plain(rows, 77)
    with pytest.raises(Exception, match="already exists"):
        token_files.write(docs, f"{tmp_path}/files")


def test_repeated_ids_and_rows(spark, tmp_path):
    rows = [("b", "one two"), ("b", "one two"), ("a", None), ("b", "three"), (None, None), (None, "x")] * 20
    token_files.write(spark.createDataFrame(rows, "name string, body string"), f"{tmp_path}/files", "name", "body")
    got = token_files.read(spark, f"{tmp_path}/files", "name").orderBy("start").collect()
    assert [r.name for r in got] == [None] * 40 + ["a"] * 20 + ["b"] * 60
    assert [r.start for r in got] == [sum(x.n_tokens for x in got[:k]) for k in range(len(got))]
    sizes = [len(LIBRARY.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in rows]
    assert sorted(r.n_tokens for r in got) == sorted(sizes)


def test_no_rows(spark, tmp_path):
    token_files.write(spark.createDataFrame([], "doc_id long, text string"), f"{tmp_path}/files")
    got = token_files.read(spark, f"{tmp_path}/files")
    assert got.columns == ["doc_id", "start", "n_tokens", "ids"] and got.count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = sorted(map(tuple, spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()))
    expected = [(i, start, n, zlib.crc32(np.array(ids, "<u4").tobytes())) for i, start, n, ids in plain(docs, 1)]
    assert sorted(map(tuple, queries.op13_token_files(spark, sf).collect())) == expected
