"""Files of token ids: whole documents in blocks, coded word-aligned (Simple-8b).

Documents are sorted by id over range partitions; each task encodes its texts and packs
their ids into blocks of whole documents. A dataset is a folder of Parquet files, written
by Spark's own committer, with a row per block: the task (``part``, in id order), the ids
before the block in that task, the documents, how many ids each has, and the block's bytes.

Bytes of a block, all little-endian: how many ids, words and escapes (32 bits each); for every
group of ``STEP`` ids the number of words and of escapes before it (32 bits each); the words; the
escapes (32 bits each). The upper 4 bits of a word are its selector. Selector 0 is a run: 28
bits say how often the id in the lower 32 bits stands. The others hold as many ids as fit, in
fields of a stated width, from the lowest bits on; a field of ones is an escape, whose id is
the next one of the escapes. So rare large ids don't widen a word of small ones. No word
holds ids of two groups, so a reader can start at any group.
"""

from __future__ import annotations

import os
import re
import struct
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lanewright.llm.batches import pieces
from lanewright.llm.bpe import ASCII_WORD, WORD_END, default_vocabulary, vocabulary

# fixed values: bits of a field by selector, from selector 1 on
BITS = [1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60]
#: Ids from one offset to the next.
STEP = 256
#: Ids from which on a block is closed; a longer document is a block of its own.
BLOCK_IDS = 1 << 16
#: Words of a text that a worker remembers with their ids; when there are more, it starts anew.
KNOWN_WORDS = 600_000
#: Longer ones are encoded each time they occur.
KNOWN_LENGTH = 64
#: Words that go to the library as one text.
TOGETHER = 256
#: Bytes of text that a task encodes together; one longer text is taken alone.
TEXTS = 16 << 20
ID_BITS = 32
COUNT = np.array([0, *(60 // b for b in BITS)], dtype=np.int64)


# --- blocks ------------------------------------------------------------------------------


def pack(ids: np.ndarray) -> bytes:
    """The bytes of a block of ids (unsigned 32 bits)."""
    small, ids = ids, np.ascontiguousarray(ids, dtype=np.uint64)
    n = len(ids)
    firsts = np.arange(0, n, STEP)
    left = np.minimum(firsts + STEP, n).repeat(STEP)[:n] - np.arange(n)  # ids to the end of the group
    # for a word that starts at each place: the selector with the fewest bits per id, escapes included
    least, chosen, ahead = np.full(n, np.inf, dtype=np.float32), np.zeros(n, dtype=np.int8), np.zeros(n, dtype=np.int64)
    for s, bits in enumerate(BITS, start=1):
        fields = 60 // bits
        if fields > n:
            continue
        wide = small >= min((1 << bits) - 1, 2**32)
        if 3 * np.count_nonzero(wide) > 2 * n:  # hardly ever pays
            continue
        before = np.zeros(n + 1, dtype=np.int32)
        np.cumsum(wide, out=before[1:])
        cost = (64 + 32 * (before[fields:] - before[:-fields])).astype(np.float32) / fields
        better = np.flatnonzero((cost < least[: n - fields + 1]) & (left[: n - fields + 1] >= fields))
        least[better], chosen[better], ahead[better] = cost[better], s, fields
    if n:
        borders = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1])))
        until = np.repeat(np.append(borders[1:], n), np.diff(np.append(borders, n)))
        run = np.minimum(until - np.arange(n), left)
        better = np.flatnonzero(64 / run < least)
        chosen[better], ahead[better] = 0, run[better]
    # the words of all groups, one more of each group at a time
    at, taken = firsts, []
    while len(at):
        taken.append(at)
        at = at + ahead[at]
        at = at[(at < n) & (at % STEP != 0)]
    starts = np.sort(np.concatenate(taken)) if taken else firsts
    selectors = chosen[starts].astype(np.uint64)
    words = selectors << np.uint64(60)
    runs = np.flatnonzero(selectors == 0)
    words[runs] |= (ahead[starts[runs]].astype(np.uint64) << np.uint64(ID_BITS)) | ids[starts[runs]]
    escaped = np.zeros(n, dtype=bool)
    for s, bits in enumerate(BITS, start=1):
        own = np.flatnonzero(selectors == s)
        if len(own):
            places, ones = starts[own][:, None] + np.arange(60 // bits), np.uint64((1 << bits) - 1)
            values = ids[places]
            escaped[places] = values >= ones
            shifts = np.arange(60 // bits, dtype=np.uint64) * np.uint64(bits)
            words[own] |= np.bitwise_or.reduce(np.minimum(values, ones) << shifts, axis=1)
    escapes = ids[escaped].astype("<u4")
    skipped = np.concatenate(([0], np.cumsum(escaped)))[firsts]
    offsets = np.stack((np.searchsorted(starts, firsts), skipped), axis=1).astype("<u4")
    return b"".join((struct.pack("<3I", n, len(words), len(escapes)), offsets.tobytes(), words.astype("<u8").tobytes(), escapes.tobytes()))


def unpack(block: bytes, first: int = 0, count: int | None = None) -> np.ndarray:
    """``count`` ids of a block (default: all) from the ``first`` on."""
    n, n_words, n_escapes = struct.unpack_from("<3I", block)
    stop = n if count is None else min(n, first + count)
    groups = -(-n // STEP)
    offsets = np.frombuffer(block, "<u4", 2 * groups, 12).reshape(groups, 2)
    words = np.frombuffer(block, "<u8", n_words, 12 + 8 * groups)
    escapes = np.frombuffer(block, "<u4", n_escapes, 12 + 8 * groups + 8 * n_words)
    if first >= stop:
        return np.empty(0, dtype="<u4")
    a, b = first // STEP, -(-stop // STEP)
    to = offsets[b] if b < groups else (n_words, n_escapes)
    ids = decoded(words[offsets[a, 0] : to[0]], escapes[offsets[a, 1] : to[1]])
    return ids[first - a * STEP : stop - a * STEP]


def decoded(words: np.ndarray, escapes: np.ndarray) -> np.ndarray:
    """The ids of some words, all words of a selector at once."""
    selectors = (words >> np.uint64(60)).astype(np.int8)
    counts = COUNT[selectors]
    runs = np.flatnonzero(selectors == 0)
    counts[runs] = (words[runs] >> np.uint64(ID_BITS)).astype(np.int64)
    ends = np.cumsum(counts)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, dtype="<u4")
    marked = np.zeros(len(out), dtype=bool)
    if len(runs):
        at = np.repeat(ends[runs] - np.cumsum(counts[runs]), counts[runs]) + np.arange(int(counts[runs].sum()))
        out[at] = np.repeat((words[runs] & np.uint64((1 << ID_BITS) - 1)).astype("<u4"), counts[runs])
    for s, bits in enumerate(BITS, start=1):
        own = np.flatnonzero(selectors == s)
        if len(own):
            ones, shifts = np.uint64((1 << bits) - 1), np.arange(60 // bits, dtype=np.uint64) * np.uint64(bits)
            values = (words[own][:, None] >> shifts) & ones
            places = (ends[own] - counts[own])[:, None] + np.arange(60 // bits)
            out[places], marked[places] = values, values == ones
    out[marked] = escapes
    return out


# --- texts to ids ------------------------------------------------------------------------


def gathered(values: list[bytes], index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The packed ids of ``values[i]`` for each i of ``index``, one after the other, and how many each has."""
    sizes = np.fromiter(map(len, values), dtype=np.int64, count=len(values)) // 4
    counts = sizes[index]
    places = np.repeat((np.cumsum(sizes) - sizes)[index] - (np.cumsum(counts) - counts), counts)
    places += np.arange(len(places))
    return np.frombuffer(b"".join(values), "<u4")[places], counts


def pieces_of(ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
    """The packed ids in pieces of ``counts``."""
    packed, ends = ids.tobytes(), (4 * np.cumsum(counts)).tolist()
    return [packed[a:b] for a, b in zip([0, *ends], ends)]


class Encoder:
    """The library's tokens of whole texts, each word of the worker's texts encoded once.

    White space never reaches a token and no rule looks across it, so what stands between ASCII white
    space (a chunk) is encoded by itself. New chunks are split into the vocabulary's words, and new words go
    to the library many at a time; each ends with the one token that has the word end.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task on every core
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        rules = vocabulary(path)
        self.ends = np.array([name.endswith(WORD_END) for name in rules.names])
        # words of many chunks, with the line ends between them
        self.ascii, self.split = (re.compile(f"{p.pattern}|\n") for p in (ASCII_WORD, rules.split))
        self.chunks: dict[bytes, bytes] = {}
        self.words: dict[str, bytes] = {}

    def alone(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def learn(self, words: list[str]) -> dict[str, bytes]:
        out, groups = {}, [words[i : i + TOGETHER] for i in range(0, len(words), TOGETHER)]
        for group, found in zip(groups, self.library.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False)):
            ids = np.array(found.ids, dtype="<u4")
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) == len(group):
                out.update(zip(group, pieces_of(ids, np.diff(ends, prepend=0))))
            else:  # a word that the library splits or leaves out
                out |= {w: self.alone(w) for w in group}
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and how many each has (null: none)."""
        for known in (self.chunks, self.words):
            if len(known) > KNOWN_WORDS:
                known.clear()
        split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        coded = split.flatten().dictionary_encode()
        chunks = coded.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
        found = list(map(self.chunks.get, chunks))
        if missing := [c for c, ids in zip(chunks, found) if ids is None]:
            new = dict(zip(missing, self.encode_chunks(missing)))
            remember(self.chunks, new)
            found = [new[c] if ids is None else ids for c, ids in zip(chunks, found)]
        ids, counts = gathered(found, coded.indices.to_numpy())
        upto = np.concatenate(([0], np.cumsum(counts)))
        return ids, np.diff(upto[split.offsets.to_numpy()])

    def encode_chunks(self, chunks: list[bytes]) -> list[bytes]:
        out: dict[bytes, bytes] = {}
        plain, other = [], []
        for chunk in chunks:
            if b"<|" in chunk:  # perhaps a special token
                out[chunk] = self.alone(chunk.decode())
            else:
                (plain if chunk.isascii() else other).append(chunk)
        for own, pattern in ((plain, self.ascii), (other, self.split)):
            text = b"\n".join(own).decode()
            if own is other:  # as the library's rules have it; lower() looks at a sigma's place
                text = unicodedata.normalize("NFC", text).replace("\u03a3", "\u03c3")
            if own:
                out.update(zip(own, self.encode_words(pattern.findall(text.lower()))))
        return [out[c] for c in chunks]

    def encode_words(self, words: list[str]) -> list[bytes]:
        """The packed ids of the words of each chunk; line ends stand between chunks."""
        coded = pa.array(words, pa.string()).dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = self.learn([w for w in distinct if w not in self.words and w != "\n"])
        known = found | {"\n": b""}
        index = coded.indices.to_numpy()
        ids, counts = gathered([known[w] if w in known else self.words[w] for w in distinct], index)
        remember(self.words, found)
        ends = np.cumsum(counts)
        border = np.flatnonzero(index == distinct.index("\n")) if "\n" in distinct else index[:0]
        upto = np.concatenate(([0], ends))[np.append(border, len(words))]
        return pieces_of(ids, np.diff(upto, prepend=0))


def remember(known: dict, new: dict) -> None:
    """Adds what is new, long words left out."""
    if max(map(len, new), default=0) <= KNOWN_LENGTH:
        known.update(new)
    else:
        known.update((w, ids) for w, ids in new.items() if len(w) <= KNOWN_LENGTH)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The encoder of a file, made once per worker."""
    return Encoder(path)


# --- files -------------------------------------------------------------------------------


def write(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text", vocabulary_path: str | None = None,
          end: int = 1) -> None:
    """Writes the token ids of all documents to the folder ``path``, in ascending order of ``id``.

    Null ids come first; rows of one id are ordered by their text's hash, equal rows are all written. Each document
    ends with the id ``end``, so a null or empty text is that id alone. A folder that exists is an
    error. Documents are not split, so a block holds the ids of one text at least.
    """
    vocabulary_path = vocabulary_path or default_vocabulary()
    last = np.array([end], dtype="<u4").tobytes()
    count = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(docs[id].alias("id"), docs[text].alias("text"), F.xxhash64(docs[text]).alias("hash"),
                       F.monotonically_increasing_id().alias("spread"))
    by = ["id", "hash", "spread"]
    sorted_ = rows.repartitionByRange(count, *by).sortWithinPartitions(*by).select("id", "text")
    kind = rows.schema["id"].dataType.simpleString()
    id_type = docs.select(docs[id]).limit(0).toArrow().schema.field(0).type

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block, before = TaskContext.get().partitionId(), 0, 0
        ids, packed, size = [], [], 0

        def row() -> pa.RecordBatch:
            lengths = [len(p) // 4 for p in packed]
            columns = [[part], [block], [before], [sum(lengths)], [ids], [lengths], [pack(np.frombuffer(b"".join(packed), "<u4"))]]
            types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(id_type), pa.list_(pa.int64()), pa.binary()]
            names = ["part", "block", "before", "n", "ids", "lengths", "bytes"]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

        for batch in pieces(batches, limit=TEXTS):
            for i, found in zip(batch.column("id").to_pylist(), pieces_of(*encoder(vocabulary_path).encode(batch.column("text")))):
                ids.append(i)
                packed.append(found + last)
                size += len(found) // 4 + 1
                if size >= BLOCK_IDS:
                    yield row()
                    block, before = block + 1, before + size
                    ids, packed, size = [], [], 0
        if ids:
            yield row()

    schema = f"part int, block bigint, before bigint, n bigint, ids array<{kind}>, lengths array<bigint>, bytes binary"
    sorted_.mapInArrow(run, schema).write.option("compression", "none").parquet(path)


def read(spark: SparkSession, path: str, id: str = "doc_id") -> DataFrame:
    """One row per document of the files in ``path``: ``id``, ``start`` (ids of all documents before it), ``n_tokens`` and ``ids``.

    ``ids`` are packed as little-endian unsigned 32-bit integers, the end id included.
    """
    blocks = spark.read.parquet(path)

    parts = blocks.groupBy("part").agg(F.sum("n").alias("_n"))
    earlier = F.sum("_n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_n")
    # a row for each partition of the write at most, as many as its setting says
    placed = blocks.join(F.broadcast(parts.select("part", earlier.alias("_earlier"))), "part")
    rows = placed.select((F.col("_earlier") + F.col("before")).alias("start"), "ids", "lengths", "bytes")
    kind = rows.schema["ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                lengths = np.array(batch.column("lengths")[k].as_py(), dtype=np.int64)
                starts = int(batch.column("start")[k].as_py()) + np.cumsum(lengths) - lengths
                values = unpack(batch.column("bytes")[k].as_py())
                ends = np.append(0, 4 * np.cumsum(lengths)).astype(np.int64)
                packed = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(ends), pa.py_buffer(values)])
                columns = [batch.column("ids")[k].values, pa.array(starts, pa.int64()), pa.array(lengths), packed.cast(pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=[id, "start", "n_tokens", "ids"])

    return rows.mapInArrow(run, f"`{id}` {kind}, start bigint, n_tokens bigint, ids binary")
