"""Benchmark decontamination with suffix arrays of the training text.

Each bounded shard of documents becomes a suffix array over its words: positions sorted by
the words that follow, as deep as the longest test item. Every suffix of every test item is
searched in it by bisection, all suffixes at once: the neighbours of its place give its
longest verbatim match, the range that shares its first ``window`` words gives all places
where that window occurs. Documents never cross shards, so nothing is shuffled.

Only positions that can matter are sorted: those whose first two words follow each other
in some test item (or whose first word is a whole item). Test items travel in blocks of
bounded size; further blocks are further passes over the same rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanewright.llm.batches import PIECE, octets, pieces

#: Consecutive item words that make a document contaminated.
WINDOW = 10
#: Bytes of test items in a block (items are never split; one longer item is a block alone).
BLOCK_BYTES = 8 << 20

_SPACES = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def word_list(text: bytes) -> list[bytes]:
    """Lower-cased (A-Z) runs of digits, Latin letters and anything beyond ASCII."""
    return text.translate(_SPACES).split()


@dataclass
class Items:
    """A block of test items: words as numbers from 1 on, all suffixes, windows."""

    names: list[str]
    texts: list[bytes]
    window: int
    vocab: dict[bytes, int] = field(default_factory=dict)

    def __post_init__(self):
        number = self.vocab.setdefault
        items = [[number(w, len(self.vocab) + 1) for w in word_list(t)] for t in self.texts]
        self.depth = max([len(x) for x in items] + [self.window])
        self.bits = max(1, (len(self.vocab) + 1).bit_length())
        self.per_key = 63 // self.bits  # words packed in one key
        self.words = np.array([w for x in items for w in [*x, 0]] + [0] * self.depth, dtype=np.int64)  # 0 ends an item
        lengths = np.array([len(x) for x in items], dtype=np.int64)
        first = np.cumsum(lengths + 1) - lengths - 1
        self.item = np.repeat(np.arange(len(items)), lengths)
        self.offset = np.arange(len(self.item)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        self.start = np.repeat(first, lengths) + self.offset
        left = np.repeat(lengths, lengths) - self.offset
        short = np.repeat(lengths, lengths) < self.window
        # words that a place must share with the suffix for a window; 0: no window starts here
        self.need = np.where(short, np.where(self.offset == 0, left, 0), np.where(left >= self.window, self.window, 0))
        w = self.words
        pairs = w[self.start] * (len(self.vocab) + 1) + w[self.start + 1]
        self.pairs = np.unique(pairs[left > 1])
        self.alone = np.unique(w[self.start[self.need == 1]])
        self.packed = pack(self.words, self.start, self.depth, self.bits, self.per_key)


def pack(words: np.ndarray, at: np.ndarray, depth: int, bits: int, per_key: int) -> list[np.ndarray]:
    """The ``depth`` words from each place as keys of ``per_key`` words; comparing keys compares words."""
    keys = []
    for k in range(0, depth, per_key):
        key = np.zeros(len(at), dtype=np.int64)
        for j in range(k, k + per_key):
            key = (key << bits) | (words[np.minimum(at + j, len(words) - 1)] if j < depth else 0)
        keys.append(key)
    return keys


@dataclass
class Shard:
    """Words of some documents (0: a word no item has, or a document's end) and their suffix array."""

    words: np.ndarray
    at: np.ndarray  # suffix array: places sorted by what follows
    keys: list[np.ndarray]  # packed words from each sorted place


def shard(texts: list[bytes], items: Items) -> tuple[Shard, np.ndarray]:
    """The shard of some texts, and where each text's words start in it (the last: the end)."""
    get, parts, ends = items.vocab.get, [], [0]
    for text in texts:
        size = 0
        for piece in byte_cuts(text):
            found = word_list(piece)
            part = np.fromiter((get(w, 0) for w in found), dtype=np.int32, count=len(found))
            parts.append(part)
            size += len(part)
        parts.append(np.zeros(1, dtype=np.int32))
        ends.append(ends[-1] + size + 1)
    words = np.concatenate([*parts, np.zeros(items.depth, dtype=np.int32)]).astype(np.int64)
    # a document's end is 0 like a foreign word, and so is an item's end: neither may match
    here, after = words[:-1], words[1:]
    known = np.flatnonzero(here)
    pair = here[known] * (len(items.vocab) + 1) + after[known]
    can = np.isin(pair, items.pairs) | (np.isin(here[known], items.alone) if len(items.alone) else False)
    at = known[can]
    return sort_suffixes(words, at, items), np.array(ends)


def byte_cuts(text: bytes) -> Iterator[bytes]:
    """A long text in pieces that end at a byte that is no part of a word."""
    start = 0
    while len(text) - start > PIECE:
        stop = start + PIECE
        while stop > start and _SPACES[text[stop - 1]] != 32:
            stop -= 1
        if stop == start:
            stop = start + PIECE
            while stop < len(text) and _SPACES[text[stop]] != 32:
                stop += 1
        yield text[start:stop]
        start = stop
    yield text[start:]


def sort_suffixes(words: np.ndarray, at: np.ndarray, items: Items) -> Shard:
    """Sorts by the first key, then only the places that are still equal by the next one, and so on."""
    keys = pack(words, at, items.depth, items.bits, items.per_key)
    order = np.argsort(keys[0], kind="stable")
    group = np.cumsum(np.concatenate([[False], np.diff(keys[0][order]) != 0])) if len(at) else order
    for key in keys[1:]:
        same = np.zeros(len(order), dtype=bool)
        equal = group[1:] == group[:-1]
        same[1:] |= equal
        same[:-1] |= equal
        tied = np.flatnonzero(same)
        if not len(tied):
            break
        inner = np.lexsort((key[order[tied]], group[tied]))
        order[tied] = order[tied][inner]
        new = np.diff(group, prepend=group[0]) != 0
        value = key[order]
        new[1:] |= (value[1:] != value[:-1]) & equal
        group = np.cumsum(new)
    return Shard(words, at[order], [key[order] for key in keys])


def bisect(sorted_keys: list[np.ndarray], wanted: list[np.ndarray], after: bool) -> np.ndarray:
    """For each wanted key list the first place not before it (``after``: behind its equals)."""
    n = len(sorted_keys[0])
    low, high = np.zeros(len(wanted[0]), dtype=np.int64), np.full(len(wanted[0]), n, dtype=np.int64)
    while len(live := np.flatnonzero(low < high)):
        mid = (low[live] + high[live]) // 2
        right = np.zeros(len(live), dtype=bool)
        open_ = np.arange(len(live))
        for have, want in zip(sorted_keys, wanted):
            a, b = have[mid[open_]], want[live[open_]]
            right[open_[a < b]] = True
            open_ = open_[a == b]
            if not len(open_):
                break
        if after:
            right[open_] = True
        low[live[right]] = mid[right] + 1
        high[live[~right]] = mid[~right]
    return low


def prefix(keys: list[np.ndarray], length: np.ndarray, items: Items, fill: int) -> list[np.ndarray]:
    """The keys with everything behind ``length`` words replaced by zeros (or ones)."""
    out = []
    for k, key in enumerate(keys):
        drop = np.clip((k + 1) * items.per_key - length, 0, items.per_key) * items.bits
        low = (np.int64(1) << drop) - 1
        out.append((key & ~low) | (low if fill else 0))
    return out


def matched(shard: Shard, place: np.ndarray, suffix: np.ndarray, items: Items) -> np.ndarray:
    """Words that the suffixes share with the shard's sorted places."""
    length = np.zeros(len(place), dtype=np.int64)
    live = np.flatnonzero((place >= 0) & (place < len(shard.at)))
    at, want = shard.at[place[live]], items.start[suffix[live]]
    for j in range(items.depth):
        a, b = shard.words[at + j], items.words[want + j]
        live, at, want = (x[(a == b) & (a > 0)] for x in (live, at, want))
        if not len(live):
            break
        length[live] = j + 1
    return length


def search(shard: Shard, items: Items) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each suffix: length and place of its longest match, and the range of sorted places with its window."""
    every = np.arange(len(items.start))
    if not len(shard.at) or not len(every):
        none = np.zeros(len(every), dtype=np.int64)
        return none, none - 1, none, none
    here = bisect(shard.keys, items.packed, after=False)
    before, at = matched(shard, here - 1, every, items), matched(shard, here, every, items)
    length = np.maximum(before, at)
    place = shard.at[np.clip(np.where(before > at, here - 1, here), 0, len(shard.at) - 1)]
    low, high = np.zeros(len(every), dtype=np.int64), np.zeros(len(every), dtype=np.int64)
    some = np.flatnonzero((items.need > 0) & (length >= items.need))
    chosen = [key[some] for key in items.packed]
    low[some] = bisect(shard.keys, prefix(chosen, items.need[some], items, 0), after=False)
    high[some] = bisect(shard.keys, prefix(chosen, items.need[some], items, 1), after=True)
    return length, place, low, high


@dataclass
class Hits:
    """What a block of items finds in one document."""

    words: int
    spans: list[tuple[int, int]]  # merged, in words, end exclusive
    items: list[str]
    longest: int  # words of the longest verbatim match; 0 if below a window


def hits(texts: list[bytes], items: Items) -> list[Hits]:
    """All windows of the items in each text."""
    made, ends = shard(texts, items)
    _, _, low, high = search(made, items)
    sizes = ends[1:] - ends[:-1] - 1
    out = [Hits(int(n), [], [], 0) for n in sizes]
    found = np.flatnonzero(high > low)
    if not len(found):
        return out
    count = high[found] - low[found]
    suffix = np.repeat(found, count)
    rank = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low[found], count)
    place = made.at[rank]
    doc = np.searchsorted(ends, place, "right") - 1
    # windows that follow each other both in the item and in the document are one longer match
    order = np.lexsort((place, place - items.start[suffix], doc))
    p, s, d, need = place[order], items.start[suffix][order], doc[order], items.need[suffix[order]]
    fresh = np.ones(len(p), dtype=bool)
    fresh[1:] = (d[1:] != d[:-1]) | (p[1:] - s[1:] != p[:-1] - s[:-1]) | (p[1:] != p[:-1] + 1)
    run = np.cumsum(fresh) - 1
    runs_start, runs_end = p[fresh], np.zeros(run[-1] + 1, dtype=np.int64)
    np.maximum.at(runs_end, run, p + need)
    for k in np.lexsort((runs_start, d[fresh])):
        one, base = out[d[fresh][k]], ends[d[fresh][k]]
        a, b = int(runs_start[k] - base), int(runs_end[k] - base)
        one.longest = max(one.longest, b - a)
        if one.spans and a <= one.spans[-1][1]:
            one.spans[-1] = (one.spans[-1][0], max(b, one.spans[-1][1]))
        else:
            one.spans.append((a, b))
    for k in np.unique(doc * len(items.names) + items.item[suffix]):
        out[k // len(items.names)].items.append(items.names[k % len(items.names)])
    return out


def blocks(benchmark: DataFrame, id: str, text: str, window: int) -> Iterator[Items]:
    """The test items in blocks of bounded size; items without words take no part."""
    names: list[str] = []
    texts: list[bytes] = []
    size = 0
    rows = benchmark.filter(F.col(text).isNotNull()).select(F.col(id).cast("string"), F.encode(text, "UTF-8"))
    for name, value in rows.toLocalIterator():
        if size and size + len(value) > BLOCK_BYTES:
            yield Items(names, texts, window)
            names, texts, size = [], [], 0
        names.append(name if name is not None else "")
        texts.append(bytes(value))
        size += len(value)
    if names:
        yield Items(names, texts, window)


_HITS = "n_words bigint, spans array<struct<start:bigint,end:bigint>>, items array<string>, longest bigint"


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """One row per document: ``id``, n_words, spans (words, end exclusive), items (ids, sorted), longest.

    A window is ``window`` consecutive words of an item; an item with fewer words is one
    window; an item without words has none. Null and empty texts have no words. ``longest``
    is the longest verbatim match with one item, 0 if there is no window. Repeated rows are
    judged one by one; items that repeat an id count as that id; other columns are left out.
    """
    rows = docs.select(docs[id].alias("id"), docs[text].alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    rows = rows.selectExpr(
        "id", "text", "cast(null as bigint) n_words",
        "cast(array() as array<struct<start:bigint,end:bigint>>) spans",
        "cast(array() as array<string>) items", "0L longest",
    )
    context = docs.sparkSession.sparkContext
    found = False
    for block in blocks(benchmark, item_id, item_text, window):
        rows = rows.mapInArrow(_pass(context.broadcast(block)), f"id {kind}, text string, {_HITS}")
        found = True
    if not found:
        empty = Items([], [], window)
        rows = rows.mapInArrow(_pass(context.broadcast(empty)), f"id {kind}, text string, {_HITS}")
    return rows.select(F.col("id").alias(id), "n_words", "spans", F.array_sort("items").alias("items"), "longest")


def _pass(block):
    """Adds what one block finds to what earlier blocks have found."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = block.value
        for batch in pieces(batches):
            new = hits(octets(batch), items)
            spans, names, longest = [], [], []
            for one, s, n, most in zip(new, *(batch.column(c).to_pylist() for c in ("spans", "items", "longest"))):
                spans.append(union(one.spans, [(x["start"], x["end"]) for x in s]))
                names.append(sorted({*one.items, *n}))
                longest.append(max(one.longest, most))
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            spans = [[{"start": a, "end": b} for a, b in x] for x in spans]
            columns = [
                batch.column("id"), batch.column("text"), pa.array([x.words for x in new], pa.int64()),
                pa.array(spans, kind), pa.array(names, pa.list_(pa.string())), pa.array(longest, pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "text", "n_words", "spans", "items", "longest"])

    return run


def union(a: list[tuple[int, int]], b: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Two lists of merged spans as one."""
    if not b or not a:
        return a or b
    out: list[tuple[int, int]] = []
    for start, end in sorted(a + b):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """The documents without those that hold a window of the benchmark; all columns stay.

    Documents with a null or empty text stay.
    """
    context, out = docs.sparkSession.sparkContext, docs
    for block in blocks(benchmark, item_id, item_text, window):
        out = out.mapInArrow(_clean(context.broadcast(block), text), docs.schema)
    return out


def _clean(block, text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text):
            yield batch.filter(pa.array([not x.spans for x in hits(octets(batch, text), block.value)], pa.bool_()))

    return run


def longest_matches(
    docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", window: int = WINDOW,
) -> DataFrame:
    """The longest verbatim match of every test suffix that has one of ``window`` words or more.

    One row per (item, offset): item_id (string), item_offset, n_words, and its place: doc
    (``id`` as text) and doc_offset, the first by text order if several are as long. A
    shorter item counts if the whole of it matches.
    """
    rows = docs.select(docs[id].cast("string").alias("id"), docs[text].alias("text"))
    context, out = docs.sparkSession.sparkContext, None
    schema = "item_id string, item_offset bigint, n_words bigint, doc string, doc_offset bigint"
    for block in blocks(benchmark, item_id, item_text, window):
        one = rows.mapInArrow(_longest(context.broadcast(block)), schema)
        out = one if out is None else out.unionByName(one)
    if out is None:
        return docs.sparkSession.createDataFrame([], schema)
    best = F.max_by(F.struct("n_words", "doc", "doc_offset"), F.struct("n_words", "doc", "doc_offset"))
    return out.groupBy("item_id", "item_offset").agg(best.alias("m")).select("item_id", "item_offset", "m.*")


def _longest(block):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = block.value
        for batch in pieces(batches):
            made, ends = shard(octets(batch), items)
            length, place, _, _ = search(made, items)
            keep = np.flatnonzero((items.need > 0) & (length >= items.need))
            doc = np.searchsorted(ends, place[keep], "right") - 1
            columns = [
                pa.array([items.names[k] for k in items.item[keep]], pa.string()), pa.array(items.offset[keep]),
                pa.array(length[keep]), batch.column("id").take(pa.array(doc)), pa.array(place[keep] - ends[doc]),
            ]
            names = ["item_id", "item_offset", "n_words", "doc", "doc_offset"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run
