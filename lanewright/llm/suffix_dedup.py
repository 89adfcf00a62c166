"""Repeated byte strings by a depth-limited radix sort of suffixes.

Suffixes are ordered only through ``LENGTH`` bytes, digit by digit, the most significant
first; a group of one suffix drops out, and the groups that are still equal after the last
digit are exactly the repeated strings. Two things keep the passes small:

* The digits are not taken from a suffix's first byte but outwards from its anchor, the
  gram of ``GRAM`` bytes in its first ``LENGTH`` bytes that has the least hash. Equal strings
  have equal anchors, and one anchor serves about a hundred suffixes in a row.
* Suffixes with one anchor move as a block as long as they can: a block whose joint text
  occurs again is repeated as a whole, one whose common core is unique is done. Only blocks
  that are neither go on to the next digit: first all of an anchor's suffixes, then
  ``BLOCK`` of them, then single ones.

Each pass counts hashed keys over all documents and sends on a sieve of the keys
that need another digit, with bits for all of them. A sieve loses none of its keys, so what does not pass is known for
certain, and what passes by chance only goes through one more digit. The strings of the last
digit are counted exactly, by 128-bit hashes, and joined back to their texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanewright.llm.batches import octets, pieces
from lanewright.llm.shared import lean, passing, settled, stored
from lanewright.llm.sieve import Sieve

#: Bytes of a repeated string.
LENGTH = 400
#: Share of these bytes in an anchor's gram.
GRAM_SHARE = 0.5
#: Suffixes that share a block in the second digit.
BLOCK = 10
#: Suffixes of a text that are looked at together.
SEGMENT = 1 << 16

_ODD, _MIX = 0x9E3779B97F4A7C15, np.uint64(0xD6E8FEB86659FD93)
_PLACE = np.uint64((1 << 21) - 1)


@dataclass
class Anchors:
    """Anchors of a text's suffixes: place, first and last suffix of each, hash of the gram."""

    at: np.ndarray
    low: np.ndarray
    high: np.ndarray
    gram: np.ndarray


def powers(base: int, n: int) -> np.ndarray:
    factors = np.full(n, base, dtype=np.uint64)
    factors[0] = 1
    return np.cumprod(factors, dtype=np.uint64)


class Radix:
    """The digits of one length; its tables are made once per worker and pass."""

    def __init__(self, length: int):
        self.length, self.gram = length, max(1, int(length * GRAM_SHARE))
        self.reach = length - self.gram + 1  # grams in a string
        self.segment = max(SEGMENT, length + 1)  # an anchor's suffixes fit in
        most = self.segment + length
        self.up, self.down = powers(_ODD, most + 1), powers(pow(_ODD, -1, 1 << 64), most + 1)

    def anchors(self, data: bytes, ends: np.ndarray | None = None) -> Iterator[Anchors]:
        """Anchors of all suffixes of at least ``length`` bytes of the texts in ``data``, by segments.

        No anchor's suffixes are cut by a segment's end: passes see the texts in different
        company, and what they say of a text must not depend on its neighbours.
        """
        ends = np.array([len(data)]) if ends is None else ends
        start = 0
        while start + self.length <= len(data):
            piece = np.frombuffer(data, dtype=np.uint8)[start : start + self.segment + self.length - 1]
            sums = np.zeros(len(piece) + 1, dtype=np.uint64)
            np.cumsum((piece.astype(np.uint64) + np.uint64(1)) * self.up[: len(piece)], dtype=np.uint64, out=sums[1:])
            grams = (sums[self.gram :] - sums[: -self.gram]) * self.down[: len(piece) - self.gram + 1]
            grams = (grams ^ (grams >> np.uint64(32))) * _MIX
            grams ^= grams >> np.uint64(29)
            least = self.least(((grams >> np.uint64(21)) << np.uint64(21)) | np.arange(len(grams), dtype=np.uint64))
            over = np.zeros(len(least) + 1, dtype=np.int32)  # suffixes that would run over a text's end
            near = ends[np.searchsorted(ends, start, "right") : np.searchsorted(ends, start + len(least) + self.length - 1)]
            np.add.at(over, np.clip(near - self.length + 1 - start, 0, len(least)), 1)
            np.add.at(over, np.clip(near - start, 0, len(least)), -1)
            inside = np.flatnonzero(np.cumsum(over[:-1]) == 0)
            begin, start = start, start + len(least)
            if not len(inside):
                continue
            place = (least[inside] & _PLACE).astype(np.int64)
            first = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (inside[1:] != inside[:-1] + 1)]))
            last = np.append(first[1:], len(place)) - 1
            at, low, high = place[first], inside[first], inside[last]
            if high[-1] == len(least) - 1 and start + self.length <= len(data):
                # the last anchor's suffixes may go on: the next segment takes them all
                start = begin + int(low[-1])
                at, low, high = at[:-1], low[:-1], high[:-1]
            yield Anchors(at + begin, low + begin, high + begin, grams[at].view(np.int64))

    def least(self, values: np.ndarray) -> np.ndarray:
        """The least value of each ``reach`` values in a row (leftmost of equals by construction)."""
        span, have = 1, values  # the least of ``span`` values from each place on
        while 2 * span <= self.reach:
            have = np.minimum(have[:-span], have[span:])
            span *= 2
        rest = self.reach - span
        return np.minimum(have[: len(have) - rest], have[rest:])

    def blocks(self, a: Anchors) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """First and last suffix of each block of each anchor, where its core starts and ends, and whose it is.

        Blocks are cut by the distance to the anchor, so that equal strings share blocks; the
        core is what all suffixes of a whole block have in common.
        """
        near, far = (a.at - a.high) // BLOCK, (a.at - a.low) // BLOCK
        count = far - near + 1
        of = np.repeat(np.arange(len(count)), count)
        block = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + near[of]
        low = np.maximum(a.low[of], a.at[of] - (block + 1) * BLOCK + 1)
        high = np.minimum(a.high[of], a.at[of] - block * BLOCK)
        core = a.at[of] - block * BLOCK
        return low, high, core, core - BLOCK + 1 + self.length, of


def hashed(text: memoryview, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128-bit hashes of slices as two halves."""
    name = xxhash.xxh3_128_digest
    packed = b"".join([name(text[a:b]) for a, b in zip(start.tolist(), end.tolist())])
    both = np.frombuffer(packed, dtype=np.int64).reshape(-1, 2)
    return both[:, 0], both[:, 1]


def spread(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """All numbers of several closed ranges."""
    count = high - low + 1
    return np.arange(count.sum()) + np.repeat(low - (np.cumsum(count) - count), count)


@dataclass
class Passes:
    """What earlier passes have found; each is a sieve, none before its pass."""

    length: int
    grams: Broadcast | None = None  # grams that occur again
    wholes: Broadcast | None = None  # texts of all of an anchor's suffixes that do not occur again
    wanted: Broadcast | bool | None = None  # cores of the blocks of such suffixes
    cores: Broadcast | None = None  # of these, cores that occur again
    parts: Broadcast | None = None  # texts of wanted blocks that do not occur again
    ends: Broadcast | None = None  # cores of the blocks that need the last digit

    def run(self, data: bytes, radix: Radix, last: bool = True, ends: np.ndarray | None = None):
        """The keys of the next pass as (kind, a, b), and the suffixes known to be repeated as (low, high).

        ``data`` holds the texts one after the other, which end at ``ends``. For the last digit the kind is the place of the string. Wherever some block needs the
        next digit, all blocks with its core give theirs, also those already known to be
        repeated, as they may be where its strings occur again.
        """
        keys: list[tuple[int | np.ndarray, np.ndarray, np.ndarray]] = []
        found: list[tuple[np.ndarray, np.ndarray]] = []
        view, n = memoryview(data), self.length
        for a in radix.anchors(data, ends):
            if self.grams is None:
                keys.append((0, a.gram, a.gram * np.int64(3)))
                continue
            a = _those(a, self.grams.value.holds(a.gram, a.gram * np.int64(3)))
            x, y = hashed(view, a.low, a.high + n)
            if self.wholes is None:
                keys.append((0, x, y))
                continue
            open_ = self.wholes.value.holds(x, y)
            found.append((a.low[~open_], a.high[~open_]))
            low, high, core, core_end, of = radix.blocks(a)
            open_ = open_[of]
            if self.wanted is None:
                keys.append((0, *hashed(view, core[open_], core_end[open_])))
                continue
            cx, cy = hashed(view, core, core_end)
            if self.cores is None:
                here = self.wanted.value.holds(cx, cy)
                keys.append((0, cx[here], cy[here]))
                keys.append((1, *hashed(view, low[here], high[here] + n)))
                continue
            open_ &= self.cores.value.holds(cx, cy)
            at = np.flatnonzero(open_)
            unique = self.parts.value.holds(*hashed(view, low[at], high[at] + n))
            found.append((low[at[~unique]], high[at[~unique]]))
            if self.ends is None:
                keys.append((0, cx[at[unique]], cy[at[unique]]))
                continue
            if not last:
                continue
            here = self.ends.value.holds(cx, cy)
            at = spread(low[here], high[here])
            keys.append((at, *hashed(view, at, at + n)))
        return keys, found


def _those(a: Anchors, chosen: np.ndarray) -> Anchors:
    return Anchors(a.at[chosen], a.low[chosen], a.high[chosen], a.gram[chosen])


def in_a_row(batch: pa.RecordBatch, radix: Radix, last: bool = True) -> tuple[bytes, Radix, bool, np.ndarray]:
    """The texts of a batch in a row and where each ends, as ``Passes.run`` takes them."""
    texts = octets(batch)
    return b"".join(texts), radix, last, np.cumsum([len(t) for t in texts], dtype=np.int64)


def _keys(passes: Passes):
    """Rows (kind, a, b) of the next pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        radix = Radix(passes.length)
        for batch in pieces(batches):
            rows = passes.run(*in_a_row(batch, radix))[0]
            if rows:
                kind = np.concatenate([np.full(len(x), k, dtype=np.int8) for k, x, _ in rows])
                columns = [kind, *(np.concatenate([r[i] for r in rows]) for i in (1, 2))]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["kind", "a", "b"])

    return run


def _strings(passes: Passes):
    """Rows (name, at, a, b) of the last digit; name is the hash of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        radix = Radix(passes.length)
        for batch in pieces(batches):
            data, _, _, ends = both = in_a_row(batch, radix)
            rows, starts = passes.run(*both)[0], np.append(0, ends[:-1])
            if rows:
                at, x, y = (np.concatenate([r[i] for r in rows]) for i in range(3))
                whose = np.searchsorted(ends, at, "right")
                names = {k: xxhash.xxh3_128_digest(data[starts[k] : ends[k]]) for k in np.unique(whose).tolist()}
                columns = [pa.array([names[k] for k in whose.tolist()], pa.binary()), *map(pa.array, (at - starts[whose], x, y))]
                yield pa.RecordBatch.from_arrays(columns, names=["name", "at", "a", "b"])

    return run


def _counted(rows: DataFrame, passes: Passes) -> DataFrame:
    """The next pass's keys and whether they occur more than once."""
    keys = rows.select("text").mapInArrow(_keys(passes), "kind tinyint, a bigint, b bigint")
    return keys.groupBy("kind", "a", "b").agg((F.count("*") > 1).alias("member"))


def sort_passes(rows: DataFrame, length: int, log2: int | None = None) -> tuple[Passes, DataFrame]:
    """The passes over the column ``text``: what the sieves tell, and (name, places) of repeated last digits.

    Sieves have ``log2`` bits (log 2), or by default as many as their keys need. What a pass moves and stores goes
    before the next ones, but for the strings' places.
    """
    done = Passes(length)
    with lean(rows.sparkSession):
        places = settled(rows.sparkSession, lambda: _sorted(rows, done, log2))
    return done, places


def _sorted(rows: DataFrame, done: Passes, log2: int | None) -> DataFrame:
    def sieve(keys: DataFrame) -> Broadcast:
        return rows.sparkSession.sparkContext.broadcast(Sieve.of(keys, log2) if log2 else Sieve.sized(keys))

    def found(which: str) -> Broadcast:
        with passing(_counted(rows, done).filter(which).select("a", "b")) as keys:
            return sieve(keys)

    done.grams = found("member")
    done.wholes = found("not member")
    done.wanted = found("true")
    with passing(_counted(rows, done)) as blocks:
        done.cores, done.parts = sieve(blocks.filter("kind = 0 and member")), sieve(blocks.filter("kind = 1 and not member"))
    done.wanted = True  # not read any more, so workers need not keep it
    done.ends = found("true")
    # stored, as it is read twice
    strings = stored(rows.select("text").mapInArrow(_strings(done), "name binary, at bigint, a bigint, b bigint"))
    again = strings.groupBy("a", "b").agg(F.count("*").alias("n")).filter("n > 1").select("a", "b")
    places = strings.join(again, ["a", "b"]).select("name", "at").distinct()
    return places.groupBy("name").agg(F.sort_array(F.collect_list("at")).alias("places"))


def merged(found: list[tuple[np.ndarray, np.ndarray]], length: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes that the repeated suffixes' first ``length`` bytes cover."""
    if not found:
        return []
    low, high = (np.concatenate([f[k] for f in found]) for k in (0, 1))
    if not len(low):
        return []
    order = np.argsort(low, kind="stable")
    low, end = low[order], np.maximum.accumulate(high[order] + length)
    first = np.flatnonzero(np.concatenate([[True], low[1:] > end[:-1]]))
    return list(zip(low[first].tolist(), end[np.append(first[1:], len(low)) - 1].tolist()))


def _name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fills ``name``, the hash of the text; texts too short to repeat have none and join nothing."""
    for batch in pieces(batches):
        names = pa.array([xxhash.xxh3_128_digest(t) if t else None for t in octets(batch)], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("text"), names], names=["id", "text", "name"])


def repeats(docs: DataFrame, id: str = "doc_id", text: str = "text", length: int = LENGTH, log2: int | None = None) -> DataFrame:
    """One row per document: ``id``, n_bytes, spans (repeated bytes, end exclusive) and kept (the other bytes).

    A byte is repeated if a string of ``length`` bytes that covers it starts anywhere else
    too, in the same document or another one; strings never cross documents and are judged on
    the texts as given. Null counts as an empty text; repeated rows are documents of their
    own, so their strings repeat; an empty table gives an empty result; other columns are
    left out. ``kept`` is binary, as a run may end inside a character.
    """
    rows = docs.select(docs[id].alias("id"), docs[text].alias("text"))
    passes, places = sort_passes(rows, length, log2)
    rows = rows.withColumn("name", F.lit(None).cast("binary"))
    named = rows.mapInArrow(_name, rows.schema)
    joined = named.join(places, "name", "left").select("id", "text", "places")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        radix = Radix(length)
        for batch in pieces(batches):
            size, spans, kept = [], [], []
            data, _, _, ends = both = in_a_row(batch, radix, last=False)
            starts = np.append(0, ends[:-1])
            found = passes.run(*both)[1]
            for k, also in enumerate(batch.column("places").to_pylist()):
                if also:
                    found.append((np.array(also) + starts[k], np.array(also) + starts[k]))
            low, high = (np.concatenate([f[i] for f in found] or [starts[:0]]) for i in (0, 1))
            order = np.argsort(low, kind="stable")
            low, high = low[order], high[order]
            cut = np.searchsorted(low, np.append(starts, len(data) + 1))
            for k, (start, end) in enumerate(zip(starts.tolist(), ends.tolist())):
                mine = slice(cut[k], cut[k + 1])
                runs = merged([(low[mine] - start, high[mine] - start)], length)
                one = data[start:end]
                size.append(len(one))
                spans.append([{"start": a, "end": b} for a, b in runs])
                edges = [0, *(x for r in runs for x in r), len(one)]
                kept.append(b"".join([one[a:b] for a, b in zip(edges[::2], edges[1::2])]))
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            columns = [batch.column("id"), pa.array(size, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "n_bytes", "spans", "kept"])

    kind = rows.schema["id"].dataType.simpleString()
    schema = f"`{id}` {kind}, n_bytes bigint, spans array<struct<start:bigint,end:bigint>>, kept binary"
    return joined.mapInArrow(run, schema)
