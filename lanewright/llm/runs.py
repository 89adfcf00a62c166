"""Periodic runs of words, found with a grammar built by recompression.

The words of a batch of texts become one sequence of numbers; each text ends with a symbol
of its own. Recompression shortens the sequence level by level: blocks of equal symbols
become one symbol, then neighbours of which the first is in a left set and the second in a
right set, until every text is one symbol. Equal stretches are compressed alike except at
their borders, so the longest common extension of two places (LCE) is found by going up the
levels while both places start equal symbols and down again from the first difference.

A run of period p and length max(24, 3 p) or more holds a place i, a multiple of the grid
step max(2 p, 24 - p), such that i and i + p are both in it. Those places, for all p
(harmonically many), whose words agree are the candidates; extensions to both sides give
the run exactly. No suffix array is built.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from lanewright.llm.batches import octets, pieces

#: Grid places that are looked at together.
PLACES = 1 << 20
RUN = "struct<start:bigint,length:bigint,period:bigint>"


def numbered(keys: np.ndarray) -> np.ndarray:
    """Dense numbers of equal keys."""
    return pd.factorize(keys)[0].astype(np.int64)


class Grammar:
    """Levels of a sequence; negative symbols occur once each and are never compressed."""

    def __init__(self, symbols: np.ndarray):
        # of level k: symbols[k], first[k] (place of a symbol's first part in level k - 1),
        # parent[k] (place in level k + 1 of the symbol that holds it), blocks[k]: how it was made
        self.symbols, self.first, self.parent, self.blocks = [symbols], [np.arange(0)], [], [False]
        step = 0
        while len(now := self.symbols[-1]) > 1 and bool(((now[1:] >= 0) & (now[:-1] >= 0)).any()):
            starts, keys = self._blocks(now) if step % 2 == 0 else self._pairs(now, step)
            step += 1
            if len(starts) == len(now):
                continue
            self.symbols.append(np.where(now[starts] < 0, now[starts], numbered(keys)))
            self.first.append(starts)
            marks = np.zeros(len(now), dtype=np.int64)
            marks[starts] = 1
            self.parent.append(np.cumsum(marks) - 1)
            self.blocks.append(step % 2 == 1)

    @staticmethod
    def _blocks(now: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts = np.flatnonzero(np.concatenate(([True], now[1:] != now[:-1])))
        lengths = np.diff(np.append(starts, len(now)))
        return starts, now[starts] * (int(lengths.max()) + 1) + lengths

    @staticmethod
    def _pairs(now: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
        # the sets: a bit of the symbol's hash, another one at each level
        mixed = (now.view(np.uint64) + np.uint64(step)) * np.uint64(0x9E3779B97F4A7C15)
        right = ((mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(63)).astype(bool)
        paired = ~right[:-1] & right[1:] & (now[:-1] >= 0) & (now[1:] >= 0)
        starts = np.flatnonzero(~np.concatenate(([False], paired)))
        second = np.zeros(len(now), dtype=np.int64)
        second[:-1][paired] = now[1:][paired] + 1
        return starts, now[starts] * (int(now.max()) + 2) + second[starts]

    def mirrored(self) -> Grammar:
        """The grammar of the sequence read backwards."""
        out = Grammar.__new__(Grammar)
        out.symbols, out.blocks = [x[::-1].copy() for x in self.symbols], self.blocks
        out.first, out.parent = [self.first[0]], [len(above) - 1 - p[::-1] for above, p in zip(self.symbols[1:], self.parent)]
        for below, first in zip(self.symbols, self.first[1:]):
            last = np.append(first[1:], len(below)) - 1
            out.first.append(len(below) - 1 - last[::-1])
        return out

    def _left(self, k: int, x: np.ndarray) -> np.ndarray:
        """Symbols of level k from place x to the end of the symbol above that holds it."""
        first, above = self.first[k + 1], self.parent[k][x] + 1
        ends = np.where(above < len(first), first[np.minimum(above, len(first) - 1)], len(self.symbols[k]))
        return ends - x

    def extension(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """How many symbols from x on equal those from y on; x and y differ, within one text."""
        start, stopped = x, {}
        which = np.arange(len(x))
        for k, now in enumerate(self.symbols):
            differ = now[x] != now[y]
            stopped[k] = [(which[differ], x[differ], y[differ])]
            which, x, y = which[~differ], x[~differ], y[~differ]
            if not len(which):
                break
            # symbols of one text that are equal up here have a level above
            first, parent = self.first[k + 1], self.parent[k]
            inside = np.flatnonzero((first[parent[x]] != x) | (first[parent[y]] != y))
            if len(inside):
                ahead = np.minimum(self._left(k, x[inside]), self._left(k, y[inside]))
                x[inside] += ahead
                y[inside] += ahead
                differ = np.zeros(len(x), dtype=bool)
                differ[inside] = now[x[inside]] != now[y[inside]]
                stopped[k].append((which[differ], x[differ], y[differ]))
                which, x, y = which[~differ], x[~differ], y[~differ]
            x, y = parent[x], parent[y]
        which, x, y = (np.concatenate(c) for c in zip(*stopped[max(stopped)]))
        for k in range(max(stopped) - 1, -1, -1):
            now = self.symbols[k]
            x, y = self.first[k + 1][x], self.first[k + 1][y]
            same = np.flatnonzero(now[x] == now[y])
            if len(same):
                ahead = np.minimum(self._left(k, x[same]), self._left(k, y[same])) if self.blocks[k + 1] else 1
                x[same] += ahead
                y[same] += ahead
            which, x, y = (np.concatenate((a, *b)) for a, b in zip((which, x, y), zip(*stopped[k])))
        out = np.empty(len(start), dtype=np.int64)
        out[which] = x - start[which]
        return out


def grid(firsts: np.ndarray, sizes: np.ndarray, low: int, high: int, least: int, times: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place, period) of the grids of periods low to high in texts that start at ``firsts``, ``PLACES`` or so at a time."""
    longest = np.where(sizes >= least, sizes // times, 0)
    fit = np.flatnonzero(longest >= low)
    each = np.minimum(longest[fit], high) - low + 1
    text = np.repeat(fit, each)
    period = np.arange(len(text)) - np.repeat(np.cumsum(each) - each, each) + low
    step = np.maximum((times - 1) * period, least - period)
    counts = -(-(sizes[text] - period) // step)
    ends = np.cumsum(counts)
    at = 0
    while at < len(text):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PLACES, "right")))
        n, own = counts[at:stop], slice(at, stop)
        k = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        yield np.repeat(firsts[text[own]], n) + k * np.repeat(step[own], n), np.repeat(period[own], n)
        at = stop


def runs_of(symbols: np.ndarray, firsts: np.ndarray, sizes: np.ndarray, least: int, times: int) -> np.ndarray:
    """(start, end, period) of all runs, by start, then period; texts lie in ``symbols``, an own end after each."""
    found = np.empty((0, 3), dtype=np.int64)
    longest = int(np.where(sizes >= least, sizes // times, 0).max(initial=0))
    if not longest:
        return found
    ahead, size = Grammar(symbols), len(symbols)
    behind = ahead.mirrored()
    # the last run found over each word: places in a run of a divisor of their period say nothing new
    covered, until = np.zeros(size, dtype=np.int64), np.zeros(size, dtype=np.int64)
    low = 1
    while low <= longest:
        for i, p in grid(firsts, sizes, low, 2 * low - 1, least, times):
            alike = symbols[i] == symbols[i + p]
            i, p = i[alike], p[alike]
            known = (covered[i] > 0) & (p % np.maximum(covered[i], 1) == 0) & (i + p < until[i])
            i, p = i[~known], p[~known]
            if not len(i):
                continue
            start = i - behind.extension(size - i - p, size - i)
            end = i + p + ahead.extension(i, i + p)
            long = end - start >= np.maximum(least, times * p)
            new = np.unique(np.stack((start[long], end[long], p[long]), axis=1), axis=0)
            for s, e, q in new[::-1].tolist():  # of one stretch, the least period comes last
                covered[s:e], until[s:e] = q, e
            found = np.concatenate((found, new))
        low *= 2
    found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
    fresh = np.concatenate(([True], (found[1:, :2] != found[:-1, :2]).any(axis=1)))[: len(found)]
    found = found[fresh]  # the least period of each stretch
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def texts_runs(texts: list[bytes], least: int, times: int) -> list[tuple[int, list[dict], bytes]]:
    """For each text: its number of words, its runs and the text without their repetitions."""
    words = [t.split() for t in texts]  # of bytes: at ASCII white space
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    every = np.array([w for text in words for w in text], dtype=object)
    # an end of its own before the first and after each text
    firsts = 1 + np.cumsum(sizes + 1) - (sizes + 1)
    symbols = np.full(int(sizes.sum()) + len(texts) + 1, -1, dtype=np.int64)
    inside = np.arange(len(every)) + np.repeat(np.arange(len(texts)) + 1, sizes)
    symbols[inside] = numbered(every) if len(every) else 0
    ends = np.append(0, firsts + sizes)
    symbols[ends] = -1 - np.arange(len(ends))
    found = runs_of(symbols, firsts, sizes, least, times)
    owner = np.searchsorted(firsts, found[:, 0], "right") - 1
    kept = np.ones(len(symbols), dtype=bool)
    runs: list[list[dict]] = [[] for _ in texts]
    for k, (s, e, q) in zip(owner.tolist(), found.tolist()):
        kept[s + q : e] = False
        runs[k].append({"start": s - int(firsts[k]), "length": e - s, "period": q})
    out = []
    for k, own in enumerate(words):
        if runs[k]:
            own = [w for w, keep in zip(own, kept[firsts[k] : firsts[k] + sizes[k]].tolist()) if keep]
        out.append((int(sizes[k]), runs[k], b" ".join(own)))
    return out


def periodic_runs(docs: DataFrame, id: str = "doc_id", text: str = "text", least: int = 24, times: int = 3) -> DataFrame:
    """One row per document: ``id``, ``n_words``, ``runs`` and ``collapsed``.

    Words are what stands between ASCII white space. A run is a stretch of words with least
    period q, at least ``least`` words and ``times`` periods long (``times`` from 2 on), that
    no neighbouring word continues. ``runs`` lists start (from 0), length and period by start, then
    period. ``collapsed`` is the text without the words that a run contains after its first
    q, joined by one space. A null or empty text has no words and no runs; rows are taken one
    by one, so repeated ids stay repeated; other columns are left out. A task holds the
    grammar of 4 MB of texts, or of one longer text.
    """
    if times < 2:
        raise ValueError("a run has two periods at least")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            sizes, runs, texts = zip(*texts_runs(octets(batch), least, times))
            kind = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))
            columns = [pa.array(sizes, pa.int64()), pa.array(runs, kind), pa.array(texts, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *columns], names=[id, "n_words", "runs", "collapsed"])

    rows = docs.select(docs[id].alias("id"), docs[text].alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id}` {kind}, n_words bigint, runs array<{RUN}>, collapsed string")
