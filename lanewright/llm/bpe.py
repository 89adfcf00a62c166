"""Byte-pair encoding and decoding with a given word-end vocabulary (speculate and verify).

A word is proposed as its greedy longest matches. The proposal is the exact encoding if
each of its tokens encodes to itself and each adjacent pair is compatible, that is, if no
merge across the pair's border comes before the merges that made the two tokens. All
pairs of a batch are tested at once in numpy; only words with a failing pair (or a token
that cannot be reached by merges) are merged step by step.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame

from lanewright.llm.batches import cuts, pieces, strings

#: Words kept with their tokens in a worker; when there are more, the store starts anew.
KNOWN_WORDS = 200_000
#: Longer words are encoded each time they occur.
KNOWN_LENGTH = 64

# fixed values: Unicode's White_Space
SPACE = "".join(map(chr, [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
# fixed values: letters and numbers of Unicode 16, which Python's tables (15.1) do not have yet
NEW_LETTERS = [(0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65),
               (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E),
               (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0),
               (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED),
               (0x1E5F0, 0x1E5F0)]
NEW_NUMBERS = [(0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79),
               (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA)]
WORD_END = "</w>"


def default_vocabulary() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


def byte_letters() -> dict[int, str]:
    """Printable bytes of Latin-1 stand for themselves, the others for letters from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    other = iter(range(256, 512))
    return {b: chr(b if b in plain else next(other)) for b in range(256)}


def members(kind: str, more: list[tuple[int, int]]) -> str:
    """The characters of a general category as ranges of a character class."""
    own = {c for a, b in more for c in range(a, b + 1)}
    inside = [unicodedata.category(chr(c))[0] == kind or c in own for c in range(0x110000)] + [False]
    edges = [c for c in range(0x110001) if inside[c] != (c > 0 and inside[c - 1])]
    return "".join(f"\\U{a:08x}-\\U{b - 1:08x}" for a, b in zip(edges[::2], edges[1::2]))


def word_pattern() -> re.Pattern:
    """The splitting pattern of the vocabulary's file; its classes are letters, numbers and white space.

    Letters may come before the endings after an apostrophe, as these begin with none.
    """
    letters, numbers = members("L", NEW_LETTERS), members("N", NEW_NUMBERS)
    return re.compile(f"[{letters}]+|'(?:s|t|re|ve|m|ll|d)|[{numbers}]|[^{SPACE}{letters}{numbers}]+")


ASCII_WORD = re.compile(r"[a-z]+|'(?:s|t|re|ve|m|ll|d)|[0-9]|[^\t-\r a-z0-9]+")
#: Symbols from which on merging uses a queue.
LONG = 32


class WordBpe:
    """Encoder and decoder for one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.vocab = vocab
        self.names = [""] * (max(*vocab.values(), *self.special.values()) + 1)
        for text, i in [*vocab.items(), *self.special.items()]:
            self.names[i] = text
        self.longest = max(map(len, vocab))
        self.letters = byte_letters()
        size = len(self.names)
        # the merge that makes a token: its order and its two parts (-1: a single byte)
        self.order = np.full(size, -1, dtype=np.int64)
        self.left, self.right = np.zeros(size, dtype=np.int64), np.zeros(size, dtype=np.int64)
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for k, (a, b) in enumerate(merges):
            a, b, made = vocab[a], vocab[b], vocab[a + b]
            self.merges.setdefault((a, b), (k, made))
            if self.order[made] < 0:
                self.order[made], self.left[made], self.right[made] = k, a, b
        self.orders = {pair: k for pair, (k, _) in self.merges.items()}
        self.made = [vocab[a + b] for a, b in merges]
        keys = np.array([a * size + b for a, b in self.merges], dtype=np.int64)
        at = np.argsort(keys)
        self.pair_keys = keys[at]
        self.pair_order = np.array([k for k, _ in self.merges.values()], dtype=np.int64)[at]
        self.reached = np.zeros(size, dtype=np.int8)  # 1: encodes to itself, -1: does not, 0: not tried yet
        self.split = word_pattern()
        self.split_special = re.compile("|".join(map(re.escape, self.special))) if self.special else None
        self.known: dict[str, bytes] = {}

    # --- words -------------------------------------------------------------------------

    def words(self, text: str) -> list[str]:
        """Normalised words of a text without special tokens: composed, lower case per letter."""
        if text.isascii():
            return ASCII_WORD.findall(text.lower())
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # lower() looks at a sigma's place
        return self.split.findall(text.lower())

    def symbols(self, word: str) -> str:
        if not (word.isascii() and word.isprintable()):
            word = "".join(map(self.letters.__getitem__, word.encode("utf-8", "surrogatepass")))
        return word

    def speculate(self, word: str) -> list[int] | None:
        """Greedy longest matches; None if some place has none."""
        vocab, found, at, n = self.vocab, [], 0, len(word)
        while at < n:
            token = vocab.get(word[at:] + WORD_END) if n - at <= self.longest else None
            stop = n
            if token is None:
                stop = min(n - 1, at + self.longest)
                while stop > at and (token := vocab.get(word[at:stop])) is None:
                    stop -= 1
                if token is None:
                    return None
            found.append(token)
            at = stop
        return found

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the exact encoding of the two tokens' joined texts is these two tokens.

        Goes back in time: of the tokens at the border, the one that was made last is taken
        apart. While two tokens stand side by side, a merge of them wins if it comes before
        the merges that take them away (on the right also at the same order, as the
        leftmost of equal merges goes first).
        """
        never = np.iinfo(np.int64).max
        x, y = a.astype(np.int64), b.astype(np.int64)
        x_until, y_until = np.full(len(x), never), np.full(len(x), never)
        good, live = np.ones(len(x), dtype=bool), np.arange(len(x))
        while len(live):
            key = x[live] * len(self.names) + y[live]
            at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
            merge = np.where(self.pair_keys[at] == key, self.pair_order[at], never)
            bad = (merge < x_until[live]) & (merge <= y_until[live]) & (merge < never)
            good[live[bad]] = False
            live = live[~bad]
            x_made, y_made = self.order[x[live]], self.order[y[live]]
            going = (x_made >= 0) | (y_made >= 0)
            live, x_made, y_made = live[going], x_made[going], y_made[going]
            on_left = x_made > y_made
            i, j = live[on_left], live[~on_left]
            x_until[i], y_until[j] = x_made[on_left], y_made[~on_left]
            x[i], y[j] = self.right[x[i]], self.left[y[j]]
        return good

    def merged(self, word: str) -> list[int]:
        """Exact encoding: always the earliest merge, of equal ones the leftmost."""
        tokens = [self.vocab.get(c) for c in word[:-1]] + [self.vocab.get(word[-1:] + WORD_END)]
        tokens = [t for t in tokens if t is not None]  # symbols the vocabulary lacks are left out
        if len(tokens) < LONG:
            return self.merged_short(tokens)
        after, before = list(range(1, len(tokens) + 1)), list(range(-1, len(tokens) - 1))
        queue = []
        for i, pair in enumerate(zip(tokens, tokens[1:])):
            if found := self.merges.get(pair):
                queue.append((found[0], i, *pair, found[1]))
        heapq.heapify(queue)
        while queue:
            _, i, a, b, made = heapq.heappop(queue)
            j = after[i] if tokens[i] == a else len(tokens)
            if j >= len(tokens) or tokens[j] != b:
                continue
            tokens[i], tokens[j] = made, -1
            after[i] = k = after[j]
            if k < len(tokens):
                before[k] = i
                if found := self.merges.get((made, tokens[k])):
                    heapq.heappush(queue, (found[0], i, made, tokens[k], found[1]))
            if (h := before[i]) >= 0 and (found := self.merges.get((tokens[h], made))):
                heapq.heappush(queue, (found[0], h, tokens[h], made, found[1]))
        return [t for t in tokens if t >= 0]

    def merged_short(self, tokens: list[int]) -> list[int]:
        """The same for few symbols: the order of each pair's merge in a list, the least one first."""
        get, never = self.orders.get, len(self.made)
        orders = [get(p, never) for p in zip(tokens, tokens[1:])]
        while orders and (least := min(orders)) < never:
            i, made = orders.index(least), self.made[least]
            tokens[i : i + 2] = [made]
            del orders[i]
            if i:
                orders[i - 1] = get((tokens[i - 1], made), never)
            if i < len(orders):
                orders[i] = get((made, tokens[i + 1]), never)
        return tokens

    def reach(self, tokens: np.ndarray) -> np.ndarray:
        """Whether each token encodes to itself."""
        for t in np.unique(tokens[self.reached[tokens] == 0]):
            name = self.names[t]
            if name.endswith(WORD_END):
                whole = self.merged(name[: -len(WORD_END)])
            else:
                # as the start of a longer word: a last symbol that merges with nothing before it
                whole = self.merged_open(name)
            self.reached[t] = 1 if whole == [t] else -1
        return self.reached[tokens] > 0

    def merged_open(self, word: str) -> list[int]:
        """Exact encoding of a word's start, which has no word end."""
        return self.merged_short([self.vocab[c] for c in word])

    def encode_words(self, words: Iterable[str]) -> dict[str, bytes]:
        """Packed tokens of each word: proposals, one test of all their pairs, merging of the rest."""
        words = list(words)
        shapes = [self.symbols(w) for w in words]
        proposals = [self.speculate(s) for s in shapes]
        lengths = np.array([len(p or ()) for p in proposals], dtype=np.int64)
        tokens = np.fromiter((t for p in proposals for t in p or ()), dtype=np.int64, count=int(lengths.sum()))
        owner = np.repeat(np.arange(len(words)), lengths)
        failed = lengths == 0
        if len(tokens):
            failed[owner[~self.reach(tokens)]] = True
            inner = np.flatnonzero(owner[1:] == owner[:-1])
            pairs, of = np.unique(tokens[inner] * len(self.names) + tokens[inner + 1], return_inverse=True)
            fits = self.compatible(pairs // len(self.names), pairs % len(self.names))
            failed[owner[inner[~fits[of]]]] = True
        packed = tokens.astype("<u4").tobytes()
        ends = np.cumsum(lengths) * 4
        out = {}
        for k, word in enumerate(words):
            if failed[k]:
                out[word] = np.array(self.merged(shapes[k]), dtype="<u4").tobytes()
            else:
                out[word] = packed[ends[k] - 4 * lengths[k] : ends[k]]
        return out

    # --- texts -------------------------------------------------------------------------

    def parts(self, text: str) -> Iterator[list[str] | bytes]:
        """Lists of words, and packed special tokens between them."""
        start = 0
        for found in self.split_special.finditer(text) if self.split_special and "<" in text else ():
            yield self.words(text[start : found.start()])
            yield np.array([self.special[found[0]]], dtype="<u4").tobytes()
            start = found.end()
        yield self.words(text[start:])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Tokens of each text, packed as little-endian unsigned 32-bit integers."""
        cut = [[list(self.parts(piece)) for piece in cuts(text)] for text in texts]
        new = {w for text in cut for piece in text for part in piece if isinstance(part, list) for w in part}
        if len(self.known) > KNOWN_WORDS:
            self.known = {}
        new.difference_update(self.known)
        found = self.encode_words(new)
        self.known.update((w, t) for w, t in found.items() if len(w) <= KNOWN_LENGTH)
        get = (found | self.known).__getitem__ if any(len(w) > KNOWN_LENGTH for w in found) else self.known.__getitem__
        return [
            b"".join([part if isinstance(part, bytes) else b"".join(map(get, part)) for piece in text for part in piece])
            for text in cut
        ]

    def decode(self, packed: bytes) -> str:
        """The vocabulary's names of the tokens, joined by a space (the file names no decoder)."""
        return " ".join(map(self.names.__getitem__, np.frombuffer(packed, dtype="<u4").tolist()))


@lru_cache(maxsize=2)
def vocabulary(path: str) -> WordBpe:
    """The vocabulary of a file, read once per worker."""
    return WordBpe(path)


def encode(docs: DataFrame, id: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """One row per document: ``id`` and ``ids``, its tokens packed as little-endian uint32.

    A null or empty text has no tokens. Rows are taken one by one, so repeated ids stay
    repeated; other columns are left out. Every machine needs the vocabulary file at
    ``path`` (default: the installed 49k-word vocabulary).
    """
    path = path or default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        for batch in pieces(batches):
            ids = pa.array(bpe.encode(strings(batch)), type=pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("id"), ids], names=[id, "ids"])

    rows = docs.select(docs[id].alias("id"), docs[text].alias("text"))
    return rows.mapInArrow(run, f"`{id}` {rows.schema['id'].dataType.simpleString()}, ids binary")


def decode(tokens: DataFrame, id: str = "doc_id", ids: str = "ids", path: str | None = None) -> DataFrame:
    """One row per row of ``tokens``: ``id``, ``ids`` and ``text``, the decoded tokens (none: empty)."""
    path = path or default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        for batch in pieces(batches, "ids"):
            text = pa.array([bpe.decode(x or b"") for x in batch.column("ids").to_pylist()], type=pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, text], names=[id, "ids", "text"])

    rows = tokens.select(tokens[id].alias("id"), tokens[ids].alias("ids"))
    return rows.mapInArrow(run, f"`{id}` {rows.schema['id'].dataType.simpleString()}, ids binary, text string")
