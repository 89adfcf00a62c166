"""Secret scan: three fixed patterns, and random strings found by their cost in tokens.

Text that people write costs a byte-pair vocabulary few tokens; random strings break into
pieces of one or two characters. A run of 20 or more key characters that mixes letters
with digits is a secret if it has few characters per token, unless it is a known digest
(hexadecimal of a digest's length), an identifier (UUID, number, version, address, path,
host name) or named as one by the word before it.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanewright.llm.batches import pieces, strings
from lanewright.llm.spans import apart

#: Kinds in the order in which spans of equal start are listed; "random" is the token-efficiency test's.
KINDS = ("assign", "access", "hex", "random")

# fixed values: the base patterns
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]+")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 8, 16, 32

#: Shortest run of the token-efficiency test.
MIN_RUN = 20
#: A run is random at no more characters per token than this.
MAX_RATIO = 2.0
#: Characters of a run that are encoded together.
RUN_PIECE = 1024

RUN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % MIN_RUN)
_LONG_HEX = re.compile(r"[0-9a-f]{%d}" % MIN_HEX)
_DIGIT, _LETTER = re.compile(r"[0-9]"), re.compile(r"[A-Za-z]")
DIGEST = re.compile(r"(?:[0-9a-f]+|[0-9A-F]+)")
DIGEST_LENGTHS = {32, 40, 48, 56, 64, 96, 128}
IDENTIFIER = re.compile(
    r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}"  # UUID
    r"|[0-9+/_=-]+"  # numbers, dates, ranges
    r"|(?:[A-Za-z]+|[0-9]+)(?:[/_-]+(?:[A-Za-z]+|[0-9]+))*[/_-]?"  # names and paths of words and numbers
)
NAMED = re.compile(
    r"(?:md5|sha-?[0-9]*|digest|checksum|hash|commit|etag|uuid|guid|revision|blob|doi|isbn|integrity)[\"']?\s*[:=/ (-]\s*[\"']?$",
    re.IGNORECASE,
)


@lru_cache(maxsize=2)
def vocabulary(path: str) -> tiktoken.Encoding:
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("runs", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ratio(run: str, path: str) -> float:
    """Characters per token."""
    encode = vocabulary(path).encode_ordinary
    return len(run) / sum(len(encode(run[k : k + RUN_PIECE])) for k in range(0, len(run), RUN_PIECE))


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns; matches that are too short are dropped, not tried again."""
    found = []
    if ":" in text or "=" in text:
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_ASSIGN]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    if _LONG_HEX.search(text):
        found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text) if m.end() - m.start() >= MIN_HEX]
    return found


def random_spans(text: str, path: str, max_ratio: float = MAX_RATIO) -> list[tuple[int, int, str]]:
    """(start, end, "random") of the runs that fail the token-efficiency test."""
    found = []
    for m in RUN.finditer(text):
        run = m[0]
        if not (_DIGIT.search(run) and _LETTER.search(run)):
            continue
        if DIGEST.fullmatch(run) and len(run) in DIGEST_LENGTHS or IDENTIFIER.fullmatch(run):
            continue
        if NAMED.search(text[max(0, m.start() - 24) : m.start()]):
            continue
        if ratio(run, path) <= max_ratio:
            found.append((m.start(), m.end(), "random"))
    return found


def spans(text: str, path: str, max_ratio: float = MAX_RATIO) -> list[tuple[int, int, str]]:
    """All spans by start, then kind; a random run that touches a base span is that span already."""
    base = base_spans(text)
    return sorted(base + apart(random_spans(text, path, max_ratio), base), key=lambda s: (s[0], KINDS.index(s[2])))


SPANS = "array<struct<start:int,end:int,kind:string>>"


def scan(
    docs: DataFrame, id: str = "doc_id", text: str = "text", path: str | None = None, max_ratio: float = MAX_RATIO
) -> DataFrame:
    """One row per document: ``id`` and ``spans``, structs of start, end (exclusive, code points) and kind.

    A null or empty text has no spans; an empty table gives an empty result; repeated rows
    are scanned one by one; other columns are left out.
    """
    path = path or public_tokenizers.path("byte_bpe_50k.tiktoken")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))
        for batch in pieces(batches):
            found = [
                [{"start": a, "end": b, "kind": k} for a, b, k in spans(t, path, max_ratio)] for t in strings(batch)
            ]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found, type=kind)], names=[id, "spans"])

    rows = docs.select(docs[id].alias("id"), docs[text].alias("text"))
    return rows.mapInArrow(run, f"`{id}` {rows.schema['id'].dataType.simpleString()}, spans {SPANS}")


def masked(text: str, path: str, max_ratio: float = MAX_RATIO) -> str:
    """The text with each stretch of spans replaced by <secret>."""
    out, at = [], 0
    for start, end, _ in spans(text, path, max_ratio):
        if start >= at:
            out += [text[at:start], "<secret>"]
        at = max(at, end)
    return "".join(out) + text[at:] if out else text


def mask(docs: DataFrame, text: str = "text", path: str | None = None, max_ratio: float = MAX_RATIO) -> DataFrame:
    """The documents with their secrets replaced by ``<secret>``; all rows and columns stay.

    ``n_chars``, if there is such a column, is counted anew for the texts that change. A
    null text stays null. Columns keep their names and order, whatever they are called.
    """
    path = path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text):
            new = [None if t is None else masked(t, path, max_ratio) for t in batch.column(at).to_pylist()]
            yield batch.set_column(at, batch.schema.field(at), pa.array(new, type=batch.schema.field(at).type))

    out = docs.mapInArrow(run, docs.schema)
    if "n_chars" in out.columns:
        count = F.when(F.col(text).isNotNull(), F.length(text)).otherwise(F.col("n_chars"))
        out = out.withColumn("n_chars", count.cast(docs.schema["n_chars"].dataType))
    return out
