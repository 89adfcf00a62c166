"""N-gram Jaccard join by filtering under several global token orders.

A document is the set of its word 5-grams. If two sets have a Jaccard similarity of at
least t, then under any order of all tokens the first tokens of the two sets (about a
share 1 - t of each) have one in common. So candidates must share such a token under every
order that is tried:

1. Hash order. The first tokens of all documents are grouped; those of one document alone
   drop out. The prefixes are a little longer than needed (``SLACK``), so that linked
   documents share several tokens, and a document with fewer shared ones is done: this
   removes texts that merely contain a common passage.
2. Rarest first, by the group sizes of step 1. Of its shared tokens a document offers only
   the rarest, just so many that a linked document must offer one of them, too.
3. A second hash order, tested for each pair before its sets are compared in full.

Equal sets are one class from the start. Candidates of similar size that hang together form
groups (copies of one text, as a rule). Within a group all documents are compared with the most typical
one, then those that are not linked to it with all of the group, in blocks of bounded size:
no pair is emitted unless it is a link, no link between different texts is lost, and no
task holds more than two blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lanewright.llm.batches import octets, pieces
from lanewright.llm.components import components
from lanewright.llm.decontaminate import PIECE
from lanewright.llm.shared import stored
from lanewright.llm.sieve import Sieve

#: Words of a shingle, and the least similarity of a link in hundredths.
WORDS, PERCENT = 5, 80
#: Hundredths of a set by which its prefix is longer than one shared token needs.
SLACK = 10
#: Bits of the first sieve of step 1 (log 2): a fixed-size filter of shared tokens. It only saves work.
SIEVE_LOG2 = 26
#: Documents and tokens of a block: a group's documents move once for each block of the other side.
BLOCK_ROWS, BLOCK_TOKENS = 1024, 1 << 19
#: Pairs of sets for each meeting at a token from which it is counted by a matrix; a matrix's columns, pairs counted at a time.
DENSE, COLUMNS, PAIRS = 128, 2048, 1 << 20
#: Words kept with their hashes in a worker; when there are more, the store starts anew.
KNOWN_WORDS = 150_000

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_BLANKS = frozenset(b" \t\n\r\x0b\x0c")
_FACTORS = [np.uint64(f) for f in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]
_ORDER = np.uint64(0xFF51AFD7ED558CCD)


class Hashes(dict):
    """64-bit hashes of words, remembered."""

    def __missing__(self, word: bytes) -> int:
        found = xxhash.xxh64_intdigest(word)
        if len(self) < KNOWN_WORDS:
            self[word] = found
        return found


def word_hashes(text: bytes, known: Hashes) -> np.ndarray:
    parts, start, text = [], 0, text.translate(_LOWER)
    while start < len(text):
        stop = min(len(text), start + PIECE)
        while stop < len(text) and text[stop] not in _BLANKS:
            stop += 1
        words = text[start:stop].split()
        parts.append(np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words)))
        start = stop
    return np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint64)


def tokens_of(text: bytes, known: Hashes, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles, or of all its words if they are fewer."""
    hashes = word_hashes(text, known)
    if not len(hashes):
        return hashes
    size = min(words, len(hashes))
    out = np.full(len(hashes) - size + 1, size, dtype=np.uint64)
    for j in range(size):
        out = (out ^ hashes[j : len(out) + j]) * _FACTORS[j % len(_FACTORS)]
        out ^= out >> np.uint64(29)
    return np.unique(out)


def least_overlap(n, percent: int):
    """Tokens that a set of n must share with any linked one."""
    return -(-percent * n // 100)


def prefix_length(n: int, percent: int) -> int:
    """First tokens of which linked documents share several."""
    return min(n, n - least_overlap(n, percent) + SLACK * n // 100 + 1)


def shared_needed(n: int, percent: int) -> int:
    """How many tokens of its prefix a document shares with any linked one (which may be smaller)."""
    return SLACK * least_overlap(n, percent) // 100 + 1


def _named(batch: pa.RecordBatch, known: Hashes, words: int) -> Iterator[tuple[np.ndarray, bytes, int]]:
    """The tokens of each document, the set's 128-bit name, and 64 bits of it for the search of candidates."""
    for text in octets(batch):
        tokens = tokens_of(text, known, words)
        name = xxhash.xxh3_128_digest(tokens.tobytes())
        yield tokens, name, int.from_bytes(name[:8], "little", signed=True)


def _prefixes(words: int, percent: int):
    """Rows (token, owner) of each document's prefix in hash order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Hashes()
        for batch in pieces(batches):
            parts, owners = [], []
            for tokens, _, owner in _named(batch, known, words):
                first = tokens[: prefix_length(len(tokens), percent)]
                parts.append(first.view(np.int64))
                owners.append(np.full(len(first), owner, dtype=np.int64))
            columns = [pa.array(np.concatenate(parts)), pa.array(np.concatenate(owners))]
            yield pa.RecordBatch.from_arrays(columns, names=["token", "owner"])
            if len(known) >= KNOWN_WORDS:
                known = Hashes()

    return run


def _sets(words: int, percent: int, sieve):
    """A row for each document; the set and the shared part of the prefix only if it may be linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Hashes()
        for batch in pieces(batches):
            size, names, owners, sets, firsts = [], [], [], [], []
            for tokens, name, owner in _named(batch, known, words):
                n = len(tokens)
                first = tokens[: prefix_length(n, percent)]
                first = first[sieve.value.holds(first.view(np.int64), _other_half(first))]
                may = n > 0 and len(first) >= shared_needed(n, percent)
                size.append(n)
                names.append(name)
                owners.append(owner)
                sets.append(tokens.tobytes() if may else None)
                firsts.append(first.view(np.int64) if may else None)
            columns = [
                batch.column("id"), pa.array(size, pa.int64()), pa.array(names, pa.binary()), pa.array(owners, pa.int64()),
                pa.array(sets, pa.binary()), pa.array(firsts, pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "n", "name", "owner", "tokens", "firsts"])
            if len(known) >= KNOWN_WORDS:
                known = Hashes()

    return run


def _other_half(tokens: np.ndarray) -> np.ndarray:
    """The halves of each token exchanged, as the second part of a sieve's key."""
    return ((tokens << np.uint64(32)) | (tokens >> np.uint64(32))).view(np.int64)


def common_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Numbers of common tokens of each left with each right set.

    Tokens that many of the sets have are counted by matrix products, the others pair by pair;
    both in pieces, so memory is that of the result.
    """
    out = np.zeros((len(left), len(right)))
    shared = np.intersect1d(np.unique(np.concatenate(left)), np.unique(np.concatenate(right)), assume_unique=True)
    if not len(shared):
        return out
    (lt, lw), (rt, rw) = _placed(left, shared), _placed(right, shared)
    lefts, rights = np.bincount(lt, minlength=len(shared)), np.bincount(rt, minlength=len(shared))
    dense = np.flatnonzero(lefts * rights * DENSE > out.size)
    column = np.full(len(shared), -1)
    column[dense] = np.arange(len(dense))
    for k in range(0, len(dense), COLUMNS):
        sides = []
        for at, whose, n in ((column[lt], lw, len(left)), (column[rt], rw, len(right))):
            here = (at >= k) & (at < k + COLUMNS)
            side = np.zeros((n, min(COLUMNS, len(dense) - k)), dtype=np.float32)
            side[whose[here], at[here] - k] = 1
            sides.append(side)
        out += sides[0] @ sides[1].T
    # the others: each left occurrence meets the token's right ones, which lie in a row
    rare = column[lt] < 0
    lt, lw, first = lt[rare], lw[rare], np.cumsum(rights) - rights
    ends = np.cumsum(rights[lt])
    start = 0
    while start < len(lt):
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + PAIRS, "right")))
        count = rights[lt[start:stop]]
        at = np.arange(count.sum()) + np.repeat(first[lt[start:stop]] - (np.cumsum(count) - count), count)
        pairs = np.repeat(lw[start:stop], count) * len(right) + rw[at]
        out += np.bincount(pairs, minlength=out.size).reshape(out.shape)
        start = stop
    return out


def _placed(sets: list[np.ndarray], shared: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each occurrence of a shared token stands in ``shared``, and whose it is, by place."""
    tokens, whose = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    at = np.minimum(np.searchsorted(shared, tokens), len(shared) - 1)
    here = shared[at] == tokens
    at, whose = at[here], whose[here]
    order = np.argsort(at, kind="stable")
    return at[order], whose[order]


def second_prefix(tokens: np.ndarray, percent: int) -> set[int]:
    """First tokens under the second hash order; linked documents have one in common."""
    order = (tokens ^ (tokens >> np.uint64(31))) * _ORDER
    size = len(tokens) - least_overlap(len(tokens), percent) + 1
    return set(tokens[np.argpartition(order, size - 1)[:size]].tolist()) if size < len(tokens) else set(tokens.tolist())


def links_between(left: list[np.ndarray], right: list[np.ndarray], percent: int) -> np.ndarray:
    """Whether each left set is linked to each right one; only sets that meet under the second order are compared in full."""
    a, b = (np.array([len(x) for x in sets], dtype=np.int64) for sets in (left, right))
    can = 100 * np.minimum(a[:, None], b) >= percent * np.maximum(a[:, None], b)
    firsts = [[np.array(list(second_prefix(x, percent)), dtype=np.uint64) for x in sets] for sets in (left, right)]
    can &= common_counts(*firsts) > 0
    i, j = np.flatnonzero(can.any(axis=1)), np.flatnonzero(can.any(axis=0))
    if len(i):
        common = common_counts([left[k] for k in i], [right[k] for k in j])
        can[np.ix_(i, j)] &= 100 * common >= percent * (a[i][:, None] + b[j] - common)
    return can


def _compare(percent: int):
    """Links between the left and the right documents of a block pair, as few as join what is linked."""

    def run(group: pa.Table) -> pa.Table:
        blob, owners = group.column("blob")[0].as_py(), group.column("owner").to_numpy()
        sets = [np.frombuffer(x, dtype=np.uint64) for x in group.column("tokens").to_pylist()]
        side = group.column("right").to_numpy()
        left, right = np.flatnonzero(~side), np.flatnonzero(side)
        a, b = [], []
        if len(left) and len(right):
            names, place = np.unique(owners, return_inverse=True)
            root = np.arange(len(names))
            for k, row in zip(place[left], links_between([sets[k] for k in left], [sets[k] for k in right], percent)):
                found = place[right][row]
                roots, first = np.unique(root[found], return_index=True)
                new = found[first[roots != root[k]]]
                a.extend([names[k]] * len(new))
                b.extend(names[new])
                root[np.isin(root, roots)] = root[k]
        return pa.table({"blob": pa.array([blob] * len(a), pa.int64()), "a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def _in_blocks(left: DataFrame, right: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (blob, a, b) between the left and the right owners of each group (columns: blob, owner, n)."""

    def cut(rows: DataFrame) -> DataFrame:
        count = F.greatest(F.ceil(F.count("*") / BLOCK_ROWS), F.ceil(F.sum("n") / BLOCK_TOKENS))
        return rows.groupBy("blob").agg(count.cast("int").alias("blocks"))

    cuts = cut(left).withColumnRenamed("blocks", "lefts").join(cut(right).withColumnRenamed("blocks", "rights"), "blob")
    # each row goes to its own block, once for each block of the other side
    mine = left.join(cuts, "blob").withColumn("i", F.expr("cast(pmod(xxhash64(owner), lefts) as int)"))
    mine = mine.withColumn("j", F.explode(F.expr("sequence(0, rights - 1)"))).withColumn("right", F.lit(False))
    other = right.join(cuts, "blob").withColumn("j", F.expr("cast(pmod(xxhash64(owner), rights) as int)"))
    other = other.withColumn("i", F.explode(F.expr("sequence(0, lefts - 1)"))).withColumn("right", F.lit(True))
    wanted = ["blob", "i", "j", "right", "owner"]
    rows = mine.select(wanted).unionByName(other.select(wanted)).join(sets.select("owner", "tokens"), "owner")
    return rows.groupBy("blob", "i", "j").applyInArrow(_compare(percent), "blob bigint, a bigint, b bigint")


def similar(docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per document: ``id``, n_shingles and component_id.

    Words are runs of anything but blank, tab and line ends, lower-cased in A-Z; a set holds
    the distinct shingles of ``words`` words, or all words as one if there are fewer; null
    texts and texts without words have an empty set and no links. Documents are linked if
    their sets' Jaccard similarity is at least ``percent`` hundredths. component_id is the
    smallest id reachable by links, the own one included (null ids never count, a null id
    alone gives null). Repeated rows are documents of their own, linked as equal texts are;
    an empty table gives an empty result; other columns are left out.
    """
    context = docs.sparkSession.sparkContext
    rows = docs.select(docs[id].alias("id"), docs[text].alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    # step 1: prefixes in hash order, tokens that several sets have there
    firsts = rows.select("text").mapInArrow(_prefixes(words, percent), "token bigint, owner bigint")
    tokens = firsts.groupBy("token").agg(F.min("owner").alias("a"), F.max("owner").alias("b"), F.count("*").alias("df"))
    tokens = stored(tokens.filter("a <> b").select("token", "df"))
    halves = tokens.select(F.col("token").alias("a"), F.expr("shiftleft(token, 32) | shiftrightunsigned(token, 32)").alias("b"))
    sieve = context.broadcast(Sieve.of(halves, SIEVE_LOG2))
    schema = f"id {kind}, n bigint, name binary, owner bigint, tokens binary, firsts array<bigint>"
    every = stored(rows.mapInArrow(_sets(words, percent, sieve), schema))
    links = _links(every, tokens, percent)

    # equal sets are one class; linked classes are one component
    classes = every.filter("n > 0").groupBy("name", "owner").agg(F.min("id").alias("least"))
    named = classes.join(components(links).withColumnRenamed("node", "owner"), "owner", "left")
    named = named.withColumn("root", F.coalesce("root", "owner"))
    lowest = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = named.select("name", "root").join(lowest, "root").select("name", "component_id")
    out = every.select("id", "n", F.when(F.col("n") > 0, F.col("name")).alias("name")).join(named, "name", "left")
    return out.select(F.col("id").alias(id), F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id"))


def _links(every: DataFrame, tokens: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that join all linked classes, though not each pair of a component."""
    may = every.filter("tokens is not null")
    sets = stored(may.dropDuplicates(["owner"]).select("owner", "n", "tokens", "firsts"))

    # step 2: of the shared tokens the rarest, as many as a linked document must meet
    shared = sets.select("owner", "n", F.explode("firsts").alias("token")).join(tokens, "token")
    order = Window.partitionBy("owner").orderBy("df", "token")
    ranked = shared.withColumn("rank", F.row_number().over(order)).withColumn("s", F.count("*").over(Window.partitionBy("owner")))
    need = F.expr(f"{SLACK} * (({percent} * n + 99) div 100) div 100 + 1")
    # sets of linked documents differ in size by less than a band, and so share one of two bands
    band = F.floor(F.log("n") / (1.0001 * math.log(100 / percent)))
    offered = ranked.filter(F.col("rank") <= F.col("s") - need + 1).select("owner", "n", "token", "df", band.alias("band"))
    offered = stored(offered.withColumn("band", F.explode(F.array("band", F.col("band") + 1))))
    heads = offered.groupBy("token", "band").agg(F.min("owner").alias("head"), F.max("owner").alias("last")).filter("head <> last")
    edges = offered.join(heads.select("token", "band", "head"), ["token", "band"]).filter("owner <> head")
    edges = edges.select(F.xxhash64("owner", "band").alias("a"), F.xxhash64("head", "band").alias("b"))
    blobs = components(edges).toDF("node", "blob")

    # the most typical document of a group: the one whose tokens are the most frequent
    weight = offered.groupBy("owner", "n", "band").agg(F.avg("df").alias("weight")).withColumn("node", F.xxhash64("owner", "band"))
    members = stored(weight.join(blobs, "node").select("blob", "owner", "n", "weight"))
    order = F.struct("weight", "owner")
    typical = members.groupBy("blob").agg(F.max_by("owner", order).alias("owner"), F.max_by("n", order).alias("n"))
    typical, slim = stored(typical), members.select("blob", "owner", "n")
    star = stored(_in_blocks(typical, slim, sets, percent))
    # the rest of each group against all of it
    met = star.select("blob", F.col("b").alias("owner")).unionByName(typical.select("blob", "owner"))
    rest = slim.join(met.distinct(), ["blob", "owner"], "left_anti")
    return star.unionByName(stored(_in_blocks(rest, slim, sets, percent))).select("a", "b")


def keep_one(docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The documents without near copies: of each component the row with the smallest id stays.

    All columns stay. Rows are judged one by one: of repeated rows one stays, and an id that
    several texts have may stay with one and go with another. Documents without words stay;
    a row with a null id stays if no row of its component has an id, one of several.
    """
    number = "_row"
    while number in docs.columns:
        number += "_"
    # rows get numbers that are written before they are used, so that they do not change
    rows = stored(docs.withColumn(number, F.monotonically_increasing_id()))
    found = similar(rows, number, text, words, percent).select(F.col(number).alias("_row"), "component_id")
    ids = rows.select(F.col(number).alias("_row"), F.col(id).alias("_id"))
    found = stored(found.join(ids, "_row"))
    groups = found.groupBy("component_id").agg(F.min(F.struct(F.col("_id").isNull(), "_id", "_row")).alias("least"))
    gone = found.select("_row").join(groups.select(F.col("least._row").alias("_row")), "_row", "left_anti")
    return rows.join(gone, rows[number] == gone["_row"], "left_anti").drop(number)
