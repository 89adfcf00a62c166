"""Document fingerprints: chains of content words that follow common words (spot signatures).

DataFrame and SQL functions only. A signature is the chain of the next two words that are
not common after an anchor (a very common word); a fingerprint is the document's set of signatures, each
shortened to 32 bits. Menus and lists hold few common words, running text many, so the
signatures come from the text proper. A text without a signature has one for the whole of it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from lanewright.llm.merkle import numbered
from lanewright.llm.shared import stored

# fixed values: anchors, and the common words of four languages that chains pass over
ANCHORS = "the is that was der die und le les que el los".split()
COMMON = (
    "the of and to in a is that it for was on as with be by this are an at from or not have he his they i you "
    "der die das und den von zu mit im für auf ist nicht ein eine dem des sich als auch es an "
    "le la les de des du et un une en est que qui dans pour pas sur par au avec ne se ce "
    "el los las y del por con para una su al lo como más o pero sus le ha me si sin sobre"
).split()
#: Content words of a signature.
CHAIN = 2
#: Hexadecimal digits of a shortened signature.
DIGITS = 8
#: Neighbouring ids that are put in one window to find the next document.
CHUNK = 512

_MARK = "\\u0001"  # stands for an anchor once texts are normalised
_ANCHOR = f" (?:{'|'.join(ANCHORS)})(?= )"
_OTHER = [w for w in dict.fromkeys(COMMON) if w not in ANCHORS]
_COMMON = f" (?=[^ {_MARK}]{{1,{max(map(len, _OTHER))}}}[ {_MARK}])(?:{'|'.join(_OTHER)})(?=[ {_MARK}])"
#: The last mark of a run, and ahead of it its chain, with other marks in between; possessive, so that time is linear.
_CHAIN = f"{_MARK}(?=({(_MARK + '*+').join([f' [^ {_MARK}]++'] * CHAIN)}))"


def normalised(text: Column) -> Column:
    """Lower-case runs of letters and digits, each between blanks; null counts as empty."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " ")), F.lit(" "))


def with_fingerprint(rows: DataFrame, text: str, name: str) -> DataFrame:
    """Adds the sorted distinct signatures of a text column, as short hexadecimal strings.

    The steps are columns of their own, as Spark does not merge projections when an
    expensive column is used twice.
    """
    rows = rows.withColumn("_words", normalised(F.col(text)))
    marked = F.regexp_replace(F.regexp_replace("_words", _ANCHOR, "\x01"), _COMMON, "")
    chains = F.regexp_extract_all(marked, F.lit(_CHAIN), F.lit(1))
    short = F.transform(chains, lambda c: F.substring(F.md5(F.translate(c, "\x01", "")), 1, DIGITS))
    rows = rows.withColumn("_signatures", F.array_sort(F.array_distinct(short)))
    plain = F.when(F.trim("_words") == "", F.coalesce(F.col(text), F.lit(""))).otherwise(F.col("_words"))
    whole = F.array(F.substring(F.md5(F.concat(F.lit("="), plain)), 1, DIGITS))
    rows = rows.withColumn(name, F.when(F.size("_signatures") > 0, F.col("_signatures")).otherwise(whole))
    return rows.drop("_words", "_signatures")


def likeness(a: Column, b: Column, least: float = 0.0) -> Column:
    """Jaccard similarity of two fingerprints; 0 without a comparison where their lengths rule out ``least``."""
    common = F.size(F.array_intersect(a, b))
    jaccard = common / (F.size(a) + F.size(b) - common)
    possible = F.least(F.size(a), F.size(b)) >= least * F.greatest(F.size(a), F.size(b))
    return F.when(possible, jaccard).otherwise(0.0) if least else jaccard


def with_next(rows: DataFrame, columns: list[str], prepare: Callable[[DataFrame], DataFrame] = lambda r: r) -> DataFrame:
    """Adds ``next_`` + column for the next row by (id, text), for the last row the first one.

    ``rows`` has id and text; null ids and texts come first. Chunks of neighbouring ids are
    windows of their own; the first rows of the next chunk are added to each chunk, so that a
    row moves once and a window holds at most a chunk. Ids that are no whole numbers, or lie
    far apart, are numbered first, which moves rows once more. ``prepare`` may add columns once rows
    have moved.
    """
    if not _dense(rows):
        return _with_next_numbered(rows, columns, prepare)
    chunk = F.coalesce(F.floor(F.col("id") / CHUNK), F.lit(-(1 << 62)))
    rows = rows.withColumn("chunk", chunk)
    firsts = rows.groupBy("chunk").agg(F.min("id").alias("first")).withColumn("group", F.floor(F.col("chunk") / CHUNK))
    # the next chunk: within a group of chunks by a window, at its end from the next group
    groups = firsts.groupBy("group").agg(F.min("chunk").alias("head"))
    every = Window.partitionBy(F.lit(0)).orderBy("group")
    groups = groups.select("group", F.coalesce(F.lead("head").over(every), F.first("head").over(every)).alias("head"))
    inside = Window.partitionBy("group").orderBy("chunk")
    follow = firsts.withColumn("after", F.lead("chunk").over(inside)).join(groups, "group")
    follow = follow.select(F.col("chunk").alias("to"), F.coalesce("after", "head").alias("of"))
    # stored, so that its size is known before the texts are joined with it
    starts = stored(follow.join(firsts.select(F.col("chunk").alias("of"), "first"), "of").select("to", "of", "first"))
    carried = rows.join(starts, (rows["chunk"] == starts["of"]) & rows["id"].eqNullSafe(starts["first"]))
    carried = carried.select(*rows.columns[:-1], F.col("to").alias("chunk"), F.lit(True).alias("carried"))
    order = Window.partitionBy("chunk").orderBy("carried", "id", "text")
    both = prepare(rows.withColumn("carried", F.lit(False)).unionByName(carried).repartition("chunk"))
    out = both.select("*", *(F.lead(c).over(order).alias(f"next_{c}") for c in columns))
    return out.filter(~F.col("carried")).drop("chunk", "carried")


def _dense(rows: DataFrame) -> bool:
    """Whether ids are whole numbers of which a chunk has many, and no chunk (that of null ids is one) has far more."""
    if not isinstance(rows.schema["id"].dataType, IntegralType):
        return False
    n, chunks, nulls = rows.agg(
        F.count(F.lit(1)), F.approx_count_distinct(F.floor(F.col("id") / CHUNK)), F.count(F.when(F.col("id").isNull(), 1))
    ).first()
    return n <= CHUNK or (n >= chunks * CHUNK / 8 and nulls <= CHUNK)


def _with_next_numbered(rows: DataFrame, columns: list[str], prepare: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``with_next`` by the rows' numbers in the order of (id, text)."""
    placed = numbered(rows.withColumn("all", F.lit("")), "all", ["id", "text"]).drop("all")
    own = placed.withColumns({"chunk": F.expr(f"pos div {CHUNK}"), "carried": F.lit(False)})
    before = F.when(F.col("pos") == 0, F.expr(f"(size - 1) div {CHUNK}")).otherwise(F.expr(f"pos div {CHUNK} - 1"))
    heads = placed.filter(F.col("pos") % CHUNK == 0).withColumns({"chunk": before, "carried": F.lit(True)})
    both = prepare(own.unionByName(heads).repartition("chunk"))
    order = Window.partitionBy("chunk").orderBy("carried", "pos")
    out = both.select("*", *(F.lead(c).over(order).alias(f"next_{c}") for c in columns))
    return out.filter(~F.col("carried")).drop("chunk", "carried", "pos", "size")


def fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``id`` and ``fingerprint``, an array of signatures.

    A null text counts as empty; equal texts have equal fingerprints; repeated rows stay.
    """
    rows = docs.select(docs[id].alias(id), docs[text].alias("_text"))
    return with_fingerprint(rows, "_text", "fingerprint").drop("_text")


def robustness(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document's fingerprint beside that of its edited text, and their likeness.

    The edited text has the last quarter of its code points replaced by the first of the
    next document by id (after the last: the first); rows with equal ids follow each other
    by text, null ids and texts come first. Columns: ``id``, n_chars, edited, fingerprint,
    edited_fingerprint, near_edited, near_next. A null text counts as empty; a table with
    one row has itself as the next document; an empty table gives an empty result.
    """
    rows = docs.select(docs[id].alias("id"), F.coalesce(docs[text], F.lit("")).alias("text"))
    rows = with_next(rows, ["text", "print"], lambda r: with_fingerprint(r, "text", "print"))
    size = F.length("text")
    quarter = F.floor(size / 4).cast("int")
    edited = F.concat(F.expr("left(text, n_chars - quarter)"), F.expr("left(next_text, quarter)"))
    rows = rows.withColumn("n_chars", size).withColumn("quarter", quarter).withColumn("edited", edited)
    rows = with_fingerprint(rows, "edited", "edited_print")
    return rows.select(
        F.col("id").alias(id), F.col("n_chars").cast("long").alias("n_chars"), "edited",
        F.col("print").alias("fingerprint"), F.col("edited_print").alias("edited_fingerprint"),
        likeness(F.col("print"), F.col("edited_print")).alias("near_edited"),
        likeness(F.col("print"), F.col("next_print")).alias("near_next"),
    )
