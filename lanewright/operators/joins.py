"""Joins the pipelines share: interval containment, either-key, two-system merge."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, LongType

from lanewright.functions import rules
from lanewright.functions.dates import epoch_seconds
from lanewright.operators.scans import ordered_scan, without_match

Pairs = Sequence[tuple[str, str]]
_ROUTES = "array<struct<route:int,slot:bigint>>"


def _equal(left: DataFrame, right: DataFrame, on: Pairs) -> Column:
    return reduce(and_, [left[a] == right[b] for a, b in on])


def _inside(at: Column, start: Column, end: Column, closed: bool) -> Column:
    before_end = (at <= end) if closed else (at < end)
    return (at >= start) & (end.isNull() | before_end)


def interval_join(
    left: DataFrame,
    right: DataFrame,
    on: Pairs,
    at: str,
    start: str,
    end: str,
    *,
    closed: bool = True,
    how: str = "left",
    bucket_hours: int | None = None,
) -> DataFrame:
    """Rows of ``right`` whose [start, end] holds ``left.at`` under equal keys; NULL end = open.

    Column names of the two sides must not overlap. Work per point stays
    proportional to the intervals near it, however many rows a key has:

    * ``bucket_hours``: for intervals known to be short and bounded. Intervals are
      laid on time buckets, the point knows its bucket, one equi join follows
      (intervals without an end are not eligible).
    * otherwise intervals are sorted into tiers by length, the next power of 16 hours; an
      open interval ends, for this, at the last point. Within a tier an interval touches
      at most two buckets, whatever its length. Only the distinct (keys, time) points are
      spread over the tiers that occur, and the matches are joined back on (keys, time).
    """
    lkeys, rkeys = [a for a, _ in on], [b for _, b in on]
    known = reduce(and_, [right[k].isNotNull() for k in rkeys])
    usable = right.filter(known & right[start].isNotNull() & (right[end].isNull() | (right[end] >= right[start])))
    first, last = epoch_seconds(usable[start]), epoch_seconds(usable[end])

    if bucket_hours is not None:
        width = bucket_hours * 3600
        laid = usable.filter(usable[end].isNotNull()).withColumn(
            "_bucket", F.explode(F.sequence(F.floor(first / width), F.floor(last / width)))
        )
        points = left.withColumn("_at_bucket", F.floor(epoch_seconds(left[at]) / width))
        matched = (
            _equal(points, laid, on)
            & (points["_at_bucket"] == laid["_bucket"])
            & _inside(points[at], laid[start], laid[end], closed)
        )
        return points.join(laid, matched, how).drop("_bucket", "_at_bucket", *rkeys)

    bounded = usable.withColumn("_until", F.coalesce(usable[end], left.agg(F.max(at)).scalar()))
    bounded = bounded.filter(F.col("_until") >= F.col(start))
    hours = F.greatest((epoch_seconds(F.col("_until")) - epoch_seconds(F.col(start))) / 3600, F.lit(1.0))
    tiered = bounded.withColumn("_tier", F.ceil(F.log2(hours) / 4).cast("int"))

    def bucket(seconds: Column) -> Column:
        return F.floor(seconds / (3600 * F.pow(F.lit(16.0), F.col("_tier"))))

    ends = bucket(epoch_seconds(F.col(start))), bucket(epoch_seconds(F.col("_until")))
    laid = tiered.withColumn("_bucket", F.explode(F.sequence(*ends))).drop("_until")
    # lengths of timestamps are below 16 ** 7 hours, so there are at most eight tiers
    occurring = F.broadcast(tiered.select(F.col("_tier").alias("_has")).distinct())
    spots = left.select(*[F.col(k).alias(f"_k_{k}") for k in lkeys], F.col(at).alias("_at")).na.drop().distinct()
    spread = spots.withColumn("_tier", F.explode(F.array(*[F.lit(i) for i in range(8)])))
    spread = spread.join(occurring, spread["_tier"] == occurring["_has"], "left_semi")
    spread = spread.withColumn("_bucket", bucket(epoch_seconds(F.col("_at"))))
    spread = spread.withColumnsRenamed({"_tier": "_at_tier", "_bucket": "_at_bucket"})
    matched = (
        reduce(and_, [spread[f"_k_{a}"] == laid[b] for a, b in on])
        & (spread["_at_tier"] == laid["_tier"])
        & (spread["_at_bucket"] == laid["_bucket"])
        & _inside(spread["_at"], laid[start], laid[end], closed)
    )
    hits = spread.join(laid, matched, "inner").drop("_tier", "_bucket", "_at_tier", "_at_bucket", *rkeys)
    back = reduce(and_, [left[k] == hits[f"_k_{k}"] for k in lkeys]) & (left[at] == hits["_at"])
    return left.join(hits, back, how).drop("_at", *[f"_k_{k}" for k in lkeys])


def span_totals(
    spans: DataFrame, points: DataFrame, on: Pairs, start: str, end: str, at: str, measure: str, *, closed: bool = True,
) -> DataFrame:
    """Every span with ``n``, ``total`` and ``last_at``: how many points it holds, their sum of ``measure``, the latest.

    ``on`` pairs keys of spans and points; a NULL end is open; spans that are empty, or lack key or
    start, hold nothing. Overlapping spans of one key are no product of spans and points: both are
    scanned together in order of time, and a span takes the difference of the running
    figures at its end and its start.
    """
    skeys, pkeys = [a for a, _ in on], [b for _, b in on]
    kind = points.schema[at].dataType
    forever = F.lit("9999-12-31 23:59:59").cast(kind)
    known = reduce(and_, [spans[k].isNotNull() for k in skeys]) & spans[start].isNotNull()
    # at one time: starts (and ends of half-open spans), points, ends
    edges = F.array(
        F.struct(F.lit(0).alias("side"), spans[start].cast(kind).alias("at"), F.lit(True).alias("begins")),
        F.struct(F.lit(2 if closed else 0).alias("side"), F.coalesce(spans[end].cast(kind), forever).alias("at"), F.lit(False).alias("begins")),
    )
    rows = spans.withColumn("_row", F.monotonically_increasing_id())
    # what holds nothing stays out of the scan's way, under no key and no time
    valid = known & (spans[end].isNull() | (spans[end] >= spans[start]))
    laid = rows.select("*", F.explode(edges).alias("_e")).select(
        *[F.when(valid, F.col(k)).alias(f"_k{i}") for i, k in enumerate(skeys)],
        F.col("_e.at").alias("_t"), F.col("_e.side").alias("_side"), F.col("_e.begins").alias("_begins"),
        "_row", valid.alias("_valid"), F.struct(*[F.col(c) for c in spans.columns]).alias("_span"),
    )
    dots = points.filter(reduce(and_, [points[k].isNotNull() for k in pkeys]) & points[at].isNotNull()).select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(pkeys)], F.col(at).alias("_t"), F.lit(1).alias("_side"),
        F.col(measure).alias("_m"), F.lit(1).cast("long").alias("_one"), F.col(at).alias("_p"),
    )
    both = laid.unionByName(dots, allowMissingColumns=True)
    scanned = ordered_scan(
        both, [f"_k{i}" for i in range(len(on))], ["_t", "_side"], chunk=F.to_date("_t"), running={"_n": "_one", "_s": "_m"}, fill={"_l": "_p"},
    ).filter(F.col("_row").isNotNull())

    def upto(column: str, begins: bool) -> Column:
        return F.max(F.when(F.col("_begins") == begins, F.col(column)))

    n = F.coalesce(upto("_n", False), F.lit(0)) - F.coalesce(upto("_n", True), F.lit(0))
    total = F.coalesce(upto("_s", False), F.lit(0)) - F.coalesce(upto("_s", True), F.lit(0))
    sums = scanned.groupBy("_row", "_valid", "_span").agg(n.alias("_n"), total.alias("_s"), upto("_l", False).alias("_l"))
    held = F.col("_valid") & (F.col("_n") > 0)
    return sums.select(
        "_span.*", F.when(held, F.col("_n")).otherwise(0).alias("n"), F.when(held, F.col("_s")).alias("total"),
        F.when(held, F.col("_l")).alias("last_at"),
    )


def asof_join(
    points: DataFrame, spans: DataFrame, on: Pairs, at: str, start: str, end: str | None = None, *, closed: bool = False,
) -> DataFrame:
    """Every point beside the span of its key that started last, at or before it; NULLs if that one has ended.

    For spans of a key that follow each other (versions, ranges of validity) this is the join
    on containment; a key and start should name one span. Points and starts are scanned
    together in order of time, so both sides are read once and no (point, span) pairs are
    formed, whatever a key's numbers of points and spans. Points without key or time find
    nothing. Without ``end`` a span lasts until the next. Column names of the sides must not overlap.
    """
    keys = [f"_k{i}" for i in range(len(on))]
    kind = points.schema[at].dataType
    known = reduce(and_, [spans[b].isNotNull() for _, b in on]) & spans[start].isNotNull()
    starts = spans.filter(known).select(
        *[F.col(b).alias(k) for k, (_, b) in zip(keys, on)], F.col(start).cast(kind).alias("_t"), F.lit(0).alias("_side"),
        F.struct(*[F.col(c) for c in spans.columns]).alias("_span"),
    )
    found = reduce(and_, [points[a].isNotNull() for a, _ in on]) & points[at].isNotNull()
    dots = points.select(
        *[F.col(a).alias(k) for k, (a, _) in zip(keys, on)], F.col(at).alias("_t"), F.lit(1).alias("_side"),
        F.struct(*[F.col(c) for c in points.columns]).alias("_point"), found.alias("_found"),
    )
    both = starts.unionByName(dots, allowMissingColumns=True)
    held = ordered_scan(both, keys, ["_t", "_side"], chunk=F.to_date("_t"), fill={"_held": "_span"}).filter("_side = 1")
    lasts = F.lit(True)
    if end:
        until = F.col(f"_held.{end}")
        lasts = until.isNull() | ((F.col("_t") <= until) if closed else (F.col("_t") < until))
    span = F.when(F.col("_found") & lasts, F.col("_held"))
    taken = [c for c in spans.columns if c not in {b for _, b in on}]
    return held.withColumn("_held", span).select("_point.*", *[F.col(f"_held.{c}").alias(c) for c in taken])


def either_key_join(left: DataFrame, right: DataFrame, on: Pairs, how: str = "left") -> DataFrame:
    """Join where any one of the key pairs matches, each matching pair of rows once.

    One equi join: rows of both sides are repeated for each key that they know, as (pair,
    hash), and a later pair leaves out what an earlier one matches; a disjunction in the
    join would be a nested loop. Each side is read once. For ``left``, rows are numbered, and
    the copies of a row that found nothing fold into one if none of its copies did.
    """
    kinds = [(left.schema[a].dataType, right.schema[b].dataType) for a, b in on]
    wide = [LongType() if isinstance(x, IntegralType) and isinstance(y, IntegralType) else x for x, y in kinds]
    if any(x != y and w is x for (x, y), w in zip(kinds, wide)):
        raise ValueError("cast the keys of a pair to one type")

    def routes(df: DataFrame, keys: Sequence[str]) -> Column:
        ways = [F.when(df[k].isNotNull(), F.struct(F.lit(i).alias("route"), F.xxhash64(df[k].cast(w)).alias("slot")))
                for i, (k, w) in enumerate(zip(keys, wide), start=1)]
        return F.array_compact(F.array(*ways))

    lost = F.array(F.struct(F.lit(0).alias("route"), F.xxhash64("_row").alias("slot")))
    rows = left.withColumn("_row", F.monotonically_increasing_id())
    ways = routes(rows, [a for a, _ in on])
    if how == "left":
        ways = F.when(F.size(ways) == 0, lost).otherwise(ways)
    rows = rows.withColumn("_left", F.explode(ways))
    others = right.withColumn("_right", F.explode(routes(right, [b for _, b in on])))
    exact, earlier = F.lit(False), F.lit(False)
    for i, (a, b) in enumerate(on, start=1):
        hit = F.coalesce(rows[a] == others[b], F.lit(False))
        exact = exact | ((rows["_left.route"] == i) & hit & ~earlier)
        earlier = earlier | hit
    met = rows.join(
        others,
        (rows["_left.route"] == others["_right.route"]) & (rows["_left.slot"] == others["_right.slot"]) & exact, how,
    )
    if how == "left":
        # copies of one row are a handful
        found = F.col("_right").isNotNull()
        own = Window.partitionBy("_row")
        met = met.withColumns({"_found": F.max(found).over(own), "_copy": F.row_number().over(own.orderBy("_left.route"))})
        met = met.filter(found | (~F.col("_found") & (F.col("_copy") == 1)))
    return met.select(*[rows[c] for c in left.columns], *[others[c] for c in right.columns])


def consolidate(
    primary: DataFrame, secondary: DataFrame, keys: Sequence[str], columns: Sequence[str],
    lineage: str | None = None, lineage_key: str | None = None,
) -> DataFrame:
    """Full outer merge of two systems, the primary winning column by column.

    NULL keys match nothing and stay on their own. Built from an inner and two anti
    joins: unlike a full outer join, these let Spark split a hot key on either side.
    ``lineage`` adds BOTH / MODERN / LEGACY by whether ``lineage_key`` is known.
    """
    p, s = primary.alias("p"), secondary.alias("s")
    match = reduce(and_, [F.col(f"p.{k}") == F.col(f"s.{k}") for k in keys])

    def column(side: str, source: DataFrame, name: str) -> Column | None:
        return F.col(f"{side}.{name}") if name in source.columns else None

    def merged(sides: list[tuple[str, DataFrame]]) -> list[Column]:
        out = []
        for name in columns:
            known = [c for side, source in sides if (c := column(side, source, name)) is not None]
            out.append(F.coalesce(*known).alias(name) if known else F.lit(None).alias(name))
        if lineage:
            has = {side: F.col(f"{side}.{lineage_key}").isNotNull() for side, _ in sides}
            out.append(rules.lineage(has.get("p", F.lit(False)), has.get("s", F.lit(False))).alias(lineage))
        return out

    both = p.join(s, match, "inner").select(*merged([("p", primary), ("s", secondary)]))
    same = [(k, k) for k in keys]
    only_p = without_match(primary, secondary, same).alias("p").select(*merged([("p", primary)]))
    only_s = without_match(secondary, primary, same).alias("s").select(*merged([("s", secondary)]))
    return both.unionByName(only_p).unionByName(only_s)


def by_priority(sources: Sequence[tuple[str, Column]], out: str, out_source: str) -> list[Column]:
    """First known value among labelled sources, and the label it came from."""
    value = F.coalesce(*[c for _, c in sources]).alias(out)
    label = rules.first_match([(c.isNotNull(), F.lit(name)) for name, c in sources]).alias(out_source)
    return [value, label]


def date_window_or_ids(
    base: DataFrame, facts: DataFrame, on: Pairs, at: str, start: str, end: str, ids: Pairs,
    bucket_hours: int = 24 * 7,
) -> DataFrame:
    """Facts dated within a base row's [start, end], or sharing all its ids, under equal keys.

    Returns the matched pairs plus every base row once with empty facts, so that a
    following group-by on the base columns behaves like one over a left join (sums and
    maxima skip the empty row). Names of the two sides must not overlap.

    One equi join: base rows are repeated for each time bucket of their window and once
    for their ids, facts once for the bucket of their date and once for their ids. The
    second route leaves out what the first one matches.
    """
    width = bucket_hours * 3600

    def routed(df: DataFrame, buckets: Column, keys: Sequence[str], side: str) -> DataFrame:
        # the route's slot is a hash; the exact comparison follows in the join condition
        by_date = F.transform(buckets, lambda b: F.struct(F.lit(1).alias("route"), F.xxhash64(b).alias("slot")))
        by_ids = F.array(F.struct(F.lit(2).alias("route"), F.xxhash64(*[df[k] for k in keys]).alias("slot")))
        way = F.explode(F.concat(F.coalesce(by_date, F.array().cast(_ROUTES)), by_ids))
        return df.select("*", way.alias(f"_{side}"))

    def bucket(date: Column) -> Column:
        return F.floor(epoch_seconds(date) / width)

    span = F.when(base[start] <= base[end], F.sequence(bucket(base[start]), bucket(base[end])))
    left = routed(base, span, [a for a, _ in ids], "base")
    right = routed(facts, F.array(bucket(facts[at])), [b for _, b in ids], "fact")
    dated = right[at].between(left[start], left[end])
    exact = F.when(left["_base.route"] == 1, dated).otherwise(
        _equal(left, right, ids) & ~F.coalesce(dated, F.lit(False))
    )
    same_way = (left["_base.route"] == right["_fact.route"]) & (left["_base.slot"] == right["_fact.slot"])
    matched = left.join(right, _equal(left, right, on) & same_way & exact, "inner")
    return matched.drop("_base", "_fact", *[b for _, b in on]).unionByName(base, allowMissingColumns=True)
