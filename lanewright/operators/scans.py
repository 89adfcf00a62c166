"""Ordered scans (row number, running sum, previous/next, fill) that survive hot keys.

A window partitioned by an entity puts all rows of that entity into one task. With
``chunk`` (an expression that never decreases along the order, such as the day of the
order column) each entity is cut into chunks.

Neighbours (``prev``, ``next``) alone are found chunk by chunk; only the first and last row
of a chunk lack one, and just these rows go on to a window over the entity. Several chunk
expressions, from coarse to fine, make several such steps: ``same_moment`` is a fine one
that also cuts up many rows of one time. Both uses of a step read one shuffle.

Row numbers, running sums and fills need a figure in every row: they are computed within
chunks, the chunks' first and last rows are scanned by entity for what earlier and later
chunks hold, and one row per (entity, chunk) joins the rows again, on the partitioning that
they have. So the input is evaluated and shuffled once.

Without ``chunk`` a plain window is used: right when the group is bounded by construction,
for example one row per entity and calendar day.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_KEY, _CHUNK, _PLACE, _LAST = "_key", "_chunk", "_place", "_last"


def ordered_scan(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    *,
    chunk: Column | Sequence[Column] | None = None,
    number: str | None = None,
    running: dict[str, str] | None = None,
    running_order: Sequence[str] | None = None,
    prev: dict[str, str] | None = None,
    next: dict[str, str] | None = None,
    fill: dict[str, str] | None = None,
) -> DataFrame:
    """Add scan columns to ``df``; each mapping is {new column: source column}.

    ``order`` must be total within a key (end it with an id); NULLs sort first.
    ``number`` counts rows from 1. ``running`` sums up to the current row and its
    peers in ``running_order`` (default: ``order``). ``prev`` and ``next`` look one
    row back and ahead. ``fill`` is the last known value up to the current row.
    """
    running, prev, next, fill = running or {}, prev or {}, next or {}, fill or {}
    keys, order = list(keys), list(order)
    peers = list(running_order or order)
    if chunk is None:
        rows = Window.partitionBy(*keys).orderBy(*order)
        upto = rows.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        out = {n: F.lag(c, 1).over(rows) for n, c in prev.items()}
        out |= {n: F.lead(c, 1).over(rows) for n, c in next.items()}
        out |= {n: F.last(c, ignorenulls=True).over(upto) for n, c in fill.items()}
        out |= {n: F.sum(c).over(Window.partitionBy(*keys).orderBy(*peers)) for n, c in running.items()}
        if number:
            out[number] = F.row_number().over(rows).cast("long")
        return df.withColumns(out)
    chunks = [chunk] if isinstance(chunk, Column) else list(chunk)
    if not (number or running or fill):
        return _neighbours(df, keys, order, chunks, prev, next)
    return _carried(df, keys, order, F.struct(*chunks), number, running, peers, prev, next, fill)


def _carried(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], chunk: Column, number: str | None, running: dict[str, str],
    peers: Sequence[str], prev: dict[str, str], next: dict[str, str], fill: dict[str, str],
) -> DataFrame:
    """All scan columns: within chunks, then with what the chunks before and after them hold."""
    sources = {f"_s_{c}": F.col(c) for side in (running, prev, next, fill) for c in side.values()}
    # keys and chunks as structs, in which NULLs are equal, so that a plain join follows their shuffle
    cut = df.withColumns({_KEY: F.struct(*keys), _CHUNK: chunk} | sources)
    rows = Window.partitionBy(_KEY, _CHUNK).orderBy(*order)
    upto = rows.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    within = {_PLACE: F.row_number().over(rows).cast("long"), _LAST: F.lead(F.lit(1)).over(rows).isNull()}
    within |= {f"_r_{n}": F.sum(f"_s_{c}").over(Window.partitionBy(_KEY, _CHUNK).orderBy(*peers)) for n, c in running.items()}
    within |= {f"_f_{n}": F.last(f"_s_{c}", ignorenulls=True).over(upto) for n, c in fill.items()}
    within |= {f"_p_{n}": F.lag(f"_s_{c}").over(rows) for n, c in prev.items()}
    within |= {f"_n_{n}": F.lead(f"_s_{c}").over(rows) for n, c in next.items()}
    local = cut.withColumns(within)

    # A chunk's first and last row hold all that others need of it. Every column takes part
    # in the filter (which keeps any hash), so that these rows come from the detail's shuffle.
    ends = local.filter(((F.col(_PLACE) == 1) | F.col(_LAST)) & (F.xxhash64(*df.columns) <= F.lit(2**63 - 1)))
    by_key = Window.partitionBy(_KEY).orderBy(_CHUNK, _PLACE)
    earlier = by_key.rowsBetween(Window.unboundedPreceding, -1)
    carried = {"_c": F.coalesce(F.sum(F.when(F.col(_LAST), F.col(_PLACE))).over(earlier), F.lit(0))}
    carried |= {f"_cr_{n}": F.sum(F.when(F.col(_LAST), F.col(f"_r_{n}"))).over(earlier) for n in running}
    carried |= {f"_cf_{n}": F.last(F.when(F.col(_LAST), F.col(f"_f_{n}")), ignorenulls=True).over(earlier) for n in fill}
    carried |= {f"_cp_{n}": F.lag(f"_s_{c}").over(by_key) for n, c in prev.items()}
    for n, c in next.items():
        ahead = F.lead(f"_s_{c}", 1).over(by_key), F.lead(f"_s_{c}", 2).over(by_key)
        carried[f"_cn_{n}"] = F.when(F.col(_LAST), ahead[0]).otherwise(ahead[1])
    # of each chunk its first row, before which its key has earlier chunks only
    carries = ends.withColumns(carried).filter(F.col(_PLACE) == 1).select(
        F.col(_KEY).alias("_k"), F.col(_CHUNK).alias("_at"), *carried
    )
    met = local.join(carries, (F.col(_KEY) == F.col("_k")) & (F.col(_CHUNK) == F.col("_at")), "inner")

    out = {n: F.when(F.col(_PLACE) == 1, F.col(f"_cp_{n}")).otherwise(F.col(f"_p_{n}")) for n in prev}
    out |= {n: F.when(F.col(_LAST), F.col(f"_cn_{n}")).otherwise(F.col(f"_n_{n}")) for n in next}
    out |= {n: F.coalesce(f"_f_{n}", f"_cf_{n}") for n in fill}
    for n in running:
        own, before = F.col(f"_r_{n}"), F.col(f"_cr_{n}")
        out[n] = F.coalesce(own + before, own, before).cast(local.schema[f"_r_{n}"].dataType)
    if number:
        out[number] = F.col(_PLACE) + F.col("_c")
    return met.withColumns(out).select(*dict.fromkeys([*df.columns, *out]))


def same_moment(at: Column, tie: Column) -> Column:
    """Fine chunk of rows ordered by time and a numeric tie: the time, and 512 steps of the tie per power of e.

    Keeps the order and cuts the rows of one time into some hundreds of chunks. Ties that
    differ by less than a five-hundredth of their size share a chunk: of numbers far from
    zero, subtract the least one first.
    """
    return F.struct(at, F.floor(F.signum(tie) * F.ln(F.abs(tie) + 1) * 512))


def _neighbours(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], chunks: Sequence[Column], prev: dict[str, str], next: dict[str, str],
) -> DataFrame:
    """``prev`` and ``next`` of every row, from the finest chunks up to the whole key."""
    cuts = [f"{_CHUNK}{i}" for i in range(len(chunks))]
    sources = {f"_s_{c}": F.col(c) for c in {*prev.values(), *next.values()}}
    rows = df.withColumns(dict(zip(cuts, chunks)) | sources)
    found: list[DataFrame] = []
    for depth in range(len(chunks), -1, -1):
        by = Window.partitionBy(*keys, *cuts[:depth]).orderBy(*order)
        step = {f"_p_{n}": F.lag(f"_s_{c}").over(by) for n, c in prev.items()}
        step |= {f"_n_{n}": F.lead(f"_s_{c}").over(by) for n, c in next.items()}
        step |= {"_first": F.row_number().over(by) == 1, "_last": F.lead(F.lit(1)).over(by).isNull()}
        if found:
            # a row that had a neighbour in its finer chunk keeps that one
            for name, value in step.items():
                edge = F.col("_first" if name[:2] == "_p" or name == "_first" else "_last")
                step[name] = F.when(edge, value).otherwise(F.lit(False) if name in ("_first", "_last") else F.col(name))
        rows = rows.withColumns(step)
        if depth:
            ends = F.col("_first") | F.col("_last")
            found.append(rows.filter(~ends))
            rows = rows.filter(ends)
    found.append(rows)
    every = reduce(lambda a, b: a.unionByName(b), found)
    named = {n: F.col(f"_p_{n}") for n in prev} | {n: F.col(f"_n_{n}") for n in next}
    return every.withColumns(named).select(*dict.fromkeys([*df.columns, *named]))


def join_groups(
    df: DataFrame, groups: DataFrame, pairs: Sequence[tuple[str, str]], how: str = "left",
    nulls_match: bool = False, also: Column | None = None,
) -> DataFrame:
    """Join rows to results that have one row per key, letting Spark split a hot key.

    Spark splits a hot partition only where both sides were shuffled for the join. An
    aggregate joined on its own grouping columns would keep its partitioning, so the
    hash of the key takes part in the join and gives it a shuffle of its own.
    """
    hashed = [F.xxhash64(*[side[p[i]] for p in pairs]) for i, side in enumerate((df, groups))]
    on = reduce(and_, [df[a].eqNullSafe(groups[b]) if nulls_match else df[a] == groups[b] for a, b in pairs])
    on = on & (hashed[0] == hashed[1])
    return df.join(groups, on if also is None else on & also, how)


def without_match(df: DataFrame, other: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Rows of ``df`` whose key does not occur in ``other`` (NULL keys occur nowhere).

    Keys are reduced to one row each before the shuffle, so copies on the other side cost
    nothing, and a hot key of ``df`` can be split.
    """
    keys = other.select(*[F.col(b).alias(f"_m_{b}") for _, b in pairs]).distinct()
    return join_groups(df, keys, [(a, f"_m_{b}") for a, b in pairs], "left_anti")


def totals_over(df: DataFrame, keys: Sequence[str], totals: dict[str, Column], base: DataFrame | None = None) -> DataFrame:
    """Whole-group aggregates beside every row, for any aggregate (distinct counts included).

    Aggregates with map-side combine and joins back, so that a hot group is never
    gathered for a window. ``base`` may supply a cheaper input with the same groups
    to aggregate from.
    """
    groups = (base or df).groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(
        *[c.alias(n) for n, c in totals.items()]
    )
    joined = join_groups(df, groups, [(k, f"_k_{k}") for k in keys], "inner", nulls_match=True)
    return joined.drop(*[f"_k_{k}" for k in keys])


def count_distinct_over(df: DataFrame, keys: Sequence[str], column: str, out: str) -> DataFrame:
    """``COUNT(DISTINCT column) OVER (PARTITION BY keys)``."""
    return totals_over(df, keys, {out: F.count_distinct(F.col(column))})


def exact_percentiles(
    df: DataFrame, keys: Sequence[str], column: str, points: dict[str, float], weight: str | None = None,
    chunk: Column | None = None,
) -> DataFrame:
    """Interpolated percentiles per group, {new column: point}.

    Equal values are counted first (map-side, in generated code). For columns with few
    distinct values, such as whole hours or days, these counts go to Spark's exact
    percentile. Where a group may hold any number of distinct values, give ``chunk``
    (an expression that never decreases with the column): counts are then accumulated
    chunk by chunk and the values at the wanted ranks picked by a plain aggregation.
    ``weight`` is a count per row.
    """
    copies = F.sum(weight) if weight else F.count(F.lit(1))
    counted = df.filter(F.col(column).isNotNull()).groupBy(*keys, column).agg(copies.alias("_n"))
    if chunk is None:
        bundle = F.percentile(F.col(column), F.array(*[F.lit(p) for p in points.values()]), F.col("_n"))
        return counted.groupBy(*keys).agg(bundle.alias("_p")).select(
            *keys, *[F.col("_p")[i].alias(n) for i, n in enumerate(points)]
        )
    ranked = ordered_scan(counted, keys, [column], chunk=chunk, running={"_upto": "_n"})
    ranked = totals_over(ranked, keys, {"_total": F.sum("_n")}, base=counted)

    def at_rank(rank: Column) -> Column:
        return F.min(F.when(F.col("_upto") > rank, F.col(column)))

    picks, out = [], []
    for name, point in points.items():
        rank = F.lit(point) * (F.col("_total") - 1)
        picks += [at_rank(F.floor(rank)).alias(f"_lo_{name}"), at_rank(F.ceil(rank)).alias(f"_hi_{name}"),
                  F.max(rank - F.floor(rank)).alias(f"_part_{name}")]
        low, high = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        out.append((low + (high - low) * F.col(f"_part_{name}")).alias(name))
    return ranked.groupBy(*keys).agg(*picks).select(*keys, *out)
