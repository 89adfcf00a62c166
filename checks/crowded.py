"""Operators on keys that hold a third of all rows, including NULL keys.

Lines returned ('R') and orders finished ('F') share one key each; the other rows keep
their own.
"""

from pyspark.sql import functions as F

from checks.registry import check
from lanewright.operators import events as ev
from lanewright.operators import joins, scans, versions
from lanewright.sources import datasets

LINES = """
  SELECT CASE l_returnflag WHEN 'R' THEN 0 WHEN 'A' THEN l_orderkey + 1 END AS k, l_orderkey AS order_id, l_partkey AS part,
         l_shipdate AS shipped, CAST(l_quantity AS BIGINT) AS units
  FROM {lineitem}"""
ORDERS = """
  SELECT CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN o_orderkey + 1 END AS rk, o_orderkey AS order_no,
         o_orderdate AS opened, o_custkey AS holder,
         CASE o_orderpriority WHEN '1-URGENT' THEN NULL WHEN '2-HIGH' THEN o_orderdate + INTERVAL 2 HOUR
              WHEN '3-MEDIUM' THEN o_orderdate + INTERVAL 3 DAY WHEN '5-LOW' THEN o_orderdate - INTERVAL 1 DAY
              ELSE o_orderdate END AS closed
  FROM {orders}"""


@check(
    "crowded_totals",
    """SELECT *, CAST(sum(units) OVER (PARTITION BY k) AS BIGINT) AS all_units, count(DISTINCT part) OVER (PARTITION BY k) AS parts FROM lines""",
    lines=LINES,
)
def crowded_totals(lines):
    return scans.totals_over(lines, ["k"], {"all_units": F.sum("units"), "parts": F.count_distinct("part")})


@check(
    "crowded_versions",
    "SELECT DISTINCT * FROM lines QUALIFY shipped = max(shipped) OVER (PARTITION BY k)",
    lines=LINES,
)
def crowded_versions(lines):
    return versions.latest_version(lines, ["k"], "shipped")


# a third of the spans share a key, many of them open: what a span holds is counted, not listed
@check(
    "crowded_intervals",
    """
    SELECT s.rk, s.order_no, s.opened, s.closed, s.holder, count(l.order_id) AS n, CAST(sum(l.units) AS BIGINT) AS total,
           max(l.shipped) AS last_at
    FROM spans s LEFT JOIN lines l ON l.k = s.rk AND l.shipped >= s.opened AND (l.shipped <= s.closed OR s.closed IS NULL)
    GROUP BY ALL""",
    spans=ORDERS, lines=LINES,
)
def crowded_intervals(spans, lines):
    return joins.span_totals(spans, lines, [("rk", "k")], "opened", "closed", "shipped", "units")


@check(
    "crowded_asof",
    """
    SELECT l.*, s.opened, s.order_no FROM lines l
    ASOF LEFT JOIN starts s ON l.k = s.rk AND l.shipped >= s.opened""",
    raw=ORDERS, lines=LINES,
    starts="SELECT rk, opened, max(order_no) AS order_no FROM {raw} WHERE rk IS NOT NULL GROUP BY rk, opened",
)
def crowded_asof(raw, lines, starts):
    """The last order opened before each line; a third of both share a key."""
    del raw
    return joins.asof_join(lines, starts, [("k", "rk")], "shipped", "opened")


@check(
    "crowded_pairs",
    """
    WITH s AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY shipped, order_id, part) AS idx FROM starts),
    e AS (SELECT *, row_number() OVER (PARTITION BY rk ORDER BY opened, order_no) AS idx, max(opened) OVER (PARTITION BY rk) AS last_opened
          FROM ends)
    SELECT s.k, s.shipped, s.order_id, s.part, s.idx, e.opened, e.last_opened FROM s LEFT JOIN e ON s.k = e.rk AND s.idx = e.idx""",
    lines=LINES, raw=ORDERS,
    starts="SELECT k, shipped, order_id, part FROM {lines}",
    ends="SELECT rk, opened, order_no FROM {raw}",
)
def crowded_pairs(lines, raw, starts, ends):
    del lines, raw
    return ev.pair_by_position(
        starts, ends.withColumnRenamed("rk", "k"), "k", "shipped", "opened", ["order_id", "part"], ["order_no"]
    )


@check(
    "crowded_merge",
    """
    SELECT t.k, t.order_id, t.part, t.shipped, CASE WHEN s.rk IS NULL THEN t.units ELSE s.holder END AS units
    FROM target t LEFT JOIN source s ON t.k = s.rk
    UNION ALL
    SELECT rk, NULL, NULL, NULL, holder FROM source WHERE NOT EXISTS (SELECT 1 FROM target t WHERE t.k = rk)""",
    target=LINES,
    raw=ORDERS,
    source="SELECT rk, max(holder) AS holder FROM {raw} GROUP BY rk",
)
def crowded_merge(target, raw, source):
    del raw
    renamed = source.select(F.col("rk").alias("k"), F.col("holder").alias("units"))
    return datasets.merge_upsert(target, renamed, ["k"], ["units"], ["k", "units"])


@check(
    "crowded_consolidation",
    """
    SELECT coalesce(p.k, l.k) AS k, coalesce(p.day, l.day) AS day, coalesce(p.n, l.n) AS n,
           CASE WHEN p.n IS NOT NULL AND l.n IS NOT NULL THEN 'BOTH' WHEN p.n IS NOT NULL THEN 'MODERN' ELSE 'LEGACY' END AS src
    FROM newer p FULL OUTER JOIN older l ON p.k = l.k AND p.day = l.day""",
    raw=ORDERS, lines=LINES,
    newer="SELECT rk AS k, CAST(opened AS DATE) AS day, max(order_no) AS n FROM {raw} GROUP BY rk, CAST(opened AS DATE)",
    older="SELECT k, CAST(shipped AS DATE) AS day, order_id AS n FROM {lines}",
)
def crowded_consolidation(raw, lines, newer, older):
    del raw, lines
    return joins.consolidate(newer, older, ["k", "day"], ["k", "day", "n"], "src", "n")


@check(
    "crowded_medians",
    """SELECT k, round(quantile_cont(share, 0.5), 9) AS p50, round(quantile_cont(share, 0.9), 9) AS p90 FROM shares GROUP BY k""",
    shares="""SELECT CASE l_returnflag WHEN 'R' THEN 0 WHEN 'A' THEN l_suppkey + 1 END AS k, l_extendedprice / 100000 AS share
              FROM {lineitem}""",
)
def crowded_medians(shares):
    rows = scans.exact_percentiles(
        shares, ["k"], "share", {"p50": 0.5, "p90": 0.9}, chunk=F.floor(F.col("share") * 1000)
    )
    return rows.withColumns({c: F.round(c, 9) for c in ("p50", "p90")})
