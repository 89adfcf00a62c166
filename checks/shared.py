"""Stand-ins for dimension tables and run times used by several queries."""

import datetime as dt
import tempfile
import uuid

from checks.registry import Source
from lanewright.session import shared_folder

# run times that keep every row of the test tables inside the look-back periods
EVENTS_NOW = dt.datetime(2024, 1, 31)
PLAN_NOW = dt.datetime(1996, 2, 20)
INVOICE_NOW = dt.datetime(1996, 1, 1)
AFTER_ORDERS = dt.datetime(2001, 8, 1)


def calendar(source: str, column: str) -> Source:
    """Calendar from the first to a month after the last date of a table's column."""
    return Source(
        spark=f"""
          SELECT d AS calendar_date, year(d) * 100 + w AS year_wk_nbr, CAST(year(d) AS BIGINT) AS year_nbr, w AS week_nbr,
                 date_format(d, 'EEEE') AS week_day_name
          FROM (SELECT d, CAST(floor((dayofyear(d) + 7 - dayofweek(d)) / 7) AS BIGINT) AS w
                FROM (SELECT explode(sequence(CAST(min({column}) AS DATE), date_add(CAST(max({column}) AS DATE), 30))) AS d
                      FROM {{{source}}}))""",
        other=f"""
          SELECT d AS calendar_date, year(d) * 100 + w AS year_wk_nbr, year(d) AS year_nbr, w AS week_nbr,
                 dayname(d) AS week_day_name
          FROM (SELECT d, CAST(strftime(d, '%U') AS BIGINT) AS w
                FROM (SELECT CAST(unnest(generate_series(CAST(min({column}) AS DATE),
                                                         CAST(max({column}) AS DATE) + 30, INTERVAL 1 DAY)) AS DATE) AS d
                      FROM {source}))""",
    )


EVENT_CALENDAR = calendar("events", "ts")
ORDER_CALENDAR = calendar("orders", "o_orderdate")
SHIP_CALENDAR = calendar("lineitem", "l_shipdate")

# nations stand for distribution centres, customers for stores, regions for time zones
ZONES = """
  SELECT r_name AS time_zone_code,
         CASE r_name WHEN 'AFRICA' THEN 'America/New_York' WHEN 'AMERICA' THEN 'America/Chicago'
                     WHEN 'ASIA' THEN 'America/Denver' WHEN 'EUROPE' THEN 'America/Los_Angeles'
                     ELSE 'America/Phoenix' END AS time_zone_name
  FROM {region}"""
DC_DIM = """
  SELECT CAST(n_nationkey AS BIGINT) AS dc_nbr, 'US' AS country_code, 'Y' AS current_ind,
         CASE n_regionkey WHEN 0 THEN 'AFRICA' WHEN 1 THEN 'AMERICA' WHEN 2 THEN 'ASIA' WHEN 3 THEN 'EUROPE'
                          ELSE 'MIDDLE EAST' END AS time_zone_code,
         CASE WHEN n_name = 'NATION_24' THEN 'Import' ELSE 'Regional' END AS dc_type_desc, n_name AS dc_name,
         'Region' AS dc_region_name, 'Grocery' AS dc_sub_type_desc
  FROM {nation}"""
STORE_DIM = """
  SELECT c_custkey AS store_nbr, 'US' AS country_code, 'Y' AS current_ind,
         CASE WHEN c_acctbal < -900 THEN 'HI' ELSE 'TX' END AS state_prov_code,
         CASE c_mktsegment WHEN 'BUILDING' THEN 'AFRICA' WHEN 'FURNITURE' THEN 'AMERICA' WHEN 'MACHINERY' THEN 'ASIA'
                           ELSE 'EUROPE' END AS time_zone_code
  FROM {customer}"""


def stored_path(df) -> str:
    """A new place in the shared folder; a session that names none, as on one machine, gets a temporary one."""
    return f"{shared_folder(df.sparkSession) or tempfile.mkdtemp(prefix='checks-')}/stored/{uuid.uuid4().hex}"
