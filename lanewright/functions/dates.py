"""Civil-time arithmetic. The session time zone must be UTC (see ``session.SETTINGS``)."""

from __future__ import annotations

import datetime as dt
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

_SECONDS = {"second": 1, "minute": 60, "hour": 3600}

# Fixed value: zone whose calendar day counts as "today" for facilities data.
HOME_ZONE = "America/Chicago"


def as_date(as_of: dt.date | dt.datetime) -> dt.date:
    return as_of.date() if isinstance(as_of, dt.datetime) else as_of


def home_date(now: dt.datetime) -> dt.date:
    """Calendar day of a UTC run time in the home zone."""
    return now.replace(tzinfo=dt.timezone.utc).astimezone(ZoneInfo(HOME_ZONE)).date()


def day(as_of: dt.date | dt.datetime, offset: int = 0) -> Column:
    """Date literal ``as_of`` + ``offset`` days."""
    return F.lit(as_date(as_of) + dt.timedelta(days=offset))


def moment(as_of: dt.date | dt.datetime, **shift: int) -> Column:
    """Civil timestamp literal ``as_of`` shifted by ``timedelta`` arguments."""
    if not isinstance(as_of, dt.datetime):
        as_of = dt.datetime.combine(as_of, dt.time())
    return F.lit((as_of + dt.timedelta(**shift)).isoformat(sep=" ")).cast("timestamp_ntz")


def epoch_seconds(ts: Column) -> Column:
    return F.unix_seconds(ts.cast("timestamp"))


def datetime_trunc(ts: Column, unit: str) -> Column:
    """Truncate and stay civil; ``date_trunc`` alone would return a zoned timestamp."""
    return F.date_trunc(unit, ts).cast("timestamp_ntz")


def datetime_diff(end: Column, start: Column, unit: str) -> Column:
    """Number of ``unit`` boundaries between two times, as a long.

    00:59 to 01:01 is one hour here; Spark's ``timestampdiff`` counts elapsed
    hours and would say zero.
    """
    unit = unit.lower()
    if unit == "day":
        return F.datediff(end, start).cast("long")
    if unit == "year":
        return (F.year(end) - F.year(start)).cast("long")
    width = _SECONDS[unit]
    if width == 1:
        return epoch_seconds(end) - epoch_seconds(start)
    return F.floor(epoch_seconds(end) / width) - F.floor(epoch_seconds(start) / width)


def week_sunday(date: Column) -> Column:
    """Week of the year, 0 to 53, weeks starting on Sunday (``%U``); ``weekofyear`` is ISO."""
    return F.floor((F.dayofyear(date) + 7 - F.dayofweek(date)) / 7).cast("int")


def to_local(ts_utc: Column, zone: Column) -> Column:
    """Civil time at ``zone`` of a UTC timestamp; the zone may vary by row."""
    return F.convert_timezone(F.lit("UTC"), zone, ts_utc)
