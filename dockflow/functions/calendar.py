"""Timestamp parsing and calendar bucketing Column functions.

Timestamps are handled as ``TIMESTAMP_NTZ`` (local wall-clock time), so every
calendar field and duration is independent of the session time zone. When the
wall clock belongs to a zone with daylight-saving changes and elapsed time must
account for them, pass ``tz`` to :func:`duration_min`.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dockflow import schema
from dockflow.functions._cols import as_col


# Text shape of the default format; with ``try_cast`` (which rejects impossible
# dates and times) it accepts exactly what the strict ``yyyy-MM-dd HH:mm:ss``
# parser accepts, at about half the cost per row.
_DEFAULT_SHAPE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}$"


def parse_timestamp(text, fmt: str = schema.TS_FORMAT, keep_chars: int | None = schema.TS_TEXT_LENGTH) -> Column:
    """Parse text to ``TIMESTAMP_NTZ``; NULL on missing or malformed input.

    ``keep_chars`` keeps only the leading characters (dropping fractional
    seconds with the default 19). Parsing is strict in ``fmt``; the value is
    taken as wall-clock time, so no session-zone conversion happens. Safe
    under ANSI mode. The default format is checked by its text shape plus
    ``try_cast``; any other format by ``try_to_timestamp`` with ``fmt``.
    """
    t = as_col(text)
    if keep_chars is not None:
        t = F.substring(t, 1, keep_chars)
    if fmt == schema.TS_FORMAT:
        well_formed = t.rlike(_DEFAULT_SHAPE)
    else:
        well_formed = F.try_to_timestamp(t, F.lit(fmt)).isNotNull()
    return F.when(well_formed, t.try_cast("timestamp_ntz"))


def duration_min(start, end, tz: str | None = None) -> Column:
    """Elapsed minutes between two NTZ timestamps (whole seconds / 60.0).

    With ``tz`` the wall-clock values are first placed in that zone, so a trip
    across a daylight-saving change gets its true elapsed time.
    """
    s, e = as_col(start), as_col(end)
    if tz is not None:
        s = F.convert_timezone(F.lit(tz), F.lit("UTC"), s)
        e = F.convert_timezone(F.lit(tz), F.lit("UTC"), e)
    # Not timestamp_diff: it places both values in the session zone first.
    gap = e - s
    part = lambda unit, size: F.extract(F.lit(unit), gap).cast("long") * F.lit(size)
    return (part("DAY", 86_400) + part("HOUR", 3_600) + part("MINUTE", 60) + part("SECOND", 1)) / F.lit(60.0)


def season(ts) -> Column:
    """Meteorological season of the timestamp's month (Dec/Jan/Feb = Winter)."""
    m = F.month(as_col(ts))
    out = None
    for label, months in schema.SEASON_MONTHS:
        cond = m.isin(*months)
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out.otherwise(schema.SEASON_OTHERWISE)


def time_of_day(hour) -> Column:
    """Named daypart of an hour 0-23."""
    h = as_col(hour)
    out = None
    for label, lo, hi in schema.DAYPARTS:
        cond = h.between(lo, hi)
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out.otherwise(schema.DAYPART_OTHERWISE)


def is_weekend(ts) -> Column:
    """Saturday or Sunday (``dayofweek`` 7 or 1)."""
    return F.dayofweek(as_col(ts)).isin(1, 7)


def day_name(ts) -> Column:
    """English weekday name, e.g. ``Monday``."""
    return F.date_format(as_col(ts), "EEEE")


def weekday_order(day_name_col) -> Column:
    """Monday=1 ... Sunday=7 from a weekday name (NULL for anything else)."""
    c = as_col(day_name_col)
    out = None
    for i, name in enumerate(schema.WEEKDAY_NAMES, start=1):
        out = F.when(c == name, i) if out is None else out.when(c == name, i)
    return out


def month_key(ts) -> Column:
    """``yyyy-MM`` month label used as the curated partition key."""
    return F.date_format(as_col(ts), "yyyy-MM")
