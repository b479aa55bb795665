"""Text normalisation Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dockflow import schema
from dockflow.functions._cols import as_col


def normalise_category(c) -> Column:
    """Trim and lower-case a categorical value (``' Classic_Bike'`` -> ``classic_bike``)."""
    return F.lower(F.trim(as_col(c)))


def normalise_name(c, blank_as_null: bool = False) -> Column:
    """Trim a station name; optionally turn a blank name into NULL."""
    t = F.trim(as_col(c))
    return F.nullif(t, F.lit("")) if blank_as_null else t


def route_label(start, end, sep: str = schema.ROUTE_SEPARATOR) -> Column:
    """Directional ``start -> end`` label (NULL parts are skipped)."""
    return F.concat_ws(sep, as_col(start), as_col(end))
