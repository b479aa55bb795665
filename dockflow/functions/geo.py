"""Geographic Column functions. All build Catalyst expressions (no UDFs)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from dockflow import schema
from dockflow.functions._cols import as_col


@dataclass(frozen=True)
class BBox:
    """Inclusive latitude/longitude box."""

    lat_min: float
    lat_max: float
    lng_min: float
    lng_max: float


SERVICE_AREA = BBox(schema.LAT_MIN, schema.LAT_MAX, schema.LNG_MIN, schema.LNG_MAX)


def haversine_km(lat1, lng1, lat2, lng2, radius_km: float = schema.EARTH_RADIUS_KM) -> Column:
    """Great-circle distance in km between two points given in degrees.

    Arguments may be column names or Columns.
    """
    p1, p2 = F.radians(as_col(lat1)), F.radians(as_col(lat2))
    half_dlat = F.radians(as_col(lat2) - as_col(lat1)) / 2
    half_dlng = F.radians(as_col(lng2) - as_col(lng1)) / 2
    h = F.pow(F.sin(half_dlat), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(half_dlng), 2)
    return F.lit(radius_km * 2) * F.asin(F.sqrt(h))


def within_bbox(lat, lng, box: BBox = SERVICE_AREA) -> Column:
    """True when the point lies in the box, edges included."""
    return as_col(lat).between(box.lat_min, box.lat_max) & as_col(lng).between(box.lng_min, box.lng_max)


def trip_within_bbox(box: BBox = SERVICE_AREA) -> Column:
    """Both trip endpoints inside the box."""
    return within_bbox("start_lat", "start_lng", box) & within_bbox("end_lat", "end_lng", box)


def grid_cell(coord, step: float) -> Column:
    """Index of the ``step``-degree grid cell holding ``coord`` (floor division)."""
    return F.floor(as_col(coord) / F.lit(float(step)))
