"""Scalar Column functions (all Catalyst expressions, codegen-friendly)."""

from dockflow.functions.calendar import (
    day_name,
    duration_min,
    is_weekend,
    month_key,
    parse_timestamp,
    season,
    time_of_day,
    weekday_order,
)
from dockflow.functions.exact import mean_km, mean_minutes, percent, ratio_half_up, whole_metres, whole_seconds
from dockflow.functions.geo import SERVICE_AREA, BBox, grid_cell, haversine_km, trip_within_bbox, within_bbox
from dockflow.functions.text import normalise_category, normalise_name, route_label

__all__ = [
    "BBox",
    "SERVICE_AREA",
    "day_name",
    "duration_min",
    "grid_cell",
    "haversine_km",
    "is_weekend",
    "mean_km",
    "mean_minutes",
    "month_key",
    "normalise_category",
    "normalise_name",
    "parse_timestamp",
    "percent",
    "ratio_half_up",
    "route_label",
    "season",
    "time_of_day",
    "trip_within_bbox",
    "weekday_order",
    "whole_metres",
    "whole_seconds",
    "within_bbox",
]
