"""dockflow: trip-flow analytics on Spark.

Most used entry points::

    from dockflow import read_raw_trips, clean_trips, quality_funnel, write_trips, read_trips
    from dockflow import run_catalog, run_report, run_sql_files
"""

from dockflow.operators.clean import clean_trips, quality_funnel
from dockflow.plans.catalog import run_catalog, run_sql_files
from dockflow.plans.rollup import run_report
from dockflow.sources.archives import read_archived_trips
from dockflow.sources.curated import read_trips, register_trips, write_trips
from dockflow.sources.raw_csv import month_paths, read_raw_trips

__all__ = [
    "clean_trips",
    "month_paths",
    "quality_funnel",
    "read_archived_trips",
    "read_raw_trips",
    "read_trips",
    "register_trips",
    "run_catalog",
    "run_report",
    "run_sql_files",
    "write_trips",
]
