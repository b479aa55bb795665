"""Result sinks: CSV export and console preview."""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.types import StructType

PREVIEW_ROWS = 12
PREVIEW_TRUNCATE = 45


def export_result(result: DataFrame, path: str, single_file: bool = False) -> None:
    """Write a result as CSV with header.

    Part files follow each other in the order of a sorted result, and small ones
    are one file already. ``single_file`` merges the partitions into one writer
    (``coalesce(1)``); that runs the last stage in one task, so ask for it only
    where the result is known to be small and to end in a shuffle.
    """
    out = result.coalesce(1) if single_file else result
    out.write.mode("overwrite").option("header", True).csv(path)


def read_result(spark: SparkSession, path: str, kind: StructType) -> DataFrame:
    """A result that was exported to ``path``."""
    return spark.read.schema(kind).option("header", True).csv(path)


def export_all(results: Mapping[str, DataFrame], base_dir: str, max_workers: int = 4) -> list[str]:
    """Export each named result to ``base_dir/<name>``; returns the paths.

    The results are independent jobs, submitted from ``max_workers`` driver
    threads at once so small report queries overlap instead of queueing.
    """
    paths = {name: f"{base_dir.rstrip('/')}/{name}" for name in results}
    with ThreadPoolExecutor(max_workers=max(1, max_workers)) as pool:
        list(pool.map(lambda name: export_result(results[name], paths[name]), list(results)))
    return list(paths.values())


def collect_all(results: Mapping[str, DataFrame], max_workers: int = 4) -> dict[str, list[Row]]:
    """Collect several independent results concurrently (driver threads); for results known to be small, as in the bench."""
    names = list(results)
    with ThreadPoolExecutor(max_workers=max(1, max_workers)) as pool:
        rows = list(pool.map(lambda name: results[name].collect(), names))
    return dict(zip(names, rows))


def preview(result: DataFrame, n: int = PREVIEW_ROWS, truncate: int = PREVIEW_TRUNCATE) -> None:
    result.show(n, truncate=truncate)
