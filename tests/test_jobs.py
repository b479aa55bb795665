"""Batch job entry points end to end on the hand-made CSV."""

from __future__ import annotations

import glob
import os
import shutil
import zipfile

from dockflow.jobs import main
from dockflow.sources.curated import read_trips

from .conftest import MINI_CSV


def _csv_rows(folder):
    files = glob.glob(os.path.join(folder, "part-*.csv"))
    assert len(files) == 1
    return open(files[0]).read().splitlines()


def test_clean_analyze_lake_jobs(spark, tmp_dir):
    raw = os.path.join(tmp_dir, "raw")
    os.makedirs(raw)
    shutil.copy(MINI_CSV, os.path.join(raw, "202401-trips.csv"))
    curated, out = os.path.join(tmp_dir, "curated"), os.path.join(tmp_dir, "out")

    assert main(["clean", "--raw", raw, "--curated", curated, "--out", out]) == 0
    assert read_trips(spark, curated).count() == 6
    funnel = _csv_rows(os.path.join(out, "quality_funnel"))
    assert [line.split(",")[2] for line in funnel[1:]] == ["13", "10", "9", "7", "6"]

    sql_dir = os.path.join(tmp_dir, "sql")
    os.makedirs(sql_dir)
    with open(os.path.join(sql_dir, "11_rides.sql"), "w") as fh:
        fh.write("SELECT COUNT(*) AS trips FROM trips;")
    assert main(["analyze", "--curated", curated, "--out", out, "--min-activity", "0", "--sql-dir", sql_dir]) == 0
    assert _csv_rows(os.path.join(out, "monthly_volume"))[0] == "trip_month,trips,member_trips,casual_trips,avg_duration_min"
    assert _csv_rows(os.path.join(out, "11_rides"))[1:] == ["6"]
    imbalance = _csv_rows(os.path.join(out, "station_imbalance"))
    assert len(imbalance) == 4  # header + 3 stations

    assert main(["lake", "--curated", curated, "--min-activity", "0"]) == 0

    assert main(["analyze", "--all", "--curated", curated, "--out", out, "--min-activity", "0"]) == 0
    assert _csv_rows(os.path.join(out, "rebalancing_pairs"))[0].startswith("pair_rank,")


def test_clean_job_from_archives(spark, tmp_dir):
    arch = os.path.join(tmp_dir, "zips")
    os.makedirs(arch)
    with zipfile.ZipFile(os.path.join(arch, "202401.zip"), "w") as zf:
        zf.write(MINI_CSV, "202401-trips.csv")
    curated, out = os.path.join(tmp_dir, "curated"), os.path.join(tmp_dir, "out")
    assert main(["clean", "--archives", "--check-header", "--raw", arch, "--curated", curated, "--out", out]) == 0
    assert read_trips(spark, curated).count() == 6


def test_land_job_incremental(spark, tmp_dir):
    landing, raw, curated, ckpt = (os.path.join(tmp_dir, d) for d in ("landing", "raw", "curated", "ckpt"))
    os.makedirs(landing)
    with zipfile.ZipFile(os.path.join(landing, "202401.zip"), "w") as zf:
        zf.write(MINI_CSV, "202401-trips.csv")
    args = ["land", "--landing", landing, "--raw", raw, "--curated", curated, "--checkpoint", ckpt, "--check-header"]
    assert main(args) == 0
    assert read_trips(spark, curated).count() == 6
    assert main(args) == 0  # nothing new: no duplicates
    assert read_trips(spark, curated).count() == 6
