"""Sources and sinks: raw CSV, curated Parquet, export, publish, catalog runner."""

from __future__ import annotations

import glob
import os

import pytest

from dockflow import schema
from dockflow.operators.clean import clean_trips
from dockflow.plans.catalog import CORE_ANALYSES, run_catalog
from dockflow.sources.curated import publish_trips, read_trips, register_trips, write_trips
from dockflow.sources.raw_csv import month_paths, read_raw_trips, write_raw_trips
from dockflow.sources.results import export_all, export_result

from .conftest import MINI_CSV


def test_month_paths():
    assert month_paths("/raw", ["202401", "202402"]) == ["/raw/202401-*.csv*", "/raw/202402-*.csv*"]
    with pytest.raises(ValueError):
        month_paths("/raw", [])


def test_raw_glob_filter_skips_archives(spark, tmp_dir):
    import shutil

    shutil.copy(MINI_CSV, os.path.join(tmp_dir, "202401-trips.csv"))
    with open(os.path.join(tmp_dir, "202401-trips.zip"), "wb") as fh:
        fh.write(b"PK\x03\x04 not a csv")
    df = read_raw_trips(spark, tmp_dir)
    assert df.count() == 13


def test_header_check(spark, tmp_dir):
    bad = os.path.join(tmp_dir, "bad.csv")
    with open(MINI_CSV) as src, open(bad, "w") as dst:
        lines = src.read().splitlines()
        dst.write("\n".join([lines[0].replace("ride_id", "trip_id")] + lines[1:]) + "\n")
    assert read_raw_trips(spark, bad).count() == 13  # positional binding by default
    with pytest.raises(Exception):
        read_raw_trips(spark, bad, check_header=True).collect()


def test_curated_round_trip_and_dynamic_overwrite(spark, mini_raw, tmp_dir):
    path = os.path.join(tmp_dir, "trips")
    trips = clean_trips(mini_raw)
    write_trips(trips, path)
    back = read_trips(spark, path)
    assert back.count() == 6
    assert set(back.columns) == set(schema.CURATED_COLUMNS)
    # Rewriting one month dynamically leaves the others untouched.
    write_trips(trips.filter("trip_month = '2024-01'"), path, dynamic_overwrite=True)
    assert read_trips(spark, path).count() == 6
    assert read_trips(spark, path, months=["2024-01"]).count() == 2


def test_a_full_rewrite_leaves_no_stale_month(spark, mini_raw, tmp_dir):
    path = os.path.join(tmp_dir, "trips")
    trips = clean_trips(mini_raw)
    write_trips(trips, path)
    write_trips(trips.filter("trip_month <> '2024-01'"), path)
    assert read_trips(spark, path).count() == 4
    assert not os.path.exists(os.path.join(path, "trip_month=2024-01"))
    publish_trips(trips.filter("trip_month = '2024-01'"), path)
    assert [r[0] for r in read_trips(spark, path).select("trip_month").distinct().collect()] == ["2024-01"]


def test_publish_raw_and_curated(spark, mini_raw, tmp_dir):
    raw_uri = "file://" + os.path.join(tmp_dir, "lake", "raw")
    cur_uri = "file://" + os.path.join(tmp_dir, "lake", "curated", "trips")
    write_raw_trips(mini_raw, raw_uri)
    publish_trips(clean_trips(mini_raw), cur_uri)
    again = read_raw_trips(spark, raw_uri)
    assert sorted(map(tuple, again.collect()), key=str) == sorted(map(tuple, mini_raw.collect()), key=str)
    assert read_trips(spark, cur_uri).count() == 6


def test_export_keeps_order_single_file(spark, trips_small, tmp_dir):
    res = run_catalog(trips_small, ["monthly_volume", "hourly_demand"])
    paths = export_all(res, tmp_dir)
    for p in paths:
        files = glob.glob(os.path.join(p, "part-*.csv"))
        assert len(files) == 1
    hours = [int(line.split(",")[0]) for line in open(glob.glob(os.path.join(paths[1], "part-*.csv"))[0]).read().splitlines()[1:]]
    assert hours == sorted(hours)
    export_result(res["monthly_volume"], os.path.join(tmp_dir, "mv"), single_file=False)


def test_catalog_runner(spark, trips_small):
    out = run_catalog(trips_small)
    assert list(out) == CORE_ANALYSES
    with pytest.raises(ValueError):
        run_catalog(trips_small, [])
    with pytest.raises(KeyError):
        run_catalog(trips_small, ["clean_trips"])
    register_trips(spark, trips_small)
    assert spark.sql("SELECT COUNT(*) FROM trips").first()[0] == trips_small.count()


def test_sql_folder_runner(spark, trips_small, tmp_dir):
    from dockflow.operators import analyses
    from dockflow.plans.catalog import run_sql_files

    with pytest.raises(FileNotFoundError):
        run_sql_files(spark, trips_small, tmp_dir)
    with open(os.path.join(tmp_dir, "02_hours.sql"), "w") as fh:
        fh.write("SELECT hour, COUNT(*) AS total_trips FROM trips GROUP BY hour ORDER BY hour;\n")
    with open(os.path.join(tmp_dir, "01_months.sql"), "w") as fh:
        fh.write("SELECT trip_month, COUNT(*) AS trips FROM trips GROUP BY trip_month ORDER BY trip_month")
    out = run_sql_files(spark, trips_small, tmp_dir)
    assert list(out) == ["01_months", "02_hours"]
    assert [tuple(r) for r in out["01_months"].collect()] == [tuple(r) for r in analyses.monthly_trips(trips_small).collect()]
    direct = analyses.hourly_demand(trips_small).select("hour", "total_trips")
    assert [tuple(r) for r in out["02_hours"].collect()] == [tuple(r) for r in direct.collect()]


def test_scale_conf():
    from dockflow.session import scale_conf

    conf = scale_conf(100 * (1 << 40), 8000)
    assert int(conf["spark.sql.shuffle.partitions"]) == 51200
    assert scale_conf(1 << 20, 8)["spark.sql.shuffle.partitions"] == "16"


def test_compressed_raw_csv(spark, tmp_dir):
    import gzip

    with open(MINI_CSV, "rb") as src, gzip.open(os.path.join(tmp_dir, "202401-trips.csv.gz"), "wb") as dst:
        dst.write(src.read())
    with open(os.path.join(tmp_dir, "202401-trips.csv.zip"), "wb") as fh:
        fh.write(b"PK not for the CSV reader")
    df = read_raw_trips(spark, month_paths(tmp_dir, ["202401"]))
    assert df.count() == 13


def test_checkpoint_dir_guard():
    from types import SimpleNamespace

    from dockflow.session import ensure_checkpoint_dir

    class Conf(dict):
        def get(self, k, default=None):
            return dict.get(self, k, default)

        def set(self, k, v):
            self[k] = v

    cluster = SimpleNamespace(conf=Conf(), sparkContext=SimpleNamespace(master="yarn", getCheckpointDir=lambda: None))
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(cluster)
    set_dirs = []
    configured = SimpleNamespace(
        conf=Conf({"spark.checkpoint.dir": "hdfs:///shared/ckpt"}),
        sparkContext=SimpleNamespace(master="yarn", getCheckpointDir=lambda: None, setCheckpointDir=set_dirs.append),
    )
    assert ensure_checkpoint_dir(configured) == "hdfs:///shared/ckpt" and set_dirs == ["hdfs:///shared/ckpt"]
