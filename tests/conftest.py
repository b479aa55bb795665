from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

DATA_DIR = os.path.join(ROOT, "tests", "data")
MINI_CSV = os.path.join(DATA_DIR, "mini-trips.csv")
SF_SMALL = "/root/testdata/sf0.001"
SF_MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[4]")
        .appName("dockflow-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "America/New_York")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    from dockflow.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="dockflow-test-")


@pytest.fixture(scope="session")
def mini_raw(spark):
    from dockflow.sources.raw_csv import read_raw_trips

    return read_raw_trips(spark, MINI_CSV)


@pytest.fixture(scope="session")
def events_small(spark):
    return spark.read.parquet(f"{SF_SMALL}/events.parquet")


@pytest.fixture(scope="session")
def trips_small(spark, events_small):
    from dockflow.operators.clean import clean_trips
    from dockflow.sources.fixture import raw_trips_from_events

    return clean_trips(raw_trips_from_events(events_small)).cache()


@pytest.fixture(scope="session")
def trips_medium(spark):
    from dockflow.operators.clean import clean_trips
    from dockflow.sources.fixture import raw_trips_from_events

    ev = spark.read.parquet(f"{SF_MEDIUM}/events.parquet")
    return clean_trips(raw_trips_from_events(ev)).cache()
