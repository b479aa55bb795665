"""Archive expansion and incremental landing (Structured Streaming, availableNow)."""

from __future__ import annotations

import os
import zipfile

import pytest

from dockflow import schema
from dockflow.operators.clean import clean_trips, quality_funnel
from dockflow.sources.archives import pick_csv_member, read_archived_trips
from dockflow.sources.curated import read_trips
from dockflow.sources.raw_csv import read_raw_trips
from dockflow.streaming.landing import land_archives, land_trips, run_to_completion

from .conftest import MINI_CSV


def _zip(path, members):
    with zipfile.ZipFile(path, "w") as zf:
        for name, data in members:
            zf.writestr(name, data)


def test_pick_csv_member():
    def pick(*names):
        found = pick_csv_member([zipfile.ZipInfo(n) for n in names])
        return found and found.filename

    assert pick("__MACOSX/._a.csv", "x/readme.txt", "x/202401-trips.CSV") == "x/202401-trips.CSV"
    assert pick("._a.csv", "dir.csv/", "not__MACOSX.csv") == "not__MACOSX.csv"
    assert pick("a.txt") is None


def test_archives_expand_to_same_rows_as_csv(spark, mini_raw, tmp_dir):
    text = open(MINI_CSV).read()
    _zip(os.path.join(tmp_dir, "202401-trips.zip"), [("__MACOSX/._x.csv", "junk"), ("inner/202401-trips.csv", text)])
    df = read_archived_trips(spark, tmp_dir, check_header=True)
    assert set(df.columns) == set(schema.RAW_COLUMNS) | {"source_archive", "source_member"}
    assert df.select("source_member").distinct().first()[0] == "202401-trips.csv"
    raw = df.select(*schema.RAW_COLUMNS)
    assert sorted(map(tuple, raw.collect()), key=str) == sorted(map(tuple, mini_raw.collect()), key=str)
    assert [r.rows for r in quality_funnel(raw).orderBy("step_no").collect()] == [13, 10, 9, 7, 6]


def test_archive_without_csv_fails(spark, tmp_dir):
    _zip(os.path.join(tmp_dir, "bad.zip"), [("notes.txt", "hello")])
    with pytest.raises(Exception, match="no CSV member"):
        read_archived_trips(spark, tmp_dir).collect()


def test_archive_header_check(spark, tmp_dir):
    text = open(MINI_CSV).read().replace("ride_id", "trip_id", 1)
    _zip(os.path.join(tmp_dir, "h.zip"), [("h.csv", text)])
    assert read_archived_trips(spark, tmp_dir).count() == 13
    with pytest.raises(Exception, match="unexpected CSV header"):
        read_archived_trips(spark, tmp_dir, check_header=True).collect()


def test_incremental_landing_is_idempotent(spark, tmp_dir):
    landing, raw, curated = (os.path.join(tmp_dir, d) for d in ("landing", "raw", "curated"))
    ck_a, ck_t = os.path.join(tmp_dir, "ck_archives"), os.path.join(tmp_dir, "ck_trips")
    os.makedirs(landing)
    text = open(MINI_CSV).read()
    _zip(os.path.join(landing, "202401.zip"), [("202401-trips.csv", text)])

    run_to_completion(land_archives(spark, landing, raw, ck_a), 300)
    run_to_completion(land_trips(spark, raw, curated, ck_t), 300)
    assert read_trips(spark, curated).count() == 6

    # Nothing new: both re-runs are no-ops.
    run_to_completion(land_archives(spark, landing, raw, ck_a), 300)
    run_to_completion(land_trips(spark, raw, curated, ck_t), 300)
    assert read_trips(spark, curated).count() == 6

    # A re-delivered month with one new ride: only the new ride lands.
    lines = text.splitlines()
    extra = "C1,classic_bike,2024-01-20 10:00:00,2024-01-20 10:30:00,Beta Ave,S2,Alpha St,S1,41.91,-87.64,41.90,-87.63,member"
    _zip(os.path.join(landing, "202401-redelivered.zip"), [("202401-trips.csv", "\n".join(lines + [extra]) + "\n")])
    run_to_completion(land_archives(spark, landing, raw, ck_a), 300)
    run_to_completion(land_trips(spark, raw, curated, ck_t), 300)
    out = read_trips(spark, curated)
    assert out.count() == 7
    assert out.groupBy("ride_id").count().filter("count > 1").count() == 0
    expected = clean_trips(spark.read.schema(schema.RAW_SCHEMA).option("header", True).csv(MINI_CSV)).count() + 1
    assert out.count() == expected


HEADER = ",".join(schema.RAW_COLUMNS)
RIDE = "{r},classic_bike,{s},{e},Beta Ave,S2,Alpha St,S1,{lat},-87.64,41.90,-87.63,member"
DELIVERIES = [
    [RIDE.format(r="Z1", s="2024-01-31 23:50:00", e="2024-02-01 00:10:00", lat="41.91"),
     RIDE.format(r="Z2", s="2024-01-05 10:00:00", e="2024-01-05 10:20:00", lat="41.91"),
     RIDE.format(r="Z5", s="2024-01-07 10:00:00", e="2024-01-07 10:20:00", lat="41.91")],
    # Z1 again in the next month; Z2 with an earlier start that fails the duration rule; Z3 with a NaN copy.
    [RIDE.format(r="Z1", s="2024-02-01 00:00:05", e="2024-02-01 00:20:00", lat="41.91"),
     RIDE.format(r="Z2", s="2023-12-05 10:00:00", e="2024-01-05 10:20:00", lat="41.91"),
     RIDE.format(r="Z3", s="2024-03-01 10:00:00", e="2024-03-01 10:20:00", lat="41.92")],
    [RIDE.format(r="Z3", s="2024-02-29 10:00:00", e="2024-03-01 10:20:00", lat="NaN"),
     RIDE.format(r="Z5", s="2024-01-07 10:00:00", e="2024-01-07 10:20:00", lat="41.90"),
     RIDE.format(r="Z4", s="2024-03-02 10:00:00", e="2024-03-02 10:20:00", lat="41.92")],
]


def _rows(df):
    return sorted((tuple(r) for r in df.select(*schema.CURATED_COLUMNS).collect()), key=str)


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 1, 0), (1, 0, 2)])
def test_landing_equals_batch_cleaning_in_any_order(spark, tmp_dir, order):
    raw, curated, ck = (os.path.join(tmp_dir, d) for d in ("raw", "curated", "ck"))
    os.makedirs(raw)
    for n, k in enumerate(order):
        with open(os.path.join(raw, f"{n}.csv"), "w") as fh:
            fh.write("\n".join([HEADER, *DELIVERIES[k]]) + "\n")
        run_to_completion(land_trips(spark, raw, curated, ck), 300)
        assert _rows(read_trips(spark, curated)) == _rows(clean_trips(read_raw_trips(spark, raw)))
    assert read_trips(spark, curated).count() == 4


def test_merging_the_same_rows_twice_changes_nothing(spark, tmp_dir):
    from dockflow.streaming.landing import merge_trips

    raw, curated = os.path.join(tmp_dir, "raw"), os.path.join(tmp_dir, "curated")
    os.makedirs(raw)
    for n, rows in enumerate(DELIVERIES):
        with open(os.path.join(raw, f"{n}.csv"), "w") as fh:
            fh.write("\n".join([HEADER, *rows]) + "\n")
    for _ in range(2):
        merge_trips(read_raw_trips(spark, raw), curated)
        assert _rows(read_trips(spark, curated)) == _rows(clean_trips(read_raw_trips(spark, raw)))


def test_a_plain_file_beside_landed_archives_lands(spark, tmp_dir):
    landing, raw, curated = (os.path.join(tmp_dir, d) for d in ("landing", "raw", "curated"))
    os.makedirs(landing)
    _zip(os.path.join(landing, "a.zip"), [("a.csv", "\n".join([HEADER, *DELIVERIES[0]]) + "\n")])
    run_to_completion(land_archives(spark, landing, raw, os.path.join(tmp_dir, "ck_a")), 300)
    with open(os.path.join(raw, "plain.csv"), "w") as fh:
        fh.write("\n".join([HEADER, *DELIVERIES[2]]) + "\n")
    run_to_completion(land_trips(spark, raw, curated, os.path.join(tmp_dir, "ck_t")), 300)
    assert {r.ride_id for r in read_trips(spark, curated).collect()} == {"Z1", "Z2", "Z4", "Z5"}
    assert read_raw_trips(spark, raw, recursive=True).count() == 6


def test_a_timeout_raises():
    class Slow:
        stopped = False

        def awaitTermination(self, timeout):
            return False

        def exception(self):
            return None

        def stop(self):
            self.stopped = True

    slow = Slow()
    with pytest.raises(TimeoutError):
        run_to_completion(slow, 0.1)
    assert slow.stopped


def test_landing_across_micro_batches(spark, tmp_dir):
    """One file per micro-batch; a ride repeated in a later batch lands once."""
    raw, curated = os.path.join(tmp_dir, "raw"), os.path.join(tmp_dir, "curated")
    os.makedirs(raw)
    lines = open(MINI_CSV).read().splitlines()
    header, body = lines[0], lines[1:]
    with open(os.path.join(raw, "202401-a.csv"), "w") as fh:
        fh.write("\n".join([header] + body[:7]) + "\n")
    with open(os.path.join(raw, "202401-b.csv"), "w") as fh:
        fh.write("\n".join([header, body[0]] + body[7:]) + "\n")  # A1 again
    q = run_to_completion(land_trips(spark, raw, curated, os.path.join(tmp_dir, "ck"), max_files_per_trigger=1), 300)
    assert len([p for p in q.recentProgress if p["numInputRows"] > 0]) == 2
    out = read_trips(spark, curated)
    assert out.count() == 6
    assert out.groupBy("ride_id").count().filter("count > 1").count() == 0


def test_batch_landing_with_manifest(spark, tmp_dir):
    from dockflow.streaming.landing import land_new_files_batch

    raw, curated, manifest = (os.path.join(tmp_dir, d) for d in ("raw", "curated", "manifest"))
    os.makedirs(raw)
    lines = open(MINI_CSV).read().splitlines()
    header, body = lines[0], lines[1:]
    with open(os.path.join(raw, "202401-a.csv"), "w") as fh:
        fh.write("\n".join([header] + body[:7]) + "\n")
    land_new_files_batch(spark, raw, curated, manifest)
    assert read_trips(spark, curated).count() == 3
    land_new_files_batch(spark, raw, curated, manifest)  # nothing new
    assert read_trips(spark, curated).count() == 3
    with open(os.path.join(raw, "202401-b.csv"), "w") as fh:
        fh.write("\n".join([header, body[0]] + body[7:]) + "\n")
    land_new_files_batch(spark, raw, curated, manifest)
    out = read_trips(spark, curated)
    assert out.count() == 6 and out.groupBy("ride_id").count().filter("count > 1").count() == 0
    assert spark.read.parquet(manifest).count() == 2


class Sparse:
    """A file whose stretches of zeros are holes."""

    def __init__(self, path):
        self.fh = open(path, "wb")

    def write(self, data):
        if len(data) > 4096 and not any(data):
            self.fh.seek(len(data), os.SEEK_CUR)
        else:
            self.fh.write(data)
        return len(data)

    def __getattr__(self, name):
        return getattr(self.fh, name)


def test_an_archive_of_more_than_two_gigabytes(spark, mini_raw, tmp_dir):
    out = Sparse(os.path.join(tmp_dir, "big.zip"))
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as zf:
        with zf.open("photos.bin", "w", force_zip64=True) as fh:
            for _ in range(140):
                fh.write(bytes(16 << 20))
        zf.writestr("202401-trips.csv", open(MINI_CSV).read())
    out.close()
    assert os.path.getsize(os.path.join(tmp_dir, "big.zip")) > 1 << 31
    df = read_archived_trips(spark, tmp_dir, check_header=True)
    assert df.rdd.getNumPartitions() == 1
    assert sorted(map(tuple, df.select(*schema.RAW_COLUMNS).collect()), key=str) == sorted(map(tuple, mini_raw.collect()), key=str)
    raw = os.path.join(tmp_dir, "raw")
    run_to_completion(land_archives(spark, tmp_dir, raw, os.path.join(tmp_dir, "ck")), 300)
    assert read_raw_trips(spark, raw, recursive=True).count() == 13


def test_a_long_trip_file_comes_in_bounded_blocks(tmp_dir):
    from dockflow.sources import archive_source

    path = os.path.join(tmp_dir, "long.zip")
    line = b"x" * 99 + b"\n"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as zf, zf.open("a.csv", "w") as fh:
        for _ in range(300):
            fh.write(line * 1000)
    sizes, lines = [], 0
    for batch in archive_source.ArchiveReader({"path": path}).read(archive_source.Archive(path)):
        assert batch.column("first_line")[0].as_py() == lines
        text = batch.column("text")[0].as_py()
        sizes.append(len(text))
        lines += text.count("\n") + 1
    assert lines == 300_000 and max(sizes) <= archive_source.BLOCK_BYTES + 100 and len(sizes) > 5


def test_archives_written_and_read_again(spark, mini_raw, tmp_dir):
    from dockflow.sources.archives import write_archived_trips

    path = os.path.join(tmp_dir, "zips")
    write_archived_trips(mini_raw.repartition(3), path)
    assert sorted(os.listdir(path)) == ["part-00000.zip", "part-00001.zip", "part-00002.zip"]
    for where in (path, f"file://{path}", f"file:{path}", f"{path}/part-*.zip"):
        df = read_archived_trips(spark, where, check_header=True)
        assert sorted(map(tuple, df.select(*schema.RAW_COLUMNS).collect()), key=str) == sorted(map(tuple, mini_raw.collect()), key=str)
    with pytest.raises(Exception, match="no archives at"):
        read_archived_trips(spark, os.path.join(tmp_dir, "nowhere")).collect()


def _batches(spark, tmp_dir):
    """The deliveries as raw tables."""
    out = []
    for n, rows in enumerate(DELIVERIES):
        path = os.path.join(tmp_dir, f"delivery-{n}.csv")
        with open(path, "w") as fh:
            fh.write("\n".join([HEADER, *rows]) + "\n")
        out.append(read_raw_trips(spark, path))
    return out


def test_a_batch_reads_its_rides_months_only(spark, tmp_dir, monkeypatch):
    """The index is joined as it lies; of the zone only the month folders that hold a ride of the batch are read."""
    from dockflow.sources import zone
    from dockflow.streaming import landing

    first, second, third = _batches(spark, tmp_dir)
    curated = os.path.join(tmp_dir, "curated")
    landing.merge_trips(third, curated)
    landing.merge_trips(first, curated)
    before = zone.read_manifest(spark, curated)
    assert {m for _, m in before.of(zone.DATA)} == {"2024-01", "2024-02", "2024-03"} or {m for _, m in before.of(zone.DATA)} == {"2024-01", "2024-03"}
    plans = {}
    monkeypatch.setattr(landing, "settled", lambda df, name: plans.setdefault(name, df))
    rides = spark.createDataFrame([("Z2",), ("new",)], "ride_id string")
    own = first.limit(0).select(*schema.RAW_COLUMNS)
    known = landing.known_rows(spark, curated, before, landing.ride_winners(landing.candidate_rides(own)).select(*landing.ROW_COLUMNS).unionByName(
        rides.select("ride_id", *[landing.F.lit(None).cast(t).alias(c) for c, t in landing.ride_winners(landing.candidate_rides(own)).select(*landing.ROW_COLUMNS).dtypes[1:]])))
    assert [(r.ride_id, r._month) for r in known.collect()] == [("Z2", "2024-01")]
    text = plans["landing-known"]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in text and "(trip_month" in text and "2024-01" in text and "2024-03" not in text
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        from dockflow.streaming import ride_index

        look = ride_index.look_up(spark, curated, before, rides)
        lines = look._jdf.queryExecution().sparkPlan().toString(), look._jdf.queryExecution().executedPlan().toString()
        assert "Bucketed: true" in lines[1]
        assert lines[1].count("Exchange hashpartitioning") == 1  # the rides asked for
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_a_writer_that_dies_leaves_the_zone_as_it_was(spark, tmp_dir, monkeypatch):
    from dockflow.sources import zone
    from dockflow.streaming import landing

    batches = _batches(spark, tmp_dir)
    curated = os.path.join(tmp_dir, "curated")
    landing.merge_trips(batches[0], curated)
    was = _rows(read_trips(spark, curated))
    with monkeypatch.context() as m:
        def dies(*_):
            raise OSError("power cut")

        m.setattr(zone, "commit", dies)
        for b in batches[1:]:
            with pytest.raises(OSError):
                landing.merge_trips(b, curated)
    assert _rows(read_trips(spark, curated)) == was
    assert zone.expired_folders(spark, curated)
    os.makedirs(os.path.join(curated, "_manifest", "version=2", "_temporary"))  # died while it committed
    for b in batches[1:]:
        landing.merge_trips(b, curated)
    together = batches[0].unionByName(batches[1]).unionByName(batches[2])
    assert _rows(read_trips(spark, curated)) == _rows(clean_trips(together))


def test_two_writers_of_one_version(spark, tmp_dir):
    from dockflow.sources import zone

    path = os.path.join(tmp_dir, "zone")
    zone.commit(spark, path, zone.Manifest(), [])
    with pytest.raises(RuntimeError, match="another writer"):
        zone.commit(spark, path, zone.Manifest(), [("data", "x", "2024-01")])
    assert zone.read_manifest(spark, path) == zone.Manifest(1)


def test_index_generations(spark, tmp_dir, monkeypatch):
    """After many appends the next generation holds a row for each ride, and landing goes on as before."""
    from dockflow.sources import zone
    from dockflow.streaming import landing, ride_index

    monkeypatch.setattr(ride_index, "MOST_APPENDS", 2)
    batches = _batches(spark, tmp_dir)
    curated = os.path.join(tmp_dir, "curated")
    for b in (batches[2], batches[0], batches[1], batches[0]):
        landing.merge_trips(b, curated, index_buckets=4)
    manifest = zone.read_manifest(spark, curated)
    assert len(manifest.of(ride_index.KIND)) <= 2
    rides = ride_index.rows_of(spark, curated, manifest).groupBy("ride_id").count().collect()
    assert {r.ride_id for r in rides} == {"Z1", "Z2", "Z3", "Z4", "Z5"}
    together = batches[0].unionByName(batches[1]).unionByName(batches[2])
    assert _rows(read_trips(spark, curated)) == _rows(clean_trips(together))
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("dockflow_rides")]
