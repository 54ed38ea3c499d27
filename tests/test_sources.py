"""Listing, date windows, footers, statistics, quarantine."""

import os
import subprocess
import sys

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from loamline.config import PipelineConfig
from loamline.sources import files, readings

GOOD = {
    "sensor_id": ["sensor_001", "sensor_002", "sensor_001"],
    "timestamp": ["2023-06-01T10:00:00Z", "2023-06-01T11:00:00Z", "2023-06-01T12:00:00Z"],
    "reading_type": ["temperature", "humidity", "temperature"],
    "value": [25.5, 60.0, 26.0],
    "battery_level": [95.0, 90.0, 94.0],
}


def put(folder, name, columns, **kw):
    path = os.path.join(folder, name)
    pq.write_table(pa.table(columns), path, **kw)
    return path


def names(df, column="path"):
    return [os.path.basename(r[column]) for r in df.collect()]


def test_listing_is_sorted_and_only_parquet(spark, folder):
    for day in ("2023-06-03", "2023-06-01", "2023-06-02"):
        put(folder, f"{day}.parquet", GOOD)
    open(os.path.join(folder, "notes.txt"), "w").write("x")
    listed = files.list_files(spark, folder)
    assert names(listed) == [f"2023-06-0{i}.parquet" for i in (1, 2, 3)]
    assert all(r.length > 0 for r in listed.collect())


def test_missing_folder_is_empty(spark):
    assert files.list_files(spark, "/nowhere/at/all").count() == 0


@pytest.mark.parametrize(
    "start,end,expected",
    [
        ("2023-06-02", "2023-06-02", 1),
        ("2023-06-01", "2023-06-02", 2),
        ("2023-06-02", None, 2),
        (None, "2023-06-01", 1),
        (None, None, 5),
    ],
)
def test_date_window_is_inclusive(spark, folder, start, end, expected):
    for name in ("2023-06-01", "2023-06-02", "2023-06-03", "invalid", "2023-13-45"):
        put(folder, f"{name}.parquet", GOOD)
    assert files.files_in_window(spark, folder, start, end).count() == expected
    assert files.read_window(spark, folder, start, end).count() == expected * 3


def test_window_prunes_files_before_reading(spark, folder):
    for day in (1, 2, 3):
        put(folder, f"2023-06-0{day}.parquet", GOOD)
    one = files.read_window(spark, folder, "2023-06-02", "2023-06-02")
    assert one.rdd.getNumPartitions() == 1
    assert files.read_window(spark, folder, "2024-01-01").rdd.getNumPartitions() == 0


def test_day_of_path(spark):
    paths = ["/x/2023-06-01.parquet", "/x/2023-06-01.parquet/part-0.parquet", "/x/invalid.parquet", "/x/2023-02-30.parquet"]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    got = [r[0] for r in df.select(files.day_of_path(df.p).cast("string")).collect()]
    assert got == ["2023-06-01", "2023-06-01", None, None]


def test_schema_check(spark, folder):
    put(folder, "2023-06-01.parquet", GOOD)
    put(folder, "2023-06-02.parquet", {k: GOOD[k] for k in ("sensor_id", "timestamp", "value")})
    open(os.path.join(folder, "2023-06-03.parquet"), "wb").write(b"not parquet at all")
    checked = {os.path.basename(r.path): r for r in files.schema_check(files.list_files(spark, folder)).collect()}
    good, lacking, broken = (checked[f"2023-06-0{i}.parquet"] for i in (1, 2, 3))
    assert good.is_valid and good.missing == [] and good.num_rows == 3
    assert good.actual["value"] == "double"
    assert not lacking.is_valid and lacking.missing == ["reading_type", "battery_level"]
    assert not broken.is_valid and broken.error and broken.actual is None


def test_ingest_sets_bad_files_aside(spark, folder):
    put(folder, "2023-06-01.parquet", GOOD)
    put(folder, "2023-06-02.parquet", {**GOOD, "value": [1.0, None, float("nan")]})
    put(folder, "2023-06-03.parquet", {k: GOOD[k] for k in ("sensor_id", "timestamp", "value")})
    open(os.path.join(folder, "2023-06-04.parquet"), "wb").write(b"junk")
    put(folder, "2023-06-05.parquet", {k: v[:0] for k, v in GOOD.items()}, )
    taken = files.ingest(spark, folder)
    stats = {os.path.basename(r.file_path): r for r in taken.stats.collect()}
    assert taken.readings.count() == 6
    assert (stats["2023-06-01.parquet"].records_valid, stats["2023-06-01.parquet"].success) == (3, True)
    assert stats["2023-06-02.parquet"].records_invalid == 2  # NaN is missing, too
    assert stats["2023-06-03.parquet"].errors == [
        "Schema validation failed: missing columns reading_type, battery_level"
    ]
    assert not stats["2023-06-04.parquet"].schema_valid
    assert sorted(names(taken.quarantined, "file_path")) == [f"2023-06-0{i}.parquet" for i in (3, 4, 5)]
    (total,) = files.ingest_summary(taken.stats).collect()
    assert (total.total_files, total.successful_files, total.failed_files) == (5, 2, 3)
    assert (total.total_records, total.error_count) == (6, 3)
    assert total.total_size_mb > 0
    assert files.ingest_errors(taken.stats).count() == 3


def test_days_with_different_timestamp_types(spark, folder):
    from datetime import datetime

    put(folder, "2023-06-01.parquet", GOOD)
    stamps = [datetime(2023, 6, 2, h) for h in (10, 11, 12)]
    put(folder, "2023-06-02.parquet", {**GOOD, "timestamp": pa.array(stamps, pa.timestamp("us"))})
    taken = files.ingest(spark, folder)
    days = taken.readings.groupBy(F.to_date("timestamp").cast("string").alias("d")).count().collect()
    assert {r.d: r["count"] for r in days} == {"2023-06-01": 3, "2023-06-02": 3}


def test_every_stored_form_of_time(spark, folder):
    from datetime import datetime

    put(folder, "2023-06-01.parquet", GOOD)
    for day, unit, zone in ((2, "us", None), (3, "us", "UTC"), (4, "ns", None), (5, "ns", "UTC"), (6, "ms", None)):
        stamps = pa.array([datetime(2023, 6, day, h, 0, 0, 5000) for h in (10, 11, 12)], pa.timestamp(unit, zone))
        put(folder, f"2023-06-0{day}.parquet", {**GOOD, "timestamp": stamps})
    taken = files.ingest(spark, folder)
    assert taken.quarantined.count() == 0
    got = {(r.d, r.n, r.h) for r in taken.readings.groupBy(F.to_date("timestamp").cast("string").alias("d"))
           .agg(F.count(F.lit(1)).alias("n"), F.min(F.hour("timestamp")).alias("h")).collect()}
    assert got == {(f"2023-06-0{d}", 3, 10) for d in range(1, 7)}
    micros = taken.readings.where("timestamp >= '2023-06-04' AND timestamp < '2023-06-05'")
    assert {r[0] for r in micros.select(F.unix_micros("timestamp") % 1_000_000).collect()} == {5000}


def test_a_window_does_not_touch_other_files(spark, folder):
    open(os.path.join(folder, "2023-05-01.parquet"), "wb").write(b"junk")
    put(folder, "2023-05-02.parquet", {k: GOOD[k] for k in ("sensor_id", "timestamp", "value")})
    put(folder, "2023-05-03.parquet", {**GOOD, "value": ["a", "b", "c"]})
    for day in (1, 2, 3):
        put(folder, f"2023-06-0{day}.parquet", GOOD)
    taken = files.ingest(spark, folder, "2023-06-01", "2023-06-03")
    assert taken.readings.count() == 9 and taken.quarantined.count() == 0
    assert files.read_window(spark, folder, "2023-06-01", "2023-06-03").count() == 9


def test_a_bad_file_in_the_window_is_pruned(spark, folder):
    put(folder, "2023-06-01.parquet", GOOD)
    open(os.path.join(folder, "2023-06-02.parquet"), "wb").write(b"junk")
    put(folder, "2023-06-03.parquet", GOOD)
    put(folder, "odd name.parquet", GOOD)
    taken = files.ingest(spark, folder)
    assert taken.readings.count() == 9 and taken.quarantined.count() == 1


def test_unreadable_types_go_to_quarantine(spark, folder):
    put(folder, "2023-06-01.parquet", GOOD)
    put(folder, "2023-06-02.parquet", {**GOOD, "value": [[1.0], [2.0], [3.0]]})
    taken = files.ingest(spark, folder)
    assert taken.readings.count() == 3
    (bad,) = taken.quarantined.collect()
    assert len(bad.errors) == 1 and "unreadable types value list<" in bad.errors[0]


def test_footer_locations():
    at = files.footer_location
    assert at("file:/a b/c.parquet") == "file:///a%20b/c.parquet"
    assert at("file:///a/c.parquet") == "file:///a/c.parquet"
    assert at("s3a://bucket/k/c.parquet") == "s3://bucket/k/c.parquet"
    assert at("hdfs://name:8020/c.parquet") == "hdfs://name:8020/c.parquet"
    assert at("abfss://box@account.dfs.core.windows.net/c").startswith("abfs://box@account.")
    assert at("dbfs:/mnt/c.parquet") == "file:///dbfs/mnt/c.parquet"
    with pytest.raises(RuntimeError, match="footers cannot be read"):
        files.footer_system("nosuchstore://x/c.parquet")


def test_footers_from_another_working_directory(folder):
    """Workers find the package wherever the driver was started."""
    put(folder, "2023-06-01.parquet", GOOD)
    code = (
        "import sys; sys.path.append(sys.argv[1]); from loamline.session import local_session; "
        "from loamline.sources import files; s = local_session(1, '1g'); "
        "print('valid', files.schema_check(files.list_files(s, sys.argv[2])).first().is_valid)"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    run = [sys.executable, "-c", code, root, folder.removeprefix("file:")]
    out = subprocess.run(run, cwd="/", env=env, capture_output=True, text=True, timeout=200)
    assert "valid True" in out.stdout, out.stderr[-2000:]


def test_all_bad_means_no_readings(spark, folder):
    open(os.path.join(folder, "2023-06-01.parquet"), "wb").write(b"junk")
    taken = files.ingest(spark, folder)
    assert taken.readings is None and taken.stats.count() == 1


def test_paths_with_special_characters(spark, folder):
    odd = os.path.join(folder, "a b+c %41")
    os.makedirs(odd)
    put(odd, "2023-06-01.parquet", GOOD)
    put(odd, "2023-06-02.parquet", {k: GOOD[k] for k in ("sensor_id", "value")})
    taken = files.ingest(spark, odd)
    assert taken.readings.count() == 3
    assert sorted(r.records_total for r in taken.stats.collect()) == [0, 3]


def test_summary_arithmetic(spark):
    ddl = (
        "file_path string, file_size_mb double, records_total bigint, records_valid bigint, "
        "records_invalid bigint, success boolean, errors array<string>"
    )
    rows = [("a", 1.5, 100, 95, 5, True, []), ("b", 0.8, 50, 0, 50, False, ["Test error"])]
    (s,) = files.ingest_summary(spark.createDataFrame(rows, ddl)).collect()
    assert (s.total_files, s.successful_files, s.failed_files) == (2, 1, 1)
    assert (s.total_records, s.valid_records, s.invalid_records) == (100, 95, 5)
    assert (s.total_size_mb, s.error_count) == (1.5, 1)


def test_scan_prunes_columns(spark, folder):
    put(folder, "2023-06-01.parquet", {**GOOD, "extra": [1, 2, 3]})
    scan = readings.scan_readings(spark, folder)
    assert scan.columns == list(readings.READING_COLUMNS)
    assert "extra" not in scan._jdf.queryExecution().executedPlan().toString()


def test_type_check(spark):
    df = spark.createDataFrame(
        [(123, "t", "not_numeric", "5"), (124, "t", "7.5", None)],
        "sensor_id int, reading_type string, value string, battery_level string",
    )
    out = {r.column: r for r in readings.type_check(df).collect()}
    assert (out["value"].severity, out["value"].uncastable_count) == ("error", 1)
    assert out["battery_level"].uncastable_count == 0
    assert out["sensor_id"].declared_type == "int"


def test_normalise_accepts_text_and_nan(spark):
    df = spark.createDataFrame(
        [("s", "2023-06-01T10:17:00", "t", float("nan"), 1.0), ("s", "garbage", "t", 1.0, None)],
        "sensor_id string, timestamp string, reading_type string, value double, battery_level double",
    )
    out = readings.normalise(df).withColumn("us", F.unix_micros("timestamp")).collect()
    assert out[0].value is None and out[0].us == 1685614620000000
    assert out[1].timestamp is None


def test_session_zone_does_not_matter(spark):
    # The last two are one wall hour in New York.
    stamps = ["2023-06-01T10:17:00", "2023-06-01 10:17:00+05:30", "2023-11-05T05:30:00Z", "2023-11-05T06:30:00Z"]
    df = spark.createDataFrame([(t,) for t in stamps], "timestamp string")
    df = df.selectExpr("'s' sensor_id", "timestamp", "'t' reading_type", "1D value", "1D battery_level")
    from loamline.operators.cleaning import local_fields

    seen = []
    before = spark.conf.get("spark.sql.session.timeZone")
    for zone in ("UTC", "Asia/Tokyo", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            out = local_fields(readings.normalise(df), PipelineConfig())
            seen.append([(r.us, r.date, r.hour) for r in out.select(F.unix_micros("timestamp").alias("us"), "date", "hour").collect()])
        finally:
            spark.conf.set("spark.sql.session.timeZone", before)
    assert seen[0] == seen[1] == seen[2]
    assert [x[1:] for x in seen[0]] == [
        ("2023-06-01", 15), ("2023-06-01", 10), ("2023-11-05", 11), ("2023-11-05", 12)
    ]


def test_partition_values(spark):
    df = spark.createDataFrame([("/b/date=2023-06-01/k=a=b/part-0.parquet",), ("/b/plain.parquet",)], "p string")
    got = [r[0] for r in df.select(files.partition_values(df.p)).collect()]
    assert got == [{"date": "2023-06-01", "k": "a=b"}, {}]


def test_union_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, 2)], "x int, y int")
    b = spark.createDataFrame([(3,)], "x int")
    assert sorted(r.x for r in readings.union_readings([a, b]).collect()) == [1, 3]


def test_days_of_mixed_parts_are_read_file_by_file(spark, folder):
    """A day folder with parts of several types and a broken one: the good parts are read, no path is in a plan."""
    from datetime import datetime

    day = os.path.join(folder, "2023-06-01.parquet")
    os.makedirs(day)
    put(day, "part-a.parquet", GOOD)
    stamps = [datetime(2023, 6, 1, h, 0, 0, 7) for h in (1, 2, 3)]
    for name, kind in (("b", pa.timestamp("ns")), ("c", pa.timestamp("us", "UTC")), ("d", pa.timestamp("us"))):
        put(day, f"part-{name}.parquet", {**GOOD, "timestamp": pa.array(stamps, kind)})
    put(day, "part-e.parquet", {**GOOD, "value": pa.array([1, 2, None], pa.int32())})
    put(day, "part f.parquet", {**GOOD, "sensor_id": pa.array(["x", "y", "x"]).dictionary_encode()})
    open(os.path.join(day, "part-g.parquet"), "wb").write(b"junk")
    put(folder, "2023-06-02.parquet", GOOD)
    taken = files.ingest(spark, folder)
    stats = {r.file_path.rsplit("/", 1)[1]: r for r in taken.stats.collect()}
    assert {n: r.records_total for n, r in stats.items() if r.success} == {
        **{f"part-{x}.parquet": 3 for x in "abcde"}, "part f.parquet": 3, "2023-06-02.parquet": 3
    }
    assert stats["part-e.parquet"].records_valid == 2 and not stats["part-g.parquet"].schema_valid
    rows = taken.readings.collect()
    assert len(rows) == 21 and sum(r.timestamp is None for r in rows) == 0
    assert sum(r.timestamp.microsecond == 7 for r in rows) == 9 and sum(r.value is None for r in rows) >= 1
    assert {r.sensor_id for r in rows} >= {"x", "y"}
    plan = taken.readings._jdf.queryExecution().optimizedPlan().toString()
    assert "part-a" not in plan and "part%20f" not in plan
    # A part that comes after the check is not read.
    checked = files.check_window(spark, folder)
    put(day, "part-h.parquet", GOOD)
    assert files.scan_checked(spark, folder, checked).count() == 21
