"""The whole batch run on generated days."""

import os
import random
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from loamline import staging
from loamline.config import PipelineConfig
from loamline.plans import pipeline
from loamline.plans.pipeline import IngestError, run_pipeline
from loamline.sinks import parquet as sink

DAYS = ("2023-06-01", "2023-06-02", "2023-06-03")
CFG = PipelineConfig(partition_by=("date",))


def land(folder, days=3):
    rng = random.Random(1)
    for day in range(1, days + 1):
        rows = []
        for hour in range(24):
            for sensor in ("sensor_001", "sensor_002", "sensor_003"):
                for kind in ("temperature", "humidity", "soil_moisture", "light_intensity"):
                    value = round(rng.gauss(50, 10), 2) if rng.random() > 0.05 else 5000.0
                    stamp = f"2023-06-{day:02d}T{hour:02d}:{rng.randrange(60):02d}:00"
                    rows.append((sensor, stamp, kind, value, round(95 - hour * 0.1, 2)))
        names = ("sensor_id", "timestamp", "reading_type", "value", "battery_level")
        table = pa.table({n: [r[i] for r in rows] for i, n in enumerate(names)})
        pq.write_table(table, f"{folder}/2023-06-{day:02d}.parquet")


def test_full_run(spark, folder):
    raw = f"{folder}/raw"
    os.makedirs(raw)
    land(raw)
    open(f"{raw}/2023-06-09.parquet", "wb").write(b"junk")
    done = run_pipeline(spark, raw, f"{folder}/out", CFG, report_path=f"{folder}/report.json")
    m = {(r.stage, r.metric): r.value for r in done.metrics.collect()}
    assert m["ingest", "total_files"] == 4 and m["ingest", "failed_files"] == 1
    assert m["transform", "original_records"] == 864 and m["load", "records_loaded"] == 864
    assert m["transform", "outliers_detected"] > 0
    assert m["validate", "total_records"] == 864 and 0 <= m["validate", "quality_score"] <= 100
    assert m["load", "partition_count"] == 4  # three UTC days are four local ones
    assert done.output.count() == 864 and done.quality_error is None
    assert done.ingest.quarantined.count() == 1
    lines = spark.read.option("header", "true").csv(done.report_paths[1]).collect()
    assert {"Overall Quality Score", "Total Missing Hours"} <= {r.metric for r in lines}
    assert done.release() > 5 and done.output.count() == 864


def test_date_window(spark, folder):
    land(folder)
    done = run_pipeline(
        spark, folder, f"{folder}-out", CFG, "2023-06-02", "2023-06-02", validate_output=False
    )
    assert done.output.count() == 288 and done.quality is None
    assert not any(r.stage == "validate" for r in done.metrics.collect())


def test_a_second_batch_keeps_the_first(spark, folder):
    land(folder, 9)
    out = f"{folder}-out"
    run = lambda a, b: run_pipeline(spark, folder, out, CFG, a, b)
    run("2023-06-01", "2023-06-03")
    later = run("2023-06-07", "2023-06-08")
    m = {(r.stage, r.metric): r.value for r in later.metrics.collect()}
    assert m["load", "records_loaded"] == m["validate", "total_records"] == 576
    assert m["load", "partition_count"] == 3
    whole = spark.read.parquet(out)
    assert whole.count() == 864 + 576
    # Loading a batch again replaces it.
    assert run("2023-06-07", "2023-06-08").output.count() == 576
    assert spark.read.parquet(out).count() == 864 + 576
    with pytest.raises(ValueError, match="overlaps"):
        run("2023-06-08", "2023-06-09")


def test_adjacent_daily_runs_keep_every_row(spark, folder):
    land(folder, 3)
    out = f"{folder}-out"
    runs = [run_pipeline(spark, folder, out, start=d, end=d, validate_output=False) for d in DAYS]
    assert [r.output.count() for r in runs] == [288, 288, 288]
    schema = runs[0].transformed.frame.schema
    rows = sorted(sink.read_back(spark, out, schema).drop("daily_avg_value").collect())
    assert len(rows) == 864
    again = run_pipeline(spark, folder, out, start=DAYS[1], end=DAYS[1], validate_output=False)
    assert sorted(sink.read_back(spark, out, schema).drop("daily_avg_value").collect()) == rows
    m = {(r.stage, r.metric): r for r in again.metrics.collect()}
    assert m["load", "records_loaded"].value == 288
    assert m["load", "completed"].status == "success" and m["load", "completed"].error is None


def test_concurrent_runs_do_not_share_tables(spark, folder):
    land(folder, 2)
    with ThreadPoolExecutor(2) as pool:
        go = lambda d: run_pipeline(spark, folder, f"{folder}-{d}", CFG, d, d, validate_output=False)
        one, two = pool.map(go, DAYS[:2])
    assert not set(one.staged.paths) & set(two.staged.paths)
    one.release()
    assert two.transformed.distinct.count() == 288
    two.release()


def test_a_failing_run_leaves_no_table(spark, folder, monkeypatch):
    land(folder, 1)
    paths = []
    make = staging.new_path
    monkeypatch.setattr(staging, "new_path", lambda *a: paths.append(make(*a)) or paths[-1])
    monkeypatch.setattr(pipeline, "transform", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        run_pipeline(spark, folder, f"{folder}-out", CFG)
    assert paths and not any(os.path.exists(p.removeprefix("file:")) for p in paths)


def test_no_valid_row_at_all(spark, folder):
    table = pa.table(
        {
            "sensor_id": pa.array([None, None], pa.string()),
            "timestamp": ["2023-06-01T10:00:00", "2023-06-01T11:00:00"],
            "reading_type": ["t", "t"],
            "value": [1.0, 2.0],
            "battery_level": [1.0, 2.0],
        }
    )
    pq.write_table(table, f"{folder}/2023-06-01.parquet")
    done = run_pipeline(spark, folder, f"{folder}-out", CFG)
    assert done.output.count() == 0 and "no data" in done.quality_error
    m = {(r.stage, r.metric): r.value for r in done.metrics.collect()}
    assert m["load", "records_loaded"] == 0 and m["transform", "original_records"] == 2


def test_nothing_to_read_aborts(spark, folder):
    with pytest.raises(IngestError):
        run_pipeline(spark, f"{folder}/none", f"{folder}/out", CFG)


def test_failed_validation_does_not_abort(spark, folder, monkeypatch):
    land(folder, 1)

    def broken(*_):
        raise RuntimeError("no")

    monkeypatch.setattr(pipeline, "validate", broken)
    done = run_pipeline(spark, folder, f"{folder}-out", CFG)
    assert done.quality_error == "RuntimeError: no" and done.output.count() == 288
    (r,) = [r for r in done.metrics.collect() if r.stage == "validate"]
    assert (r.metric, r.value, r.status, r.error) == ("completed", 0.0, "failed", "RuntimeError: no")
