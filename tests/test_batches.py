"""Tables of batches: publishing, stored types, and what a batch knows of the batches before it."""

import os
import threading

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from loamline import folders
from loamline.config import PipelineConfig
from loamline.operators import history, outliers, quality, series
from loamline.plans import pipeline
from loamline.plans.pipeline import read_table, run_pipeline
from loamline.sinks import parquet as sink
from loamline.sinks.batches import BatchTable, Entry, PublishError
from tests.helpers import READING_DDL, at, close, readings, skewed_rows
from tests.test_pipeline import CFG, DAYS, land


def bag(df):
    return sorted(tuple(map(str, r)) for r in df.collect())


def numbers(spark, n, name="v"):
    return spark.range(n).select(F.col("id").cast("string").alias("date"), F.col("id").cast("double").alias(name))


# --- publishing ---------------------------------------------------------------------


def test_a_failing_write_leaves_the_published_rows(spark, folder):
    path, good = f"{folder}/t", numbers(spark, 5)
    sink.load(good, path, CFG, batch="a")
    broken = good.withColumn("v", F.when(F.col("v") < 3, F.col("v")).otherwise(F.raise_error(F.lit("no")).cast("double")))
    with pytest.raises(Exception):
        sink.load(broken, path, CFG, batch="a")
    assert bag(sink.read_back(spark, path, good.schema)) == bag(good)
    assert len(folders.child_folders(spark, f"{path}/batch=a")) == 1  # nothing is left of the failed one


def test_readers_see_the_old_rows_until_the_new_ones_are_published(spark, folder, monkeypatch):
    path, old = f"{folder}/t", numbers(spark, 5)
    sink.load(old, path, CFG, batch="a")
    during, publish = [], BatchTable.publish

    def late(self, *args, **kw):
        during.append(bag(sink.read_back(spark, path, old.schema)))
        publish(self, *args, **kw, keep_superseded=True)
        during.append(bag(early))

    early = sink.read_back(spark, path, old.schema)  # resolved before the switch, read after it
    monkeypatch.setattr(BatchTable, "publish", late)
    new = numbers(spark, 2)
    sink.load(new, path, CFG, batch="a")
    assert during == [bag(old), bag(old)]
    assert bag(sink.read_back(spark, path, old.schema)) == bag(new)
    assert BatchTable(spark, path).vacuum() == 1 and BatchTable(spark, path).vacuum() == 0
    assert bag(sink.read_back(spark, path, old.schema)) == bag(new)


def test_loads_that_publish_at_once_both_count(spark, folder):
    path = f"{folder}/t"
    names = [f"b{i}" for i in range(6)]
    threads = [threading.Thread(target=lambda n=n: sink.load(numbers(spark, 3), path, CFG, batch=n)) for n in names]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sink.stored_batches(spark, path) == names
    assert sink.read_back(spark, path, numbers(spark, 1).schema).count() == 18


def test_an_unfinished_manifest_is_passed_over(spark, folder):
    path, rows = f"{folder}/t", numbers(spark, 4)
    sink.load(rows, path, CFG, batch="a")
    number = max(int(n[:12]) for n in os.listdir(f"{path}/_manifest") if n.endswith(".json"))
    open(f"{path}/_manifest/{number + 1:012d}.json", "w").write('{"batches": {"a"')
    assert bag(sink.read_back(spark, path, rows.schema)) == bag(rows)
    sink.load(rows, path, CFG, batch="b")
    assert sink.read_back(spark, path, rows.schema).count() == 8
    for _ in range(6):
        sink.load(rows, path, CFG, batch="b")
    assert len([n for n in os.listdir(f"{path}/_manifest") if n.endswith(".json")]) <= 6
    table = BatchTable(spark, path)
    with pytest.raises(PublishError):
        table.publish("c", Entry("v", {}, []), attempts=0)


def test_batches_with_other_types_columns_and_layouts_read_as_one_table(spark, folder):
    path = f"{folder}/t"
    full, holey = numbers(spark, 4), numbers(spark, 4).withColumn("v", F.when(F.col("v") > 1, F.col("v")))
    sink.load(full, path, CFG, batch="a", narrowed=True)
    sink.load(holey, path, CFG, batch="b", narrowed=True)
    sink.load(numbers(spark, 2, "w"), path, CFG, batch="c")
    sink.load(numbers(spark, 3), path, CFG, partition_by=(), batch="d")
    sink.load(numbers(spark, 3).limit(0), path, CFG, batch="e")
    types = {n: e.types["v"] for n, e in BatchTable(spark, path).entries().items() if "v" in e.types}
    assert types["a"] == "float" and types["b"] == "double"
    back = sink.read_back(spark, path, full.schema)
    expected = [("0", 0.0), ("1", 1.0), ("2", 2.0), ("3", 3.0), ("0", None), ("1", None), ("2", 2.0), ("3", 3.0), ("0", None), ("1", None)]
    expected += [("0", 0.0), ("1", 1.0), ("2", 2.0)]
    assert bag(back) == sorted(tuple(map(str, r)) for r in expected)
    assert back.schema["v"].dataType == full.schema["v"].dataType


def test_a_failing_history_publishes_nothing(spark, folder, monkeypatch):
    land(folder, 2)
    out = f"{folder}-out"
    run_pipeline(spark, folder, out, CFG, DAYS[0], DAYS[0], validate_output=False)
    before = BatchTable(spark, out).entries()
    monkeypatch.setattr(pipeline, "_write_history", lambda *_: 1 / 0)
    for day in DAYS[:2]:
        with pytest.raises(ZeroDivisionError):
            run_pipeline(spark, folder, out, CFG, day, day, validate_output=False)
    table = BatchTable(spark, out)
    assert table.entries() == before and table.vacuum() == 0


# --- batches after batches ---------------------------------------------------------------


def columns(df):
    return {(r.sensor_id, r.timestamp, r.reading_type, r.battery_level): r for r in df.collect()}


def test_daily_runs_equal_one_run(spark, folder):
    # Outliers depend on the days seen so far; without them everything must equal one run over the window. Series
    # are cut into slices here; the query over daily loads takes the plain way.
    cfg = CFG.with_(z_score_threshold=1e9, max_series_rows=30, rows_per_slice=7)
    land(folder, 3)
    one, daily = f"{folder}-one", f"{folder}-daily"
    whole = run_pipeline(spark, folder, one, cfg, DAYS[0], DAYS[2], validate_output=False, day_span=True)
    for day in DAYS:
        last = run_pipeline(spark, folder, daily, cfg, day, day, validate_output=False, day_span=True)
        assert last.stale == []
    left, right = columns(read_table(spark, one, whole.output.schema)), columns(read_table(spark, daily, whole.output.schema))
    assert len(left) == 864 and left.keys() == right.keys()
    for key, row in left.items():
        for name, value in row.asDict().items():
            other = right[key][name]
            assert close(value, other, 1e-9) if isinstance(value, float) else value == other, (key, name)


def test_a_batch_alone_starts_anew_and_leaves_nothing(spark, folder):
    land(folder, 2)
    out = f"{folder}-out"
    for day in DAYS[:2]:
        done = run_pipeline(spark, folder, out, CFG, day, day, validate_output=False, after_earlier=False)
    assert done.output.where("value_change IS NULL").count() == 12  # the first of each series
    assert not os.path.exists(f"{out}/_history")
    names = {r.metric for r in done.metrics.collect()}
    assert "duplicates_of_earlier_batches" not in names


def test_changed_predecessors_are_told(spark, folder):
    table = BatchTable(spark, f"{folder}/t")
    entry = lambda v, digest, parent: Entry(v, {}, [], [], digest, parent)
    names = [f"{d}_{d}" for d in DAYS]
    for name, digest, parent in zip(names, "abc", (None, "a", "b")):
        table.publish(name, entry(digest, digest, parent))
    assert table.stale() == [] and table.before(names[2]) == names[:2]
    table.publish(names[0], entry("v2", "x", None))
    assert table.stale() == names[1:2]
    table.publish(names[1], entry("v3", "y", "x"))
    assert table.stale() == names[2:]
    with pytest.raises(ValueError, match="overlaps"):
        table.refuse_overlap(f"{DAYS[0]}_{DAYS[1]}")


def test_copies_over_a_border_are_stored_once(spark, folder):
    land(folder, 3)
    frames = [spark.read.parquet(f"{folder}/{d}.parquet").toPandas() for d in DAYS]
    late = frames[0][frames[0].timestamp >= "2023-06-01T23"]
    other_spelling = late.head(1).assign(timestamp=lambda x: x.timestamp + "Z")
    pd.concat([frames[1], late, other_spelling]).to_parquet(f"{folder}/{DAYS[1]}.parquet", index=False)
    pd.concat([frames[2], frames[0].head(5)]).to_parquet(f"{folder}/{DAYS[2]}.parquet", index=False)
    out = f"{folder}-out"
    counts = []
    for day in DAYS:
        done = run_pipeline(spark, folder, out, CFG, day, day, validate_output=False, copy_days=1)
        m = {r.metric: r.value for r in done.metrics.collect() if r.stage == "transform"}
        counts.append((m["records_final"], m["duplicates_of_earlier_batches"], m["duplicates_removed"]))
    # Two spellings of one instant are two rows; a copy beyond the look-back stays.
    assert counts == [(288, 0, 0), (289, 12, 12), (293, 0, 0)]


def test_stored_rows_are_compared_exactly(spark):
    rows = [("a", at(0), "t", 1.0, 5.0), ("a", at(1), "t", 1.0, None), ("b", at(2), "t", 2.0, 1.0), (None, at(3), "t", 1.0, 1.0)]
    distinct = readings(spark, rows)
    stored = history.keys(readings(spark, [rows[0], rows[1], ("b", at(2), "t", 2.0, 1.5), ("c", at(99), "t", 1.0, 1.0)]))
    assert bag(history.without_stored(distinct, stored)) == bag(readings(spark, rows[2:]))
    nothing = spark.createDataFrame([], READING_DDL)
    assert history.without_stored(nothing, stored).count() == 0
    assert history.without_stored(distinct, history.keys(nothing)).count() == 4


def test_statistics_of_parts_equal_those_of_the_whole(spark, monkeypatch):
    rows = skewed_rows(n=700)
    parts = [readings(spark, rows[i::3]) for i in range(3)]
    older = spark.createDataFrame([], history.SCHEMAS["histograms"])
    values = spark.createDataFrame([], history.SCHEMAS["values"])
    for part in parts:
        moments, older = history.type_moments(part, older, values)
        values = values.unionByName(history.value_counts(part))
    whole = {r.reading_type: r for r in outliers.type_moments(readings(spark, rows)).collect()}
    got = {r.reading_type: r for r in moments.collect()}
    assert got.keys() == whole.keys()
    for kind, r in got.items():
        w = whole[kind]
        assert r.n == w.n and r.median == w.median and close(r.mean, w.mean) and close(r.std, w.std)
    # The bins of many types are not spelled out for the reader; the result is the same.
    monkeypatch.setattr(history, "_SPELLED_TYPES", 0)
    again = {r.reading_type: r.median for r in history.type_moments(parts[2], *_upto(spark, parts[:2]))[0].collect()}
    assert again == {k: r.median for k, r in whole.items()}


def _upto(spark, parts):
    older = spark.createDataFrame([], history.SCHEMAS["histograms"])
    values = spark.createDataFrame([], history.SCHEMAS["values"])
    for part in parts:
        _, older = history.type_moments(part, older, values)
        values = values.unionByName(history.value_counts(part))
    return older, values


@pytest.mark.parametrize("limit", [10**9, 3])
def test_day_spans_continue(spark, limit):
    cfg = PipelineConfig(max_series_rows=limit, rows_per_slice=5)
    rows = skewed_rows(n=500)
    cut = at(9 * 24 * 60 + 17)
    old = readings(spark, [r for r in rows if r[1] < cut])
    new = readings(spark, [r for r in rows if r[1] >= cut])
    spans = series.cut_hours(new, cfg)
    needed = F.lit(False)
    for a, b in spans:
        needed = needed | F.col("timestamp").between(F.lit(a), F.lit(b))
    got = series.rolling_days(new, cfg, history=(history.hour_sums(old), old.where(needed)))
    whole = series.rolling_days(readings(spark, rows), cfg).where(F.col("timestamp") >= F.lit(cut))
    key = lambda r: repr((r.sensor_id, r.timestamp, r.reading_type, r.value, r.battery_level))
    left, right = sorted(got.collect(), key=key), sorted(whole.collect(), key=key)
    assert len(left) == len(right) > 50
    assert all(close(a.rolling_days_avg, b.rolling_days_avg) for a, b in zip(left, right))
    assert series.cut_hours(new.limit(0), cfg) == []


def test_tails_keep_the_last_rows_of_all_batches(spark):
    cfg = PipelineConfig()
    rows = readings(spark, [("a", at(i), "t", float(i), 1.0) for i in range(20)] + [("b", at(0), "t", 1.0, 1.0)])
    made = rows.withColumn("source_value", F.col("value"))
    old = history.tails(made.where(F.col("timestamp") < F.lit(at(10))), None, cfg)
    assert old.count() == 7
    new = history.tails(made.where(F.col("timestamp") >= F.lit(at(16))), old, cfg)
    assert sorted(r.value for r in new.where("sensor_id = 'a'").collect()) == [8.0, 9.0, 16.0, 17.0, 18.0, 19.0]
    assert new.where("sensor_id = 'b'").count() == 1


def test_hour_maps_give_coverage_and_gaps(spark):
    cfg = PipelineConfig()
    df = readings(spark, skewed_rows(n=300))
    hours = quality.active_hours(df, cfg)
    maps = [history.hour_bits(df.where(F.col("timestamp") < F.lit(at(5_000))), cfg), history.hour_bits(df.where(F.col("timestamp") >= F.lit(at(5_000))), cfg)]
    days = history.merged_bits(maps[0].unionByName(maps[1]))
    calendar = history.calendar_of(days)
    assert bag(calendar) == bag(quality.series_calendar(hours))
    assert bag(quality.gap_spans(history.hours_of(days), calendar)) == bag(quality.gap_spans(hours))
    none = history.hour_bits(df.limit(0), cfg)
    assert history.calendar_of(history.merged_bits(none)).count() == 0


def test_a_batch_without_rows_passes_the_history_on(spark, folder):
    land(folder, 3)
    middle = pq.read_table(f"{folder}/{DAYS[1]}.parquet").slice(0, 1)
    nobody = middle.set_column(0, "sensor_id", pa.array([None], pa.string()))
    pq.write_table(nobody, f"{folder}/{DAYS[1]}.parquet")
    out = f"{folder}-out"
    for day in DAYS:
        done = run_pipeline(spark, folder, out, CFG, day, day, validate_output=False, day_span=True)
    assert done.output.count() == 288 and done.output.where("value_change IS NULL").count() == 0
