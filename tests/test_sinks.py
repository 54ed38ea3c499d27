"""Round trips, layouts, statistics about written tables, narrowing."""

import os

import pytest
from pyspark.sql import functions as F

from loamline.config import PipelineConfig
from loamline.operators import cleaning
from loamline.sinks import parquet as sink
from tests.helpers import readings, skewed_rows

CFG = PipelineConfig()


def dated(spark, n=200):
    return cleaning.local_fields(readings(spark, skewed_rows(n=n)), CFG)


def bag(df):
    return sorted(tuple(map(str, r)) for r in df.collect())


@pytest.mark.parametrize("keys", [("date",), ("date", "sensor_id"), (), ("absent",)])
@pytest.mark.parametrize("codec", ["snappy", "gzip"])
def test_round_trip(spark, folder, keys, codec):
    df, path = dated(spark), f"{folder}/out"
    sink.load(df, path, CFG, keys, codec)
    assert bag(sink.read_back(spark, path, df.schema)) == bag(df)
    inside = os.listdir(path)
    assert any(x.startswith("date=") for x in inside) == ("date" in keys)


def test_partition_values_keep_their_type_and_nulls_are_kept(spark, folder):
    df = spark.createDataFrame([("001", 1.0), ("1", 2.0), (None, 3.0), ("a/b", 4.0)], "k string, v double")
    sink.write_partitioned(df, f"{folder}/out", ("k",))
    back = sink.read_back(spark, f"{folder}/out", df.schema)
    assert bag(back) == bag(df)
    assert "k=__HIVE_DEFAULT_PARTITION__" in os.listdir(f"{folder}/out")


def test_manifest(spark):
    df = spark.createDataFrame([("d1", "a/b"), ("d1", "a/b"), ("d2", "x\\y")], "date string, s string")
    out = {r.path: r.rows for r in sink.partition_manifest(df, "/base", ["date", "s"]).collect()}
    assert out == {"/base/date=d1/s=a_b": 2, "/base/date=d2/s=x_y": 1}


def test_load_stats_and_storage_summary(spark, folder):
    df, path = dated(spark), f"{folder}/out"
    sink.load(df, path, CFG, ("date",))
    rows = df.agg(F.count(F.lit(1)).alias("records_loaded"))
    (s,) = sink.load_stats(spark, path, len(df.columns), rows).collect()
    found = [
        os.path.join(r, f) for r, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")
    ]
    size = sum(map(os.path.getsize, found))
    assert (s.records_loaded, s.partition_count) == (200, df.select("date").distinct().count())
    assert s.file_size_mb == size / 1024**2
    assert abs(s.compression_ratio - (1 - size / (200 * len(df.columns) * 8)) * 100) < 1e-9
    (t,) = sink.storage_summary(spark, path).collect()
    assert (t.total_files, t.total_records, t.total_size_mb) == (len(found), 200, size / 1024**2)
    assert t.last_modified is not None
    info = {(r.column, r.value) for r in sink.partition_info(spark, path).collect()}
    assert info == {("date", r.date) for r in df.select("date").distinct().collect()}


def test_batches(spark, folder):
    df = dated(spark)
    done = sink.load_batches([df, df.limit(10)], f"{folder}/batch", CFG, partition_by=("date",))
    assert [os.path.basename(b.path) for b in done] == ["batch_part_000.parquet", "batch_part_001.parquet"]
    (t,) = sink.batch_totals(spark, done).collect()
    assert (t.total_files, t.total_records, t.successful_batches, t.failed_batches) == (2, 210, 2, 0)
    assert t.total_size_mb > 0 and t.average_compression_ratio >= 0


def test_totals_take_the_same_jobs_whatever_the_loads(spark, folder):
    df = dated(spark, 60)
    frames = [df, df.limit(7), df.limit(0), df.limit(3)] + [df.limit(1)] * 8
    done = sink.load_batches(frames, f"{folder}/batch", CFG, partition_by=("date",))
    count = spark.sparkContext._jsc.sc().dagScheduler().numTotalJobs
    took = []
    for some in (done[:2], done):
        before = count()
        (t,) = sink.batch_totals(spark, some).collect()
        took.append(count() - before)
    assert took[0] == took[1] and t.total_files == 12 and t.total_records == 60 + 7 + 3 + 8
    one = sink.load_stats(spark, done[0].path, len(df.columns), df.agg(F.count(F.lit(1)).alias("records_loaded")))
    (alone,) = sink.batch_totals(spark, done[:1]).collect()
    (s,) = one.collect()
    assert alone.total_size_mb == s.file_size_mb
    assert alone.average_compression_ratio == max(0.0, s.compression_ratio)


def test_a_failing_frame_leaves_the_others(spark, folder):
    df = dated(spark)
    broken = df.withColumn("value", F.raise_error(F.lit("no such value")).cast("double"))
    done = sink.load_batches([df, broken, df.limit(5)], f"{folder}/batch", CFG, partition_by=())
    assert [b.success for b in done] == [True, False, True]
    (t,) = sink.batch_totals(spark, done).collect()
    assert (t.total_records, t.successful_batches, t.failed_batches) == (205, 2, 1)
    (e,) = sink.batch_errors(spark, done).collect()
    assert e.output_path.endswith("_part_001.parquet") and e.error
    (none,) = sink.batch_totals(spark, [done[1]]).collect()
    assert (none.total_files, none.failed_batches) == (0, 1)
    assert sink.load_batches([], f"{folder}/none", CFG) == []


def test_batches_of_a_table_replace_themselves_only(spark, folder):
    df = dated(spark)
    path = f"{folder}/table"
    for batch, rows in (("a", df), ("b", df.limit(10)), ("a", df.limit(7))):
        sink.load(rows, path, CFG, partition_by=("date",), batch=batch)
    assert sink.stored_batches(spark, path) == ["a", "b"]
    assert sink.read_back(spark, path, df.schema).count() == 17
    assert sink.stored_batches(spark, f"{folder}/absent") == []


def test_narrowed_load_keeps_types_and_rows(spark, folder):
    df = dated(spark).withColumn("n", F.lit(7).cast("bigint"))
    path = sink.load(df, f"{folder}/slim", CFG, partition_by=("date",), narrowed=True)
    assert dict(spark.read.parquet(path).dtypes)["n"] == "smallint"
    back = sink.read_back(spark, path, df.schema, narrowed=True)
    assert back.schema["n"].dataType == df.schema["n"].dataType and back.count() == 200


def test_narrow_plan(spark):
    df = spark.createDataFrame(
        [(i, i * 10**6, i * 10**12, float(i), None if i == 3 else 1.0, f"u{i}", "same") for i in range(50)],
        "small bigint, mid bigint, big bigint, d double, holey double, uniq string, rep string",
    )
    plan = {r.column: r.to_type for r in sink.narrow_plan(df).collect()}
    assert plan == {"small": "smallint", "mid": "int", "d": "float", "rep": "dictionary"}
    slim = sink.narrow(df, sink.narrow_plan(df))
    assert dict(slim.dtypes)["mid"] == "int" and slim.count() == 50


def test_narrow_plan_decides_the_half_exactly(spark):
    # 51 of 100 distinct is no dictionary, 49 is; both are within the sketch's error.
    for distinct, expected in ((51, set()), (50, set()), (49, {"s"})):
        df = spark.createDataFrame([(f"v{min(i, distinct - 1)}",) for i in range(100)], "s string")
        assert {r.column for r in sink.narrow_plan(df).collect()} == expected


def test_hot_partition_is_split(spark, folder):
    """A partition far above the advisory size is written by several tasks."""
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "32KB")
    try:
        df = spark.range(0, 60000, 1, 8).selectExpr("'one' k", "id", "rand(1) x")
        sink.write_partitioned(df, f"{folder}/out", ("k",))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    parts = [f for f in os.listdir(f"{folder}/out/k=one") if f.endswith(".parquet")]
    assert len(parts) > 1
    assert spark.read.parquet(f"{folder}/out").count() == 60000
