"""Run-history operators and scalar helpers on hand-made rows."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from loamline import functions as fx
from loamline.operators import runs as op

NOW = datetime(2024, 5, 15, 12)  # a Wednesday
RUN_DDL = (
    "id bigint, job_id bigint, start_time timestamp_ntz, end_time timestamp_ntz, status string, "
    "execution_time_seconds double"
)
JOB_DDL = (
    "id bigint, name string, job_type string, status string, next_run_timestamp timestamp_ntz, "
    "description string, configuration_parameters string, updated_at timestamp_ntz"
)


@pytest.fixture(scope="module")
def runs(spark):
    day = lambda d, h=0: datetime(2024, 5, d, h)
    rows = [
        (1, 1, day(1), day(1, 1), "success", 3600.0),
        (2, 1, day(15, 6), None, "running", None),
        (3, 2, day(10), day(10, 2), "failed", 7200.0),
        (4, 2, day(10), day(10, 1), "success", 100.0),
        (5, 2, datetime(2024, 1, 1), datetime(2024, 1, 1), "success", None),
    ] + [(100 + i, 3, day(1 + i), None, "queued", None) for i in range(12)]
    return spark.createDataFrame(rows, RUN_DDL)


@pytest.fixture(scope="module")
def jobs(spark):
    rows = [
        (1, "Alpha", "data_pipeline", "active", datetime(2024, 5, 15, 12), "Loads SOIL data", "{}", NOW),
        (2, "beta", "data_pipeline", "active", None, None, '{"raw_data_path": null}', NOW),
        (3, "Gamma", "email_notification", "paused", datetime(2024, 1, 1), "", None, NOW),
        (4, "Delta", "data_pipeline", "active", datetime(2024, 5, 15, 11), "x", None, NOW),
        (5, "never", "system_maintenance", "inactive", None, "x", "not json", NOW),
    ]
    return spark.createDataFrame(rows, JOB_DDL)


def ids(df):
    return [r.id for r in df.collect()]


def now():
    return F.lit(NOW).cast("timestamp_ntz")


def test_filters(runs):
    assert sorted(ids(op.filter_runs(runs, job_id=2, status="success"))) == [4, 5]
    assert sorted(ids(op.filter_runs(runs, job_id=1, start=datetime(2024, 5, 1), end=datetime(2024, 5, 1)))) == [1]
    assert op.filter_runs(runs).count() == runs.count()


def test_search(jobs):
    assert sorted(ids(op.search_jobs(jobs, "soil"))) == [1]
    assert sorted(ids(op.search_jobs(jobs, "ETA"))) == [2]
    assert ids(op.search_jobs(jobs, "%")) == []


def test_due(jobs):
    assert ids(op.due_jobs(jobs, now())) == [4, 1]
    assert ids(op.due_jobs(jobs, now(), 1)) == [4]


def test_config_violations(jobs):
    assert sorted(ids(op.config_violations(jobs))) == [1, 4]


def test_last_status_and_history(jobs, runs):
    status = {r.id: r.last_run_status for r in op.last_run_status(jobs, runs).collect()}
    assert status == {1: "running", 2: "success", 3: "queued", 4: "never_run", 5: "never_run"}
    history = {r.id: [h.run_id for h in r.run_history] for r in op.job_history(jobs, runs).collect()}
    assert history[1] == [2, 1] and history[2] == [4, 3, 5] and history[4] == []
    assert history[3] == [111 - i for i in range(10)]


def test_history_limits_before_the_shuffle(runs):
    plan = op.recent_runs_per_job(runs)._jdf.queryExecution().sparkPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_names(spark):
    existing = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b")], "id bigint, name string")
    asked = spark.createDataFrame([(1, "a"), (9, "a"), (2, "b"), (None, "a"), (7, "z")], "id bigint, name string")
    taken = {(r.id, r.name) for r in op.names_taken(asked, existing).collect()}
    assert taken == {(9, "a"), (2, "b"), (None, "a")}
    assert [(r.name, r.holders) for r in op.duplicate_names(existing).collect()] == [("b", 2)]


def test_statistics(jobs, runs):
    (c,) = op.job_counts(jobs, now()).collect()
    assert tuple(c) == (5, 3, 1, 2)
    (s,) = op.run_stats(runs, NOW).collect()
    assert (s.total_runs, s.successful_runs, s.failed_runs, s.running_jobs, s.queued_jobs) == (17, 3, 1, 1, 12)
    assert (s.runs_last_24h, s.success_rate, s.average_execution_time) == (1, 17.65, 1850.0)
    (d,) = op.dashboard(jobs, runs, NOW).collect()
    assert d.jobs_by_type == {"data_pipeline": 3, "email_notification": 1, "system_maintenance": 1}
    assert (d.jobs_due, d.runs_total) == (2, 17)


def test_statistics_of_nothing(jobs, runs):
    (s,) = op.run_stats(runs.limit(0), NOW).collect()
    assert (s.total_runs, s.success_rate, s.average_execution_time) == (0, 0.0, 0.0)
    (d,) = op.dashboard(jobs.limit(0), runs.limit(0), NOW).collect()
    assert (d.jobs_total, d.runs_total) == (0, 0)


def test_pages(runs):
    newest = ids(op.newest_runs(runs, 5))
    first, second = op.page_of_runs(runs, None, 1, 3), op.page_of_runs(runs, None, 2, 3)
    assert ids(first.rows) == newest[:3] and ids(second.rows)[:2] == newest[3:]
    assert first.total.first().total == 17
    last = first.rows.collect()[-1]
    assert ids(op.runs_after(runs, None, last.start_time, last.id, 3)) == ids(second.rows)
    assert op.page_of_runs(runs, 1).total.first().total == 2


def test_recent_activity(jobs, runs):
    a = op.recent_activity(jobs, runs, NOW)
    top = a.recent_runs.collect()
    assert top[0].id == 2 and top[0].job_name == "Alpha" and top[0].duration is None
    assert [r.duration for r in top if r.id == 3] == [7200.0]
    assert ids(a.recent_jobs) == [5, 4, 3, 2, 1] and ids(a.due_jobs) == [4, 1]


def test_retention(runs):
    split = op.retention(runs, NOW)
    assert ids(split.expired) == [5] and split.deleted_count.first().deleted_count == 1
    assert split.keep.count() == 16


def test_deep_pages_equal_shallow_ones(spark):
    rows = [(i, i % 3, None if i % 10 == 7 else NOW - timedelta(hours=11 * (i % 23))) for i in range(90)]
    runs = spark.createDataFrame(rows, "id bigint, job_id bigint, start_time timestamp_ntz")
    for page in (1, 2, 5, 9, 10, 13, 20):
        plain = op.page_of_runs(runs, None, page, 7)
        deep = op.page_of_runs(runs, None, page, 7, deep=-1)
        assert plain.rows.collect() == deep.rows.collect() and deep.total.first().total == 90


def test_log_stats(spark):
    logs = [
        'x\n{"records_processed": 5, "records_failed": 1}\n',
        '{"records_processed": 1}\n{"records_processed": 2}',
        '{"records_processed": 1}\n{bad}',
        "nothing",
        None,
        ' \n{"other": 1}\n  ',
        '{"records_processed": 7, "records_failed": 1} extra }',
        '{"records_processed": 7}{"records_failed": 1}',
        '{"records_processed": 7},{"records_failed": 1}',
        '{"records_processed": "x", "records_failed": 3}',
        '{"records_processed": 1.5}',
        '{"records_processed": "4"}',
        '{"records_processed": 3, "records_failed": 0}\n{open\nclosed}\n}',
    ]
    df = spark.createDataFrame([(s,) for s in logs], "stdout string")
    out = [(r.records_processed, r.records_failed) for r in op.log_stats(df).collect()]
    assert out == [(5, 1), (2, None), (None, None), (None, None), (None, None), (None, None)] + [
        (None, None)
    ] * 6 + [(3, 0)]


# --- scalars ---------------------------------------------------------------------------


def one(spark, column):
    return spark.range(1).select(column).first()[0]


def test_format_duration(spark):
    cases = {0.0: "0.0s", 59.94: "59.9s", 60.0: "1.0m", 3599.0: "60.0m", 3600.0: "1.0h", 5400.0: "1.5h", 0.25: "0.2s"}
    for seconds, expected in cases.items():
        assert one(spark, fx.format_duration(F.lit(seconds))) == expected


def test_divisions(spark):
    assert one(spark, fx.safe_divide(F.lit(1.0), F.lit(0.0), 7.0)) == 7.0
    assert one(spark, fx.safe_divide(F.lit(None).cast("double"), F.lit(2.0))) == 0.0
    assert one(spark, fx.z_score(F.lit(5.0), F.lit(1.0), F.lit(0.0))) == 0.0
    assert one(spark, fx.z_score(F.lit(-5.0), F.lit(1.0), F.lit(2.0))) == 3.0
    assert one(spark, fx.percent_text(F.lit(12.345))) == "12.34%"


@pytest.mark.parametrize(
    "schedule,as_of,expected",
    [
        ("daily", datetime(2024, 5, 15, 1, 59), datetime(2024, 5, 15, 2)),
        ("DAILY", datetime(2024, 5, 15, 2), datetime(2024, 5, 16, 2)),
        ("hourly", datetime(2024, 5, 15, 12), datetime(2024, 5, 15, 13)),
        ("Hourly", datetime(2024, 5, 15, 23, 59, 59), datetime(2024, 5, 16)),
        ("weekly", datetime(2024, 5, 15, 12), datetime(2024, 5, 20, 2)),
        ("weekly", datetime(2024, 5, 13, 0), datetime(2024, 5, 20, 2)),
        ("weekly", datetime(2024, 5, 19, 23), datetime(2024, 5, 20, 2)),
        ("0 3 * * *", datetime(2024, 5, 15), None),
    ],
)
def test_next_run(spark, schedule, as_of, expected):
    assert one(spark, fx.next_run(F.lit(schedule), F.lit(as_of).cast("timestamp_ntz"))) == expected


def test_map_merge(spark):
    out = one(spark, fx.map_merge(F.expr("map('a', '1', 'b', '2')"), F.expr("map('b', null, 'c', '3')")))
    assert out == {"a": "1", "b": None, "c": "3"}


def test_iso_text(spark):
    t = F.expr("TIMESTAMP '2023-06-01 10:00:00Z'")
    assert one(spark, fx.iso_in_zone(t, "Asia/Kolkata")) == "2023-06-01T15:30:00+05:30"
    assert one(spark, fx.iso_in_zone(t, "America/New_York")) == "2023-06-01T06:00:00-04:00"
    assert one(spark, fx.iso_in_zone(F.expr("TIMESTAMP '2023-06-01 10:00:00.5Z'"), "UTC")).endswith("10:00:00.500000+00:00")


def test_hours_before_the_epoch(spark):
    wall = F.expr("TIMESTAMP_NTZ '1969-12-31 23:30:00'")
    assert one(spark, fx.hour_index(wall)) == -1
    assert one(spark, fx.day_of_hour(fx.hour_index(wall))) == -1
    assert one(spark, fx.hour_start(fx.hour_index(wall))) == datetime(1969, 12, 31, 23)
