"""Registered queries: jobs and run history."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from loamline import functions as fx
from loamline.catalog import bridge as b
from loamline.catalog.queries_readings import sql_text, text
from loamline.operators import runs as op

QUERIES = {}
SQL = {}
_AS_OF = "TIMESTAMP '2001-08-01 00:00:00'"


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql.strip()
        return fn

    return register


def _now():
    return F.expr("TIMESTAMP_NTZ '2001-08-01 00:00:00'")


# --- filters -----------------------------------------------------------------------


@query(
    "prj_run_filter",
    f"""WITH {b.RUNS_SQL}
SELECT id, job_id, {sql_text('start_time', 'start_time')}, status FROM job_runs
WHERE status = 'success' AND start_time >= TIMESTAMP '1997-01-01' AND start_time <= TIMESTAMP '1998-12-31'""",
)
def _(spark, d):
    out = op.filter_runs(
        b.job_runs(spark, d, counts=False), status="success",
        start=datetime(1997, 1, 1), end=datetime(1998, 12, 31),
    )
    return out.select("id", "job_id", text("start_time"), "status")


@query(
    "prj_job_search",
    f"""WITH {b.JOBS_SQL}
SELECT id, name, description FROM jobs
WHERE contains(lower(name), 'achin') OR contains(lower(description), 'achin')""",
)
def _(spark, d):
    return op.search_jobs(b.jobs(spark, d), "ACHIN").select("id", "name", "description")


@query(
    "prj_due_jobs",
    f"""WITH {b.JOBS_SQL}
SELECT id, name, {sql_text('next_run_timestamp', 'next_run_timestamp')} FROM jobs
WHERE status = 'active' AND jobs.next_run_timestamp <= {_AS_OF}
ORDER BY jobs.next_run_timestamp, id""",
)
def _(spark, d):
    return op.due_jobs(b.jobs(spark, d), _now()).select("id", "name", text("next_run_timestamp"))


@query(
    "prj_config_violations",
    f"""WITH {b.JOBS_SQL}
SELECT id, name, 'raw_data_path' AS missing_field FROM jobs
WHERE job_type = 'data_pipeline' AND NOT contains(configuration_parameters, 'raw_data_path')""",
)
def _(spark, d):
    return op.config_violations(b.jobs(spark, d))


# --- joins ---------------------------------------------------------------------------


@query(
    "join_run_job",
    f"""WITH {b.JOBS_SQL}, {b.RUNS_SQL}
SELECT r.id, r.job_id, j.name AS job_name, j.owner AS job_owner, r.status
FROM job_runs r JOIN jobs j ON r.job_id = j.id""",
)
def _(spark, d):
    joined = op.runs_with_job(b.job_runs(spark, d, counts=False), b.jobs(spark, d), "name", "owner")
    return joined.select("id", "job_id", "job_name", "job_owner", "status")


_NEWEST = """newest AS (
  SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY start_time DESC, id DESC) AS rn
  FROM job_runs)"""


@query(
    "join_job_history",
    f"""WITH {b.JOBS_SQL}, {b.RUNS_SQL}, {_NEWEST}
SELECT j.id, j.name, coalesce(string_agg(n.id || ':' || n.status, ',' ORDER BY rn), '') AS history
FROM jobs j LEFT JOIN newest n ON n.job_id = j.id AND rn <= 10 GROUP BY 1, 2""",
)
def _(spark, d):
    history = op.job_history(b.jobs(spark, d), b.job_runs(spark, d, counts=False))
    entry = lambda r: F.concat(r["run_id"].cast("string"), F.lit(":"), r["status"])
    return history.select(
        "id", "name", F.array_join(F.transform("run_history", entry), ",").alias("history")
    )


@query(
    "join_name_taken",
    f"""WITH {b.JOBS_SQL}, candidates AS (
  SELECT CASE WHEN id % 2 = 0 THEN id ELSE id + 1000000 END AS id, name FROM jobs)
SELECT id, name FROM candidates c
WHERE EXISTS (SELECT 1 FROM jobs j WHERE j.name = c.name AND j.id <> c.id)""",
)
def _(spark, d):
    jobs = b.jobs(spark, d)
    # Even ids keep their own row; odd ones ask for a name somebody else has.
    asked = F.when(F.col("id") % 2 == 0, F.col("id")).otherwise(F.col("id") + 1_000_000)
    return op.names_taken(jobs.select(asked.alias("id"), "name"), jobs)


@query(
    "join_name_duplicates",
    f"""WITH {b.JOBS_SQL} SELECT owner AS name, count(*) AS holders FROM jobs
GROUP BY 1 HAVING count(*) > 1""",
)
def _(spark, d):
    # Owners stand in for names here: job names are unique in the given tables.
    return op.duplicate_names(b.jobs(spark, d).select("id", F.col("owner").alias("name")))


# --- windows, order, pages ---------------------------------------------------------------


@query(
    "win_last_run_status",
    f"""WITH {b.JOBS_SQL}, {b.RUNS_SQL}, {_NEWEST}
SELECT j.id, j.name, coalesce(n.status, 'never_run') AS last_run_status
FROM jobs j LEFT JOIN newest n ON n.job_id = j.id AND rn = 1""",
)
def _(spark, d):
    return op.last_run_status(b.jobs(spark, d), b.job_runs(spark, d, counts=False))


@query(
    "win_run_history",
    f"""WITH {b.RUNS_SQL}, {_NEWEST}
SELECT id, job_id, {sql_text('start_time', 'start_time')}, status, rn FROM newest WHERE rn <= 10""",
)
def _(spark, d):
    out = op.recent_runs_per_job(b.job_runs(spark, d, counts=False))
    return out.select("id", "job_id", text("start_time"), "status", F.col("rn").cast("bigint").alias("rn"))


@query(
    "srt_recent_runs",
    f"""WITH {b.RUNS_SQL}
SELECT id, job_id, {sql_text('start_time', 'start_time')}, status FROM job_runs
ORDER BY job_runs.start_time DESC, id DESC LIMIT 20""",
)
def _(spark, d):
    out = op.newest_runs(b.job_runs(spark, d, counts=False))
    return out.select("id", "job_id", text("start_time"), "status")


@query(
    "srt_page",
    f"""WITH {b.RUNS_SQL}
SELECT id, {sql_text('start_time', 'start_time')}, (SELECT count(*) FROM job_runs) AS total
FROM job_runs ORDER BY job_runs.start_time DESC, id DESC LIMIT 20 OFFSET 40""",
)
def _(spark, d):
    page = op.page_of_runs(b.job_runs(spark, d, counts=False), None, page=3, size=20)
    # One total beside at most 20 rows.
    rows = page.rows.select("id", text("start_time"), F.lit(1).alias("k"))
    return rows.join(page.total.withColumn("k", F.lit(1)), "k").drop("k")


@query(
    "srt_page_after",
    f"""WITH {b.RUNS_SQL}
SELECT id, {sql_text('start_time', 'start_time')} FROM job_runs
WHERE job_runs.start_time < TIMESTAMP '1999-06-15'
  OR (job_runs.start_time = TIMESTAMP '1999-06-15' AND id < 5000)
ORDER BY job_runs.start_time DESC, id DESC LIMIT 20""",
)
def _(spark, d):
    out = op.runs_after(b.job_runs(spark, d, counts=False), None, datetime(1999, 6, 15), 5000)
    return out.select("id", text("start_time"))


# --- statistics --------------------------------------------------------------------------


@query("agg_jobs_by_type", f"WITH {b.JOBS_SQL} SELECT job_type, count(*) AS jobs FROM jobs GROUP BY 1")
def _(spark, d):
    return op.jobs_by_type(b.jobs(spark, d))


_JOB_COUNTS = f"""count(*) AS total_jobs, count(*) FILTER (status = 'active') AS active_jobs,
  count(*) FILTER (status = 'inactive') AS inactive_jobs,
  count(*) FILTER (status = 'active' AND next_run_timestamp <= {_AS_OF}) AS due_jobs"""
_RUN_STATS = f"""SELECT count(*) AS total_runs, count(*) FILTER (status = 'success') AS successful_runs,
  count(*) FILTER (status = 'failed') AS failed_runs, count(*) FILTER (status = 'running') AS running_jobs,
  count(*) FILTER (status = 'queued') AS queued_jobs,
  count(*) FILTER (start_time >= {_AS_OF} - INTERVAL 24 HOUR) AS runs_last_24h,
  count(*) FILTER (start_time >= {_AS_OF} - INTERVAL 7 DAY) AS runs_last_7d,
  round(count(*) FILTER (status = 'success') * 100.0 / count(*), 2) AS success_rate,
  round(coalesce(avg(execution_time_seconds) FILTER (status = 'success'), 0.0), 2)
    AS average_execution_time
FROM job_runs"""


@query("agg_job_counts", f"WITH {b.JOBS_SQL} SELECT {_JOB_COUNTS} FROM jobs")
def _(spark, d):
    return op.job_counts(b.jobs(spark, d), _now())


@query(
    "agg_run_counts",
    f"""WITH {b.RUNS_SQL}, s AS ({_RUN_STATS})
SELECT total_runs, successful_runs, failed_runs, running_jobs, queued_jobs, runs_last_24h, runs_last_7d
FROM s""",
)
def _(spark, d):
    stats = op.run_stats(b.job_runs(spark, d, counts=False), b.RUNS_AS_OF)
    return stats.drop("success_rate", "average_execution_time")


@query(
    "agg_run_rates",
    f"WITH {b.RUNS_SQL}, s AS ({_RUN_STATS}) SELECT success_rate, average_execution_time FROM s",
)
def _(spark, d):
    stats = op.run_stats(b.job_runs(spark, d, counts=False), b.RUNS_AS_OF)
    return stats.select("success_rate", "average_execution_time")


@query(
    "run_dashboard",
    f"""WITH {b.JOBS_SQL}, {b.RUNS_SQL}, j AS (SELECT {_JOB_COUNTS} FROM jobs), s AS ({_RUN_STATS}),
t AS (SELECT string_agg(job_type || '=' || n, ',' ORDER BY job_type) AS by_type
      FROM (SELECT job_type, count(*) AS n FROM jobs GROUP BY 1))
SELECT total_jobs AS jobs_total, active_jobs AS jobs_active, due_jobs AS jobs_due,
  by_type AS jobs_by_type, total_runs AS runs_total, successful_runs AS runs_successful,
  failed_runs AS runs_failed, running_jobs AS runs_running, success_rate AS runs_success_rate,
  runs_last_24h AS runs_recent_24h, average_execution_time AS runs_avg_execution_time
FROM j, s, t""",
)
def _(spark, d):
    board = op.dashboard(b.jobs(spark, d), b.job_runs(spark, d, counts=False), b.RUNS_AS_OF)
    pair = lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))
    flat = F.array_join(F.transform(F.map_entries("jobs_by_type"), pair), ",")
    return board.withColumn("jobs_by_type", flat)


@query(
    "run_recent_activity",
    f"""WITH {b.JOBS_SQL}, {b.RUNS_SQL},
r AS (SELECT r.id, j.name, start_time AS t, r.status,
        datediff('microsecond', start_time, end_time) / 1000000.0::DOUBLE AS duration
      FROM job_runs r JOIN jobs j ON j.id = r.job_id ORDER BY start_time DESC, r.id DESC LIMIT 20),
u AS (SELECT id, name, updated_at AS t, status FROM jobs ORDER BY updated_at DESC, id DESC LIMIT 10),
n AS (SELECT id, name, next_run_timestamp AS t, status FROM jobs
      WHERE status = 'active' AND next_run_timestamp <= {_AS_OF}
      ORDER BY next_run_timestamp, id LIMIT 5)
SELECT 'run' AS kind, id, name, strftime(t, '%Y-%m-%d %H:%M:%S.%f') AS "at", status, duration FROM r
UNION ALL SELECT 'updated', id, name, strftime(t, '%Y-%m-%d %H:%M:%S.%f'), status, NULL FROM u
UNION ALL SELECT 'due', id, name, strftime(t, '%Y-%m-%d %H:%M:%S.%f'), status, NULL FROM n""",
)
def _(spark, d):
    a = op.recent_activity(b.jobs(spark, d), b.job_runs(spark, d, counts=False), b.RUNS_AS_OF)
    none = F.lit(None).cast("double").alias("duration")
    row = lambda kind, df, name, at, duration: df.select(
        F.lit(kind).alias("kind"), "id", F.col(name).alias("name"), text(at, "at"), "status", duration
    )
    return (
        row("run", a.recent_runs, "job_name", "start_time", F.col("duration"))
        .unionByName(row("updated", a.recent_jobs, "name", "updated_at", none))
        .unionByName(row("due", a.due_jobs, "name", "next_run_timestamp", none))
    )


@query(
    "run_retention",
    f"""WITH {b.RUNS_SQL}
SELECT 'kept' AS part, count(*) AS runs FROM job_runs
WHERE NOT coalesce(start_time < {_AS_OF} - INTERVAL 30 DAY, FALSE)
UNION ALL SELECT 'deleted', count(*) FROM job_runs WHERE start_time < {_AS_OF} - INTERVAL 30 DAY""",
)
def _(spark, d):
    split = op.retention(b.job_runs(spark, d, counts=False), b.RUNS_AS_OF)
    kept = split.keep.agg(F.count(F.lit(1)).alias("runs"))
    deleted = split.deleted_count.withColumnRenamed("deleted_count", "runs")
    return kept.select(F.lit("kept").alias("part"), "runs").unionByName(
        deleted.select(F.lit("deleted").alias("part"), "runs")
    )


@query(
    "run_retention_keep",
    f"""WITH {b.RUNS_SQL}
SELECT id, job_id, status FROM job_runs WHERE start_time >= {_AS_OF} - INTERVAL 30 DAY""",
)
def _(spark, d):
    kept = op.retention(b.job_runs(spark, d, counts=False), b.RUNS_AS_OF).keep
    return kept.select("id", "job_id", "status")


@query(
    "run_log_stats",
    """
WITH lines AS (SELECT l_orderkey AS id, count(*) AS n FROM lineitem GROUP BY 1)
SELECT o_orderkey AS id,
  CASE WHEN o_orderkey % 5 IN (0, 1) THEN coalesce(n, 0) WHEN o_orderkey % 5 = 2 THEN coalesce(n, 0) + 1 END
    AS records_processed,
  CASE WHEN o_orderkey % 5 IN (0, 1, 2) THEN o_orderkey % 7 END AS records_failed
FROM orders LEFT JOIN lines ON lines.id = o_orderkey""",
)
def _(spark, d):
    # Five kinds of output: one JSON line, JSON then noise, two JSON lines, a broken one, none.
    runs = b.job_runs(spark, d)
    kind, n = F.col("id") % 5, F.coalesce("records_processed", F.lit(0))
    failed = F.col("id") % 7
    stats = lambda shown: F.concat(
        F.lit('{"records_processed": '), shown, F.lit(', "records_failed": '), failed, F.lit("}")
    )
    stdout = (
        F.when(kind == 0, F.concat(F.lit("starting\n"), stats(n), F.lit("\n")))
        .when(kind == 1, F.concat(stats(n), F.lit("\ndone {not closed\n")))
        .when(kind == 2, F.concat(stats(n), F.lit("\n"), stats(n + 1)))
        .when(kind == 3, F.concat(stats(n), F.lit("\n{broken}")))
        .otherwise(F.lit("no statistics"))
    )
    out = op.log_stats(runs.select("id", stdout.alias("stdout")))
    return out.select("id", "records_processed", "records_failed")


# --- scalars ------------------------------------------------------------------------------


@query(
    "scl_format_duration",
    """
SELECT o_orderkey AS id, CASE WHEN s < 60 THEN printf('%.1fs', s) WHEN s < 3600 THEN printf('%.1fm', s / 60)
  ELSE printf('%.1fh', s / 3600) END AS duration
FROM (SELECT o_orderkey, (o_orderkey % 9000) + 0.25::DOUBLE AS s FROM orders)""",
)
def _(spark, d):
    seconds = (F.col("o_orderkey") % 9000) + F.lit(0.25)
    return b.table(spark, d, "orders").select(
        F.col("o_orderkey").alias("id"), fx.format_duration(seconds).alias("duration")
    )


@query("scl_megabytes", "SELECT o_orderkey AS id, o_totalprice * 1000 / 1048576 AS mb FROM orders")
def _(spark, d):
    return b.table(spark, d, "orders").select(
        F.col("o_orderkey").alias("id"), fx.megabytes(F.col("o_totalprice") * 1000).alias("mb")
    )


@query(
    "scl_run_duration",
    f"""WITH {b.RUNS_SQL}
SELECT id, datediff('microsecond', start_time, end_time) / 1000000.0::DOUBLE AS seconds FROM job_runs""",
)
def _(spark, d):
    seconds = fx.run_duration(F.col("start_time"), F.col("end_time"))
    return b.job_runs(spark, d, counts=False).select("id", seconds.alias("seconds"))


@query(
    "scl_schedule_class",
    f"""WITH {b.JOBS_SQL}
SELECT id, CASE WHEN lower(schedule) IN ('daily', 'hourly', 'weekly') THEN lower(schedule)
  ELSE schedule END AS schedule,
  CASE WHEN lower(schedule) IN ('daily', 'hourly', 'weekly') THEN 'predefined' ELSE 'other' END AS class
FROM jobs""",
)
def _(spark, d):
    jobs = b.jobs(spark, d).select("id", fx.schedule_class(F.col("schedule")).alias("s"))
    return jobs.select("id", "s.schedule", "s.class")


@query(
    "scl_next_run",
    f"""WITH {b.JOBS_SQL}, r AS (
SELECT id, CASE lower(schedule)
  WHEN 'daily' THEN CASE WHEN date_trunc('day', updated_at) + INTERVAL 2 HOUR <= updated_at
    THEN date_trunc('day', updated_at) + INTERVAL 26 HOUR
    ELSE date_trunc('day', updated_at) + INTERVAL 2 HOUR END
  WHEN 'hourly' THEN date_trunc('hour', updated_at) + INTERVAL 1 HOUR
  WHEN 'weekly' THEN date_trunc('day', updated_at)
    + (8 - isodow(updated_at)) * INTERVAL 1 DAY + INTERVAL 2 HOUR
  END AS t FROM jobs)
SELECT id, {sql_text('t', 'next_run')} FROM r""",
)
def _(spark, d):
    due = fx.next_run(F.col("schedule"), F.col("updated_at"))
    return b.jobs(spark, d).select("id", due.alias("next_run")).select("id", text("next_run"))


@query(
    "scl_map_merge",
    """
SELECT o_orderkey AS id, 'base' AS kept, CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority ELSE 'normal' END
  AS priority, CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus END AS added FROM orders""",
)
def _(spark, d):
    orders = b.table(spark, d, "orders")
    base = F.create_map(F.lit("kept"), F.lit("base"), F.lit("priority"), F.lit("normal"))
    given = F.create_map(
        F.lit("priority"), F.col("o_orderpriority"), F.lit("added"), F.col("o_orderstatus")
    )
    none = F.map_filter(given, lambda k, v: F.lit(False))
    overrides = F.when(F.col("o_orderkey") % 3 == 0, given).otherwise(none)
    merged = orders.select(F.col("o_orderkey").alias("id"), fx.map_merge(base, overrides).alias("m"))
    at = lambda k: F.try_element_at("m", F.lit(k)).alias(k)
    return merged.select("id", at("kept"), at("priority"), at("added"))
