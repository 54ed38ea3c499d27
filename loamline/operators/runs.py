"""Questions about jobs and their run history.

``jobs`` and ``runs`` are plain DataFrames. Every "now" is an explicit ``as_of`` wall time.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loamline import functions as fx
from loamline.rows import one_row

# --- filters ---------------------------------------------------------------------


def filter_equal(df: DataFrame, **wanted) -> DataFrame:
    """Equality filters; a parameter that is None adds no predicate."""
    for name, value in wanted.items():
        if value is not None:
            df = df.where(F.col(name) == F.lit(value))
    return df


def filter_runs(
    runs: DataFrame,
    job_id: int | None = None,
    status: str | None = None,
    start: datetime | None = None,
    end: datetime | None = None,
) -> DataFrame:
    """Runs by job, status and inclusive start-time range; pushed down to the scan."""
    out = filter_equal(runs, job_id=job_id, status=status)
    if start is not None:
        out = out.where(F.col("start_time") >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        out = out.where(F.col("start_time") <= F.lit(end).cast("timestamp_ntz"))
    return out


def search_jobs(jobs: DataFrame, text: str) -> DataFrame:
    """Jobs whose name or description contains ``text``, whatever the case."""
    needle = F.lower(F.lit(text))
    return jobs.where(
        F.lower("name").contains(needle)
        | F.coalesce(F.lower("description").contains(needle), F.lit(False))
    )


def is_due(as_of: Column) -> Column:
    due = (F.col("status") == "active") & (F.col("next_run_timestamp") <= as_of)
    return F.coalesce(due, F.lit(False))


def due_jobs(jobs: DataFrame, as_of: Column, k: int | None = None) -> DataFrame:
    """Active jobs whose next run has come, earliest first."""
    out = jobs.where(is_due(as_of)).orderBy("next_run_timestamp", "id")
    return out if k is None else out.limit(k)


def config_violations(jobs: DataFrame, required: str = "raw_data_path") -> DataFrame:
    """(id, name, missing_field): pipeline jobs whose configuration lacks the key."""
    keys = F.json_object_keys("configuration_parameters")
    has = F.coalesce(F.array_contains(keys, required), F.lit(False))
    return jobs.where((F.col("job_type") == "data_pipeline") & ~has).select(
        "id", "name", F.lit(required).alias("missing_field")
    )


# --- joins -----------------------------------------------------------------------


def runs_with_job(runs: DataFrame, jobs: DataFrame, *job_columns: str) -> DataFrame:
    """Each run with the named columns of its job, prefixed ``job_``.

    No hint: Spark broadcasts the jobs when their measured size allows it; otherwise the
    sort-merge join splits a job that holds much of the history.
    """
    names = job_columns or ("name",)
    side = jobs.select(
        F.col("id").alias("job_id"), *[F.col(c).alias("job_" + c.removeprefix("job_")) for c in names]
    )
    return runs.join(side, "job_id")


def _recent_first() -> list[Column]:
    return [F.desc("start_time"), F.desc("id")]


def recent_runs_per_job(runs: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` newest runs of every job, numbered from 1.

    The row-number filter becomes a group limit before the shuffle, so a job with a very long
    history sends at most ``k`` rows per map task.
    """
    newest = W.partitionBy("job_id").orderBy(*_recent_first())
    return runs.withColumn("rn", F.row_number().over(newest)).where(F.col("rn") <= k)


def last_run_status(jobs: DataFrame, runs: DataFrame) -> DataFrame:
    """(id, name, last_run_status); jobs without runs say ``never_run``.

    ``max_by`` combines map-side: one row per job and map task is shuffled.
    """
    latest = runs.groupBy("job_id").agg(
        F.max_by("status", F.struct("start_time", F.col("id"))).alias("status_of_last")
    )
    return jobs.join(latest.withColumnRenamed("job_id", "id"), "id", "left").select(
        "id", "name", F.coalesce("status_of_last", F.lit("never_run")).alias("last_run_status")
    )


def job_history(jobs: DataFrame, runs: DataFrame, k: int = 10) -> DataFrame:
    """Each job with its ``k`` newest runs as an array, newest first; empty if none."""
    entry = F.struct("rn", F.col("id").alias("run_id"), "start_time", "status")
    lists = (
        recent_runs_per_job(runs, k)
        .groupBy("job_id")
        .agg(F.sort_array(F.collect_list(entry)).alias("run_history"))
        .withColumnRenamed("job_id", "id")
    )
    empty = F.array().cast(lists.schema["run_history"].dataType)
    return jobs.join(lists, "id", "left").withColumn(
        "run_history", F.coalesce("run_history", empty)
    )


def names_taken(candidates: DataFrame, existing: DataFrame) -> DataFrame:
    """Candidates (id, name) whose name a row with another id already has.

    Existing names are first reduced to one row each (smallest and largest id), so a name that
    many rows share is never paired with all of them.
    """
    owners = existing.groupBy("name").agg(F.min("id").alias("lo"), F.max("id").alias("hi"))
    other = F.col("id").isNull() | (F.col("lo") != F.col("id")) | (F.col("hi") != F.col("id"))
    return candidates.join(owners, "name").where(other).select(*candidates.columns)


def duplicate_names(jobs: DataFrame) -> DataFrame:
    """(name, holders) for names that occur more than once."""
    return jobs.groupBy("name").agg(F.count(F.lit(1)).alias("holders")).where("holders > 1")


# --- statistics --------------------------------------------------------------------


def jobs_by_type(jobs: DataFrame) -> DataFrame:
    return jobs.groupBy("job_type").agg(F.count(F.lit(1)).alias("jobs"))


def job_counts(jobs: DataFrame, as_of: Column) -> DataFrame:
    """One row: total, active, inactive and due jobs, in one pass."""
    return jobs.agg(
        F.count(F.lit(1)).alias("total_jobs"),
        F.count_if(F.col("status") == "active").alias("active_jobs"),
        F.count_if(F.col("status") == "inactive").alias("inactive_jobs"),
        F.count_if(is_due(as_of)).alias("due_jobs"),
    )


def run_stats(runs: DataFrame, as_of: datetime) -> DataFrame:
    """One row: counts by status, recent runs, success rate, mean run time; one pass."""
    since = lambda **ago: F.lit(as_of - timedelta(**ago)).cast("timestamp_ntz")
    status = lambda s: F.count_if(F.col("status") == s)
    timed = F.when(F.col("status") == "success", F.col("execution_time_seconds"))
    counts = runs.agg(
        F.count(F.lit(1)).alias("total_runs"),
        status("success").alias("successful_runs"),
        status("failed").alias("failed_runs"),
        status("running").alias("running_jobs"),
        status("queued").alias("queued_jobs"),
        F.count_if(F.col("start_time") >= since(hours=24)).alias("runs_last_24h"),
        F.count_if(F.col("start_time") >= since(days=7)).alias("runs_last_7d"),
        F.avg(timed).alias("mean_seconds"),
    )
    rate = fx.percent(F.col("successful_runs"), F.col("total_runs"))
    return counts.withColumns(
        {
            "success_rate": F.round(rate, 2),
            "average_execution_time": F.round(F.coalesce("mean_seconds", F.lit(0.0)), 2),
        }
    ).drop("mean_seconds")


def dashboard(jobs: DataFrame, runs: DataFrame, as_of: datetime) -> DataFrame:
    """One row of job and run statistics, with jobs per type as a map; two scans."""
    now = F.lit(as_of).cast("timestamp_ntz")
    per_type = jobs.groupBy("job_type").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("status") == "active").alias("active"),
        F.count_if(is_due(now)).alias("due"),
    )
    # Job types are an enumeration of the data model, so the map has a few entries.
    job_side = per_type.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("jobs_total"),
        F.coalesce(F.sum("active"), F.lit(0)).alias("jobs_active"),
        F.coalesce(F.sum("due"), F.lit(0)).alias("jobs_due"),
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("job_type", "n")))).alias(
            "jobs_by_type"
        ),
    )
    run_side = run_stats(runs, as_of).select(
        F.col("total_runs").alias("runs_total"),
        F.col("successful_runs").alias("runs_successful"),
        F.col("failed_runs").alias("runs_failed"),
        F.col("running_jobs").alias("runs_running"),
        F.col("success_rate").alias("runs_success_rate"),
        F.col("runs_last_24h").alias("runs_recent_24h"),
        F.col("average_execution_time").alias("runs_avg_execution_time"),
    )
    return one_row(job_side, run_side)


# --- ordering and paging -------------------------------------------------------------


def newest_runs(runs: DataFrame, k: int = 20) -> DataFrame:
    return runs.orderBy(*_recent_first()).limit(k)


def updated_jobs(jobs: DataFrame, k: int = 10) -> DataFrame:
    return jobs.orderBy(F.desc("updated_at"), F.desc("id")).limit(k)


@dataclass(frozen=True)
class Page:
    rows: DataFrame
    total: DataFrame


# Rows that a page may skip by a top-k; a deeper page first finds the days it lies on.
DEEP_OFFSET = 10_000


def page_of_runs(
    runs: DataFrame, job_id: int | None, page: int = 1, size: int = 20, deep: int = DEEP_OFFSET
) -> Page:
    """One page of runs, newest first, and the total count.

    A top-k of offset + limit rows gathers the offset in one task. Beyond ``deep`` rows the runs are
    counted per day instead: the page's rows lie on few days, and only the runs of these days are
    ordered. :func:`runs_after` needs no offset at all.
    """
    chosen = filter_equal(runs, job_id=job_id)
    skip = (page - 1) * size
    total = chosen.agg(F.count(F.lit(1)).alias("total"))
    if skip > deep:
        chosen, skip = _days_of_page(chosen, skip, size)
    return Page(chosen.orderBy(*_recent_first()).offset(skip).limit(size), total)


def _days_of_page(runs: DataFrame, skip: int, size: int) -> tuple[DataFrame, int]:
    """The runs of the days that rows ``skip`` … ``skip + size`` lie on, and what to skip of them.

    One row per day is windowed; one row comes back. Runs without a start are the last "day".
    """
    day = F.to_date("start_time")
    upto = F.sum("n").over(W.orderBy(F.desc_nulls_last("day")))
    days = runs.groupBy(day.alias("day")).agg(F.count(F.lit(1)).alias("n")).withColumn("upto", upto)
    here = days.where((F.col("upto") > skip) & (F.col("upto") - F.col("n") < skip + size))
    found = here.agg(
        F.min("day").alias("low"),
        F.max("day").alias("high"),
        F.coalesce(F.bool_or(F.col("day").isNull()), F.lit(False)).alias("undated"),
        F.min(F.col("upto") - F.col("n")).alias("before"),
    ).first()
    if found.before is None:
        return runs.limit(0), 0
    kept = F.coalesce((day >= F.lit(found.low)) & (day <= F.lit(found.high)), F.lit(False))
    if found.undated:
        kept = kept | day.isNull()
    return runs.where(kept), skip - found.before


def runs_after(
    runs: DataFrame, job_id: int | None, last_start: datetime, last_id: int, size: int = 20
) -> DataFrame:
    """The page that follows a known last row: a filter and a top-k, however deep."""
    at = F.lit(last_start).cast("timestamp_ntz")
    beyond = (F.col("start_time") < at) | ((F.col("start_time") == at) & (F.col("id") < last_id))
    return filter_equal(runs, job_id=job_id).where(beyond).orderBy(*_recent_first()).limit(size)


@dataclass(frozen=True)
class Activity:
    recent_runs: DataFrame
    recent_jobs: DataFrame
    due_jobs: DataFrame


def recent_activity(jobs: DataFrame, runs: DataFrame, as_of: datetime) -> Activity:
    """20 newest runs with job name and duration, 10 last-updated jobs, 5 next due ones.

    The top-k comes before the join, so only 20 runs meet the jobs.
    """
    top = runs_with_job(newest_runs(runs, 20), jobs, "name")
    shown = top.select(
        "id",
        "job_name",
        "start_time",
        "end_time",
        "status",
        fx.run_duration(F.col("start_time"), F.col("end_time")).alias("duration"),
    ).orderBy(*_recent_first())
    now = F.lit(as_of).cast("timestamp_ntz")
    return Activity(shown, updated_jobs(jobs, 10), due_jobs(jobs, now, 5))


# --- retention and logs ----------------------------------------------------------------


@dataclass(frozen=True)
class Retention:
    keep: DataFrame
    expired: DataFrame
    deleted_count: DataFrame


def retention(runs: DataFrame, as_of: datetime, days: int = 30) -> Retention:
    """Split runs at ``as_of − days``; a run without a start is kept."""
    old = F.col("start_time") < F.lit(as_of - timedelta(days=days)).cast("timestamp_ntz")
    old = F.coalesce(old, F.lit(False))
    expired = runs.where(old)
    return Retention(
        runs.where(~old), expired, expired.agg(F.count(F.lit(1)).alias("deleted_count"))
    )


def log_stats(df: DataFrame, stdout: str = "stdout") -> DataFrame:
    """Add ``records_processed`` and ``records_failed`` from captured output.

    The last line that starts with ``{`` and ends with ``}`` counts. Unless it is one valid JSON
    object, with nothing after it, and its two fields are whole numbers where they occur, both stay
    null.
    """
    last = F.regexp_extract(F.col(stdout), _LAST_OBJECT_LINE, 1)
    # In brackets, text after the object is a syntax error and a second object another element.
    tree = F.try_parse_json(F.when(last != "", F.concat(F.lit("["), last, F.lit("]"))))
    number = lambda c: F.try_variant_get(tree, f"$[0].{c}", "bigint")
    shown = lambda c: F.try_variant_get(tree, f"$[0].{c}", "string")
    fields = ("records_processed", "records_failed")
    fits = F.try_variant_get(tree, "$[1]", "string").isNull()
    for c in fields:
        # A quoted number is a text, not a number.
        quoted = last.rlike(f'"{c}"\\s*:\\s*"')
        fits = fits & (shown(c).isNull() | (shown(c).rlike(r"^-?\d+$") & ~quoted))
    return df.withColumns({c: F.when(fits, number(c)) for c in fields})


# The last line of a trimmed text that begins with { and ends with }: greedy, so one match finds it.
_LAST_OBJECT_LINE = r"(?s)^\s*(?:.*\n)?(\{[^\n]*\})(?:\s*$|\n(?!.*(?:^|\n)\{[^\n]*\}(?:\n|\s*$)))"
