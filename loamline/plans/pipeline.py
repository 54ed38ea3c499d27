"""The batch run: ingest → transform → load → validate → report."""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import datetime, timedelta
from hashlib import sha256

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loamline import functions as fx
from loamline.config import PipelineConfig
from loamline.operators import history, series
from loamline.operators.quality import Quality, validate
from loamline.plans.transform import Earlier, Transformed, transform, transform_stats
from loamline.rows import local_frame
from loamline.session import sized_shuffles
from loamline.sinks import parquet as sink
from loamline.sinks.batches import BatchTable, Entry, batch_name, window_of
from loamline.sinks.reports import write_report
from loamline.sources import files
from loamline.staging import Scope, stage, together


class IngestError(RuntimeError):
    """No file of the window could be read."""


@dataclass(frozen=True)
class PipelineResult:
    output_path: str
    output: DataFrame
    ingest: files.Ingest
    transformed: Transformed
    quality: Quality | None
    quality_error: str | None
    report_paths: tuple[str, str] | None
    metrics: DataFrame
    staged: Scope
    stale: list[str]  # batches to load again because rows before them have changed

    def release(self) -> int:
        """Delete the run's intermediate tables; ``output`` and the reports stay."""
        return self.staged.drop()


@dataclass(frozen=True)
class _Job:
    """What a run was asked for."""

    raw_path: str
    table: BatchTable
    batch: str
    cfg: PipelineConfig
    start: str | None
    end: str | None
    validate_output: bool
    report_path: str | None
    partition_by: tuple[str, ...] | None
    narrowed: bool
    after_earlier: bool
    day_span: bool
    copy_days: int


def run_pipeline(
    spark: SparkSession,
    raw_path: str,
    output_path: str,
    cfg: PipelineConfig = PipelineConfig(),
    start: str | None = None,
    end: str | None = None,
    validate_output: bool = True,
    report_path: str | None = None,
    partition_by: tuple[str, ...] | None = None,
    narrowed: bool = False,
    after_earlier: bool = True,
    day_span: bool = False,
    copy_days: int = 2,
) -> PipelineResult:
    """One batch. Ingest, transform and load failures abort; a failed validation does not.

    The table at ``output_path`` holds one batch per window, see :mod:`loamline.sinks.batches`. A run replaces
    the batch of its own window and no other, so adjacent windows keep all their rows and a run
    that is repeated changes nothing. Windows that overlap without being equal are refused: their
    common files would be stored twice. The rows are written aside and published when they are complete; until
    then, and if the run fails, readers see the batch as it was. ``output`` is this batch;
    :func:`read_table` reads the table.

    A batch continues the published batches before it (:mod:`loamline.operators.history`): rows that they have
    stored, up to ``copy_days`` days before, are copies; a type's statistics include theirs; the first rows of a series
    see their last ones. So load the batches of a table in order; a batch whose predecessors have changed since is
    named in ``stale``. With ``after_earlier=False`` a batch stands alone and leaves no history.
    ``day_span`` adds ``rolling_days_avg``, the mean over the last ``cfg.rolling_days`` days.

    The enriched rows are written once, as the result; counters and validation then read the
    columns they need from that written table, so nothing is computed twice. The frames of the
    result read intermediate tables in the shared folder until ``release`` is called.
    """
    batch = batch_name(start, end)
    job = _Job(
        raw_path, BatchTable(spark, output_path), batch, cfg, start, end, validate_output, report_path,
        partition_by, narrowed, after_earlier, day_span, copy_days,
    )
    with Scope(spark) as scope:
        job.table.refuse_overlap(batch)
        checked = files.check_window(spark, raw_path, start, end)
        size = checked.agg(F.sum("length")).first()[0] or 0
        with sized_shuffles(spark, size):
            return _stages(scope, job, checked)


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All published rows of a table of batches.

    A local day may lie in two batches; its ``daily_avg_value`` is the mean over all of them, from the day sums
    that the batches left.
    """
    table = BatchTable(spark, path)
    rows = table.read(schema)
    if "daily_avg_value" not in rows.columns:
        return rows
    sums = table.read_history("day_sums", history.SCHEMAS["day_sums"], list(table.entries()))
    return history.with_whole_days(rows, sums)


def stored_calendar(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(calendar, hours) of a whole table from its hour maps; no reading is read.

    They are what :mod:`loamline.operators.quality` makes coverage and gaps of: ``time_coverage(calendar)``,
    ``gap_counts(calendar)``, ``gap_spans(hours, calendar)``. Copies that several batches stored count once
    as hours and each as readings.
    """
    table = BatchTable(spark, path)
    maps = table.read_history("hour_bits", history.SCHEMAS["hour_bits"], list(table.entries()))
    days = stage(history.merged_bits(maps), "hour-maps")
    return stage(history.calendar_of(days), "series-calendar"), history.hours_of(days)


def _earlier(job: _Job) -> Earlier:
    before = job.table.before(job.batch)
    read = lambda kind, batches: job.table.read_history(kind, history.SCHEMAS[kind], batches).drop("batch")
    first = datetime.fromisoformat(window_of(job.batch)[0].replace("0000", "0001", 1))
    near = [b for b in before if _day(window_of(b)[1]) + timedelta(days=job.copy_days) >= first]
    if not before:
        return Earlier()
    # Tails and histograms are those of all batches so far.
    stored = read("keys", near) if near else None
    return Earlier(read("tails", before[-1:]), read("histograms", before[-1:]), read("values", before), stored)


def _day(text: str) -> datetime:
    return datetime.fromisoformat(text) if text < "9999" else datetime(9998, 12, 31)


def _with_day_span(job: _Job, frame: DataFrame) -> DataFrame:
    """``frame`` with the trailing mean over days, the rows of earlier batches included."""
    rows = stage(frame, "enriched")
    before = job.table.before(job.batch) if job.after_earlier else []
    spans = series.cut_hours(rows, job.cfg) if before else []
    if not spans:
        return series.rolling_days(rows, job.cfg)
    sums = job.table.read_history("hour_sums", history.SCHEMAS["hour_sums"], before).drop("batch")
    low, high = (F.floor(F.unix_micros(F.lit(t)) / 3_600_000_000) for t in (spans[0][0], spans[1][1]))
    sums = sums.where((F.col("span_hour") >= low) & (F.col("span_hour") <= high))
    needed, columns = F.lit(False), ["sensor_id", "reading_type", "timestamp", "value", "date"]
    for start, end in spans:
        # The local dates prune folders, the instants row groups.
        dates = [F.to_date(fx.wall_time(F.lit(t), job.cfg.target_timezone)).cast("string") for t in (start, end)]
        inside = (F.col("timestamp") >= F.lit(start)) & (F.col("timestamp") <= F.lit(end))
        needed = needed | (F.col("date").between(*dates) & inside)
    schema = T.StructType([f for f in frame.schema.fields if f.name in columns])
    older = job.table.read(schema, before).where(needed)
    return series.rolling_days(rows, job.cfg, history=(sums, stage(older, "cut-hours")))


def _write_history(job: _Job, entry: Entry, done: Transformed, earlier: Earlier, output: DataFrame) -> Entry:
    """Write what later batches need beside the new version; the entry that tells of it."""
    folder = lambda kind: job.table.history_folder(kind, job.batch, entry.version)
    sources = done.replaced.select("reading_type", F.col("source_value").alias("value"))
    frames = {
        "tails": history.tails(done.replaced, earlier.tails, job.cfg),
        "histograms": done.histogram.coalesce(1),
        # Sorted, so that row groups can be passed over.
        "values": history.value_counts(sources).sortWithinPartitions("reading_type", "bin"),
        "keys": history.keys(done.distinct).sortWithinPartitions("timestamp"),
        "hour_sums": history.hour_sums(output),
        "day_sums": history.day_sums(output),
        "hour_bits": history.hour_bits(output, job.cfg),
    }

    def write(kind):
        return lambda: frames[kind].write.parquet(folder(kind))

    def rows_digest():
        hashed = F.xxhash64(*done.distinct.columns).cast("decimal(38,0)")
        return done.distinct.agg(F.sum(hashed).alias("s"), F.count(F.lit(1)).alias("n")).first()

    *_, rows = together(*[write(k) for k in frames], rows_digest)
    before = job.table.before(job.batch)
    parent = job.table.entries()[before[-1]].digest if before else None
    digest = sha256(f"{parent}|{rows.s}|{rows.n}|{job.cfg}".encode()).hexdigest()[:32]
    return replace(entry, history=sorted(frames), digest=digest, parent=parent)


def _stages(scope: Scope, job: _Job, checked: DataFrame) -> PipelineResult:
    spark, cfg, table = scope.spark, job.cfg, job.table
    taken = files.ingest(spark, job.raw_path, job.start, job.end, checked)
    if taken.readings is None:
        raise IngestError(f"no readable file in {job.raw_path}")
    earlier = _earlier(job) if job.after_earlier else None
    done = transform(taken.readings, cfg, earlier)
    frame = _with_day_span(job, done.frame) if job.day_span else done.frame
    keys = sink.partition_keys(frame, cfg, job.partition_by)
    entry = sink.write_version(frame, table, job.batch, cfg, keys, narrowed=job.narrowed)
    written = table.folder(job.batch, entry.version)
    output = sink.read_back(spark, written, frame.schema, job.narrowed)
    try:
        if earlier is not None:
            entry = _write_history(job, entry, done, earlier, output)
        table.publish(job.batch, entry)
    except BaseException:
        table.discard(job.batch, entry.version, list(history.SCHEMAS))
        raise

    quality, problem, report = None, None, None
    if job.validate_output:
        try:
            quality = validate(output, cfg)
            if job.report_path is not None:
                report = write_report(quality, job.report_path)
        except Exception as e:  # the data is already loaded; the caller decides
            quality, problem = None, f"{type(e).__name__}: {e}"

    counters = transform_stats(done, output)
    loaded = sink.load_stats(
        spark, written, len(output.columns), output.agg(F.count(F.lit(1)).alias("records_loaded"))
    )
    summary = files.ingest_summary(taken.stats)
    metrics = stage(pipeline_metrics(summary, counters, quality, loaded, problem), "metrics")
    return PipelineResult(
        table.path, output, taken, done, quality, problem, report, metrics, scope, table.stale()
    )


def _long(df: DataFrame, stage_name: str, columns: list[str]) -> DataFrame:
    pairs = F.array(
        *[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in columns]
    )
    return df.select(F.lit(stage_name).alias("stage"), F.inline(pairs))


def pipeline_metrics(
    ingested: DataFrame,
    counters: DataFrame,
    quality: Quality | None,
    loaded: DataFrame | None,
    problem: str | None = None,
) -> DataFrame:
    """(stage, metric, value, status, error) of a run; every input is a one-row frame.

    Every stage has a row ``completed``: 1 with status ``success``, or 0 with status ``failed`` and
    the error. A validation that was not asked for has none.
    """
    numbers = lambda df: [
        f.name for f in df.schema.fields if f.dataType.typeName() in ("long", "integer", "double")
    ]
    out = _long(ingested, "ingest", numbers(ingested)).unionByName(
        _long(counters, "transform", numbers(counters))
    )
    if quality is not None:
        out = out.unionByName(_long(quality.score, "validate", ["quality_score"]))
        out = out.unionByName(_long(quality.totals, "validate", ["total_records"]))
    if loaded is not None:
        out = out.unionByName(_long(loaded, "load", numbers(loaded)))
    ended = [("ingest", None), ("transform", None)]
    if quality is not None or problem is not None:
        ended.append(("validate", problem))
    if loaded is not None:
        ended.append(("load", None))
    rows = [(s, "completed", float(e is None), "failed" if e else "success", e) for s, e in ended]
    ddl = "stage string, metric string, value double, status string, error string"
    return out.unionByName(local_frame(ingested.sparkSession, rows, ddl), allowMissingColumns=True)
