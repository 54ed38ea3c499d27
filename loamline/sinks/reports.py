"""Quality reports: JSON sections and a long-form CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamline.operators.quality import Quality, gap_report, gap_span_report, report_rows


def report_sections(q: Quality, with_hours: bool = False) -> DataFrame:
    """(section, body): every row of every section as JSON text.

    Gaps are counts per series and one row per span; ``with_hours`` lists each missing hour in the
    series' row instead (see :func:`gap_report`).
    """
    sections = {
        "quality_score": q.score,
        "total_records": q.totals,
        "data_types": q.data_types,
        "value_ranges": q.ranges,
        "missing_values": q.missing,
        "anomalies": q.anomalies,
        "time_coverage": q.coverage,
        "data_gaps": gap_report(q.hours) if with_hours else q.gaps,
    }
    if not with_hours:
        sections["data_gap_spans"] = gap_span_report(q.hours)
    out = None
    for name, df in sections.items():
        rows = df.select(F.lit(name).alias("section"), F.to_json(F.struct("*")).alias("body"))
        out = rows if out is None else out.unionByName(rows)
    return out


def write_report(q: Quality, path: str, with_hours: bool = False) -> tuple[str, str]:
    """Write ``<path>.json`` (all sections) and ``<path>.csv`` (long summary); returns both."""
    base = path[: -len(".json")] if path.endswith(".json") else path
    json_path, csv_path = f"{base}.json", f"{base}.csv"
    report_sections(q, with_hours).write.mode("overwrite").json(json_path)
    # A handful of rows per column and type: one file.
    report_rows(q).coalesce(1).write.mode("overwrite").option("header", "true").csv(csv_path)
    return json_path, csv_path
