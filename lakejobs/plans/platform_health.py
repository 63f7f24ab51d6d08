"""Eight platform checks, their issues and the overall health."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from lakejobs.operators import monitoring as mon

# A log: its frame, or a function that opens it.
Log = DataFrame | Callable[[], DataFrame]


@dataclass(frozen=True)
class Logs:
    """The logs the checks read."""

    runs: Log
    updates: Log
    files: Log
    queries: Log
    costs: Log
    quality: Log
    audit: Log


def _open(log: Log) -> DataFrame:
    return log if isinstance(log, DataFrame) else log()


def issues(
    logs: Logs, as_of: str | None = None, cost_day: str | None = None,
    thresholds: dict[str, float] | None = None, access_hours: int = 1, latency_hours: int = 1,
) -> DataFrame:
    """Issues of all checks as one frame; a check that cannot be made is an issue itself."""
    t = {**mon.THRESHOLDS, **(thresholds or {})}
    spark = SparkSession.active()
    checks = (
        ("failure_rate", "HIGH", lambda: mon.failure_rate(
            _open(logs.runs), as_of, threshold=t["pipeline_failure_rate"])),
        ("stuck_runs", "HIGH", lambda: mon.stuck_runs(
            _open(logs.runs), as_of, threshold=t["stuck_seconds"])),
        ("freshness", "MEDIUM", lambda: mon.stale_tables(
            mon.table_freshness(_open(logs.updates), as_of), t["data_freshness_hours"])),
        ("storage", "MEDIUM", lambda: mon.storage_issues(
            mon.storage_by_layer(_open(logs.files)), t["quarantine_files"])),
        ("latency", "LOW", lambda: mon.latency_issues(
            mon.latency_bins(_open(logs.queries), as_of, latency_hours,
                             threshold=t["query_latency_ms"]),
            t["query_latency_ms"])),
        ("cost", "LOW", lambda: mon.cost_issues(
            mon.cost_variance(_open(logs.costs)), cost_day, t["cost_variance_percent"])),
        ("quality", "MEDIUM", lambda: mon.quality_issues(
            mon.quality_scores(_open(logs.quality), as_of), t["data_quality_score"])),
        ("access", "MEDIUM", lambda: mon.access_issues(
            mon.failed_access(_open(logs.audit), as_of, access_hours), t["failed_access"],
            access_hours)),
    )
    return mon.union_issues(*[mon.guarded(spark, *check) for check in checks])


def run(logs: Logs, as_of: str | None = None, cost_day: str | None = None, **kwargs) -> DataFrame:
    """The health row."""
    return mon.overall_health(issues(logs, as_of, cost_day, **kwargs))
