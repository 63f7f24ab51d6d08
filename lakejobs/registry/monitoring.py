"""Queries: platform checks."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakejobs.operators import monitoring as mon
from lakejobs.plans import platform_health
from lakejobs.registry.case import case
from lakejobs.sources import star_tables as star

NOW = star.EVENTS_AS_OF
COST_DAY = "2024-01-30"
# The document listing is far smaller than a lake's, so its limit is lower.
LIMITS = {"quarantine_files": 50, "failed_access": 2}


def spelled(issues: DataFrame) -> DataFrame:
    """Issue details as ``key=value`` text in key order."""
    entries = F.array_sort(F.map_entries("details"))
    text = F.array_join(
        F.transform(entries, lambda e: F.concat_ws("=", e["key"], e["value"])), ";"
    )
    return issues.withColumn("details", text)


def logs(spark, d) -> platform_health.Logs:
    return platform_health.Logs(
        runs=star.pipeline_runs(spark, d),
        updates=star.table(spark, d, "events").selectExpr(
            "concat('user_', user_id) as table_name", "ts as updated_at"
        ),
        files=star.file_listing(spark, d),
        queries=star.query_log(spark, d),
        costs=star.cost_log(spark, d),
        quality=star.quality_log(spark, d),
        audit=star.access_audit(spark, d),
    )


_FAILURE = """
    SELECT 'pipeline_failure' AS type, 'HIGH' AS severity,
        'Failed runs make up ' || CAST(CAST(f * 100.0 / n AS DECIMAL(18,1)) AS VARCHAR)
          || '% of the window' AS message,
        'failed_runs=' || f || ';failure_rate=' || CAST(CAST(f * 100.0 / n AS DECIMAL(18,1))
          AS VARCHAR) || ';threshold=10.0;total_runs=' || n AS details
    FROM (SELECT count(*) AS n, count(*) FILTER (status = 'Failed') AS f FROM runs
          WHERE run_start > TIMESTAMP '2024-01-30 00:00:00'
            AND run_start <= TIMESTAMP '2024-01-31 00:00:00') WHERE f * 100.0 / n > 10"""
_STUCK = """
    SELECT 'pipeline_stuck' AS type, 'MEDIUM' AS severity,
        'Pipeline ' || pipeline_name || ' has been in progress for ' || s || ' seconds' AS message,
        'duration_seconds=' || s || ';pipeline_name=' || pipeline_name || ';run_id=' || run_id
          AS details
    FROM (SELECT *, date_sub('second', run_start, TIMESTAMP '2024-01-31 00:00:00') AS s FROM runs
          WHERE status = 'InProgress' AND run_start > TIMESTAMP '2024-01-30 00:00:00'
            AND run_start <= TIMESTAMP '2024-01-31 00:00:00') WHERE s > 7200"""
_STALE = """
    SELECT 'data_staleness' AS type, 'MEDIUM' AS severity,
        'Newest rows of ' || t || ' are ' || h || ' hours old' AS message,
        'hours_stale=' || h || ';last_update=' || strftime(m, '%Y-%m-%d %H:%M:%S')
          || ';table_name=' || t || ';threshold=24' AS details
    FROM (SELECT concat('user_', user_id) AS t, max(ts) AS m,
                 date_sub('hour', max(ts), TIMESTAMP '2024-01-31 00:00:00') AS h
          FROM events GROUP BY 1) WHERE h > 24"""
_STORAGE = """
    SELECT 'storage_issues' AS type,
        CASE WHEN n = 0 THEN 'HIGH' ELSE 'MEDIUM' END AS severity,
        CASE WHEN n = 0 THEN 'No file in layer ' || layer
             ELSE 'Quarantine grew to ' || n || ' files' END AS message,
        'blob_count=' || n || ';container=' || layer || ';total_bytes=' || b AS details
    FROM (SELECT k.layer, count(files.layer) AS n, coalesce(sum(file_size), 0) AS b
          FROM (VALUES ('bronze'), ('silver'), ('gold'), ('quarantine')) AS k(layer)
          LEFT JOIN files ON k.layer = files.layer GROUP BY 1)
    WHERE (layer = 'quarantine' AND n > 50) OR (layer IN ('bronze', 'silver') AND n = 0)"""
_LATENCY = """
    SELECT 'performance_degradation' AS type, 'MEDIUM' AS severity,
        'Mean query time of ' || CAST(CAST(a AS DECIMAL(18,1)) AS VARCHAR)
          || 'ms in one interval' AS message,
        'avg_query_time_ms=' || CAST(CAST(a AS DECIMAL(18,1)) AS VARCHAR)
          || ';bin_start=' || strftime(b, '%Y-%m-%d %H:%M:%S') || ';threshold_ms=30000.0' AS details
    FROM (SELECT time_bucket(INTERVAL 15 MINUTE, ts) AS b,
                 CAST(sum(CAST(value * 1000 AS DECIMAL(18,3))) AS DOUBLE) / count(*) AS a
          FROM events WHERE ts > TIMESTAMP '2024-01-30 23:00:00'
            AND ts <= TIMESTAMP '2024-01-31 00:00:00' GROUP BY 1) WHERE a > 30000"""
_VARIANCE = """
    SELECT service, CAST(day AS VARCHAR) AS day, CAST(cost AS DOUBLE) AS current_cost,
           CAST(sum(cost) OVER w AS DOUBLE) / count(cost) OVER w AS baseline_cost,
           (CAST(cost AS DOUBLE) - CAST(sum(cost) OVER w AS DOUBLE) / count(cost) OVER w)
             / (CAST(sum(cost) OVER w AS DOUBLE) / count(cost) OVER w) * CAST(100 AS DOUBLE)
             AS variance_percent
    FROM (SELECT event_type AS service, CAST(ts AS DATE) AS day,
                 sum(CAST(value AS DECIMAL(12,2))) AS cost FROM events GROUP BY 1, 2)
    WINDOW w AS (PARTITION BY service ORDER BY day
                 RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING)"""
_COST = f"""
    SELECT 'cost_anomaly' AS type, 'MEDIUM' AS severity,
        'Daily cost of ' || service || ' increased by '
          || CAST(CAST(variance_percent AS DECIMAL(18,1)) AS VARCHAR) || '%' AS message,
        'baseline_cost=' || CAST(CAST(baseline_cost AS DECIMAL(18,2)) AS VARCHAR)
          || ';current_cost=' || CAST(CAST(current_cost AS DECIMAL(18,2)) AS VARCHAR)
          || ';day=' || day || ';service=' || service || ';threshold_percent=20.0;variance_percent='
          || CAST(CAST(variance_percent AS DECIMAL(18,1)) AS VARCHAR) AS details
    FROM ({_VARIANCE}) WHERE day = '2024-01-30' AND variance_percent > 20"""
_QUALITY = """
    SELECT 'data_quality_failure' AS type, 'HIGH' AS severity,
        'Checks of ' || event_type || ' score only ' || CAST(CAST(a AS DECIMAL(18,1)) AS VARCHAR)
          || '% on average' AS message,
        'check_count=' || n || ';quality_score=' || CAST(CAST(a AS DECIMAL(18,1)) AS VARCHAR)
          || ';table_name=' || event_type || ';threshold=85.0' AS details
    FROM (SELECT event_type, count(*) AS n,
                 CAST(sum(CAST(value AS DECIMAL(18,6))) AS DOUBLE) / count(value) AS a
          FROM events WHERE ts > TIMESTAMP '2024-01-30 00:00:00'
            AND ts <= TIMESTAMP '2024-01-31 00:00:00' GROUP BY 1) WHERE a < 85"""
_ACCESS = """
    SELECT 'security_violation' AS type, 'HIGH' AS severity,
        n || ' attempts to get access were refused' AS message,
        'failed_attempts=' || n || ';time_window=1 hour' AS details
    FROM (SELECT count(*) FILTER (event_type = 'error') AS n FROM events
          WHERE ts > TIMESTAMP '2024-01-30 23:00:00' AND ts <= TIMESTAMP '2024-01-31 00:00:00')
    WHERE n > 2"""
_ALL = " UNION ALL ".join(
    f"SELECT * FROM ({part})"
    for part in (_FAILURE, _STUCK, _STALE, _STORAGE, _LATENCY, _COST, _QUALITY, _ACCESS)
)


@case("mon_failure_rate", _FAILURE, "runs")
def _(spark, d):
    return spelled(mon.failure_rate(star.pipeline_runs(spark, d), NOW))


@case("mon_stuck_runs", _STUCK, "runs")
def _(spark, d):
    return spelled(mon.stuck_runs(star.pipeline_runs(spark, d), NOW))


@case("mon_freshness", """
    SELECT event_type AS table_name, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS last_update,
           date_sub('hour', max(ts), TIMESTAMP '2024-01-31 00:00:00') AS hours_stale
    FROM events GROUP BY 1""")
def _(spark, d):
    updates = star.table(spark, d, "events")
    return mon.table_freshness(updates, NOW, "event_type", "ts")


@case("mon_table_union_freshness", """
    SELECT 'orders' AS table_name,
           strftime(CAST(max(o_orderdate) AS TIMESTAMP), '%Y-%m-%d %H:%M:%S.%f') AS last_update,
           date_sub('hour', CAST(max(o_orderdate) AS TIMESTAMP),
                    TIMESTAMP '2001-12-31 00:00:00') AS hours_stale FROM orders
    UNION ALL
    SELECT 'lineitem', strftime(CAST(max(l_shipdate) AS TIMESTAMP), '%Y-%m-%d %H:%M:%S.%f'),
           date_sub('hour', CAST(max(l_shipdate) AS TIMESTAMP),
                    TIMESTAMP '2001-12-31 00:00:00') FROM lineitem""")
def _(spark, d):
    """Freshness over several tables, each with a time column of its own."""
    updates = mon.latest_updates({
        "orders": (star.table(spark, d, "orders"), "o_orderdate"),
        "lineitem": (star.table(spark, d, "lineitem"), "l_shipdate"),
    })
    return mon.table_freshness(updates, "2001-12-31 00:00:00")


@case("mon_stale_tables", _STALE)
def _(spark, d):
    return spelled(mon.stale_tables(mon.table_freshness(logs(spark, d).updates, NOW)))


@case("mon_storage", _STORAGE, "files")
def _(spark, d):
    storage = mon.storage_by_layer(star.file_listing(spark, d))
    return spelled(mon.storage_issues(storage, LIMITS["quarantine_files"]))


@case("mon_latency_bins", """
    SELECT strftime(time_bucket(INTERVAL 15 MINUTE, ts), '%Y-%m-%d %H:%M:%S.%f') AS bin_start,
           count(*) AS query_count,
           CAST(sum(CAST(value * 1000 AS DECIMAL(18,3))) AS DOUBLE) / count(*) AS avg_duration_ms
    FROM events GROUP BY 1
    HAVING CAST(sum(CAST(value * 1000 AS DECIMAL(18,3))) AS DOUBLE) / count(*) > 30000""")
def _(spark, d):
    return mon.latency_bins(star.query_log(spark, d), NOW, hours=24 * 60)


@case("mon_latency_window", """
    SELECT strftime(time_bucket(INTERVAL 15 MINUTE, ts), '%Y-%m-%d %H:%M:%S.%f') AS bin_start,
           count(*) AS query_count,
           CAST(sum(CAST(value * 1000 AS DECIMAL(18,3))) AS DOUBLE) / count(*) AS avg_duration_ms
    FROM events WHERE ts > TIMESTAMP '2024-01-27 12:00:00' AND ts <= TIMESTAMP '2024-01-31 00:00:00'
    GROUP BY 1 HAVING CAST(sum(CAST(value * 1000 AS DECIMAL(18,3))) AS DOUBLE) / count(*) > 30000""")
def _(spark, d):
    """Bins of a window that leaves most of the log out."""
    return mon.latency_bins(star.query_log(spark, d), NOW, hours=84)


@case("mon_cost_variance", _VARIANCE)
def _(spark, d):
    return mon.cost_variance(star.cost_log(spark, d))


@case("mon_quality_24h", _QUALITY)
def _(spark, d):
    return spelled(mon.quality_issues(mon.quality_scores(star.quality_log(spark, d), NOW)))


@case("mon_failed_access", """
    SELECT count(*) FILTER (event_type = 'error') AS failed_attempts FROM events
    WHERE ts > TIMESTAMP '2024-01-30 22:00:00' AND ts <= TIMESTAMP '2024-01-31 00:00:00'""")
def _(spark, d):
    return mon.failed_access(star.access_audit(spark, d), NOW, 2)


@case("mon_access_issues", _ACCESS)
def _(spark, d):
    counts = mon.failed_access(star.access_audit(spark, d), NOW)
    return spelled(mon.access_issues(counts, LIMITS["failed_access"]))


@case("mon_top_issues", f"""
    SELECT * FROM ({_ALL})
    ORDER BY CASE severity WHEN 'CRITICAL' THEN 1 WHEN 'HIGH' THEN 2 WHEN 'MEDIUM' THEN 3
             ELSE 4 END, type, message LIMIT 5""", "runs files")
def _(spark, d):
    issues = platform_health.issues(logs(spark, d), NOW, COST_DAY, LIMITS)
    return spelled(mon.top_issues(issues))


@case("mon_recommendations", f"""
    SELECT *, CASE type
        WHEN 'pipeline_failure' THEN 'Pipeline restart initiated and resources scaled'
        WHEN 'data_staleness' THEN 'Manual pipeline trigger initiated'
        WHEN 'storage_issues' THEN 'Storage optimization and cleanup initiated'
        WHEN 'performance_degradation' THEN 'Performance optimization applied'
        WHEN 'cost_anomaly' THEN 'Cost optimization measures applied'
        WHEN 'data_quality_failure' THEN 'Data quality remediation applied'
        END AS suggested_action
    FROM ({_ALL})""", "runs files")
def _(spark, d):
    issues = platform_health.issues(logs(spark, d), NOW, COST_DAY, LIMITS)
    return spelled(mon.recommendations(issues))


_HEALTH = f"""
    SELECT count(*) AS issue_count,
           CASE WHEN count(*) = 0 THEN 'HEALTHY' WHEN count(*) <= 3 THEN 'DEGRADED'
                ELSE 'CRITICAL' END AS overall_health FROM ({_ALL})"""


@case("mon_overall_health", _HEALTH, "runs files")
def _(spark, d):
    found = platform_health.issues(logs(spark, d), NOW, COST_DAY, LIMITS)
    return mon.overall_health(found)


@case("mon_check_errors", f"""
    SELECT type, severity, message FROM ({_ALL}) WHERE type NOT IN ('storage_issues', 'cost_anomaly')
    UNION ALL SELECT 'monitoring_error', 'MEDIUM', 'Check storage could not be made'
    UNION ALL SELECT 'monitoring_error', 'LOW', 'Check cost could not be made'""", "runs files")
def _(spark, d):
    """All checks, with one log that is missing and one that lacks a column."""
    whole = logs(spark, d)
    broken = replace(
        whole, files=lambda: spark.read.parquet(f"{d}/no_such_log.parquet"),
        costs=whole.costs.drop("cost"),
    )
    return platform_health.issues(broken, NOW, COST_DAY, LIMITS).drop("details")


@case("flow_platform_health", _HEALTH, "runs files")
def _(spark, d):
    return platform_health.run(logs(spark, d), NOW, COST_DAY, thresholds=LIMITS)


@case("flow_run_health", """
    SELECT pipeline_name, strftime(max(run_start), '%Y-%m-%d %H:%M:%S.%f') AS execution_timestamp,
           '1.0.0' AS pipeline_version,
           count(DISTINCT CASE WHEN layer = 'bronze' THEN table_name END) AS bronze_tables_count,
           count(DISTINCT CASE WHEN layer = 'silver' THEN table_name END) AS silver_tables_count,
           count(DISTINCT CASE WHEN layer = 'gold' THEN table_name END) AS gold_tables_count,
           count(*) FILTER (status = 'Failed') = 0 AS quality_checks_passed,
           date_sub('minute', min(run_start), max(run_start)) AS execution_duration_minutes,
           arg_max(status, (run_start, run_id)) AS status
    FROM runs GROUP BY 1""", "runs")
def _(spark, d):
    return mon.run_health(star.pipeline_runs(spark, d))
