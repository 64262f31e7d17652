"""Queries: reports over dry-run rows derived from the events table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators import reports
from ..sources.audit_log import dry_run_payload
from .base import query, read

ACTIONS = "CASE event_id % 4 WHEN 0 THEN 'WOULD_ARCHIVE' WHEN 1 THEN 'WOULD_APPEND' WHEN 2 THEN 'SKIP' ELSE 'WOULD_DELETE' END"

PLAIN = f"""
SELECT CAST(event_id AS STRING) AS audit_id, 'run_' || CAST(event_id % 40 AS STRING) AS archive_run_id,
       'tbl_' || CAST(user_id % 12 AS STRING) AS table_name, CAST(2015 + event_id % 9 AS INT) AS year,
       CASE event_type WHEN 'view' THEN 'DRY_RUN' WHEN 'click' THEN 'DRY_RUN' ELSE 'ARCHIVED' END AS status,
       {ACTIONS} AS action,
       CAST(floor(value * 10) AS BIGINT) AS total_eligible, CAST(floor(value * 7) AS BIGINT) AS would_archive,
       CAST(event_id % 3 AS BIGINT) AS c1, CAST(event_id % 5 AS BIGINT) AS c2,
       CAST(CASE WHEN event_id % 6 = 0 THEN event_id % 4 ELSE NULL END AS BIGINT) AS null_date_count,
       'user_' || CAST(event_id % 2 AS STRING) AS archived_by, ts AS created_at
FROM events
"""
DRY = f"SELECT * FROM ({PLAIN}) p WHERE status = 'DRY_RUN'"
LATEST = f"SELECT archive_run_id FROM ({DRY}) l ORDER BY created_at DESC, audit_id DESC LIMIT 1"


def log(spark, d) -> DataFrame:
    read(spark, d, "events")
    counts = F.create_map(F.lit("c1"), F.col("c1"), F.lit("c2"), F.col("c2"))
    return spark.sql(PLAIN).withColumn(
        "conditions_applied",
        dry_run_payload(F.col("action"), counts, F.col("total_eligible"), F.col("would_archive")),
    ).drop("action", "total_eligible", "would_archive", "c1", "c2")


SUMMARY_SQL = f"""
    SELECT audit_id, archive_run_id, table_name, year, total_eligible, would_archive,
           CASE WHEN action IN ('WOULD_APPEND', 'SKIP') THEN 0 ELSE total_eligible - would_archive END AS protected_by_conditions,
           CASE WHEN action IN ('WOULD_APPEND', 'SKIP') THEN total_eligible - would_archive ELSE 0 END AS archived_or_protected,
           coalesce(null_date_count, 0) AS null_date_count, created_at
    FROM ({DRY}) s WHERE archive_run_id = ({LATEST})
"""


@query("dryrun_summary", SUMMARY_SQL)
def dryrun_summary(spark, d) -> DataFrame:
    return reports.summary(log(spark, d))


@query(
    "dryrun_rollup",
    f"""
    SELECT archive_run_id, archived_by, min(created_at) AS run_started_at,
           count(DISTINCT table_name) AS tables_scanned, CAST(sum(total_eligible) AS BIGINT) AS total_eligible_rows,
           CAST(sum(would_archive) AS BIGINT) AS total_would_archive,
           CAST(sum(total_eligible) - sum(would_archive) AS BIGINT) AS total_protected
    FROM ({DRY}) s GROUP BY 1, 2
    """,
)
def dryrun_rollup(spark, d) -> DataFrame:
    return reports.rollup(log(spark, d))


@query(
    "dryrun_drift",
    f"""
    WITH runs AS (SELECT * FROM (
            SELECT *, row_number() OVER (PARTITION BY table_name, year, archive_run_id ORDER BY created_at DESC, audit_id DESC) AS rn
            FROM ({DRY}) s) x WHERE rn = 1),
    seq AS (SELECT *, lag(would_archive) OVER w AS prev, lag(archive_run_id) OVER w AS prev_run
            FROM runs WINDOW w AS (PARTITION BY table_name, year ORDER BY created_at, audit_id))
    SELECT table_name, year, would_archive AS current_count, prev AS previous_count,
           would_archive - coalesce(prev, 0) AS delta,
           CAST(round(CAST(100.0 * (would_archive - coalesce(prev, 0)) AS DOUBLE) / nullif(prev, 0), 2) AS DOUBLE) AS delta_pct,
           archive_run_id AS current_run, coalesce(prev_run, '(no previous run)') AS previous_run
    FROM seq WHERE archive_run_id = ({LATEST})
    """,
)
def dryrun_drift(spark, d) -> DataFrame:
    return reports.drift(log(spark, d))


@query("dryrun_quality", f"SELECT * FROM ({SUMMARY_SQL}) q WHERE null_date_count > 0 OR total_eligible <> would_archive")
def dryrun_quality(spark, d) -> DataFrame:
    return reports.quality(log(spark, d))


@query(
    "dryrun_breakdown",
    " UNION ALL ".join(
        f"SELECT audit_id, archive_run_id, table_name, year, '{c}' AS condition_name, {c} AS rows_protected "
        f"FROM ({DRY}) s{c} WHERE {c} > 0 AND archive_run_id = ({LATEST})"
        for c in ("c1", "c2")
    ),
)
def dryrun_breakdown(spark, d) -> DataFrame:
    return reports.breakdown(log(spark, d))
