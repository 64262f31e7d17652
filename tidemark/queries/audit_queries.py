"""Queries: audit state, decisions and gates over a log derived from the events table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from ..operators import audit_state, decisions, gates
from .base import AUDIT, AUDIT_WIDE, audit, lifecycle, query

NOW = dt.datetime(2024, 1, 31, tzinfo=dt.timezone.utc)
NOW_SQL = "TIMESTAMP '2024-01-31 00:00:00'"
STALE = 240.0
RUN = "run_1"
SUCCESS_SQL = "status IN ('ARCHIVED', 'ARCHIVED_AND_DELETED', 'RECOVERY_ARCHIVE_ROLLED_BACK')"


def newest_sql(columns: str, where: str = "TRUE", keys: str = "table_name, year", log: str = AUDIT) -> str:
    return f"""
    SELECT {keys}, {columns} FROM (
        SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY created_at DESC NULLS LAST, audit_id DESC) AS rn
        FROM ({log}) a WHERE {where}) w WHERE rn = 1
    """


@query(
    "audit_append",
    f"""
    SELECT audit_id, archive_run_id, table_name, year, status, record_count, watermark_value, source_year_count
    FROM ({AUDIT}) a
    """,
)
def audit_append(spark, d) -> DataFrame:
    _, log = lifecycle(spark)
    rows = audit(spark, d)
    log.append(rows.where("status <> 'DRY_RUN'"))
    log.append(rows.where("status = 'DRY_RUN'"))
    return log.rows().select(
        "audit_id", "archive_run_id", "table_name", "year", "status", "record_count",
        "watermark_value", "source_year_count",
    )


@query("latest_status", newest_sql("status, archive_run_id"))
def latest_status(spark, d) -> DataFrame:
    return audit_state.latest_status(audit(spark, d))


@query("last_success", newest_sql("status, watermark_value, source_year_count", SUCCESS_SQL))
def last_success(spark, d) -> DataFrame:
    return audit_state.last_success(audit(spark, d))


@query(
    "prior_archived",
    newest_sql("archive_run_id, created_at AS archived_at, record_count", "status = 'ARCHIVED'"),
)
def prior_archived(spark, d) -> DataFrame:
    return audit_state.prior_archived(audit(spark, d))


@query(
    "verify_failed_flag",
    f"SELECT table_name, year, bool_or(status = 'VERIFY_FAILED') AS verify_failed FROM ({AUDIT_WIDE}) a GROUP BY 1, 2",
)
def verify_failed_flag(spark, d) -> DataFrame:
    return audit_state.verify_failed_flag(audit(spark, d, AUDIT_WIDE))


@query(
    "delete_blockers",
    f"""
    WITH a AS ({AUDIT}),
    cut AS (SELECT table_name, year, max(created_at) AS after_created_at FROM a WHERE status = 'ARCHIVED' GROUP BY 1, 2)
    SELECT table_name, year, audit_id AS blocker_audit_id, created_at AS deleted_at FROM (
        SELECT a.*, row_number() OVER (PARTITION BY a.table_name, a.year ORDER BY created_at DESC, audit_id DESC) AS rn
        FROM a JOIN cut USING (table_name, year)
        WHERE status = 'ARCHIVED_AND_DELETED' AND created_at > after_created_at) w WHERE rn = 1
    """,
)
def delete_blockers(spark, d) -> DataFrame:
    log = audit(spark, d)
    cutoffs = audit_state.prior_archived(log).select(
        "table_name", "year", F.col("archived_at").alias("after_created_at")
    )
    return audit_state.delete_blockers(log, cutoffs)


@query(
    "owned_slices",
    f"SELECT DISTINCT table_name, year, archive_run_id FROM ({AUDIT}) a WHERE status = 'ARCHIVED'",
)
def owned_slices(spark, d) -> DataFrame:
    return audit_state.owned_slices(audit(spark, d))


OPEN_SQL = """
    SELECT s.audit_id, s.table_name, s.year, s.archive_run_id, s.created_at FROM ({log}) s
    WHERE s.status = 'STARTED' AND NOT EXISTS (
        SELECT 1 FROM ({log}) t WHERE t.table_name = s.table_name AND t.year = s.year
        AND t.archive_run_id = s.archive_run_id AND t.status <> 'STARTED')
"""


@query("open_runs", OPEN_SQL.format(log=AUDIT))
def open_runs(spark, d) -> DataFrame:
    return audit_state.open_runs(audit(spark, d))


def _probe_sql(keys: str, more: str, log: str = AUDIT) -> str:
    age = f"greatest(0.0, (epoch_us({NOW_SQL}) - epoch_us(created_at)) / 3.6e9)"
    return f"""
    SELECT {keys}, archive_run_id AS foreign_run_id{more}, {age} AS age_hours,
           {age} < {STALE} AS is_concurrent, NOT ({age} < {STALE}) AS is_stale
    FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY created_at DESC, audit_id DESC) AS rn
          FROM ({OPEN_SQL.format(log=log)}) o WHERE archive_run_id <> '{RUN}') w WHERE rn = 1
    """


@query("concurrency_probe", _probe_sql("table_name, year", ""))
def concurrency_probe(spark, d) -> DataFrame:
    return audit_state.concurrency_probe(audit(spark, d), RUN, NOW, STALE)


@query("busy_tables", _probe_sql("table_name", ", year AS foreign_year"))
def busy_tables(spark, d) -> DataFrame:
    return audit_state.busy_tables(audit(spark, d), RUN, NOW, STALE)


@query(
    "delete_eligibility",
    f"""
    WITH s AS (SELECT DISTINCT table_name, year FROM ({AUDIT_WIDE}) a),
    ok AS ({newest_sql("status", SUCCESS_SQL, log=AUDIT_WIDE)}),
    con AS ({_probe_sql("table_name, year", "", AUDIT_WIDE)}),
    vf AS (SELECT DISTINCT table_name, year FROM ({AUDIT_WIDE}) a WHERE status = 'VERIFY_FAILED')
    SELECT table_name, year, last_status, reason IS NULL AS eligible, reason FROM (
        SELECT s.table_name, s.year, ok.status AS last_status,
               CASE WHEN coalesce(ok.status, '') <> 'ARCHIVED' THEN 'not_archived_state'
                    WHEN coalesce(con.is_concurrent, FALSE) THEN 'concurrent_foreign_run'
                    WHEN vf.table_name IS NOT NULL THEN 'verify_failed_present' END AS reason
        FROM s LEFT JOIN ok USING (table_name, year) LEFT JOIN con USING (table_name, year)
               LEFT JOIN vf ON vf.table_name = s.table_name AND vf.year = s.year) x
    """,
)
def delete_eligibility(spark, d) -> DataFrame:
    return audit_state.delete_eligibility(audit(spark, d, AUDIT_WIDE), RUN, NOW, STALE)


# Slice facts derived per (table, year) of the log, so that every branch is reached.
SLICE_FACTS = f"""
SELECT table_name, year, slice_state, n % 2 = 0 AS delete_after, n AS kept_rows, n % 3 AS new_rows FROM (
    SELECT table_name, year, count(*) AS n,
           CASE (min(source_year_count) / 10 + year) % 5 WHEN 0 THEN 'MISSING' WHEN 1 THEN 'ORPHAN' ELSE 'VALID' END AS slice_state
    FROM (SELECT table_name, year, source_year_count FROM ({AUDIT_WIDE}) a) b GROUP BY table_name, year) c
"""


@query(
    "resolve_actions",
    f"""
    WITH f AS ({SLICE_FACTS}),
    ok AS ({newest_sql("status, watermark_value, created_at, audit_id", SUCCESS_SQL, log=AUDIT_WIDE)}),
    wi AS ({newest_sql("created_at, audit_id", "status = 'RECOVERY_ARCHIVE_DELETED'", log=AUDIT_WIDE)}),
    ow AS (SELECT DISTINCT table_name, year FROM ({AUDIT_WIDE}) a WHERE status = 'ARCHIVED' AND archive_run_id = '{RUN}'),
    vf AS (SELECT DISTINCT table_name, year FROM ({AUDIT_WIDE}) a WHERE status = 'VERIFY_FAILED'),
    j AS (SELECT f.*, ok.status AS last_status, ok.watermark_value AS high_water,
                 coalesce(wi.created_at > ok.created_at OR (wi.created_at = ok.created_at AND wi.audit_id > ok.audit_id), FALSE) AS wiped,
                 ow.table_name IS NOT NULL AS owned, vf.table_name IS NOT NULL AS failed
          FROM f LEFT JOIN ok ON ok.table_name = f.table_name AND ok.year = f.year
                 LEFT JOIN wi ON wi.table_name = f.table_name AND wi.year = f.year
                 LEFT JOIN ow ON ow.table_name = f.table_name AND ow.year = f.year
                 LEFT JOIN vf ON vf.table_name = f.table_name AND vf.year = f.year),
    r AS (SELECT *, CASE
            WHEN slice_state = 'MISSING' AND last_status = 'ARCHIVED_AND_DELETED' THEN 'ERROR:missing_folder_after_delete'
            WHEN slice_state = 'ORPHAN' THEN 'ERROR:archive_folder_orphan'
            WHEN slice_state = 'VALID' AND last_status IS NULL THEN 'ERROR:archive_folder_orphan'
            WHEN slice_state = 'VALID' AND last_status = 'ARCHIVED_AND_DELETED' THEN 'SKIP'
            WHEN slice_state = 'VALID' AND wiped THEN 'CREATE'
            WHEN slice_state = 'VALID' AND last_status = 'ARCHIVED' AND delete_after AND owned THEN 'RESUME_DELETE'
            WHEN slice_state = 'MISSING' THEN 'CREATE'
            WHEN high_water IS NULL THEN 'ERROR:cannot_determine_incremental_position'
            WHEN new_rows = 0 THEN 'SKIP'
            WHEN failed THEN 'ERROR:verify_failed_requires_reconcile'
            ELSE 'APPEND' END AS v FROM j)
    SELECT table_name, year, split_part(v, ':', 1) AS action, nullif(split_part(v, ':', 2), '') AS reason,
           CAST(CASE v WHEN 'CREATE' THEN kept_rows WHEN 'APPEND' THEN new_rows ELSE 0 END AS BIGINT) AS would_archive
    FROM r
    """,
)
def resolve_actions(spark, d) -> DataFrame:
    log = audit(spark, d, AUDIT_WIDE)
    facts = spark.sql(SLICE_FACTS.replace(" / 10", " div 10"))
    keys = ["table_name", "year"]
    state = (
        facts.join(audit_state.slice_summary(log, RUN), keys, "left")
        .withColumnRenamed("last_watermark", "high_water")
    )
    return decisions.resolve(state, live=True).select(*keys, "action", "reason", "would_archive")


# Rollback requests: one per audit row, some of them wrong in one way or another.
GATE_LOG = AUDIT_WIDE.replace(
    "       ts AS created_at,", "       CASE WHEN event_id % 23 = 0 THEN NULL ELSE ts END AS created_at,"
)
REQUESTS = f"""
SELECT CASE WHEN CAST(audit_id AS BIGINT) % 19 = 0 THEN 'x' || audit_id ELSE audit_id END AS target_audit_id,
       CASE WHEN CAST(audit_id AS BIGINT) % 13 = 0 THEN 'tbl_other' ELSE table_name END AS table_id,
       CASE WHEN CAST(audit_id AS BIGINT) % 17 = 0 THEN CAST(year + 1 AS INT) ELSE year END AS year
FROM ({GATE_LOG}) q
"""
GATE_STATES = f"""
SELECT DISTINCT table_name AS table_id, year, CASE WHEN year % 5 = 0 THEN 'MISSING' ELSE 'VALID' END AS slice_state
FROM ({GATE_LOG}) s
"""
REACHABLE = f"""
SELECT DISTINCT table_name AS table_id, year, archive_delta_version AS version FROM ({GATE_LOG}) v
WHERE archive_delta_version BETWEEN 0 AND 2
"""


@query(
    "rollback_gates",
    f"""
    WITH a AS ({GATE_LOG}), q AS ({REQUESTS}), st AS ({GATE_STATES}), re AS ({REACHABLE}),
    del AS (SELECT table_name, year, max(created_at) AS deleted_at FROM a WHERE status = 'ARCHIVED_AND_DELETED' GROUP BY 1, 2)
    SELECT q.target_audit_id, q.table_id, q.year, a.archive_delta_version AS target_version,
           CASE WHEN a.audit_id IS NULL THEN 'target_not_found'
                WHEN a.table_name <> q.table_id THEN 'target_wrong_table'
                WHEN a.status NOT IN ('ARCHIVED', 'RECOVERY_ARCHIVE_ROLLED_BACK') THEN 'target_status_not_rollbackable'
                WHEN a.created_at IS NULL THEN 'target_missing_created_at'
                WHEN a.year IS NULL THEN 'target_missing_year'
                WHEN a.year <> q.year THEN 'target_wrong_year'
                WHEN del.deleted_at > a.created_at THEN 'rollback_after_source_delete_refused'
                WHEN a.archive_delta_version IS NULL THEN 'target_missing_version'
                WHEN coalesce(st.slice_state, 'MISSING') <> 'VALID' THEN 'target_version_unavailable'
                WHEN re.table_id IS NULL THEN 'target_version_vacuumed' END AS refused_by
    FROM q LEFT JOIN a ON a.audit_id = q.target_audit_id
           LEFT JOIN del ON del.table_name = q.table_id AND del.year = q.year
           LEFT JOIN st ON st.table_id = q.table_id AND st.year = q.year
           LEFT JOIN re ON re.table_id = q.table_id AND re.year = q.year AND re.version = a.archive_delta_version
    """,
)
def rollback_gates(spark, d) -> DataFrame:
    log = audit(spark, d, GATE_LOG)
    return gates.rollback_gates(
        spark.sql(REQUESTS), log, spark.sql(GATE_STATES), spark.sql(REACHABLE)
    )
