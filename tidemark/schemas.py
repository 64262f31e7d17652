"""Declared schemas and enumerations shared by every module."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: status and action vocabularies that users' logs already hold ---
ARCHIVE_STATUSES = (
    "STARTED",
    "DRY_RUN",
    "ARCHIVED",
    "ARCHIVED_AND_DELETED",
    "FAILED",
    "VERIFY_FAILED",
    "SKIPPED",
    "SKIPPED_CONCURRENT",
    "NO_DATA",
    "RECOVERY_ARCHIVE_DELETED",
    "RECOVERY_ARCHIVE_ROLLED_BACK",
)
SUCCESS_STATUSES = ("ARCHIVED", "ARCHIVED_AND_DELETED", "RECOVERY_ARCHIVE_ROLLED_BACK")
ROLLBACK_STATUSES = ("ARCHIVED", "RECOVERY_ARCHIVE_ROLLED_BACK")
RESTORE_STATUSES = ("COMPLETED", "PARTIAL_COMPLETED", "FAILED")
DRY_RUN_ACTIONS = (
    "WOULD_ARCHIVE",
    "WOULD_APPEND",
    "WOULD_DELETE",
    "SKIP_NOT_ELIGIBLE",
    "SKIP_CONCURRENT",
    "SKIP_DRIFT",
    "SKIP",
    "ERROR",
)
RULE_TYPES = ("same_table", "custom_sql")
RULE_OPERATORS = (
    "equals",
    "not_equals",
    "in",
    "within_years",
    "within_months",
    "greater_than",
    "is_not_null",
)
MATCH_STATUSES = ("matched", "ambiguous", "unmatched", "excluded")
UNMATCHED_REASON = "no date column matched — no pattern matched any column"
AMBIGUOUS_PREFIX = "ambiguous date column: "
BELOW_SIZE_FORMAT = "table size %.1f GB is below minimum threshold of %.1f GB"
ADDED_TEXT, UPDATED_TEXT = "added by scan %s", "updated by scan %s"
DROPPED_TEXT, INACTIVE_TEXT = "dropped: not found in scan %s", "marked inactive by scan %s"
NO_PREVIOUS_RUN = "(no previous run)"
EXCLUDED_REASON = "excluded by template exclude_tables"
# --- end of fixed values ---

TERMINAL_STATUSES = tuple(s for s in ARCHIVE_STATUSES if s != "STARTED")


def ddl(text: str) -> T.StructType:
    """A DDL column list as a ``StructType``; needs an active session."""
    return T.StructType.fromDDL(text)


# --- Fixed values: columns of logs and configuration that users' tables already have ---
# Watermarks are kept at microsecond precision, zone-free; zoned columns are stored as UTC.
AUDIT_DDL = """
    audit_id STRING, archive_run_id STRING, table_name STRING, year INT, status STRING,
    record_count BIGINT, conditions_applied STRING, null_date_count BIGINT,
    error_message STRING, watermark_value TIMESTAMP_NTZ, source_year_count BIGINT,
    archive_mode STRING, archived_by STRING, workspace_id STRING, job_id STRING,
    job_run_id STRING, task_run_id STRING, created_at TIMESTAMP, needs_review BOOLEAN,
    archive_delta_version BIGINT
"""

RESTORE_AUDIT_DDL = """
    audit_id STRING, archive_run_id STRING, archive_path STRING, source_table STRING,
    target_catalog STRING, target_schema STRING, years STRING, tables_created INT,
    status STRING, error_message STRING, rehydrated_by STRING, workspace_id STRING,
    job_id STRING, job_run_id STRING, task_run_id STRING, created_at TIMESTAMP
"""

RULE_DDL = (
    "name STRING, scope STRING, column STRING, operator STRING, value STRING, sql STRING"
)

TABLE_CONFIG_DDL = f"""
    table_id STRING, source_catalog STRING, source_schema STRING, source_table STRING,
    watermark_column STRING, retention_years INT, archive_base_path STRING,
    delete_after_archive BOOLEAN, is_active BOOLEAN, reason STRING,
    exclusion_conditions ARRAY<STRUCT<{RULE_DDL.replace(' STRING', ': STRING')}>>,
    modified_by STRING, modified_at TIMESTAMP, change_reason STRING, scan_run_id STRING
"""

# --- end of fixed values ---

MANIFEST_DDL = """
    table_id STRING, year INT, version BIGINT, op STRING, chain BIGINT, dirs ARRAY<STRING>,
    row_count BIGINT, wm_lo TIMESTAMP_NTZ, wm_hi TIMESTAMP_NTZ, schema_ddl STRING,
    run_id STRING, rows_this_run BIGINT, mode STRING, conditions ARRAY<STRING>,
    source_year_count BIGINT, retention_years INT, committed_by STRING, committed_at TIMESTAMP
"""
