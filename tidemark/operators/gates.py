"""Ordered safety gates in front of recovery operations; the first failing gate names itself."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.skew import unique_lookup
from ..schemas import ROLLBACK_STATUSES
from ..sources.slices import VALID


def rollback_gates(
    requests: DataFrame, log: DataFrame, states: DataFrame, recoverable: DataFrame
) -> DataFrame:
    """Check each request (table_id, year, target_audit_id) against log and slice versions.

    Output: the request with ``target_version`` and ``refused_by`` (NULL means allowed).
    Two joins: by audit id, and by slice to one row that holds all there is to know about
    the slice. Both lookup sides are unique, so a hot slice cannot multiply rows.
    """
    target = log.select(
        F.col("audit_id").alias("target_audit_id"),
        F.col("table_name").alias("_table"),
        F.col("year").alias("_year"),
        F.col("status").alias("_status"),
        F.col("created_at").alias("_created_at"),
        F.col("archive_delta_version").alias("target_version"),
        F.lit(True).alias("_found"),
    )
    # A source delete later than the target blocks it. The newest delete of the slice is
    # later than the target exactly when any delete is.
    facts = (
        log.where(F.col("status") == "ARCHIVED_AND_DELETED")
        .select(F.col("table_name").alias("table_id"), "year", F.col("created_at").alias("_deleted_at"))
        .unionByName(states.select("table_id", "year", F.col("slice_state").alias("_state")), allowMissingColumns=True)
        .unionByName(recoverable.select("table_id", "year", F.col("version").alias("_version")), allowMissingColumns=True)
    )
    slices = unique_lookup(
        facts,
        ["table_id", "year"],
        F.max("_deleted_at").alias("_deleted_at"),
        F.max("_state").alias("_state"),
        F.collect_set("_version").alias("_versions"),
    )
    joined = requests.join(target, "target_audit_id", "left").join(slices, ["table_id", "year"], "left")
    refused = (
        F.when(F.col("_found").isNull(), "target_not_found")
        .when(F.coalesce(F.col("_table") != F.col("table_id"), F.lit(True)), "target_wrong_table")
        .when(~F.coalesce(F.col("_status").isin(*ROLLBACK_STATUSES), F.lit(False)), "target_status_not_rollbackable")
        .when(F.col("_created_at").isNull(), "target_missing_created_at")
        .when(F.col("_year").isNull(), "target_missing_year")
        .when(F.col("_year") != F.col("year"), "target_wrong_year")
        .when(F.col("_deleted_at") > F.col("_created_at"), "rollback_after_source_delete_refused")
        .when(F.col("target_version").isNull(), "target_missing_version")
        .when(F.coalesce(F.col("_state") != VALID, F.lit(True)), "target_version_unavailable")
        .when(~F.array_contains("_versions", F.col("target_version")), "target_version_vacuumed")
    )
    return joined.select("target_audit_id", "table_id", "year", "target_version", refused.alias("refused_by"))


def wipe_gates(requests: DataFrame, log: DataFrame, states: DataFrame, live: bool) -> DataFrame:
    """Check each request (table_id, year, wipe_reason): reason, no source delete, slice there."""
    deleted = (
        log.where(F.col("status") == "ARCHIVED_AND_DELETED")
        .select(F.col("table_name").alias("table_id"), "year")
        .distinct()
        .withColumn("_deleted", F.lit(True))
    )
    joined = requests.join(deleted, ["table_id", "year"], "left").join(
        states.select("table_id", "year", "slice_state", "row_count", "version"),
        ["table_id", "year"],
        "left",
    )
    no_reason = F.lit(live) & (F.trim(F.coalesce("wipe_reason", F.lit(""))) == "")
    refused = (
        F.when(no_reason, "reason_required")
        .when(F.col("_deleted"), "delete_archived_after_source_delete_refused")
        .when(F.coalesce(F.col("slice_state") != VALID, F.lit(True)), "delete_archived_target_missing")
    )
    return joined.select(
        "table_id", "year", "wipe_reason", "version", F.coalesce("row_count", F.lit(0)).alias("row_count"),
        refused.alias("refused_by"),
    )
