"""What to do with each (table, year): one ``when`` chain over joined state.

Dry and live runs use the same columns, so they cannot disagree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..sources.slices import MISSING, ORPHAN, VALID


def _yes(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(False))


def resolve(state: DataFrame, live: bool = False) -> DataFrame:
    """Add ``action``, ``reason`` and ``would_archive``.

    Needs: slice_state, last_status, delete_after, owned, wiped_since, high_water (audit
    first, else the slice), kept_rows, new_rows, verify_failed; optionally empty_slice. First
    match wins.
    """
    missing = F.col("slice_state") == MISSING
    valid = F.col("slice_state") == VALID
    last = F.coalesce(F.col("last_status"), F.lit("NONE"))
    deleted = last == "ARCHIVED_AND_DELETED"
    new = F.coalesce(F.col("new_rows"), F.lit(0)) > 0
    empty = _yes("empty_slice") if "empty_slice" in state.columns else F.lit(False)

    verdict = (
        F.when(missing & deleted, _verdict("ERROR", "missing_folder_after_delete"))
        .when(F.col("slice_state") == ORPHAN, _verdict("ERROR", "archive_folder_orphan"))
        .when(valid & (last == "NONE"), _verdict("ERROR", "archive_folder_orphan"))
        .when(valid & deleted, _verdict("SKIP"))
        # a wipe newer than the last success empties the slice for good reason: refill it
        .when(valid & _yes("wiped_since"), _verdict("CREATE"))
        .when(valid & (last == "ARCHIVED") & _yes("delete_after") & _yes("owned"), _verdict("RESUME_DELETE"))
        .when(missing, _verdict("CREATE"))
        # a slice without a row has no position and needs none
        .when(valid & empty & F.col("high_water").isNull(), _verdict("CREATE"))
        .when(F.col("high_water").isNull(), _verdict("ERROR", "cannot_determine_incremental_position"))
        .when(~new, _verdict("SKIP"))
    )
    if live:
        verdict = verdict.when(
            _yes("verify_failed"), _verdict("ERROR", "verify_failed_requires_reconcile")
        )
    verdict = verdict.otherwise(_verdict("APPEND"))
    action = F.col("_verdict.action")
    return (
        state.select("*", verdict.alias("_verdict"))
        .select(
            "*",
            action.alias("action"),
            F.col("_verdict.reason").alias("reason"),
            F.when(action == "CREATE", F.coalesce("kept_rows", F.lit(0)))
            .when(action == "APPEND", F.col("new_rows"))
            .otherwise(F.lit(0))
            .cast("bigint")
            .alias("would_archive"),
        )
        .drop("_verdict")
    )


def _verdict(action: str, reason: str | None = None) -> Column:
    return F.struct(F.lit(action).alias("action"), F.lit(reason).cast("string").alias("reason"))


def dry_run_action(action: Column) -> Column:
    """Live action as the word a dry run records."""
    return (
        F.when(action == "CREATE", "WOULD_ARCHIVE")
        .when(action == "APPEND", "WOULD_APPEND")
        .when(action == "RESUME_DELETE", "WOULD_DELETE")
        .otherwise(action)
    )


def drift(counts: DataFrame, profile: DataFrame) -> DataFrame:
    """Archived rows against current source rows, per slice; both inputs are per-year rows."""
    return (
        counts.join(profile.where("slice_year IS NOT NULL").select("slice_year", "kept_rows"), "slice_year", "left")
        .select(
            "slice_year",
            F.col("row_count").alias("archive_count"),
            F.coalesce("kept_rows", F.lit(0)).alias("source_count"),
        )
        .withColumn("drifted", F.col("archive_count") != F.col("source_count"))
    )


def delete_plan(scope: DataFrame, eligibility: DataFrame, busy: DataFrame, counts: DataFrame) -> DataFrame:
    """One row per requested year with the action of the delete job and its reason.

    scope: (table_id, slice_year, source_count). eligibility, busy: audit state.
    counts: (table_id, slice_year, slice_state, archive_count).
    """
    table_busy = busy.where("is_concurrent").select(
        F.col("table_name").alias("table_id"), F.lit(True).alias("busy"), "foreign_run_id"
    )
    joined = (
        scope.join(
            eligibility.select(
                F.col("table_name").alias("table_id"),
                F.col("year").alias("slice_year"),
                "eligible",
                F.col("reason").alias("not_eligible"),
            ),
            ["table_id", "slice_year"],
            "left",
        )
        .join(table_busy, "table_id", "left")
        .join(counts, ["table_id", "slice_year"], "left")
    )
    blocked = _yes("busy")
    eligible = _yes("eligible")
    absent = F.coalesce(F.col("slice_state"), F.lit(MISSING)) != VALID
    drifted = F.coalesce("archive_count", F.lit(0)) != F.coalesce("source_count", F.lit(0))
    return joined.select(
        "table_id",
        "slice_year",
        F.when(blocked, "SKIP_CONCURRENT")
        .when(~eligible, "SKIP_NOT_ELIGIBLE")
        .when(absent, "ERROR")
        .when(drifted, "SKIP_DRIFT")
        .otherwise("WOULD_DELETE")
        .alias("action"),
        F.when(blocked, "concurrent_run_on_table")
        .when(~eligible, F.coalesce("not_eligible", F.lit("not_archived_state")))
        .when(absent, "archive_slice_missing")
        .when(drifted, "source_drift")
        .alias("reason"),
        F.coalesce("archive_count", F.lit(0)).cast("bigint").alias("archive_count"),
        F.coalesce("source_count", F.lit(0)).cast("bigint").alias("source_count"),
    )
