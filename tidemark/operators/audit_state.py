"""State queries over the audit log, for every slice at once.

"The newest row" is ``max(struct(created_at, audit_id, ...))``: a mergeable aggregate that
combines map-side, so a slice with a third of all log rows is not one task's window.
``audit_id`` breaks ties.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import watermarks as W
from ..functions.skew import unique_lookup
from ..schemas import SUCCESS_STATUSES, TERMINAL_STATUSES

SLICE = ("table_name", "year")
NO_RUN = "00000000-0000-0000-0000-000000000000"


def newest(fields: list[str], where: Column | None = None) -> Column:
    row = F.struct("created_at", "audit_id", *fields)
    return F.max(row if where is None else F.when(where, row))


def _pick(log: DataFrame, keys, fields: list[str], where: Column | None = None) -> DataFrame:
    rows = log if where is None else log.where(where)
    return (
        rows.groupBy(*keys)
        .agg(newest([f for f in fields if f != "created_at"]).alias("_newest"))
        .select(*keys, *[F.col(f"_newest.{f}").alias(f) for f in fields])
    )


def latest_status(log: DataFrame) -> DataFrame:
    return _pick(log, SLICE, ["status", "archive_run_id"])


def last_success(log: DataFrame) -> DataFrame:
    return _pick(
        log,
        SLICE,
        ["status", "watermark_value", "source_year_count"],
        F.col("status").isin(*SUCCESS_STATUSES),
    )


def prior_archived(log: DataFrame) -> DataFrame:
    """Newest ARCHIVED row per slice: run, time and the rows that run wrote (may be NULL)."""
    return (
        log.where(F.col("status") == "ARCHIVED")
        .groupBy(*SLICE)
        .agg(newest(["archive_run_id", "record_count"]).alias("_newest"))
        .select(
            *SLICE,
            F.col("_newest.archive_run_id").alias("archive_run_id"),
            F.col("_newest.created_at").alias("archived_at"),
            F.col("_newest.record_count").alias("record_count"),
        )
    )


def verify_failed_flag(log: DataFrame, since: dt.datetime | None = None) -> DataFrame:
    """Whether a slice ever had VERIFY_FAILED; it blocks appends and deletes.

    ``since`` lets an operator who has reconciled the slice ignore older failures.
    """
    failed = F.col("status") == "VERIFY_FAILED"
    if since is not None:
        failed = failed & (F.col("created_at") > F.lit(since))
    return log.groupBy(*SLICE).agg(F.bool_or(failed).alias("verify_failed"))


def delete_blockers(log: DataFrame, cutoffs: DataFrame | None = None) -> DataFrame:
    """Newest ARCHIVED_AND_DELETED row per slice, optionally only if after a per-slice cutoff.

    ``cutoffs`` is (table_name, year, after_created_at), one row per slice. The newest delete
    is after the cutoff exactly when any is, so the log is aggregated before the join.
    """
    found = (
        log.where(F.col("status") == "ARCHIVED_AND_DELETED")
        .groupBy(*SLICE)
        .agg(newest([]).alias("_newest"))
        .select(
            *SLICE,
            F.col("_newest.audit_id").alias("blocker_audit_id"),
            F.col("_newest.created_at").alias("deleted_at"),
        )
    )
    if cutoffs is None:
        return found
    return found.join(cutoffs, list(SLICE)).where("deleted_at > after_created_at").drop("after_created_at")


def owned_slices(log: DataFrame, run_id: str | None = None) -> DataFrame:
    """Slices for which a run has an ARCHIVED row; only that run may resume the delete."""
    archived = log.where(F.col("status") == "ARCHIVED")
    if run_id is not None:
        archived = archived.where(F.col("archive_run_id") == run_id)
    return archived.select(*SLICE, "archive_run_id").distinct()


def open_runs(log: DataFrame) -> DataFrame:
    """STARTED rows whose run has no terminal row for the same table and year."""
    keys = [*SLICE, "archive_run_id"]
    finished = unique_lookup(log.where(F.col("status").isin(*TERMINAL_STATUSES)), keys)
    return (
        log.where(F.col("status") == "STARTED")
        .join(finished, keys, "left_anti")
        .select("audit_id", *keys, "created_at")
    )


def concurrency_probe(
    log: DataFrame, run_id: str | None, as_of: dt.datetime, stale_hours: float = 4.0
) -> DataFrame:
    """Newest foreign open run per slice: concurrent while fresh, stale after that."""
    return _probe(log, SLICE, ["archive_run_id"], run_id, as_of, stale_hours)


def busy_tables(
    log: DataFrame, run_id: str | None, as_of: dt.datetime, stale_hours: float = 4.0
) -> DataFrame:
    """The same per table: a fresh foreign run on any year blocks the whole table."""
    return _probe(log, ("table_name",), ["archive_run_id", "year"], run_id, as_of, stale_hours)


def _probe(log, keys, fields, run_id, as_of, stale_hours) -> DataFrame:
    foreign = open_runs(log).where(F.col("archive_run_id") != F.lit(run_id or NO_RUN))
    found = _pick(foreign, keys, [*fields, "created_at"])
    renamed = found.withColumnRenamed("archive_run_id", "foreign_run_id")
    if "year" in fields:
        renamed = renamed.withColumnRenamed("year", "foreign_year")
    # a log without time zone is taken as UTC, like the stored watermarks
    now = F.lit(as_of.astimezone(dt.timezone.utc).replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp_ntz")
    age = F.timestamp_diff("MICROSECOND", W.instant(renamed, "created_at"), now) / F.lit(3.6e9)
    aged = renamed.withColumn("age_hours", F.greatest(F.lit(0.0), age))
    fresh = F.col("age_hours") < F.lit(float(stale_hours))
    return aged.withColumn("is_concurrent", fresh).withColumn("is_stale", ~fresh).drop("created_at")


def slice_summary(log: DataFrame, run_id: str | None = None, reconciled: DataFrame | None = None) -> DataFrame:
    """Everything the decisions need about each slice, in one aggregation of the log.

    ``owned`` says whether ``run_id`` has an ARCHIVED row for the slice. ``reconciled`` (table_name, year, reconciled_at)
    takes back failures up to that time; its rows go through the same aggregation, so it costs no join.
    """
    status = F.col("status")
    since = F.lit(None)
    if reconciled is not None:
        marks = reconciled.select(*SLICE, F.col("reconciled_at").cast(log.schema["created_at"].dataType).alias("_since"))
        log = log.unionByName(marks, allowMissingColumns=True)
        since = F.max("_since")
    failed_at = F.max(F.when(status == "VERIFY_FAILED", F.col("created_at")))
    return (
        log.groupBy(*SLICE)
        .agg(
            newest(
                ["status", "watermark_value", "source_year_count", "archive_run_id"],
                status.isin(*SUCCESS_STATUSES),
            ).alias("_ok"),
            newest([], status == "RECOVERY_ARCHIVE_DELETED").alias("_wipe"),
            newest(["archive_run_id"], status == "ARCHIVED").alias("_archived"),
            F.coalesce(failed_at > since, failed_at.isNotNull()).alias("verify_failed"),
            F.bool_or((status == "ARCHIVED") & (F.col("archive_run_id") == F.lit(run_id))).alias("owned"),
        )
        .select(
            *SLICE,
            F.col("_ok.status").alias("last_status"),
            F.col("_ok.watermark_value").alias("last_watermark"),
            F.col("_ok.source_year_count").alias("last_source_count"),
            F.col("_archived.archive_run_id").alias("archived_run_id"),
            F.col("_archived.created_at").alias("archived_at"),
            F.coalesce(
                F.struct("_wipe.created_at", "_wipe.audit_id")
                > F.struct("_ok.created_at", "_ok.audit_id"),
                F.lit(False),
            ).alias("wiped_since"),
            "verify_failed",
            F.coalesce("owned", F.lit(False)).alias("owned"),
        )
    )


def delete_eligibility(
    log: DataFrame, run_id: str | None, as_of: dt.datetime, stale_hours: float = 4.0, reconciled: DataFrame | None = None
) -> DataFrame:
    """Three checks in order: last success is ARCHIVED, nobody else runs, no VERIFY_FAILED since a reconciliation."""
    concurrent = concurrency_probe(log, run_id, as_of, stale_hours).select(*SLICE, "is_concurrent")
    reason = (
        F.when(F.coalesce(F.col("last_status"), F.lit("")) != "ARCHIVED", "not_archived_state")
        .when(F.coalesce(F.col("is_concurrent"), F.lit(False)), "concurrent_foreign_run")
        .when(F.col("verify_failed"), "verify_failed_present")
    )
    return (
        slice_summary(log, reconciled=reconciled)
        .join(concurrent, list(SLICE), "left")
        .select(*SLICE, "last_status", reason.isNull().alias("eligible"), reason.alias("reason"))
    )
