"""Reports over DRY_RUN audit rows."""

from __future__ import annotations

import datetime as dt
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import rules as R, watermarks as W
from ..functions.skew import unique_lookup
from ..schemas import NO_PREVIOUS_RUN
from ..session import local_frame
from ..sources.audit_log import PAYLOAD_DDL
from ..sources.slices import SliceStore
from ..sources.tables import Source


def dry_runs(log: DataFrame) -> DataFrame:
    """DRY_RUN rows with the JSON payload parsed once, typed."""
    return log.where(F.col("status") == "DRY_RUN").withColumn(
        "payload", F.from_json("conditions_applied", PAYLOAD_DDL)
    )


def latest_run(log: DataFrame) -> DataFrame:
    """One-row DataFrame with the run of the newest DRY_RUN row."""
    return log.where(F.col("status") == "DRY_RUN").agg(
        F.max(F.struct("created_at", "audit_id", "archive_run_id")).getField("archive_run_id").alias("archive_run_id")
    )


def _selected(log: DataFrame, run_id: str | None) -> DataFrame:
    runs = dry_runs(log)
    if run_id:
        return runs.where(F.col("archive_run_id") == run_id)
    return runs.join(F.broadcast(latest_run(log)), "archive_run_id", "left_semi")


def _eligible() -> Column:
    return F.col("payload.total_eligible")


def _would() -> Column:
    return F.col("payload.would_archive")


def summary(log: DataFrame, run_id: str | None = None) -> DataFrame:
    """Counts per table and year of one dry run (the newest by default)."""
    action = F.col("payload.action")
    held = F.when(action.isin("WOULD_APPEND", "SKIP"), _eligible() - _would()).otherwise(F.lit(0))
    return _selected(log, run_id).select(
        "audit_id",
        "archive_run_id",
        "table_name",
        "year",
        _eligible().alias("total_eligible"),
        _would().alias("would_archive"),
        # on an append or skip the difference is mostly rows already archived
        (_eligible() - _would() - held).alias("protected_by_conditions"),
        held.alias("archived_or_protected"),
        F.coalesce("null_date_count", F.lit(0)).alias("null_date_count"),
        "created_at",
    )


def rollup(log: DataFrame) -> DataFrame:
    """Totals per dry run."""
    return (
        dry_runs(log)
        .groupBy("archive_run_id", "archived_by")
        .agg(
            F.min("created_at").alias("run_started_at"),
            F.countDistinct("table_name").alias("tables_scanned"),
            F.sum(_eligible()).alias("total_eligible_rows"),
            F.sum(_would()).alias("total_would_archive"),
            (F.sum(_eligible()) - F.sum(_would())).alias("total_protected"),
        )
        .orderBy(F.col("run_started_at").desc())
    )


def drift(log: DataFrame, run_id: str | None = None) -> DataFrame:
    """Selected dry run against the previous run of the same slice.

    A run's latest row per slice stands for the run. "Previous" is the greatest earlier row
    of another run, found by a join and a mergeable maximum rather than a window, so a
    slice that owns much of the log is spread over many tasks.
    """
    keys = ["table_name", "year"]
    row = F.struct("created_at", "audit_id", _would().alias("would_archive"), "archive_run_id")
    per_run = (
        dry_runs(log).groupBy(*keys, "archive_run_id").agg(F.max(row).alias("row")).select(*keys, "archive_run_id", "row")
    )
    if run_id:
        current = per_run.where(F.col("archive_run_id") == run_id)
    else:
        current = per_run.join(F.broadcast(latest_run(log)), "archive_run_id", "left_semi")
    current = current.select(*keys, F.col("row").alias("now"))
    earlier = (
        per_run.join(current, keys)
        .where(F.col("row") < F.col("now"))
        .groupBy(*keys)
        .agg(F.max("row").alias("before"))
    )
    now, before = F.col("now.would_archive"), F.col("before.would_archive")
    delta = now - F.coalesce(before, F.lit(0))
    return (
        current.join(earlier, keys, "left")
        .select(
            *keys,
            now.alias("current_count"),
            before.alias("previous_count"),
            delta.alias("delta"),
            F.round(F.lit(100.0) * delta / F.nullif(before, F.lit(0)), 2).alias("delta_pct"),
            F.col("now.archive_run_id").alias("current_run"),
            F.coalesce("before.archive_run_id", F.lit(NO_PREVIOUS_RUN)).alias("previous_run"),
        )
        .orderBy(F.abs("delta").desc())
    )


def quality(log: DataFrame, run_id: str | None = None) -> DataFrame:
    """Rows of the summary with NULL dates or protected rows."""
    return summary(log, run_id).where("null_date_count > 0 OR total_eligible <> would_archive").orderBy(
        F.col("null_date_count").desc(), "table_name"
    )


def breakdown(log: DataFrame, run_id: str | None = None) -> DataFrame:
    """Rows each rule protects, rules with none left out."""
    return (
        _selected(log, run_id)
        .select(
            "audit_id",
            "archive_run_id",
            "table_name",
            "year",
            F.explode("payload.per_condition_counts").alias("condition_name", "rows_protected"),
        )
        .where("rows_protected > 0")
        .orderBy(F.col("rows_protected").desc(), "table_name")
    )


def slice_health(eligible: DataFrame, states: DataFrame) -> DataFrame:
    """Eligible slices whose archive is missing or orphaned."""
    known = states.select("table_id", F.col("year").alias("slice_year"), "slice_state")
    return (
        eligible.join(known, ["table_id", "slice_year"], "left")
        .withColumn("slice_state", F.coalesce("slice_state", F.lit("MISSING")))
        .where("slice_state <> 'VALID'")
    )


def late_arrivals(source: DataFrame, archived: DataFrame, marks: DataFrame) -> DataFrame:
    """Source rows at or below a slice's high-water mark that the slice does not hold.

    The incremental append never sees them. Rows are compared as multisets in two steps.
    First two row hashes per row are counted on both sides, combined map-side, so a few
    bytes per row are shuffled and copies of one row do not pile up. Then only rows whose
    hashes are in surplus are compared column by column and reported once with their count.

    ``source`` has slice_year and _wm; ``marks`` (slice_year, high_water) has one row per
    calendar year, hence broadcast.
    """
    columns = [c for c in archived.columns if c != "slice_year"]
    key = ["slice_year", "_h1", "_h2"]
    hashes = [
        F.xxhash64(*[F.col(f"`{c}`") for c in columns]).alias("_h1"),
        F.xxhash64(F.lit(17), *[F.col(f"`{c}`") for c in columns]).alias("_h2"),
    ]
    below = source.join(F.broadcast(marks), "slice_year").where(F.col("_wm") <= F.col("high_water"))
    have = below.select("slice_year", *columns, *hashes, F.lit(1).alias("_n"))
    held = archived.select("slice_year", *columns, *hashes, F.lit(-1).alias("_n"))
    counted = have.select(*key, "_n").unionByName(held.select(*key, "_n"))
    surplus = unique_lookup(counted, key, F.sum("_n").alias("_n")).where("_n > 0").drop("_n")
    suspects = have.join(surplus, key, "left_semi").unionByName(held.join(surplus, key, "left_semi"))
    return suspects.groupBy("slice_year", *columns).agg(F.sum("_n").alias("copies")).where("copies > 0")


def late_rows(source: Source, store: SliceStore, as_of: dt.date) -> DataFrame:
    """``late_arrivals`` of one table: reads the marked years only, without protected rows."""
    marks = store.latest().where(F.col("table_id") == source.table_id).select(
        F.col("year").alias("slice_year"), F.col("wm_hi").alias("high_water")
    ).where("high_water IS NOT NULL")
    marks = local_frame(store.spark, [tuple(r) for r in marks.collect()], "slice_year INT, high_water TIMESTAMP_NTZ")
    years = [r.slice_year for r in marks.collect()]  # one per slice
    marked = [source.in_years(a, b) for a, b in W.year_runs(years)]
    rows = source.rows.where(reduce(or_, marked, F.lit(False)))
    rows = source.flagged(as_of, rows).where(F.col(R.KEEP)).withColumn("_wm", source.instant())
    return late_arrivals(rows, store.read(source.table_id, years), marks)
