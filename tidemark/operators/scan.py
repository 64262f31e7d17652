"""Table scanner: find each table's watermark column and propose configuration."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..schemas import (
    ADDED_TEXT, AMBIGUOUS_PREFIX, BELOW_SIZE_FORMAT, DROPPED_TEXT, EXCLUDED_REASON, INACTIVE_TEXT, UNMATCHED_REASON,
    UPDATED_TEXT,
)
from ..session import local_frame

TABLE = ("source_catalog", "source_schema", "source_table")


@dataclass(frozen=True)
class Template:
    """Scan settings of one schema."""

    source_catalog: str
    source_schema: str
    patterns: tuple[str, ...]
    archive_base_path: str = ""
    default_retention_years: int | None = None
    delete_after_archive: bool = False
    min_table_size_gb: float = 0.0
    exclude_tables: tuple[str, ...] = ()


def usable_patterns(patterns) -> list[tuple[int, str]]:
    """Drop patterns that do not compile, keeping the position of the others.

    Patterns run as Java regular expressions inside Spark.
    """
    good = []
    for i, p in enumerate(patterns):
        try:
            re.compile(p)
        except re.error:
            continue
        good.append((i, p))
    return good


def templates_frame(spark: SparkSession, templates: list[Template]) -> DataFrame:
    """Templates as rows, one per schema; a duplicate schema is refused."""
    keys = [(t.source_catalog, t.source_schema) for t in templates]
    if len(set(keys)) != len(keys):
        raise ValueError("duplicate (source_catalog, source_schema) among the templates")
    data = [
        (
            t.source_catalog,
            t.source_schema,
            [{"position": i, "pattern": p} for i, p in usable_patterns(t.patterns)],
            t.archive_base_path,
            t.default_retention_years,
            t.delete_after_archive,
            float(t.min_table_size_gb),
            list(t.exclude_tables),
        )
        for t in templates
    ]
    return local_frame(
        spark,
        data,
        "source_catalog STRING, source_schema STRING, "
        "patterns ARRAY<STRUCT<position: INT, pattern: STRING>>, archive_base_path STRING, "
        "default_retention_years INT, delete_after_archive BOOLEAN, min_table_size_gb DOUBLE, "
        "exclude_tables ARRAY<STRING>",
    )


def match_columns(columns: DataFrame, templates: DataFrame) -> DataFrame:
    """Resolve the watermark column of every table in ``columns``.

    Patterns are tried in order, an exact name before a regular expression within each
    pattern. One hit: matched. Several: ambiguous, and the search stops. None of all:
    unmatched. Only hits are emitted per column, never all column-pattern pairs.
    """
    t = templates.select("source_catalog", "source_schema", "patterns", "exclude_tables")
    scanned = columns.join(F.broadcast(t), ["source_catalog", "source_schema"]).where(
        ~F.array_contains("exclude_tables", F.col("source_table"))
    )
    name = F.col("column_name")
    hits_here = F.filter(
        F.transform(
            "patterns",
            lambda p: F.struct(
                p["position"].alias("position"),
                p["pattern"].alias("pattern"),
                (name == p["pattern"]).alias("exact"),
                F.rlike(name, F.concat(F.lit("^(?:"), p["pattern"], F.lit(")$"))).alias("regex"),
            ),
        ),
        lambda h: h["exact"] | h["regex"],
    )
    per_pattern = (
        scanned.select(*TABLE, "ordinal", "column_name", F.explode(hits_here).alias("hit"))
        .groupBy(*TABLE, "hit.position", "hit.pattern")
        .agg(
            F.collect_list(F.when(F.col("hit.exact"), F.struct("ordinal", "column_name"))).alias("exact"),
            F.collect_list(F.when(F.col("hit.regex"), F.struct("ordinal", "column_name"))).alias("regex"),
        )
        .withColumn(
            "hits",
            F.transform(
                F.sort_array(F.when(F.size("exact") > 0, F.col("exact")).otherwise(F.col("regex"))),
                lambda h: h["column_name"],
            ),
        )
    )
    first = (
        per_pattern.groupBy(*TABLE)
        .agg(F.min_by(F.struct("pattern", "hits"), F.col("position")).alias("first"))
        .select(*TABLE, F.col("first.pattern").alias("matched_pattern"), F.col("first.hits").alias("hits"))
    )
    tables = scanned.select(*TABLE).distinct()
    single = F.size("hits") == 1
    return tables.join(first, list(TABLE), "left").select(
        *TABLE,
        F.when(F.col("hits").isNull(), "unmatched").when(single, "matched").otherwise("ambiguous").alias("match_status"),
        F.when(single, F.col("hits")[0]).alias("matched_column"),
        "matched_pattern",
        F.coalesce("hits", F.array().cast("array<string>")).alias("all_matched_columns"),
    )


def size_gate(size_gb: Column, min_gb: Column) -> Column:
    """NULL when the table is large enough, else the reason it is not; 0 turns the gate off."""
    return F.when(min_gb == 0, F.lit(None).cast("string")).when(
        size_gb.isNull(), "table size unknown"
    ).when(
        size_gb < min_gb,
        F.format_string(BELOW_SIZE_FORMAT, size_gb, min_gb),
    )


def table_id() -> Column:
    return F.concat_ws(".", *TABLE)


def propose(matches: DataFrame, sizes: DataFrame, templates: DataFrame) -> DataFrame:
    """Config rows from match results; ``sizes`` is (TABLE..., size_gb), NULL when unknown.

    A table is active when matched and large enough; otherwise ``reason`` says why not.
    """
    joined = matches.join(sizes, list(TABLE), "left").join(
        F.broadcast(templates.drop("patterns", "exclude_tables")), ["source_catalog", "source_schema"]
    )
    status = F.col("match_status")
    listed = F.concat_ws(", ", "all_matched_columns")
    detail = F.concat(
        F.lit("pattern '"), F.col("matched_pattern"), F.lit("' matched ["), listed, F.lit("]")
    )
    too_small = size_gate(F.col("size_gb"), F.col("min_table_size_gb"))
    reason = (
        F.when(status == "unmatched", UNMATCHED_REASON)
        .when(status == "ambiguous", F.concat(F.lit(AMBIGUOUS_PREFIX), detail))
        .otherwise(too_small)
    )
    return joined.select(
        table_id().alias("table_id"),
        *TABLE,
        F.when(status == "matched", F.col("matched_column")).alias("watermark_column"),
        F.col("default_retention_years").alias("retention_years"),
        "archive_base_path",
        "delete_after_archive",
        reason.isNull().alias("is_active"),
        reason.alias("reason"),
        "match_status",
        "matched_column",
        "matched_pattern",
        "all_matched_columns",
        F.when(status == "ambiguous", detail).alias("ambiguity_detail"),
        F.col("size_gb").alias("table_size_gb"),
        ((status == "matched") & too_small.isNull()).alias("size_check_passed"),
    )


STAGED = (
    "table_id", *TABLE, "watermark_column", "retention_years", "archive_base_path",
    "delete_after_archive", "is_active", "reason",
)


def staging(proposed: DataFrame, scan_run_id: str) -> DataFrame:
    """Rows for the staging table: the business columns, no conditions, and the run."""
    return proposed.select(
        *STAGED, F.lit("scanner").alias("modified_by"), F.lit(scan_run_id).alias("scan_run_id")
    )


def merge(
    existing: DataFrame, staged: DataFrame, scan_run_id: str, force: bool = False, changed_at: Column | None = None
) -> DataFrame:
    """Upsert staged rows into the config: insert new, update scanner-owned (all when forced).

    Rows owned by people stay as they are, and exclusion conditions always survive.
    """
    settable = [c for c in STAGED if c not in ("table_id", *TABLE)]
    old = existing.alias("old")
    new = staged.select("table_id", *TABLE, *settable).alias("new")
    joined = old.join(new, F.col("old.table_id") == F.col("new.table_id"), "full_outer")
    inserted = F.col("old.table_id").isNull()
    updated = F.col("new.table_id").isNotNull() & ~inserted & (
        F.lit(force) | F.coalesce(F.col("old.modified_by") == "scanner", F.lit(False))
    )

    def field(name: str) -> Column:
        if name in settable:
            value = F.when(inserted | updated, F.col(f"new.{name}")).otherwise(F.col(f"old.{name}"))
        elif name in ("table_id", *TABLE):
            value = F.coalesce(f"old.{name}", f"new.{name}")
        elif name == "modified_by":
            value = F.when(inserted, "scanner").otherwise(F.col("old.modified_by"))
        elif name == "change_reason":
            value = (
                F.when(inserted, ADDED_TEXT % scan_run_id)
                .when(updated, UPDATED_TEXT % scan_run_id)
                .otherwise(F.col("old.change_reason"))
            )
        elif name == "modified_at" and changed_at is not None:
            value = F.when(inserted | updated, changed_at).otherwise(F.col("old.modified_at"))
        elif name == "scan_run_id":
            value = F.when(inserted | updated, scan_run_id).otherwise(F.col("old.scan_run_id"))
        else:
            value = F.col(f"old.{name}")
        return value.alias(name)

    return joined.select(*[field(c) for c in existing.columns])


def deactivate(config: DataFrame, staged: DataFrame, scanned: DataFrame, scan_run_id: str) -> DataFrame:
    """Switch off scanner-owned rows of the scanned schemas that this scan did not find."""
    found = staged.select("table_id").where("table_id IS NOT NULL").distinct().withColumn("_found", F.lit(True))
    schemas = scanned.select("source_catalog", "source_schema").distinct().withColumn("_scanned", F.lit(True))
    joined = config.join(found, "table_id", "left").join(
        schemas, ["source_catalog", "source_schema"], "left"
    )
    vanished = (
        F.coalesce(F.col("modified_by") == "scanner", F.lit(False))
        & F.col("_scanned").isNotNull()
        & F.col("_found").isNull()
    )
    changes = {
        "is_active": F.lit(False),
        "reason": F.lit(DROPPED_TEXT % scan_run_id),
        "change_reason": F.lit(INACTIVE_TEXT % scan_run_id),
        "scan_run_id": F.lit(scan_run_id),
    }
    return joined.select(
        *[
            (F.when(vanished, changes[c]).otherwise(F.col(c)) if c in changes else F.col(c)).alias(c)
            for c in config.columns
        ]
    )


def log_rows(
    tables: DataFrame,
    proposed: DataFrame,
    existing: DataFrame,
    scan_run_id: str,
    force: bool = False,
    workspace_id: str | None = None,
) -> DataFrame:
    """One log row per table of the scan, excluded tables included, with its merge action."""
    owner = existing.select("table_id", F.coalesce("modified_by", F.lit("")).alias("_owner"))
    excluded = F.col("match_status").isNull()
    action = (
        F.when(excluded, F.lit(None).cast("string"))
        .when(F.col("_owner").isNull(), "added")
        .when((F.col("_owner") == "scanner") | F.lit(force), "updated")
        .otherwise("preserved")
    )
    return (
        tables.select(table_id().alias("table_id"), *TABLE)
        .join(proposed.drop(*TABLE), "table_id", "left")
        .join(owner, "table_id", "left")
        .select(
            F.sha2(F.concat_ws("/", F.lit(scan_run_id), "table_id"), 256).alias("log_id"),
            F.lit(scan_run_id).alias("scan_run_id"),
            "table_id",
            *TABLE,
            F.when(excluded, "excluded").otherwise(F.col("match_status")).alias("match_status"),
            "matched_column",
            "matched_pattern",
            F.to_json(F.coalesce("all_matched_columns", F.array().cast("array<string>"))).alias("all_matched_columns"),
            "ambiguity_detail",
            "table_size_gb",
            F.coalesce("size_check_passed", F.lit(False)).alias("size_check_passed"),
            F.coalesce("is_active", F.lit(False)).alias("is_active"),
            F.when(excluded, EXCLUDED_REASON).otherwise(F.col("reason")).alias("inactive_reason"),
            action.alias("merge_action"),
            F.lit(workspace_id).cast("string").alias("workspace_id"),
            F.current_user().alias("scanned_by"),
            F.current_timestamp().alias("created_at"),
        )
    )


def summary(log: DataFrame) -> DataFrame:
    """Counters of a scan, one row, one aggregation."""
    status, active = F.col("match_status"), F.col("is_active")
    failed = (status == "matched") & ~F.col("size_check_passed")
    unknown = failed & F.col("table_size_gb").isNull()
    return log.agg(
        F.count_if((status == "matched") & active).alias("tables_matched"),
        F.count_if(status == "ambiguous").alias("tables_ambiguous"),
        F.count_if(status == "unmatched").alias("tables_unmatched"),
        F.count_if(status == "excluded").alias("tables_excluded"),
        F.count_if(failed & ~unknown).alias("tables_below_size_threshold"),
        F.count_if(unknown).alias("tables_size_unknown"),
        F.count_if(F.col("merge_action") == "preserved").alias("tables_preserved"),
    )


def run_scan(
    columns: DataFrame,
    sizes: DataFrame,
    existing: DataFrame,
    templates: DataFrame,
    scan_run_id: str,
    force: bool = False,
) -> dict[str, DataFrame]:
    """The scan end to end as DataFrames: staging, config, log and summary.

    Write ``staging`` and ``log`` by append and publish ``config`` as a new table.
    """
    tables = columns.join(
        F.broadcast(templates.select("source_catalog", "source_schema")), ["source_catalog", "source_schema"]
    ).select(*TABLE).distinct()
    proposed = propose(match_columns(columns, templates), sizes, templates)
    staged = staging(proposed, scan_run_id)
    config = deactivate(merge(existing, staged, scan_run_id, force), staged, templates, scan_run_id)
    log = log_rows(tables, proposed, existing, scan_run_id, force)
    return {"staging": staged, "config": config, "log": log, "summary": summary(log)}
