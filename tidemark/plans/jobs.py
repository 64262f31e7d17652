"""Run the jobs from table configuration: the library's equivalent of a scheduled task.

``config`` is the table_configs DataFrame; one row per table. Rows are checked before
anything runs, and only the active ones matching the filters are used.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Row, SparkSession

from ..functions.rules import Rule
from ..operators import config as C
from ..sources.audit_log import AuditLog
from ..sources.slices import SliceStore
from ..sources.tables import Source, parquet_location
from .archive import Outcome, archive_tables, delete_archived, dry_run_tables


def from_catalog(spark: SparkSession) -> Callable[[Row], DataFrame]:
    """Source rows by full name, in any format Spark reads by name; partition columns included."""

    return lambda row: spark.table(_full_name(row))


def _full_name(row: Row) -> str:
    parts = [row.source_catalog, row.source_schema, row.source_table]
    return ".".join(f"`{p}`" for p in parts if p)


def sources(
    spark: SparkSession,
    config: DataFrame,
    default_retention_years: int,
    default_timezone: str | None = None,
    read: Callable[[Row], DataFrame] | None = None,
    store: SliceStore | None = None,
    **filters,
) -> list[Source]:
    """Sources of the active config rows that match the filters of ``config.subset``.

    With ``store``, rows that its deletes took out of a source are left out: give the store that the
    jobs run against.
    """
    chosen = C.subset(config, **filters)
    broken = C.table_violations(chosen).collect()  # of the configuration: a few rows per table
    if "exclusion_conditions" in config.columns:
        broken += C.condition_violations(chosen).collect()
    if broken:
        raise C.ConfigError("; ".join(f"{b.table_id}: {b.violation}" for b in broken))
    rows = C.effective(chosen, default_retention_years, default_timezone).collect()
    if not rows and any(v is not None for v in filters.values()):
        raise C.ConfigError(f"no active table matches {filters}")
    by_name = read is None
    read = read or from_catalog(spark)

    def source(r: Row) -> Source:
        table = read(r)
        snapshot = store.source_snapshot(r.table_id, table) if store else None
        return Source(
            r.table_id,
            snapshot.read() if snapshot else table,
            r.watermark_column,
            r.retention_years,
            rules=tuple(Rule.of(c) for c in (r.exclusion_conditions or ())),
            timezone=r.timezone,
            delete_after=bool(r.delete_after_archive),
            catalog=r.source_catalog,
            schema=r.source_schema,
            snapshot=snapshot,
            location=parquet_location(spark, _full_name(r), r.watermark_column) if by_name else None,
        )

    return [source(r) for r in rows]


def run_archive(
    found: list[Source], store: SliceStore, audit: AuditLog, as_of: dt.date, is_dry: bool = True, run_id: str | None = None
) -> list:
    """Archive job; a dry run (the default) only plans and records."""
    run_id = run_id or str(uuid.uuid4())
    if is_dry:
        return dry_run_tables(found, store, audit, run_id, as_of)
    return archive_tables(found, store, audit, run_id, as_of)


def run_delete(
    found: list[Source],
    store: SliceStore,
    audit: AuditLog,
    as_of: dt.date,
    years: list[int] | None = None,
    is_dry: bool = True,
    filtered: bool = False,
    run_id: str | None = None,
) -> list[Outcome]:
    """Delete job. A live run must be narrowed by a table filter or by years."""
    if not is_dry and not filtered and not years:
        raise C.ConfigError("a live delete needs a table filter or a list of years")
    run_id = run_id or str(uuid.uuid4())
    return [delete_archived(s, store, audit, run_id, as_of, years, is_dry) for s in found]
