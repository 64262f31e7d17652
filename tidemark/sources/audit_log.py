"""Append-only audit logs as plain Parquet tables with a declared schema."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..schemas import ARCHIVE_STATUSES, AUDIT_DDL, DRY_RUN_ACTIONS, RESTORE_AUDIT_DDL, RESTORE_STATUSES, ddl
from ..session import local_frame
from .tables import append_batch, read_or_empty


_RECONCILED_DDL = "table_name STRING, year INT, reconciled_at TIMESTAMP, note STRING, reconciled_by STRING"


def _utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


@dataclass
class AuditLog:
    spark: SparkSession
    base: str
    clock: Callable[[], dt.datetime] = field(default=_utc_now)
    job: dict = field(default_factory=dict)  # workspace_id, job_id, job_run_id, task_run_id

    @property
    def path(self) -> str:
        return f"{self.base}/audit/archive"

    @property
    def restore_path(self) -> str:
        return f"{self.base}/audit/restore"

    def rows(self) -> DataFrame:
        return read_or_empty(self.spark, self.path, AUDIT_DDL)

    def restores(self) -> DataFrame:
        return read_or_empty(self.spark, self.restore_path, RESTORE_AUDIT_DDL)

    def reconcile(self, table_id: str, years: list[int], note: str, by: str | None = None) -> None:
        """Record that somebody has looked into the slices: failures up to now no longer hold them back."""
        if not note.strip():
            raise ValueError("a reconciliation says what was found")
        rows = [(table_id, int(y), self.clock(), note, by) for y in sorted(set(years))]
        frame = local_frame(self.spark, rows, _RECONCILED_DDL)
        append_batch(frame.withColumn("reconciled_by", F.coalesce("reconciled_by", F.current_user())).coalesce(1), f"{self.base}/audit/reconciled")

    def reconciliations(self) -> DataFrame:
        return read_or_empty(self.spark, f"{self.base}/audit/reconciled", _RECONCILED_DDL)

    def append(self, events: DataFrame) -> None:
        """Append a DataFrame of events; absent columns become NULL, a bad status fails."""
        self._append(events, AUDIT_DDL, self.path, ARCHIVE_STATUSES)

    def append_restores(self, events: DataFrame) -> None:
        self._append(events, RESTORE_AUDIT_DDL, self.restore_path, RESTORE_STATUSES)

    def _append(self, events: DataFrame, schema_ddl: str, path: str, allowed) -> None:
        have = set(events.columns)
        unknown = have - set(ddl(schema_ddl).names)
        if unknown:
            raise ValueError(f"unknown audit columns: {sorted(unknown)}")
        checked = F.when(F.col("status").isin(*allowed), F.col("status")).otherwise(
            F.raise_error(F.concat(F.lit("audit status not allowed: "), F.coalesce("status", F.lit("NULL"))))
        )
        out = events.withColumn("status", checked)
        shaped = out.select(
            *[
                (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
                for f in ddl(schema_ddl)
            ]
        )
        append_batch(shaped, path)

    def record(self, run_id: str, events: list[dict]) -> None:
        """Append the events of one run (at most a few per table and year) as one file."""
        if not events:
            return
        bad = [e["status"] for e in events if e["status"] not in ARCHIVE_STATUSES]
        if bad:
            raise ValueError(f"audit status not allowed: {bad[0]}")
        names = ddl(AUDIT_DDL).names
        now = self.clock()
        data = []
        for i, e in enumerate(events):
            row = {
                "audit_id": str(uuid.uuid4()),
                "archive_run_id": run_id,
                # events of one batch keep their order
                "created_at": now + dt.timedelta(microseconds=i),
                "needs_review": False,
                **self.job,
                **e,
            }
            data.append(tuple(row.get(n) for n in names))
        frame = local_frame(self.spark, data, AUDIT_DDL)
        append_batch(frame.withColumn("archived_by", F.current_user()).coalesce(1), self.path)


def dry_run_payload(action, counts, total_eligible, would_archive):
    """The JSON document stored in ``conditions_applied`` of a DRY_RUN row."""
    return F.to_json(
        F.struct(
            F.when(action.isin(*DRY_RUN_ACTIONS), action)
            .otherwise(F.raise_error(F.concat(F.lit("dry-run action not allowed: "), action)))
            .alias("action"),
            counts.alias("per_condition_counts"),
            total_eligible.alias("total_eligible"),
            would_archive.alias("would_archive"),
        )
    )


PAYLOAD_DDL = (
    "action STRING, per_condition_counts MAP<STRING, BIGINT>, "
    "total_eligible BIGINT, would_archive BIGINT"
)
