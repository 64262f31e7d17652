"""Roll a slice back to an earlier version, or wipe it; each step is a new version."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators import gates
from ..session import local_frame
from ..sources.audit_log import AuditLog
from ..sources.slices import SliceStore, safe_name

KEPT = ("row_count", "wm_lo", "wm_hi", "schema_ddl", "conditions")


def rollback(
    store: SliceStore, audit: AuditLog, requests: DataFrame, run_id: str, dry_run: bool = True
) -> DataFrame:
    """Restore slices to the version of a target audit row; ``requests`` is an operator's list.

    Returns one row per request: target_version, refused_by, and ``action`` when allowed.
    """
    ids = _tables(requests)
    checked = gates.rollback_gates(requests, audit.rows(), store.states(ids), store.recoverable(ids))
    verdicts = checked.collect()
    word = "WOULD_RECOVERY_ARCHIVE_ROLLED_BACK" if dry_run else "RECOVERY_ARCHIVE_ROLLED_BACK"
    allowed = [v for v in verdicts if v.refused_by is None]
    if allowed and not dry_run:
        wanted = local_frame(
            store.spark,
            [(v.table_id, v.year, v.target_version) for v in allowed],
            "table_id STRING, year INT, version BIGINT",
        )
        target = {
            (r.table_id, r.year): r
            for r in store.resolved(wanted).collect()
        }
        newest = {
            (r.table_id, r.year): r.version
            for r in store.latest().join(wanted, ["table_id", "year"], "left_semi").collect()
        }
        rows, events = [], []
        for v in allowed:
            key = (v.table_id, v.year)
            t = target[key]
            rows.append(
                {
                    "table_id": v.table_id,
                    "year": v.year,
                    "version": newest[key] + 1,
                    "op": "ROLLBACK",
                    "run_id": run_id,
                    "rows_this_run": t.row_count,
                    "mode": "rollback",
                    "dirs": t.live_dirs,
                    **{k: t[k] for k in KEPT},
                }
            )
            events.append(
                {
                    "table_name": v.table_id,
                    "year": v.year,
                    "status": "RECOVERY_ARCHIVE_ROLLED_BACK",
                    "record_count": t.row_count,
                    "archive_delta_version": newest[key] + 1,
                    "needs_review": True,
                }
            )
        store.publish(rows)
        audit.record(run_id, events)
    return _report(store, verdicts, word, "target_version BIGINT", lambda v: v.target_version)


def wipe(
    store: SliceStore, audit: AuditLog, requests: DataFrame, run_id: str, dry_run: bool = True
) -> DataFrame:
    """Empty slices whose source rows are still there; a later archive run refills them."""
    checked = gates.wipe_gates(requests, audit.rows(), store.states(_tables(requests)), live=not dry_run)
    verdicts = checked.collect()
    word = "WOULD_RECOVERY_ARCHIVE_DELETED" if dry_run else "RECOVERY_ARCHIVE_DELETED"
    allowed = [v for v in verdicts if v.refused_by is None]
    if allowed and not dry_run:
        wanted = local_frame(
            store.spark, [(v.table_id, v.year) for v in allowed], "table_id STRING, year INT"
        )
        last = {
            (r.table_id, r.year): r
            for r in store.latest().join(wanted, ["table_id", "year"], "left_semi").collect()
        }
        rows, events = [], []
        for v in allowed:
            old = last[(v.table_id, v.year)]
            rows.append(
                {
                    "table_id": v.table_id,
                    "year": v.year,
                    "version": old.version + 1,
                    "op": "WIPE",
                    "dirs": [],
                    "row_count": 0,
                    "schema_ddl": old.schema_ddl,
                    "run_id": run_id,
                    "rows_this_run": 0,
                    "mode": "wipe",
                }
            )
            events.append(
                {
                    "table_name": v.table_id,
                    "year": v.year,
                    "status": "RECOVERY_ARCHIVE_DELETED",
                    "record_count": v.row_count,
                    "error_message": v.wipe_reason.strip(),
                    "needs_review": True,
                }
            )
        store.publish(rows)
        audit.record(run_id, events)
    return _report(store, verdicts, word, "rows_deleted BIGINT", lambda v: v.row_count)


def _tables(requests: DataFrame) -> list[str]:
    """Tables an operator's list names; unsafe names, which no slice has, are left to the gates."""
    return [r.table_id for r in requests.select("table_id").distinct().collect() if r.table_id and safe_name(r.table_id)]


def _report(store: SliceStore, verdicts, word: str, extra_ddl: str, extra) -> DataFrame:
    data = [
        (v.table_id, v.year, extra(v), v.refused_by, word if v.refused_by is None else None)
        for v in verdicts
    ]
    return local_frame(
        store.spark, data, f"table_id STRING, year INT, {extra_ddl}, refused_by STRING, action STRING"
    )
