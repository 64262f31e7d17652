"""Lifecycle of aged data in large Spark tables: archive, verify, delete, restore, recover."""

from .functions.rules import Rule
from .plans.archive import archive, archive_tables, delete_archived, dry_run, dry_run_tables, plan, plan_delete, work_plan
from .operators.reports import late_rows
from .operators.verification import verify
from .plans.compaction import compact
from .plans.recovery import rollback, wipe
from .plans.restore import restore, unify
from .sources.audit_log import AuditLog
from .sources.publication import publish_source
from .sources.slices import SliceStore
from .sources.snapshots import Snapshot
from .sources.tables import Source

__all__ = [
    "AuditLog",
    "Rule",
    "SliceStore",
    "Snapshot",
    "Source",
    "archive",
    "archive_tables",
    "compact",
    "delete_archived",
    "dry_run",
    "dry_run_tables",
    "late_rows",
    "plan",
    "plan_delete",
    "publish_source",
    "restore",
    "rollback",
    "unify",
    "verify",
    "wipe",
    "work_plan",
]
