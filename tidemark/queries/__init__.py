"""One registered query per operator, each with reference SQL where SQL can say it."""

from . import audit_queries, report_queries, restore_queries, scan_queries, selection, slice_queries  # noqa: F401
from .base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
