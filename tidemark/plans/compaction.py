"""Rewrite the small files that many appends leave in a slice, as a version of its own."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import evolution
from ..operators import audit_state
from ..schemas import ddl
from ..session import local_frame
from ..sources.audit_log import AuditLog
from ..sources.slices import VALID, SliceStore, check_name
from ..sources.tables import file_listing

TARGET_BYTES = 128 << 20


def small_directories(store: SliceStore, table_id: str, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """Per valid slice: its version, the directories worth rewriting with their files and bytes, and those that stay.

    A directory is small if its files are under half the target on average. A slice is listed only if
    rewriting its small directories leaves fewer files.
    """
    states = store.states([table_id]).where(F.col("slice_state") == VALID)
    live = states.select("year", "version", F.explode("live_dirs").alias("dir"))
    where = F.regexp_extract("path", r"(/data/.*/slice_year=-?\d+)/[^/]+$", 1)
    sizes = file_listing(store.spark, store.table_dir(table_id)).groupBy(where.alias("_tail")).agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes")
    )
    tail = F.regexp_extract("dir", r"(/data/.*/slice_year=-?\d+)$", 1)
    small = F.col("bytes") < F.col("files") * F.lit(target_bytes // 2)
    return (
        live.withColumn("_tail", tail).join(sizes, "_tail")
        .groupBy("year", "version")
        .agg(
            F.collect_list(F.when(small, F.col("dir"))).alias("rewrite"),
            F.collect_list(F.when(~small, F.col("dir"))).alias("stay"),
            F.sum(F.when(small, F.col("files"))).alias("files"),
            F.sum(F.when(small, F.col("bytes"))).alias("bytes"),
        )
        .where(F.col("files") > F.greatest(F.lit(1), F.ceil(F.col("bytes") / F.lit(target_bytes))))
    )


def compact(
    store: SliceStore, audit: AuditLog, table_id: str, run_id: str, target_bytes: int = TARGET_BYTES, stale_hours: float = 4.0
) -> DataFrame:
    """Rewrite the small directories of all slices of a table in one job; (year, version, files, error) of each.

    Rows are verified by count and content as in an archive; a slice that differs keeps its version. The
    new version begins a chain: the directories that stay, then the new one. Older versions and their files are left
    for rollbacks. Refused while another run works on the table. Compacting again does nothing.
    """
    check_name(table_id, run_id)
    spark = store.spark
    report = "year INT, version BIGINT, files BIGINT, error STRING"
    foreign = audit_state.busy_tables(audit.rows(), run_id, audit.clock(), stale_hours)
    if foreign.where((F.col("table_name") == table_id) & F.col("is_concurrent")).limit(1).count():
        raise RuntimeError(f"another run works on {table_id}")
    chosen = {r.year: r for r in small_directories(store, table_id, target_bytes).collect()}  # one row per slice
    if not chosen:
        return local_frame(spark, [], report)
    slices = {r.year: r for r in store.latest().where(F.col("table_id") == table_id).collect() if r.year in chosen}
    schema = evolution.common([ddl(r.schema_ddl) for r in slices.values()])
    rows = store.rows_in(table_id, schema, [d for r in chosen.values() for d in r.rewrite])
    path, sent = store.write_checked(rows, table_id, run_id, sorted(chosen))
    names = schema.names
    got = {
        r.slice_year: (r.row_count, (r.sum_a, r.sum_b))
        for r in store.content(store.rows_in(table_id, schema, [path]), names).collect()
    }
    new, lines = [], []
    for y, s in sorted(slices.items()):
        if got.get(y) != sent[y]:
            lines.append((y, s.version, None, "the rows read back are not the rows written"))
            continue
        kept = {k: s[k] for k in ("row_count", "wm_lo", "wm_hi", "schema_ddl", "conditions", "source_year_count", "retention_years")}
        new.append(
            {
                **kept, "table_id": table_id, "year": y, "version": s.version + 1, "op": "COMPACT", "mode": "compact",
                "dirs": [*chosen[y].stay, f"{path}/slice_year={y}"], "run_id": run_id, "rows_this_run": sent[y][0],
            }
        )
        lines.append((y, s.version + 1, chosen[y].files, None))
    store.publish(new)
    return local_frame(spark, lines, report)
