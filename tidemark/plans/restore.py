"""Restore archived years as DataFrames and temporary views, or as a table and views that other sessions can query."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T

from ..functions import evolution
from ..schemas import ddl
from ..session import local_frame
from ..sources.audit_log import AuditLog
from ..sources.slices import VALID, SliceStore
from ..sources.tables import append_batch, read_or_empty

_RESTORED_DDL = (
    "table_id STRING, run_id STRING, target_schema STRING, name STRING, kind STRING, expires_at TIMESTAMP, noted_at TIMESTAMP, state STRING"
)
_BATCH = 200  # partitions added by one statement


class SchemaMismatch(ValueError):
    """Participants of a unified view differ in column names, order or types."""


@dataclass
class Restored:
    status: str
    years: dict[int, DataFrame] = field(default_factory=dict)
    skipped: list[int] = field(default_factory=list)
    unified: DataFrame | None = None
    views: list[str] = field(default_factory=list)


def _shape(schema: T.StructType) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in schema]


def mismatch(expected: T.StructType, actual: T.StructType) -> str | None:
    """Why two participants cannot be unioned, or None."""
    want, have = _shape(expected), _shape(actual)
    if [n for n, _ in want] != [n for n, _ in have]:
        return "column names or order differ"
    wrong = [f"{n}: {a} vs {b}" for (n, a), (_, b) in zip(want, have) if a != b]
    return "column types differ: " + ", ".join(wrong) if wrong else None


def unify(participants: dict[str, DataFrame]) -> DataFrame:
    """UNION ALL of participants with equal names and types."""
    (first, head), *rest = participants.items()
    for name, df in rest:
        why = mismatch(head.schema, df.schema)
        if why:
            raise SchemaMismatch(f"{name} does not match {first}: {why}")
    return reduce(DataFrame.unionByName, [df for _, df in rest], head)


def restore(
    store: SliceStore,
    audit: AuditLog | None,
    table_id: str,
    years: list[int],
    *,
    live: DataFrame | None = None,
    unified: bool = True,
    prefix: str = "",
    suffix: str = "_unified",
    run_id: str | None = None,
    target_schema: str | None = None,
    live_table: str | None = None,
    expires_at: dt.datetime | None = None,
) -> Restored:
    """One view per available year, and optionally one over all of them and the live table.

    Only VALID slices are available; others are skipped. No year at all is FAILED. Views
    are lazy: nothing is read until they are queried, and then only what the query needs.

    Without ``target_schema`` the views are those of this session. With it they are views of the catalogue over an
    external table whose partitions are the slices' directories: no row is copied. ``live_table`` is then the
    live table's name in the catalogue, and ``drop_expired`` takes all of it away after ``expires_at``.
    """
    if target_schema is not None and live is not None:
        raise ValueError("views that outlive the session take the live table by name: live_table")
    if target_schema is not None and live_table is not None:
        live = store.spark.table(live_table)
    # One query for all years: their state, directories and schemas.
    valid = {
        r.year: r
        for r in store.states([table_id])
        .where((F.col("slice_state") == VALID) & F.col("year").isin([int(y) for y in years]))
        .select("year", "live_dirs", "schema_ddl")
        .collect()
    }
    base = prefix + table_id.split(".")[-1]
    out = Restored("FAILED", skipped=[y for y in years if y not in valid])
    error = None
    for y in years:
        if y in valid:
            rows = store.rows_of(table_id, [valid[y]]).drop("slice_year")
            if target_schema is None:
                rows.createOrReplaceTempView(f"{base}_year_{y}")
            out.years[y] = rows
            out.views.append(f"{base}_year_{y}")
    try:
        if not out.years:
            raise LookupError("no requested year could be restored")
        if unified:
            parts = {f"{base}_year_{y}": df for y, df in out.years.items()}
            if live is not None:
                parts = {table_id: live, **parts}
            out.unified = unify(parts)
            if target_schema is None:
                out.unified.createOrReplaceTempView(base + suffix)
            out.views.append(base + suffix)
        if target_schema is not None:
            made = _lasting(store, table_id, base, suffix if unified else None, valid, out, target_schema, live_table)
            note = [(table_id, run_id, target_schema, name, kind, expires_at) for name, kind in made]
            _note(store, note, "RESTORED")
        out.status = "COMPLETED" if len(out.years) == len(years) else "PARTIAL_COMPLETED"
    except (LookupError, SchemaMismatch) as exc:
        error = exc
    if audit is not None:
        audit.append_restores(_event(store, audit, table_id, years, out, error, run_id, target_schema))
    if error is not None:
        raise error
    return out


def _quoted(*names: str) -> str:
    return ".".join("`" + n.replace("`", "``") + "`" for n in names)


def _lasting(store, table_id, base, suffix, valid, out: Restored, target: str, live_table) -> list[tuple[str, str]]:
    """Create the external table and its views; (name, kind) of each, views first.

    A slice of several directories has a partition for each, so the table is partitioned by year and piece. The
    statements are metadata alone: one per view and one per few hundred directories.
    """
    spark = store.spark
    slices = [valid[y] for y in out.years]
    schema = evolution.common([ddl(r.schema_ddl) for r in slices])
    table = f"{base}_restored"
    name = _quoted(target, table)
    columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in schema)
    root = store.fresh(f"{store.base}/restored/{target}/{table}")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(
        f"CREATE TABLE {name} ({columns}, slice_year INT, slice_piece INT) USING parquet "
        f"PARTITIONED BY (slice_year, slice_piece) LOCATION '{root}'"
    )
    places = [
        f"PARTITION (slice_year = {r.year}, slice_piece = {k}) LOCATION '{d}'"
        for r in slices for k, d in enumerate(r.live_dirs)
    ]
    for k in range(0, len(places), _BATCH):
        spark.sql(f"ALTER TABLE {name} ADD {' '.join(places[k : k + _BATCH])}")
    made = []

    def view(title: str, body: str) -> None:
        spark.sql(f"CREATE OR REPLACE VIEW {_quoted(target, title)} AS {body}")
        made.append((title, "VIEW"))

    def shaped(own: T.StructType) -> str:
        return ", ".join(f"CAST({_quoted(f.name)} AS {f.dataType.simpleString()}) AS {_quoted(f.name)}" for f in own)

    for y, rows in out.years.items():
        view(f"{base}_year_{y}", f"SELECT {shaped(rows.schema)} FROM {name} WHERE slice_year = {y}")
    if suffix is not None:
        own = next(iter(out.years.values())).schema
        years = ", ".join(map(str, out.years))
        body = f"SELECT {shaped(own)} FROM {name} WHERE slice_year IN ({years})"
        if live_table is not None:
            body = f"SELECT {', '.join(_quoted(n) for n in own.names)} FROM {live_table} UNION ALL {body}"
        view(base + suffix, body)
    return [*made, (table, "TABLE")]


def _note(store: SliceStore, rows: list[tuple], state: str) -> None:
    now = dt.datetime.now(dt.timezone.utc)
    frame = local_frame(store.spark, [(*r, now, state) for r in rows], _RESTORED_DDL)
    append_batch(frame.coalesce(1), f"{store.base}/restored_log")


def restored(store: SliceStore) -> DataFrame:
    """Tables and views of the catalogue that restores made and nobody dropped: the newest note of each name."""
    notes = read_or_empty(store.spark, f"{store.base}/restored_log", _RESTORED_DDL)
    key = ["target_schema", "name", "kind"]
    rest = [c for c in notes.columns if c not in key]
    newest = notes.groupBy(*key).agg(F.max_by(F.struct(*rest), F.col("noted_at")).alias("_row")).select(*key, "_row.*")
    return newest.where("state = 'RESTORED'").select(*notes.columns)


def drop_expired(store: SliceStore, now: dt.datetime) -> list[str]:
    """Drop the views and tables whose time is over, views first; the slices they show stay. Their names."""
    over = restored(store).where(F.col("expires_at") <= F.lit(now)).collect()
    over.sort(key=lambda r: r.kind == "TABLE")
    for r in over:
        store.spark.sql(f"DROP {r.kind} IF EXISTS {_quoted(r.target_schema, r.name)}")
    if over:
        _note(store, [(r.table_id, r.run_id, r.target_schema, r.name, r.kind, r.expires_at) for r in over], "DROPPED")
    return [r.name for r in over]


def _event(store, audit, table_id, years, out: Restored, error, run_id, target_schema=None) -> DataFrame:
    row = (
        run_id,
        store.table_dir(table_id),
        table_id,
        "[" + ", ".join(str(y) for y in years) + "]",
        len(out.years),
        out.status,
        None if error is None else f"{error}; restored={sorted(out.years)}; skipped={out.skipped}",
        store.spark.catalog.currentCatalog() if target_schema is not None else None,
        target_schema,
        audit.clock(),
    )
    return local_frame(
        store.spark,
        [row],
        "archive_run_id STRING, archive_path STRING, source_table STRING, years STRING, "
        "tables_created INT, status STRING, error_message STRING, target_catalog STRING, target_schema STRING, created_at TIMESTAMP",
    ).withColumn("audit_id", F.uuid()).withColumn("rehydrated_by", F.current_user())
