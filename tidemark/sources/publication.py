"""Deletes that reach the table: a catalogue table without the rows that this store's deletes took out of it.

A delete leaves the files of the table alone and remembers what to read instead. Publishing folds all of a table's deletes
into it. Of a partitioned table only the partitions that hold touched files are written anew, each
to a fresh directory that takes the partition's place; any other table is written anew as a whole. The
switch is a change of location in the catalogue, so a reader sees the old files or the new ones. What was replaced
stays for a keep time, for readers that began earlier, and is then removed.

A publication is written down before its first switch and once more after the last. Switches can be
repeated, so one that was cut short is finished by the next call; until then the source is not read at all, because
some of its rows may stand in both places.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from ..session import local_frame
from .slices import SliceStore
from .snapshots import touched_rows
from .tables import location


def _sql_literal(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _partitions(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def _make_directory(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).mkdirs(where)


def publish_source(store: SliceStore, table_id: str, name: str, run_id: str) -> str | None:
    """Fold the deletes of ``table_id`` into the catalogue table ``name`` (a quoted SQL name if need be).

    Returns the directory of the new files, or None if no delete is waiting. What reaches the driver is one row per
    touched partition: its values and its locations.
    """
    spark = store.spark
    finish(store, table_id)
    table = spark.table(name)
    snapshot = store.source_snapshot(table_id, table)
    if not snapshot.deletes:
        return None
    target = store.fresh(f"{store.base}/published/{table_id}/run={run_id}")
    parts = _partitions(spark, name)
    if not parts:
        snapshot.read().write.parquet(target)
        switches = [("", location(spark, name), target)]
    else:
        columns = [F.col(f"`{p}`") for p in parts]
        hit = touched_rows(snapshot).select(*columns).distinct()
        touched = [tuple(r) for r in hit.select(*[c.cast("string") for c in columns]).collect()]
        ddl = ", ".join([f"`_p{k}` STRING" for k in range(len(parts))] + ["_place INT"])
        places = local_frame(spark, [(*values, k) for k, values in enumerate(touched)], ddl)
        same = [c.cast("string").eqNullSafe(F.col(f"_p{k}")) for k, c in enumerate(columns)]
        left = snapshot.read().join(F.broadcast(places), same)  # one row per touched partition
        data = [F.col(f"`{c}`") for c in snapshot.schema.names if c not in parts]
        left.select(*data, "_place").hint("rebalance", "_place").write.partitionBy("_place").parquet(target)
        switches = []
        for k, values in enumerate(touched):
            spec = "PARTITION (" + ", ".join(f"`{p}` = {_sql_literal(v)}" for p, v in zip(parts, values)) + ")"
            switches.append((spec, location(spark, name, spec), f"{target}/_place={k}"))
    store.note_publication(
        [(table_id, run_id, name, spec, old, new, list(snapshot.deletes), "PREPARED") for spec, old, new in switches]
    )
    finish(store, table_id)
    return target


def finish(store: SliceStore, table_id: str) -> int:
    """Switch what the prepared publications of a table have not switched yet; the number of publications finished."""
    spark = store.spark
    open_ = store.publications(table_id).where("state = 'PREPARED'").join(
        store.publications(table_id).where("state = 'DONE'").select("run_id", "new"), ["run_id", "new"], "left_anti"
    )
    rows = open_.collect()  # one per touched partition
    for r in rows:
        _make_directory(spark, r.new)  # a partition without rows left is an empty directory
        spark.sql(f"ALTER TABLE {r.name} {r.spec} SET LOCATION {_sql_literal(r.new)}")
        spark.catalog.refreshTable(r.name)
    store.note_publication(
        [(table_id, r.run_id, r.name, r.spec, r.old, r.new, r.folded, "DONE") for r in rows]
    )
    return len({r.run_id for r in rows})


def replaced(store: SliceStore, table_id: str | None = None) -> DataFrame:
    """Directories that publications took out of use and that are not removed yet: (table_id, run_id, dir, replaced_at)."""
    all_ = store.publications(table_id)
    removed = all_.where("state = 'REMOVED'").select(F.col("old").alias("dir"))
    done = all_.where("state = 'DONE'").select("table_id", "run_id", F.col("old").alias("dir"), F.col("noted_at").alias("replaced_at"))
    return done.join(removed, "dir", "left_anti").select("table_id", "run_id", "dir", "replaced_at")


def remove_replaced(store: SliceStore, before: dt.datetime, table_id: str | None = None) -> int:
    """Delete replaced directories from before a time; their bytes are free then. The number of directories removed.

    A directory that a table or one of its partitions uses (again) stays.
    """
    spark = store.spark
    rows = replaced(store, table_id).where(F.col("replaced_at") < F.lit(before)).collect()
    used: dict[str, set] = {}
    gone: list[Row] = []
    notes = {(r.run_id, r.old): r for r in store.publications(table_id).where("state = 'DONE'").collect()}
    for r in rows:
        note = notes[r.run_id, r.dir]
        if note.name not in used:
            used[note.name] = {location(spark, note.name)}
        now = location(spark, note.name, note.spec) if note.spec else location(spark, note.name)
        if _plain(r.dir) in {_plain(u) for u in (*used[note.name], now)}:
            continue
        where = spark._jvm.org.apache.hadoop.fs.Path(r.dir)
        where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(where, True)
        gone.append(note)
    store.note_publication([(r.table_id, r.run_id, r.name, r.spec, r.old, r.new, r.folded, "REMOVED") for r in gone])
    return len(gone)


def _plain(path: str) -> str:
    """A path without scheme and doubled slashes, to compare with another."""
    return "/" + path.split(":", 1)[-1].strip("/") if ":" in path.split("/", 1)[0] else "/" + path.strip("/")
