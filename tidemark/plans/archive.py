"""Archive and delete jobs: plan every year of every table at once, then act on all of them.

Per run: one query for the state of all slices, one append for each batch of audit rows and
slice versions. Per table: one profile scan, one write job for all years, one read-back of
what was written. Nothing runs per year. What reaches the driver is one row per slice.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce
from operator import or_

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Row, functions as F, types as T

from ..functions import digest, evolution, rules as R, watermarks as W
from ..operators import audit_state, decisions, profile, verification
from ..schemas import ddl
from ..session import local_frame
from ..sources.audit_log import AuditLog, dry_run_payload
from ..sources.slices import MISSING, SliceStore, check_name
from ..sources.snapshots import DOOMED, Snapshot, doom, without
from ..sources.tables import Source


@dataclass
class Outcome:
    """What one run did to one table."""

    table_id: str
    years: list[dict] = field(default_factory=list)
    source_after: Snapshot | None = None  # set when rows left the source


# -- planning ---------------------------------------------------------------------------


def _log_of(log: DataFrame, source: Source) -> DataFrame:
    return log.where(F.col("table_name") == source.table_id)


def known_slices(
    store: SliceStore, log: DataFrame, run_id: str, table_ids: list[str], reconciled: DataFrame | None = None
) -> DataFrame:
    """Slice state joined with audit state: one row per slice either of them knows."""
    states = store.states(table_ids)
    log = log.where(F.col("table_name").isin(table_ids))
    audited = audit_state.slice_summary(log, run_id, reconciled).withColumnRenamed("table_name", "table_id")
    return (
        states.join(audited, ["table_id", "year"], "full_outer")
        .where("year IS NOT NULL")
        .select(
            "*", F.coalesce("last_watermark", "wm_hi").alias("high_water"), F.col("year").alias("slice_year")
        )
        .drop("archived_at")
    )


_STATE_DDL = (
    "slice_year INT, slice_state STRING, last_status STRING, high_water TIMESTAMP_NTZ, "
    "owned BOOLEAN, wiped_since BOOLEAN, verify_failed BOOLEAN, row_count BIGINT"
)


def _marks(store: SliceStore, known: list[Row]) -> DataFrame:
    names = ddl(_STATE_DDL).names
    return local_frame(store.spark, [tuple(k[n] for n in names) for k in known], _STATE_DDL)


def _plan(
    source: Source, store: SliceStore, known: list[Row], as_of: dt.date, live: bool, counts: DataFrame | None = None
) -> DataFrame:
    """One row per eligible year: counts, state and the action; reads the source once.

    ``known`` has at most one row per calendar year of this table, hence the broadcast.
    """
    state = _marks(store, known)
    if counts is None:
        counts = profile.year_profile(source, as_of, marks=state)
    joined = (
        counts.where("slice_year IS NOT NULL").join(F.broadcast(state), "slice_year", "left")
        .withColumn("slice_state", F.coalesce("slice_state", F.lit(MISSING)))
        .withColumn("delete_after", F.lit(source.delete_after))
        .withColumn("empty_slice", F.coalesce(F.col("row_count") == 0, F.lit(False)))
        .drop("row_count")
    )
    return decisions.resolve(joined, live)


def plan(
    source: Source,
    store: SliceStore,
    log: DataFrame,
    run_id: str,
    as_of: dt.date,
    live: bool = False,
    reconciled: DataFrame | None = None,
) -> DataFrame:
    """What the next run would do with each eligible year of one table."""
    known = known_slices(store, log, run_id, [source.table_id], reconciled).collect()
    return _plan(source, store, known, as_of, live)


def dry_run_tables(
    sources: list[Source], store: SliceStore, audit: AuditLog, run_id: str, as_of: dt.date, max_parallel: int = 4
) -> list[DataFrame]:
    """Plan without writing slices; record one DRY_RUN row per year, and NULL dates once.

    One state query and one append for all tables. Each source is profiled once: the profile, one
    row per year, is fetched, and the returned plans are made of it without a further scan.
    """
    ids = [s.table_id for s in sources]
    check_name(run_id, *ids)
    known: dict[str, list[Row]] = {i: [] for i in ids}
    for r in known_slices(store, audit.rows(), run_id, ids, audit.reconciliations()).collect():
        known[r.table_id].append(r)

    def one(source: Source) -> tuple[DataFrame, DataFrame]:
        counts = profile.year_profile(source, as_of, marks=_marks(store, known[source.table_id]))
        counts = store.spark.createDataFrame(counts.collect(), counts.schema)
        planned = _plan(source, store, known[source.table_id], as_of, False, counts).select(
            "table_id",
            "slice_year",
            decisions.dry_run_action(F.col("action")).alias("action"),
            "reason",
            F.col("total_rows").alias("total_eligible"),
            "would_archive",
            F.when(F.col("action").isin("CREATE", "APPEND"), F.col("protected"))
            .otherwise(F.create_map().cast("map<string,bigint>"))
            .alias("per_condition_counts"),
        )
        nulls = counts.where("slice_year IS NULL").select("table_id", F.col("total_rows").alias("null_rows"))
        return planned, dry_run_events(planned, nulls, run_id, audit.clock())

    if len(sources) == 1:
        made = [one(sources[0])]
    else:
        with ThreadPoolExecutor(max_parallel) as pool:
            made = list(pool.map(inheritable_thread_target(store.spark)(one), sources))
    if made:
        audit.append(reduce(DataFrame.unionByName, [events for _, events in made]))
    return [planned for planned, _ in made]


def dry_run(
    source: Source, store: SliceStore, audit: AuditLog, run_id: str, as_of: dt.date
) -> DataFrame:
    """``dry_run_tables`` for one table."""
    return dry_run_tables([source], store, audit, run_id, as_of)[0]


def dry_run_events(
    planned: DataFrame, nulls: DataFrame, run_id: str, created_at: dt.datetime
) -> DataFrame:
    """DRY_RUN audit rows of a plan, plus one year-less row when dates are NULL."""
    per_year = planned.select(
        F.col("table_id").alias("table_name"),
        F.col("slice_year").alias("year"),
        F.col("would_archive").alias("record_count"),
        dry_run_payload(
            F.col("action"), F.col("per_condition_counts"), F.col("total_eligible"), F.col("would_archive")
        ).alias("conditions_applied"),
        F.lit(None).cast("bigint").alias("null_date_count"),
        F.col("reason").alias("error_message"),
    )
    undated = nulls.where("null_rows > 0").select(
        F.col("table_id").alias("table_name"),
        F.lit(None).cast("int").alias("year"),
        F.lit(0).cast("bigint").alias("record_count"),
        dry_run_payload(
            F.lit("SKIP"), F.create_map().cast("map<string,bigint>"), F.lit(0).cast("bigint"), F.lit(0).cast("bigint")
        ).alias("conditions_applied"),
        F.col("null_rows").alias("null_date_count"),
        F.lit("rows without a date are not archived").alias("error_message"),
    )
    events = per_year.unionByName(undated)
    return events.select(
        F.sha2(F.concat_ws("/", F.lit(run_id), "table_name", F.coalesce(F.col("year").cast("string"), F.lit("-"))), 256)
        .alias("audit_id"),
        F.lit(run_id).alias("archive_run_id"),
        "*",
        F.lit("DRY_RUN").alias("status"),
        F.current_user().alias("archived_by"),
        F.lit(created_at).alias("created_at"),
        F.lit(False).alias("needs_review"),
    )


# -- live archive -----------------------------------------------------------------------


def _selection(source: Source, creates: list[int], appends: dict[int, dt.datetime]) -> Column:
    """Rows to write, as bounds on the raw column so that they reach the Parquet reader."""
    parts = [source.in_years(a, b) for a, b in W.year_runs(creates)]
    parts += [
        source.in_years(y, y)
        & (W.col(source.watermark) > W.literal(source.rows, source.watermark, mark))
        for y, mark in sorted(appends.items())
    ]
    return reduce(or_, parts)


def archivable(
    source: Source, as_of: dt.date, creates: list[int], appends: dict[int, dt.datetime]
) -> DataFrame:
    """The rows a run writes: selected years, above the marks, protected by no rule."""
    chosen = source.rows.where(_selection(source, creates, appends))
    return R.drop_flags(source.flagged(as_of, chosen).where(F.col(R.KEEP)))


@dataclass
class _Job:
    """One table on its way through a run."""

    source: Source
    known: dict[int, Row]
    planned: dict[int, Row] = field(default_factory=dict)
    creates: list[int] = field(default_factory=list)
    appends: dict[int, dt.datetime] = field(default_factory=dict)
    resumes: list[int] = field(default_factory=list)
    events: list[dict] = field(default_factory=list)
    versions: list[dict] = field(default_factory=list)
    windows: dict[int, tuple[dt.datetime, dt.datetime]] = field(default_factory=dict)
    error: Exception | None = None
    outcome: Outcome | None = None

    def fail(self, exc: Exception) -> None:
        """FAILED for the slices that were to be written or deleted; without a plan, one row without a year."""
        queued = {*self.creates, *self.appends, *self.resumes}
        self.error = exc
        self.windows.clear()
        self.versions.clear()
        self.events = [e for e in self.events if e["year"] not in queued]
        for year in sorted(queued) or ([] if self.planned else [None]):
            self.done(year, "FAILED", error_message=str(exc))

    def done(self, year: int | None, status: str, count: int = 0, **more) -> None:
        self.events.append(
            {"table_name": self.source.table_id, "year": year, "status": status, "record_count": count, **more}
        )


def archive_tables(
    sources: list[Source],
    store: SliceStore,
    audit: AuditLog,
    run_id: str,
    as_of: dt.date,
    *,
    stale_hours: float = 4.0,
    merge_schema: bool = False,
    max_parallel: int = 4,
) -> list[Outcome]:
    """Archive every eligible year of the tables, and delete from sources that ask for it.

    Order: plan, STARTED, look for other runs, write, read back, publish versions, audit,
    delete. A slice that fails a check is not published, is recorded as FAILED, and does
    not hold up the others; a table that raises does not hold up other tables, and the
    first error is raised at the end. A directory no version names stays invisible.
    """
    ids = [s.table_id for s in sources]
    if len(set(ids)) != len(ids):
        raise ValueError("a table is listed twice")
    check_name(run_id, *ids)
    log = audit.rows()
    known: dict[str, dict[int, Row]] = {i: {} for i in ids}
    for r in known_slices(store, log, run_id, ids, audit.reconciliations()).collect():
        known[r.table_id][r.slice_year] = r
    jobs = [_Job(s, known[s.table_id]) for s in sources]

    def each(step: Callable[[_Job], None]) -> None:
        def guarded(job: _Job) -> None:
            if job.error is None:
                try:
                    step(job)
                except Exception as exc:
                    job.fail(exc)

        if len(jobs) == 1:
            guarded(jobs[0])
            return
        # a few driver threads keep the cluster busy between the stages of one table
        with ThreadPoolExecutor(max_parallel) as pool:
            list(pool.map(inheritable_thread_target(store.spark)(guarded), jobs))

    def look(job: _Job) -> None:
        rows = _plan(job.source, store, list(job.known.values()), as_of, live=True).collect()
        job.planned = {r.slice_year: r for r in rows}

    each(look)
    audit.record(
        run_id,
        [
            {"table_name": j.source.table_id, "year": y, "status": "STARTED", "record_count": 0}
            for j in jobs
            for y in sorted(j.planned)
        ],
    )
    foreign = audit_state.concurrency_probe(
        audit.rows().where(F.col("table_name").isin(ids)), run_id, audit.clock(), stale_hours
    )
    busy = {
        (r.table_name, r.year): r.foreign_run_id for r in foreign.where("is_concurrent").collect()
    }
    each(lambda job: _sort_out(job, busy))
    each(lambda job: _write(job, store, run_id, as_of, merge_schema))
    store.publish([v for j in jobs for v in j.versions])
    audit.record(run_id, [e for j in jobs for e in j.events])
    for j in jobs:
        j.outcome = Outcome(j.source.table_id, list(j.events))
        j.events = []
    each(lambda job: _delete(job, store, run_id, as_of))
    audit.record(run_id, [e for j in jobs for e in j.events])
    for j in jobs:
        j.outcome.years += j.events
    for j in jobs:
        if j.error is not None:
            raise j.error
    return [j.outcome for j in jobs]


def archive(
    source: Source, store: SliceStore, audit: AuditLog, run_id: str, as_of: dt.date, **options
) -> Outcome:
    """``archive_tables`` for one table."""
    return archive_tables([source], store, audit, run_id, as_of, **options)[0]


def _sort_out(job: _Job, busy: dict) -> None:
    """Record the slices that need no write; queue the others."""
    for y, p in sorted(job.planned.items()):
        foreign = busy.get((job.source.table_id, y))
        if foreign:
            job.done(y, "SKIPPED_CONCURRENT", error_message=f"run {foreign} is working on this slice")
        elif p.action == "ERROR":
            job.done(y, "FAILED", error_message=p.reason)
        elif p.action == "SKIP":
            job.done(y, "SKIPPED", archive_mode="SKIP", source_year_count=p.total_rows)
        elif p.action == "RESUME_DELETE":
            job.resumes.append(y)
        elif p.action == "CREATE":
            job.creates.append(y)
        else:
            job.appends[y] = p.high_water


def _write(job: _Job, store: SliceStore, run_id: str, as_of: dt.date, merge_schema: bool) -> None:
    """Write all years in one job, read them back, and prepare versions and audit rows."""
    source = job.source
    schemas = {y: source.rows.schema for y in job.creates}
    for y in list(job.appends):
        try:  # each slice against the source, so that the order of slices decides nothing
            schemas[y] = evolution.reconciled(ddl(job.known[y].schema_ddl), source.rows.schema, merge_schema)
        except evolution.SchemaDrift as exc:
            del job.appends[y]
            job.done(y, "FAILED", error_message=f"schema_drift: {exc}")
    expected = {y: job.planned[y].would_archive for y in [*job.creates, *job.appends]}
    got: dict[int, Row] = {}
    sent: dict[int, tuple[int, tuple]] = {}
    path = None
    if any(expected.values()):
        schema = evolution.common([source.rows.schema, *schemas.values()])
        rows = archivable(source, as_of, job.creates, job.appends)
        shaped = evolution.conform(
            rows, T.StructType(schema.fields + [T.StructField("slice_year", T.IntegerType())])
        )
        path, sent = store.write_checked(shaped, source.table_id, run_id, sorted(expected))
        got = {r.slice_year: r for r in store.written(path, schema, source.watermark, content=True).collect()}
    for y, want in sorted(expected.items()):
        written, old = got.get(y), job.known.get(y)
        n = written.row_count if written else 0
        if n != want:
            job.done(y, "FAILED", error_message=f"verification_failed: expected {want}, wrote {n}")
            continue
        if n and sent[y] != (n, (written.sum_a, written.sum_b)):
            job.done(y, "FAILED", error_message=f"verification_failed: the {n} rows read back are not the rows written")
            continue
        _prepare(job, run_id, y, n, written, old, schemas[y], path)


def _prepare(job, run_id, year, n, written, old, schema, path) -> None:
    source, planned = job.source, job.planned[year]
    base = old if year in job.appends else None
    version = old.version + 1 if old and old.version is not None else 0
    wm_hi = _greatest(base.wm_hi if base else None, written.wm_hi if written else None)
    job.versions.append(
        {
            "table_id": source.table_id,
            "year": year,
            "version": version,
            "op": planned.action,
            "chain": base.chain if base else version,
            "dirs": [f"{path}/slice_year={year}"] if n else [],
            "row_count": n + (base.row_count if base else 0),
            "wm_lo": _least(base.wm_lo if base else None, written.wm_lo if written else None),
            "wm_hi": wm_hi,
            "schema_ddl": _ddl_of(schema),
            "run_id": run_id,
            "rows_this_run": n,
            "mode": planned.action.lower() + ("_deleted" if source.delete_after else ""),
            "conditions": [r.name for r in source.rule_list],
            "source_year_count": planned.total_rows,
            "retention_years": source.retention_years,
        }
    )
    job.done(
        year,
        "ARCHIVED",
        n,
        conditions_applied=json.dumps([r.name for r in source.rule_list]),
        watermark_value=wm_hi,
        source_year_count=planned.total_rows,
        archive_mode=planned.action,
        archive_delta_version=version,
    )
    if written:
        job.windows[year] = (written.wm_lo, written.wm_hi)


def _delete(job: _Job, store: SliceStore, run_id: str, as_of: dt.date) -> None:
    """Remove freshly archived rows, and finish deletes an earlier attempt of this run left."""
    if not job.source.delete_after:
        return
    fresh = [e for e in job.outcome.years if e["status"] == "ARCHIVED"]
    for y in job.resumes:
        kept, held = job.planned[y].kept_rows, job.known[y].row_count
        if kept != held:
            job.events.append(_verify_failed(job.source, y, held, kept))
            continue
        if held:
            job.windows[y] = (job.known[y].wm_lo, job.known[y].wm_hi)
        job.done(
            y,
            "ARCHIVED_AND_DELETED",
            held,
            watermark_value=job.known[y].high_water,
            source_year_count=job.planned[y].total_rows,
        )
    for e in fresh:
        job.events.append({**e, "status": "ARCHIVED_AND_DELETED", "conditions_applied": None})
    job.events, job.outcome.source_after = delete_windows(store, job.source, as_of, job.windows, run_id, job.events)


def _verify_failed(
    source: Source, year: int, archive_count: int, source_count: int, unproven: int | None = None
) -> dict:
    why = f"source has {source_count}" if unproven is None else f"{unproven} of {source_count} source rows are not among them"
    return {
        "table_name": source.table_id,
        "year": year,
        "status": "VERIFY_FAILED",
        "record_count": archive_count,
        "source_year_count": source_count,
        "error_message": f"{source.table_id} year {year}: archive holds {archive_count} rows, "
        f"{why}; delete refused",
        "needs_review": True,
    }


def window_bounds(source: Source, windows: dict) -> Column:
    """Rows inside a year's inclusive window, as bounds on the raw column."""
    wm = W.col(source.watermark)
    return reduce(
        or_,
        [
            source.in_years(y, y)
            & wm.between(
                W.literal(source.rows, source.watermark, lo), W.literal(source.rows, source.watermark, hi)
            )
            for y, (lo, hi) in sorted(windows.items())
        ],
    )


def doomed_rows(source: Source, as_of: dt.date, windows: dict, rows: DataFrame) -> DataFrame:
    """``rows`` with a boolean ``_doomed``: kept rows inside a window."""
    flagged = source.flagged(as_of, rows)
    doomed = window_bounds(source, windows) & F.col(R.KEEP)
    return R.drop_flags(flagged.withColumn(DOOMED, doomed))


def delete_windows(
    store: SliceStore, source: Source, as_of: dt.date, windows: dict, run_id: str, events: list[dict]
) -> tuple[list[dict], Snapshot | None]:
    """Publish the source without the rows of the given windows, rewriting only hit files.

    ``events`` are the audit rows of the delete. Each doomed row must be in its slice: one scan of the
    source gives counts and content sums per file and year, which are compared with those of the slices' rows
    in the windows. A year that differs loses its window and becomes VERIFY_FAILED; the others are deleted, and the
    number of rows must be the one the events state. The store remembers the snapshot before any audit row
    says that the rows are gone.
    """
    if not windows:
        return events, None
    path = store.fresh(f"{store.base}/source/{source.table_id}/run={run_id}")
    old = source.snapshot or Snapshot(source.rows)

    def mark(chosen: dict) -> Callable[[DataFrame], DataFrame]:
        return lambda rows: doomed_rows(source, as_of, chosen, rows)

    slices = {
        r.year: r for r in store.latest().where(F.col("table_id") == source.table_id).collect() if r.year in windows
    }
    shape = verification.shape_of(source.rows.schema, [ddl(r.schema_ddl) for r in slices.values() if r.schema_ddl])
    doomed = doom(old, window_bounds(source, windows), mark(windows), shape, path)
    held = _held(store, source, shape, slices, windows)
    sums = ("sum_a", "sum_b")
    would = {
        r.slice_year: r
        for r in doomed.groupBy("slice_year").agg(F.sum("d").alias("n"), *[F.sum(s).alias(s) for s in sums]).collect()
    }
    kept = held.groupBy("slice_year").agg(
        F.count(F.lit(1)).alias("n"), *[s.alias(n) for s, n in zip(digest.content_sums(held, shape.names), sums)]
    )
    proven = {r.slice_year: r for r in kept.collect()}
    suspect = [y for y, r in would.items() if r != proven.get(y)]
    if suspect:
        events, windows = _refuse(source, as_of, old, shape, held, suspect, windows, would, proven, events, mark)
        doomed = doomed.where(F.col("slice_year").isin(sorted(windows)))
        if not windows:
            return events, None
    expected = sum(e["record_count"] for e in events if e["status"] == "ARCHIVED_AND_DELETED")
    new = without(old, doomed, mark(windows), path, expected)
    if new is not old:
        store.publish_delete(source.table_id, run_id, path)
    return events, new


def _held(store: SliceStore, source: Source, shape: T.StructType, slices: dict, windows: dict) -> DataFrame:
    """Rows of the slices inside the windows, as ``shape`` with ``slice_year``."""
    rows = store.rows_of(source.table_id, list(slices.values()))
    at = W.instant(rows, source.watermark)
    inside = [
        (F.col("slice_year") == y) & at.between(*[F.lit(b.isoformat(sep=" ")).cast("timestamp_ntz") for b in windows[y]])
        for y in sorted(slices)
    ]
    return evolution.conform(
        rows.where(reduce(or_, inside, F.lit(False))),
        T.StructType(shape.fields + [T.StructField("slice_year", T.IntegerType())]),
    )


def _refuse(source, as_of, old, shape, held, suspect, windows, would, proven, events, mark):
    """Events and windows without the years that hold doomed rows their slice lacks, or that count differently."""
    year = T.StructField("slice_year", T.IntegerType())
    own = {y: windows[y] for y in suspect}
    gone = F.coalesce(F.col(DOOMED), F.lit(False))
    doomed = mark(own)(old.read().where(window_bounds(source, own))).where(gone)
    lacking = verification.not_archived(
        evolution.conform(doomed, T.StructType([*shape.fields, year])), held.where(F.col("slice_year").isin(suspect))
    )
    unproven = {r.slice_year: r.n for r in lacking.groupBy("slice_year").agg(F.sum("copies").alias("n")).collect()}
    failed = {}
    for y in suspect:
        n, m = would[y].n, proven[y].n if y in proven else 0
        if unproven.get(y) or n != m:
            failed[y] = _verify_failed(source, y, m, n, unproven.get(y, 0) if n == m or unproven.get(y) else None)
    events = [failed.get(e["year"], e) if e["status"] == "ARCHIVED_AND_DELETED" else e for e in events]
    return events, {y: w for y, w in windows.items() if y not in failed}


# -- delete job -------------------------------------------------------------------------


def plan_delete(
    source: Source,
    store: SliceStore,
    log: DataFrame,
    run_id: str,
    as_of: dt.date,
    now: dt.datetime,
    years: list[int] | None = None,
    stale_hours: float = 4.0,
    reconciled: DataFrame | None = None,
) -> DataFrame:
    """Which archived years may leave the source: guard, eligibility, drift, in that order."""
    spark = store.spark
    log = _log_of(log, source)
    counts = profile.year_profile(source, as_of, years=years).where("slice_year IS NOT NULL")
    counted = counts.select("slice_year", F.col("kept_rows").alias("source_count"))
    if years is None:
        scope = counted
    else:
        wanted = local_frame(spark, [(y,) for y in sorted({int(y) for y in years})], "slice_year INT")
        scope = wanted.join(counted, "slice_year", "left")
    scope = scope.select(F.lit(source.table_id).alias("table_id"), "slice_year", "source_count")
    held = store.states([source.table_id]).select(
        "table_id", F.col("year").alias("slice_year"), "slice_state", F.col("row_count").alias("archive_count")
    )
    return decisions.delete_plan(
        scope,
        audit_state.delete_eligibility(log, run_id, now, stale_hours, reconciled),
        audit_state.busy_tables(log, run_id, now, stale_hours),
        held,
    )


def delete_archived(
    source: Source,
    store: SliceStore,
    audit: AuditLog,
    run_id: str,
    as_of: dt.date,
    years: list[int] | None = None,
    dry_run: bool = True,
    stale_hours: float = 4.0,
) -> Outcome:
    """The delete job: remove rows of already archived years, or record what would happen."""
    out = Outcome(source.table_id)
    log = audit.rows()
    planned = plan_delete(
        source, store, log, run_id, as_of, audit.clock(), years, stale_hours, audit.reconciliations()
    )
    if dry_run:
        shown = planned.select(
            "table_id",
            "slice_year",
            "action",
            "reason",
            F.when(F.col("action").isin("WOULD_DELETE", "SKIP_DRIFT"), F.col("source_count"))
            .otherwise(F.lit(0)).cast("bigint").alias("total_eligible"),
            F.when(F.col("action") == "WOULD_DELETE", F.col("source_count")).otherwise(F.lit(0)).cast("bigint").alias("would_archive"),
            F.create_map().cast("map<string,bigint>").alias("per_condition_counts"),
        )
        no_nulls = store.spark.createDataFrame([], "table_id STRING, null_rows BIGINT")
        audit.append(dry_run_events(shown, no_nulls, run_id, audit.clock()))
        out.years = [r.asDict() for r in planned.orderBy("slice_year").collect()]
        return out

    verdicts = planned.orderBy("slice_year").collect()
    slices = {r.year: r for r in store.latest().where(F.col("table_id") == source.table_id).collect()}
    prior = {r.year: r for r in audit_state.prior_archived(_log_of(log, source)).collect()}
    events, windows = [], {}
    for v in verdicts:
        y = v.slice_year
        if v.action == "SKIP_DRIFT":
            events.append(_verify_failed(source, y, v.archive_count, v.source_count))
        elif v.action == "WOULD_DELETE":
            if v.archive_count:
                windows[y] = (slices[y].wm_lo, slices[y].wm_hi)
            p = prior.get(y)
            origin = f"slice written by run {p.archive_run_id} on {p.archived_at}" if p else "writer of the slice unknown"
            events.append(
                {
                    "table_name": source.table_id,
                    "year": y,
                    "status": "ARCHIVED_AND_DELETED",
                    "record_count": v.source_count,
                    "error_message": f"{v.source_count} source rows removed; {origin}",
                    "watermark_value": slices[y].wm_hi,
                    "archive_mode": "DELETE",
                }
            )
        else:
            events.append(
                {
                    "table_name": source.table_id,
                    "year": y,
                    "status": "FAILED",
                    "record_count": 0,
                    "error_message": v.reason,
                    "needs_review": True,
                }
            )
    events, out.source_after = delete_windows(store, source, as_of, windows, run_id, events)
    audit.record(run_id, events)
    out.years = events
    return out


def work_plan(sources: list[Source], as_of: dt.date, years: list[int] | None = None) -> DataFrame:
    """(table_id, slice_year, last_eligible_year) of every slice the job would touch.

    Tables that name their Parquet ``location`` share one scan per watermark column, type and time zone; any other
    table is a scan of its own.
    """
    parts, shared = [], {}
    for s in sources:
        if s.whole_location() is None:
            parts.append(
                profile.eligible_years(s, as_of).withColumn("last_eligible_year", F.lit(s.last_eligible_year(as_of)))
            )
        else:
            shared.setdefault((s.watermark, W.type_of(s.rows, s.watermark), s.timezone), []).append(s)
    parts += [profile.eligible_years_of(group, as_of) for group in shared.values()]
    plan_rows = reduce(DataFrame.unionByName, parts)
    if years is not None:
        plan_rows = plan_rows.where(F.col("slice_year").isin([int(y) for y in years]))
    return plan_rows


def _ddl_of(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)


def _least(a, b):
    return min((x for x in (a, b) if x is not None), default=None)


def _greatest(a, b):
    return max((x for x in (a, b) if x is not None), default=None)
