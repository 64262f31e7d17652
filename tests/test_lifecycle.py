"""Whole runs on real Spark: nothing is lost, nothing is doubled, and reruns change nothing."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import tidemark as tm
from tidemark.operators import profile
from tidemark.plans.jobs import run_delete, sources
from tidemark.operators.config import ConfigError

AS_OF = dt.date(2025, 6, 30)  # retention 5: years up to 2020
DDL = "id INT, status STRING, amount DOUBLE, at TIMESTAMP_NTZ"
KEEP_OPEN = tm.Rule("open", "same_table", "status", "equals", "open")


def rows(first_id, year, n, month=3, status="done"):
    return [
        (first_id + i, status, float(i), dt.datetime(year, month, 1 + i % 27, i % 24, 30, 0, i)) for i in range(n)
    ]


BASE = rows(0, 2018, 30) + rows(100, 2020, 40) + rows(200, 2022, 20) + [
    (300, "open", 1.0, dt.datetime(2018, 4, 1)),
    (301, None, 1.0, dt.datetime(2018, 4, 2)),
    (302, "done", 1.0, None),
]


def source(df, **more):
    return tm.Source("db.t", df, "at", 5, **{"rules": (KEEP_OPEN,), **more})


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


def statuses(outcome):
    return {(e["year"], e["status"]): e["record_count"] for e in outcome.years}


def same_rows(a, b):
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_archive_and_rerun(life, table):
    store, audit = life
    src = source(table(BASE, DDL))
    assert statuses(tm.archive(src, store, audit, "r1", AS_OF)) == {(2018, "ARCHIVED"): 30, (2020, "ARCHIVED"): 40}
    # the NULL status and the NULL date stay out, like the protected row
    assert ids(store.read("db.t")) == list(range(30)) + list(range(100, 140))
    again = tm.archive(src, store, audit, "r2", AS_OF)
    assert statuses(again) == {(2018, "SKIPPED"): 0, (2020, "SKIPPED"): 0}
    assert store.read("db.t").count() == 70


def test_dry_run_equals_live(life, table):
    store, audit = life
    src = source(table(BASE, DDL))
    planned = {r.slice_year: r for r in tm.dry_run(src, store, audit, "d", AS_OF).collect()}
    assert {y: r.would_archive for y, r in planned.items()} == {2018: 30, 2020: 40}
    assert planned[2018].per_condition_counts == {"open": 1}
    assert store.states().count() == 0
    live = tm.archive(src, store, audit, "r1", AS_OF)
    assert {y: n for (y, s), n in statuses(live).items() if s == "ARCHIVED"} == {2018: 30, 2020: 40}
    undated = audit.rows().where("status = 'DRY_RUN' AND year IS NULL").collect()
    assert [r.null_date_count for r in undated] == [1]


def test_append_below_a_day(life, table):
    """A watermark in the middle of a day neither repeats nor loses rows of that day."""
    store, audit = life
    noon = dt.datetime(2020, 5, 5, 12)
    early = [(i, "done", 0.0, noon - dt.timedelta(minutes=i)) for i in range(10)]
    late = [(50 + i, "done", 0.0, noon + dt.timedelta(microseconds=1 + i)) for i in range(7)]
    tm.archive(source(table(early, DDL, name="a")), store, audit, "r1", AS_OF)
    out = tm.archive(source(table(early + late, DDL, name="b")), store, audit, "r2", AS_OF)
    assert statuses(out) == {(2020, "ARCHIVED"): 7}
    assert ids(store.read("db.t")) == list(range(10)) + list(range(50, 57))
    assert store.history().first().versions == [0, 1]


def test_conservation_with_delete(spark, life, table):
    """Archived plus retained is the source, as multisets, with duplicates and NULLs."""
    store, audit = life
    df = table(BASE + BASE[:5], DDL, files=3)
    out = tm.archive(source(df, delete_after=True), store, audit, "r1", AS_OF)
    left = out.source_after.read(spark)
    same_rows(df, left.unionByName(store.read("db.t").drop("slice_year")))
    assert left.count() == 20 + 3
    assert statuses(out)[(2018, "ARCHIVED_AND_DELETED")] == 35


def test_delete_rewrites_only_hit_files(spark, life, tmp_path):
    store, audit = life
    path = f"{tmp_path}/files"
    for y in (2018, 2020, 2022):
        spark.createDataFrame(rows(y * 100, y, 10), DDL).coalesce(1).write.mode("append").parquet(path)
    mixed = rows(1, 2020, 3) + rows(9, 2023, 2)
    spark.createDataFrame(mixed, DDL).coalesce(1).write.mode("append").parquet(path)
    df = spark.read.schema(DDL).parquet(path)
    out = tm.archive(source(df, delete_after=True), store, audit, "r1", AS_OF)
    (done,) = out.source_after.deletes
    touched = {(r.n, r.d) for r in spark.read.parquet(f"{done}/files").collect()}
    assert touched == {(10, 10), (5, 3)}  # two whole files, and the mixed one
    assert ids(spark.read.parquet(f"{done}/rows")) == [9, 10]  # of which only the rest is written anew
    assert ids(out.source_after.read(spark)) == sorted([9, 10] + [202200 + i for i in range(10)])


def test_delete_refused_when_source_is_not_what_was_archived(life, table):
    """A source filtered in the plan would delete rows that were never archived."""
    store, audit = life
    df = table(BASE, DDL).where("id % 2 = 0")
    with pytest.raises(ValueError, match="delete refused"):
        tm.archive(source(df, delete_after=True), store, audit, "r1", AS_OF)
    assert audit.rows().where("status = 'ARCHIVED_AND_DELETED'").count() == 0
    assert audit.rows().where("status = 'FAILED'").count() == 2


def test_delete_after_append_in_same_run(spark, life, table):
    store, audit = life
    first = rows(0, 2020, 10)
    tm.archive(source(table(first, DDL, name="a")), store, audit, "r1", AS_OF)
    second = first + rows(50, 2020, 5, month=9)
    out = tm.archive(source(table(second, DDL, name="b"), delete_after=True), store, audit, "r2", AS_OF)
    # only the rows of this run leave the source
    assert ids(out.source_after.read(spark)) == list(range(10))
    assert statuses(out)[(2020, "ARCHIVED_AND_DELETED")] == 5


def test_resume_delete_checks_drift(spark, life, table):
    store, audit = life
    seen = rows(0, 2018, 10) + rows(50, 2020, 10)
    tm.archive(source(table(seen, DDL, name="a")), store, audit, "r1", AS_OF)
    grown = table(seen + rows(90, 2020, 1), DDL, name="b")
    out = tm.archive(source(grown, delete_after=True), store, audit, "r1", AS_OF)
    assert statuses(out) == {(2018, "ARCHIVED_AND_DELETED"): 10, (2020, "VERIFY_FAILED"): 10}
    assert ids(out.source_after.read(spark)) == list(range(50, 60)) + [90]
    # VERIFY_FAILED blocks later appends until somebody reconciles
    more = table(seen + rows(95, 2020, 1, month=12), DDL, name="c")
    blocked = tm.archive(source(more), store, audit, "r5", AS_OF)
    assert [e["error_message"] for e in blocked.years if e["year"] == 2020] == ["verify_failed_requires_reconcile"]


def test_delete_job(spark, life, table):
    store, audit = life
    src = source(table(BASE, DDL))
    tm.archive(src, store, audit, "r1", AS_OF)
    dry = tm.delete_archived(src, store, audit, "d1", AS_OF)
    assert {y["slice_year"]: y["action"] for y in dry.years} == {2018: "WOULD_DELETE", 2020: "WOULD_DELETE"}
    assert dry.source_after is None
    out = tm.delete_archived(src, store, audit, "x1", AS_OF, years=[2020, 2022], dry_run=False)
    assert statuses(out) == {(2020, "ARCHIVED_AND_DELETED"): 40, (2022, "FAILED"): 0}
    assert "r1" in out.years[0]["error_message"]
    same_rows(src.rows, out.source_after.read(spark).unionByName(store.read("db.t", [2020]).drop("slice_year")))
    # a second delete finds the year no longer in state ARCHIVED
    again = tm.delete_archived(src, store, audit, "x2", AS_OF, years=[2020], dry_run=False)
    assert again.years[0]["error_message"] == "not_archived_state"


def test_delete_job_guard_and_missing_slice(life, table):
    store, audit = life
    src = source(table(BASE, DDL))
    audit.record("other", [{"table_name": "db.t", "year": 2020, "status": "STARTED", "record_count": 0}])
    busy = tm.plan_delete(src, store, audit.rows(), "x", AS_OF, audit.clock())
    assert {r.action for r in busy.collect()} == {"SKIP_CONCURRENT"}
    audit.record("other", [{"table_name": "db.t", "year": 2020, "status": "ARCHIVED", "record_count": 40}])
    missing = tm.plan_delete(src, store, audit.rows(), "x", AS_OF, audit.clock(), years=[2020])
    assert [(r.action, r.reason) for r in missing.collect()] == [("ERROR", "archive_slice_missing")]


def test_concurrent_run_is_respected_until_stale(life, table):
    store, audit = life
    src = source(table(BASE, DDL))
    audit.record("other", [{"table_name": "db.t", "year": 2018, "status": "STARTED", "record_count": 0}])
    out = tm.archive(src, store, audit, "r1", AS_OF)
    assert statuses(out) == {(2018, "SKIPPED_CONCURRENT"): 0, (2020, "ARCHIVED"): 40}
    later = tm.AuditLog(audit.spark, audit.base, clock=lambda: dt.datetime.now(dt.timezone.utc) + dt.timedelta(hours=5))
    out = tm.archive(src, store, later, "r2", AS_OF)
    assert statuses(out) == {(2018, "ARCHIVED"): 30, (2020, "SKIPPED"): 0}


def test_orphan_and_lost_directories(life, table, tmp_path):
    store, audit = life
    src = source(table(BASE, DDL))
    crashed = src.flagged(AS_OF).where("slice_year = 2018").select(*src.rows.columns, "slice_year")
    store.write_rows(crashed, "db.t", "crashed")
    out = tm.archive(src, store, audit, "r1", AS_OF)
    assert [e["error_message"] for e in out.years if e["year"] == 2018] == ["archive_folder_orphan"]
    assert ids(store.read("db.t")) == list(range(100, 140))
    # a published slice whose directory is gone is MISSING; without a source delete it is written again
    (tmp_path / "data/db.t/run=r1").rename(tmp_path / "elsewhere")
    assert {(r.year, r.slice_state) for r in store.states().collect()} == {(2018, "ORPHAN"), (2020, "MISSING")}
    out = tm.archive(src, store, audit, "r2", AS_OF)
    assert statuses(out)[(2020, "ARCHIVED")] == 40
    assert ids(store.read("db.t")) == list(range(100, 140))


def request(spark, audit, run_id, year):
    return (
        audit.rows()
        .where((F.col("archive_run_id") == run_id) & (F.col("year") == year) & (F.col("status") == "ARCHIVED"))
        .select(F.col("audit_id").alias("target_audit_id"), F.col("table_name").alias("table_id"), "year")
    )


def test_rollback_undoes_append_and_append_returns(spark, life, table):
    store, audit = life
    first, more = rows(0, 2020, 10), rows(50, 2020, 5, month=9)
    tm.archive(source(table(first, DDL, name="a")), store, audit, "r1", AS_OF)
    whole = source(table(first + more, DDL, name="b"))
    tm.archive(whole, store, audit, "r2", AS_OF)
    before = store.fingerprints("db.t").collect()
    asked = request(spark, audit, "r1", 2020)
    assert tm.rollback(store, audit, asked, "b0").first().action == "WOULD_RECOVERY_ARCHIVE_ROLLED_BACK"
    assert store.read("db.t").count() == 15
    assert tm.rollback(store, audit, asked, "b1", dry_run=False).first().action == "RECOVERY_ARCHIVE_ROLLED_BACK"
    assert ids(store.read("db.t")) == list(range(10))
    assert store.history().first().versions == [0, 1, 2]
    tm.archive(whole, store, audit, "r3", AS_OF)
    assert store.fingerprints("db.t").collect() == before


def test_rollback_refused_after_source_delete(spark, life, table):
    store, audit = life
    tm.archive(source(table(rows(0, 2020, 10), DDL), delete_after=True), store, audit, "r1", AS_OF)
    report = tm.rollback(store, audit, request(spark, audit, "r1", 2020), "b1", dry_run=False).collect()
    assert [r.refused_by for r in report] == ["rollback_after_source_delete_refused"]
    assert store.history().first().versions == [0]


def test_wipe_then_refill(spark, life, table):
    store, audit = life
    src = source(table(BASE, DDL))
    tm.archive(src, store, audit, "r1", AS_OF)
    asked = spark.createDataFrame([("db.t", 2020, "bad")], "table_id STRING, year INT, wipe_reason STRING")
    assert tm.wipe(store, audit, asked, "w0").first().rows_deleted == 40
    assert store.read("db.t", [2020]).count() == 40
    tm.wipe(store, audit, asked, "w1", dry_run=False)
    assert store.read("db.t", [2020]).count() == 0
    assert {r.year: (r.slice_state, r.row_count) for r in store.states().collect()}[2020] == ("VALID", 0)
    out = tm.archive(src, store, audit, "r2", AS_OF)
    assert statuses(out) == {(2018, "SKIPPED"): 0, (2020, "ARCHIVED"): 40}


def test_late_row_is_left_and_reported(life, table):
    from tidemark.operators import reports

    store, audit = life
    tm.archive(source(table(rows(0, 2020, 10, month=6), DDL, name="a")), store, audit, "r1", AS_OF)
    late = [(900, "done", 0.0, dt.datetime(2020, 1, 1))] * 2 + [(0, "done", 0.0, rows(0, 2020, 1, month=6)[0][3])]
    src = source(table(rows(0, 2020, 10, month=6) + late, DDL, name="b"))
    assert statuses(tm.archive(src, store, audit, "r2", AS_OF)) == {(2020, "SKIPPED"): 0}
    flagged = src.flagged(AS_OF).where("_keep").withColumn("_wm", src.instant())
    marks = store.latest().select(F.col("year").alias("slice_year"), F.col("wm_hi").alias("high_water"))
    found = reports.late_arrivals(flagged, store.read("db.t"), marks).collect()
    assert {(r.id, r.copies) for r in found} == {(900, 2), (0, 1)}


@pytest.mark.parametrize("kind", ["DATE", "TIMESTAMP"])
def test_other_watermark_types(spark, life, table, kind):
    store, audit = life
    utc = dt.timezone.utc
    value = (lambda y, m, d, h=0: dt.date(y, m, d)) if kind == "DATE" else (
        lambda y, m, d, h=0: dt.datetime(y, m, d, h, tzinfo=utc)
    )
    ddl = f"id INT, at {kind}"
    first = [(1, value(2020, 2, 1)), (2, value(2020, 3, 1, 5)), (3, value(2022, 1, 1))]
    src = lambda r, n: tm.Source("z", table(r, ddl, name=n), "at", 5)
    tm.archive(src(first, "a"), store, audit, "r1", AS_OF)
    assert ids(store.read("z")) == [1, 2]
    out = tm.archive(src(first + [(4, value(2020, 4, 1))], "b"), store, audit, "r2", AS_OF)
    assert statuses(out) == {(2020, "ARCHIVED"): 1}


def test_year_follows_the_time_zone(spark, table):
    # 03:00 UTC on New Year's Day is still the old year in New York
    df = table([(1, dt.datetime(2021, 1, 1, 3, tzinfo=dt.timezone.utc))], "id INT, at TIMESTAMP")
    utc = tm.Source("z", df, "at", 5)
    local = tm.Source("z", df, "at", 5, timezone="America/New_York")
    assert [r.slice_year for r in profile.eligible_years(local, AS_OF).collect()] == [2020]
    assert profile.eligible_years(utc, AS_OF).count() == 0


def test_schema_change_of_one_year(spark, life, table):
    """Years written before a column was widened and one added read together with later ones."""
    store, audit = life
    old = rows(0, 2018, 4) + rows(10, 2020, 4)
    tm.archive(source(table(old, DDL, name="a")), store, audit, "r1", AS_OF)
    wider = [(*r, "eu") for r in old + rows(50, 2020, 2, month=9)]
    df = table(wider, "id BIGINT, status STRING, amount DOUBLE, at TIMESTAMP_NTZ, region STRING", name="b")
    refused = tm.archive(source(df), store, audit, "r2", AS_OF)
    assert [e["status"] for e in refused.years if e["year"] == 2020] == ["FAILED"]
    assert "schema_drift" in [e["error_message"] for e in refused.years if e["year"] == 2020][0]
    tm.archive(source(df), store, audit, "r3", AS_OF, merge_schema=True)
    got = store.read("db.t")
    assert dict(got.dtypes)["id"] == "bigint"
    assert {r.id: r.region for r in got.collect()} == {**{r[0]: None for r in old}, 50: "eu", 51: "eu"}


def test_empty_slice_is_filled_once_rows_are_free(life, table):
    """All rows protected: an empty slice, which a later run creates again."""
    store, audit = life
    src = source(table(rows(0, 2020, 5, status="open"), DDL))
    assert statuses(tm.archive(src, store, audit, "r1", AS_OF)) == {(2020, "ARCHIVED"): 0}
    again = source(table(rows(0, 2020, 5, status="done"), DDL, name="b"))
    assert statuses(tm.archive(again, store, audit, "r2", AS_OF)) == {(2020, "ARCHIVED"): 5}
    assert store.read("db.t").count() == 5


def test_one_broken_table_does_not_stop_others(life, table):
    store, audit = life
    good = source(table(BASE, DDL, name="a"))
    bad = tm.Source("db.bad", table(BASE, DDL, name="b"), "at", 5, rules=(tm.Rule("x", "same_table", "gone", "equals", 1),))
    with pytest.raises(Exception, match="'x'"):
        tm.archive_tables([bad, good], store, audit, "r1", AS_OF)
    assert ids(store.read("db.t")) == list(range(30)) + list(range(100, 140))


def test_audit_rejects_unknown_status(spark, life):
    _, audit = life
    with pytest.raises(ValueError):
        audit.record("r", [{"table_name": "t", "year": 1, "status": "DONE", "record_count": 0}])
    with pytest.raises(Exception, match="not allowed"):
        audit.append(spark.createDataFrame([("a", "DONE")], "audit_id STRING, status STRING"))


def test_jobs_from_config(spark, life, table):
    store, audit = life
    df = table(BASE, DDL)
    row = ("db.t", "c", "db", "t", "at", None, "/archive", False, True, [("open", "same_table", "status", "equals", "open", None)], None)
    ddl = (
        "table_id STRING, source_catalog STRING, source_schema STRING, source_table STRING, watermark_column STRING, "
        "retention_years INT, archive_base_path STRING, delete_after_archive BOOLEAN, is_active BOOLEAN, "
        "exclusion_conditions ARRAY<STRUCT<name: STRING, scope: STRING, column: STRING, operator: STRING, value: STRING, sql: STRING>>, timezone STRING"
    )
    config = spark.createDataFrame([row], ddl)
    found = sources(spark, config, 5, read=lambda r: df)
    assert statuses(tm.archive(found[0], store, audit, "r1", AS_OF)) == {(2018, "ARCHIVED"): 30, (2020, "ARCHIVED"): 40}
    with pytest.raises(ConfigError, match="filter"):
        run_delete(found, store, audit, AS_OF, is_dry=False)
    with pytest.raises(ConfigError, match="no active table"):
        sources(spark, config, 5, read=lambda r: df, table_id="other")
    broken = config.withColumn("archive_base_path", F.lit(" "))
    with pytest.raises(ConfigError, match="archive_base_path is missing"):
        sources(spark, broken, 5, read=lambda r: df)


def test_restore(spark, life, table):
    store, audit = life
    df = table(BASE, DDL)
    tm.archive(source(df), store, audit, "r1", AS_OF)
    done = tm.restore(store, audit, "db.t", [2018, 2019, 2020], live=df, prefix="p_")
    assert done.status == "PARTIAL_COMPLETED" and done.skipped == [2019]
    assert ids(spark.table("p_t_year_2018")) == list(range(30))
    assert spark.table("p_t_unified").count() == len(BASE) + 70
    with pytest.raises(LookupError):
        tm.restore(store, audit, "db.t", [2019])
    with pytest.raises(ValueError, match="column types differ"):
        tm.restore(store, audit, "db.t", [2018], live=df.withColumn("id", F.col("id").cast("bigint")))
    assert [r.status for r in audit.restores().orderBy("created_at").collect()] == ["PARTIAL_COMPLETED", "FAILED", "FAILED"]


def test_partitioned_source_keeps_its_partition_columns(spark, life, tmp_path):
    store, audit = life
    days = [(i, "done" if i % 2 else None, dt.date(2018 + i % 3, 1, 1 + i % 9)) for i in range(60)]
    for column in ("at", "status"):
        path = f"{tmp_path}/by {column}"  # a blank in the path
        spark.createDataFrame(days, "id INT, status STRING, at DATE").write.partitionBy(column).parquet(path)
        df = spark.read.schema("id INT, status STRING, at DATE").parquet(path)
        src = tm.Source(f"by_{column}", df, "at", 5, delete_after=True)
        out = tm.archive(src, store, audit, f"nightly run {column}", AS_OF)
        held = store.read(f"by_{column}").select("id", "status", "at")
        assert sorted(map(tuple, held.collect()), key=str) == sorted(days, key=str)
        assert out.source_after.read(spark).count() == 0
        again = tm.archive(src, store, audit, "next run", AS_OF)
        assert {e["status"] for e in again.years} == {"SKIPPED"}


def test_delete_outlives_the_session_objects(life, table):
    store, audit = life
    df = table(BASE, DDL)
    tm.archive(source(df, delete_after=True), store, audit, "r1", AS_OF)
    snapshot = store.source_snapshot("db.t", df)
    left = snapshot.read()
    assert left.count() == len(BASE) - 70
    src = source(left, snapshot=snapshot, delete_after=True)
    assert {e["status"] for e in tm.archive(src, store, audit, "r2", AS_OF).years} <= {"SKIPPED"}


def test_repeated_run_id_and_unsafe_names(life, table):
    store, audit = life
    first = table(rows(0, 2020, 5), DDL)
    tm.archive(source(first), store, audit, "r1", AS_OF)
    more = table(rows(0, 2020, 5) + rows(50, 2020, 3, month=9), DDL, name="b")
    assert statuses(tm.archive(source(more), store, audit, "r1", AS_OF)) == {(2020, "ARCHIVED"): 3}
    assert store.read("db.t").count() == 8
    for bad in ("a/b", "", "x*", "{a,b}", "50%"):
        with pytest.raises(ValueError):
            tm.archive(source(first), store, audit, bad, AS_OF)
    with pytest.raises(ValueError, match="used by the jobs"):
        source(first.withColumn("slice_year", F.lit(1)))


def test_only_the_slice_at_odds_is_refused(life, table):
    """An old column of one slice decides nothing for another."""
    store, audit = life
    wide = table([(*r, "x") for r in rows(0, 2018, 3)], DDL + ", old STRING", name="a")
    tm.archive(source(wide), store, audit, "r1", AS_OF)
    tm.archive(source(table(rows(20, 2019, 3), DDL, name="b")), store, audit, "r2", AS_OF)
    batch = rows(0, 2018, 3) + rows(40, 2018, 2, month=9) + rows(20, 2019, 3) + rows(60, 2019, 2, month=9)
    out = tm.archive(source(table(batch, DDL, name="c")), store, audit, "r3", AS_OF)
    assert statuses(out) == {(2018, "ARCHIVED"): 2, (2019, "ARCHIVED"): 2}
    assert "old" not in store.read("db.t", [2019]).columns


def test_a_failed_plan_leaves_a_row(life, table):
    store, audit = life
    bad = source(table(BASE, DDL), rules=(tm.Rule("r", "same_table", "id", "equals", "abc"),))
    with pytest.raises(ValueError):
        tm.archive(bad, store, audit, "r1", AS_OF)
    assert [(r.year, r.status) for r in audit.rows().collect()] == [(None, "FAILED")]
