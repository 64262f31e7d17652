"""Slices stay small: version rows grow with appends, not with their square, and small files are packed."""

import datetime as dt
import shutil

import pytest
from pyspark.sql import functions as F
from test_lifecycle import AS_OF, DDL, ids, rows, same_rows, source

import tidemark as tm
from tidemark.plans.compaction import small_directories

DAYS = [dt.datetime(2020, m, 5) for m in range(1, 7)]


@pytest.fixture
def appended(life, table):
    """2020 in five appends, 2018 in one."""
    store, audit = life
    for k in range(1, 6):
        data = rows(0, 2018, 5) + [r for m in range(1, k + 1) for r in rows(100 * m, 2020, 4, month=m)]
        tm.archive(source(table(data, DDL, name=f"t{k}")), store, audit, f"r{k}", AS_OF)
    return store, audit


def test_versions_compaction_and_recovery(spark, appended):
    store, audit = appended
    raw = store.versions().where("year = 2020").select("version", "chain", F.size("dirs").alias("n")).orderBy("version")
    assert [tuple(r) for r in raw.collect()] == [(k, 0, 1) for k in range(5)]  # one directory a row
    before = store.read("db.t")
    assert store.latest().where("year = 2020").first().live_dirs == [f"{store.run_dir('db.t', f'r{k}')}/slice_year=2020" for k in range(1, 6)]
    assert len(ids(store.read("db.t", [2020], version=2))) == 12

    done = {r.year: r for r in tm.compact(store, audit, "db.t", "c1").collect()}
    assert set(done) == {2020} and done[2020].files == 5 and done[2020].error is None
    newest = store.latest().where("year = 2020").first()
    assert (newest.op, newest.version, newest.chain, newest.row_count) == ("COMPACT", 5, 5, 20)
    assert newest.live_dirs == [f"{store.run_dir('db.t', 'c1')}/slice_year=2020"]
    same_rows(before, store.read("db.t"))
    assert {r.slice_state for r in store.states().collect()} == {"VALID"}
    assert tm.compact(store, audit, "db.t", "c2").count() == 0  # nothing is left to do

    # an append goes on from the compacted slice, a rollback before it
    more = rows(0, 2018, 5) + [r for m in range(1, 7) for r in rows(100 * m, 2020, 4, month=m)]
    tm.archive(source(spark.createDataFrame(more, DDL)), store, audit, "r6", AS_OF)
    newest = store.latest().where("year = 2020").first()
    assert (newest.version, newest.chain, len(newest.live_dirs), newest.row_count) == (6, 5, 2, 24)
    target = audit.rows().where("archive_run_id = 'r2' AND status = 'ARCHIVED' AND year = 2020").first().audit_id
    asked = spark.createDataFrame([(target, "db.t", 2020)], "target_audit_id STRING, table_id STRING, year INT")
    assert tm.rollback(store, audit, asked, "b1", dry_run=False).first().refused_by is None
    assert len(ids(store.read("db.t", [2020]))) == 8

    # a lost directory takes the later versions of its chain, and no others
    shutil.rmtree(f"{store.run_dir('db.t', 'r3')}/slice_year=2020")
    assert sorted(r.version for r in store.recoverable().where("year = 2020").collect()) == [0, 1, 5, 6, 7]


def test_large_directories_stay_and_busy_tables_are_left_alone(spark, appended):
    store, audit = appended
    sizes = small_directories(store, "db.t").first()
    assert sizes.year == 2020 and len(sizes.rewrite) == 5 and not sizes.stay
    assert small_directories(store, "db.t", target_bytes=2).count() == 0
    audit.record("other", [{"table_name": "db.t", "year": 2018, "status": "STARTED", "record_count": 0}])
    with pytest.raises(RuntimeError, match="another run"):
        tm.compact(store, audit, "db.t", "c1")


def test_a_bad_rewrite_changes_nothing(spark, appended):
    store, audit = appended

    class Losing(tm.SliceStore):
        def _save(self, rows, path):
            super()._save(rows.where("id <> 101"), path)

    found = tm.compact(Losing(spark, store.base), audit, "db.t", "c1").first()
    assert found.error and store.latest().where("year = 2020").first().op == "APPEND"
    assert len(ids(store.read("db.t", [2020]))) == 20
