"""Writes are verified by content, and a delete proves that every row it takes is archived."""

import datetime as dt

from pyspark.sql import functions as F
from test_lifecycle import AS_OF, BASE, DDL, ids, rows, same_rows, source, statuses

import tidemark as tm
from tidemark.functions import digest
from tidemark.operators.verification import not_archived
from tidemark.sources.tables import file_listing


class Swapping(tm.SliceStore):
    """Writes another amount for one row of 2018 than it was given."""

    def _save(self, rows, path):
        changed = F.when((F.col("id") == 3) & (F.col("slice_year") == 2018), -1.0).otherwise(F.col("amount"))
        super()._save(rows.withColumn("amount", changed), path)


def test_a_swapped_row_is_not_published(spark, life, table):
    store, audit = life
    out = tm.archive(source(table(BASE, DDL)), Swapping(spark, store.base), audit, "r1", AS_OF)
    assert statuses(out) == {(2018, "FAILED"): 0, (2020, "ARCHIVED"): 40}
    assert "not the rows written" in next(e["error_message"] for e in out.years if e["year"] == 2018)
    assert ids(store.read("db.t")) == list(range(100, 140))
    # and nothing of it is deleted
    again = tm.archive(source(table(BASE, DDL, name="b"), delete_after=True), Swapping(spark, store.base), audit, "r2", AS_OF)
    assert (2018, "ARCHIVED_AND_DELETED") not in statuses(again)


def test_delete_of_a_row_that_is_not_archived(spark, life, table):
    store, audit = life
    tm.archive(source(table(BASE, DDL, name="a")), store, audit, "r1", AS_OF)
    swapped = [(r[0], r[1], 99.5 if r[0] == 7 else r[2], r[3]) for r in BASE]
    df = table(swapped, DDL, files=2, name="b")
    out = tm.delete_archived(source(df), store, audit, "x1", AS_OF, [2018, 2020], dry_run=False)
    assert statuses(out) == {(2018, "VERIFY_FAILED"): 30, (2020, "ARCHIVED_AND_DELETED"): 40}
    failed = next(e for e in out.years if e["year"] == 2018)
    assert failed["needs_review"] and "1 of 30 source rows are not among them" in failed["error_message"]
    same_rows(out.source_after.read(spark), df.where("at IS NULL OR year(at) <> 2020"))


def test_nothing_is_deleted_where_no_year_is_proven(spark, life, table):
    store, audit = life
    tm.archive(source(table(rows(0, 2018, 10), DDL, name="a")), store, audit, "r1", AS_OF)
    moved = table([(i, s, a + 1, at) for i, s, a, at in rows(0, 2018, 10)], DDL, name="b")
    out = tm.delete_archived(source(moved), store, audit, "x1", AS_OF, [2018], dry_run=False)
    assert statuses(out) == {(2018, "VERIFY_FAILED"): 10} and out.source_after is None
    assert store.source_snapshot("db.t", moved).deletes == ()


def test_new_columns_of_the_source(spark, life, table):
    """A column the slice lacks holds the delete back only where it holds a value."""
    store, audit = life
    tm.archive(source(table(BASE, DDL, name="a")), store, audit, "r1", AS_OF)
    grown = [(*r, "x" if r[0] == 105 else None) for r in BASE]
    df = table(grown, DDL + ", note STRING", name="b")
    out = tm.delete_archived(source(df), store, audit, "x1", AS_OF, [2018, 2020], dry_run=False)
    assert statuses(out) == {(2018, "ARCHIVED_AND_DELETED"): 30, (2020, "VERIFY_FAILED"): 40}


def test_widened_and_dropped_columns_of_the_source(spark, life, table):
    store, audit = life
    tm.archive(source(table(BASE, DDL, name="a")), store, audit, "r1", AS_OF)
    df = table([(r[0], r[1], r[3]) for r in BASE], "id BIGINT, status STRING, at TIMESTAMP_NTZ", name="b")
    out = tm.delete_archived(source(df), store, audit, "x1", AS_OF, [2018, 2020], dry_run=False)
    assert statuses(out) == {(2018, "ARCHIVED_AND_DELETED"): 30, (2020, "ARCHIVED_AND_DELETED"): 40}


def test_a_reconciled_slice_is_released(spark, life, table):
    store, audit = life
    first = rows(0, 2018, 5) + rows(50, 2020, 5)
    tm.archive(source(table(first, DDL, name="a")), store, audit, "r1", AS_OF)
    failed = {"table_name": "db.t", "status": "VERIFY_FAILED", "record_count": 0}
    audit.record("r0", [{**failed, "year": 2018}, {**failed, "year": 2020}])
    audit.reconcile("db.t", [2020], "checked by hand")
    more = table(first + rows(80, 2018, 2, month=9) + rows(90, 2020, 3, month=9), DDL, name="b")
    out = tm.archive(source(more), store, audit, "r2", AS_OF)
    assert statuses(out) == {(2018, "FAILED"): 0, (2020, "ARCHIVED"): 3}
    out = tm.delete_archived(source(more), store, audit, "x1", AS_OF, [2018, 2020], dry_run=True)
    assert {y["slice_year"]: y["action"] for y in out.years} == {2018: "SKIP_NOT_ELIGIBLE", 2020: "WOULD_DELETE"}
    audit.record("r0", [{**failed, "year": 2020}])  # a failure after the reconciliation counts again
    out = tm.delete_archived(source(more), store, audit, "x2", AS_OF, [2020], dry_run=True)
    assert out.years[0]["reason"] == "verify_failed_present"


def test_sums_see_what_a_plain_hash_misses(spark):
    one = spark.createDataFrame([(None, 5), (1, 1)], "a INT, b INT")
    two = spark.createDataFrame([(5, None), (1, 1)], "a INT, b INT")
    sums = [df.agg(*[s.alias(n) for s, n in zip(digest.content_sums(df, ["a", "b"]), "xy")]).first() for df in (one, two)]
    assert sums[0].x == sums[1].x and sums[0].y != sums[1].y


def test_not_archived_counts_copies(spark):
    cols = "slice_year INT, a INT, m MAP<STRING, INT>"
    have = spark.createDataFrame([(1, 1, None)] * 3 + [(1, 2, {"x": 1, "y": 2}), (2, 1, None)], cols)
    held = spark.createDataFrame([(1, 1, None)] + [(1, 2, {"y": 2, "x": 1}), (3, 1, None)], cols)
    found = {(r.slice_year, r.copies) for r in not_archived(have, held).collect()}
    assert found == {(1, 2), (2, 1)}


def test_listing_tasks_do_not_grow_with_files(spark, tmp_path):
    for k in range(3):
        with open(f"{tmp_path}/f{k}.parquet", "wb") as f:
            f.truncate(20 << 30)  # sparse
    found = file_listing(spark, str(tmp_path))
    assert found.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
    assert found.agg(F.sum("length")).first()[0] == 60 << 30
    spark.range(4).write.parquet(f"{tmp_path}/many")
    assert file_listing(spark, f"{tmp_path}/many").select("path").rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
