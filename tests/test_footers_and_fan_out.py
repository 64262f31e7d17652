"""Answers from Parquet footers, and one plan for many tables."""

import datetime as dt

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

import tidemark as tm
from tidemark.plans import jobs
from tidemark.schemas import TABLE_CONFIG_DDL, ddl

AS_OF = dt.date(2010, 6, 30)


def text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def archived(life, rows, run_id, table_id="t"):
    store, audit = life
    source = tm.Source(table_id, rows, "at", 1)
    tm.archive(source, store, audit, run_id, AS_OF, merge_schema=True)
    return source


def test_counts_come_from_footers(spark, life, table):
    store, _ = life
    rows = [(i, dt.date(2000 + i % 3, 1, 1 + i % 20)) for i in range(300)]
    archived(life, table(rows[:200], "id INT, at DATE", 3, "a"), "r1")
    later = [(dt.date(2000 + i % 3, 6, 1), i, "x") for i in range(90)]  # other order, one column more
    archived(life, table(later, "at DATE, id INT, note STRING", 2, "b"), "r2")
    counts = store.counts("t")
    assert "PushedAggregation: [COUNT(*)]" in text(counts)
    read_back = {r.slice_year: r.n for r in store.read("t").groupBy("slice_year").agg(F.count("*").alias("n")).collect()}
    assert {r.slice_year: r.row_count for r in counts.collect()} == read_back
    assert sum(read_back.values()) == 290
    assert {r.slice_year for r in store.counts("t", [2001]).collect()} == {2001}


def window(df):
    return {r.slice_year: (r.row_count, r.wm_lo, r.wm_hi) for r in df.select("slice_year", "row_count", "wm_lo", "wm_hi").collect()}


def test_window_of_a_run_comes_from_footers(spark, life, table):
    """Also when the watermark is not the first column, and at full precision."""
    store, _ = life
    base = dt.datetime(2001, 3, 1, 23, 59, 59, 999_999)
    for run, ddl, cast in (("ntz", "n BIGINT, at TIMESTAMP_NTZ, s STRING", lambda x: x), ("day", "n BIGINT, at DATE, s STRING", lambda x: x.date())):
        rows = [(10**12 + i, cast(base + dt.timedelta(days=37 * (i % 40))), "s") for i in range(400)]
        rows += [(1, cast(dt.datetime(1931, 1, 1)), None)]  # before the epoch
        source = archived(life, table(rows, ddl, 4, run), "r1", run)
        got = store.written(store.run_dir(run, "r1"), source.rows.schema, "at")
        assert "PushedAggregation: [COUNT(*), MIN(" in text(got)
        want = {}
        for _, at, _ in rows:
            at = dt.datetime(at.year, at.month, at.day) if run == "day" else at
            n, lo, hi = want.get(at.year, (0, at, at))
            want[at.year] = (n + 1, min(lo, at), max(hi, at))
        want = {y: w for y, w in want.items() if y <= 2009}
        assert window(got) == window(store.written(store.run_dir(run, "r1"), source.rows.schema, "at", content=True)) == want


def test_window_without_footers(spark, life, table):
    """Nested columns shift positions in the footer, zoned timestamps have no extremes there: the column is read."""
    store, _ = life
    rows = [([i, i + 1], dt.date(2001, 1, 1 + i % 28), dt.datetime(2001, 1, 1 + i % 28)) for i in range(60)]
    source = archived(life, table(rows, "a ARRAY<INT>, at DATE, z TIMESTAMP", 2), "r1")
    got = store.written(store.run_dir("t", "r1"), source.rows.schema, "at")
    assert "PushedAggregation: [COUNT" not in text(got)
    assert window(got) == {2001: (60, dt.datetime(2001, 1, 1), dt.datetime(2001, 1, 28))}


def many_tables(spark, root, n):
    """n tables of a few rows under two watermark names, some one folder above or beside another's name."""
    sources, want = [], set()
    for i in range(n):
        wm, years, keep = ("at", "day")[i % 2], [1990 + (i * k) % 23 for k in (1, 3, 7)], 1 + i % 4
        where = root / ("deep er" if i % 3 else "") / f"t{i}"
        where.mkdir(parents=True)
        dates = [dt.date(y, 5, 5) for y in years] + [None]
        pq.write_table(pa.table({"k": list(range(4)), wm: pa.array(dates, pa.date32())}), where / "part-0.parquet")
        rows = spark.read.schema(f"k BIGINT, {wm} DATE").parquet(str(where))
        sources.append(tm.Source(f"db.t{i}", rows, wm, keep, location=str(where)))
        want |= {(f"db.t{i}", y, 2010 - keep) for y in years if y <= 2010 - keep}
    return sources, want


def test_work_plan_does_not_grow_with_tables(spark, tmp_path):
    sources, want = many_tables(spark, tmp_path, 500)
    big, small = tm.work_plan(sources, AS_OF), tm.work_plan(sources[:20], AS_OF)
    assert text(big).count("FileScan") == 2
    assert text(big).count("\n") == text(small).count("\n")
    assert {tuple(r) for r in big.select("table_id", "slice_year", "last_eligible_year").collect()} == want
    assert big.count() == len(want)


def test_work_plan_mixes_shared_and_own_scans(spark, tmp_path):
    sources, want = many_tables(spark, tmp_path, 6)
    narrowed = tm.Source("own", sources[0].rows.where("k > 0"), "at", 1, location=sources[0].location)
    again = tm.Source("twice", sources[2].rows, "at", 2, location=sources[2].location)
    own = spark.createDataFrame([(1, dt.date(1999, 1, 1))], "k BIGINT, at DATE")
    got = {tuple(r) for r in tm.work_plan([*sources, narrowed, again, tm.Source("memory", own, "at", 5)], AS_OF).collect()}
    years = lambda s: {r.at.year for r in s.rows.where("at IS NOT NULL").collect()}
    want |= {("own", y, 2009) for y in years(narrowed)} | {("twice", y, 2008) for y in years(again) if y <= 2008}
    assert got == want | {("memory", 1999, 2005)}


def test_jobs_know_where_catalogue_tables_stand(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS fan")
    spark.sql("CREATE TABLE fan.plain USING parquet AS SELECT 1 AS k, DATE '2001-02-03' AS at")
    spark.sql("CREATE TABLE fan.parted USING parquet PARTITIONED BY (at) AS SELECT 1 AS k, DATE '2002-02-03' AS at")
    try:
        shared = {
            "source_catalog": "spark_catalog", "source_schema": "fan", "watermark_column": "at", "retention_years": 1,
            "archive_base_path": "/archive", "is_active": True, "delete_after_archive": False,
        }
        config = spark.createDataFrame(
            [
                tuple({**shared, "table_id": f"spark_catalog.fan.{t}", "source_table": t}.get(n) for n in ddl(TABLE_CONFIG_DDL).names)
                for t in ("plain", "parted")
            ],
            TABLE_CONFIG_DDL,
        )
        found = {s.table_id: s for s in jobs.sources(spark, config, 5)}
        assert found["spark_catalog.fan.plain"].whole_location() and not found["spark_catalog.fan.parted"].location
        got = {(r.table_id, r.slice_year) for r in tm.work_plan(list(found.values()), AS_OF).collect()}
        assert got == {("spark_catalog.fan.plain", 2001), ("spark_catalog.fan.parted", 2002)}
    finally:
        spark.sql("DROP DATABASE fan CASCADE")
