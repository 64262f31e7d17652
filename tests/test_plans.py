"""Physical plans: what is scanned, pushed, shuffled and split."""

import contextlib
import datetime as dt
import re

from pyspark.sql import functions as F

import tidemark as tm
from conftest import SF
from tidemark.operators import audit_state, profile, reports
from tidemark.plans.archive import archivable
from tidemark.queries.base import AS_OF, BIG, PENDING, RETURNED, audit, lineitem_source, orders_source, read


def text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_profile_is_one_pruned_scan_with_pushed_bounds(spark):
    (orders,) = read(spark, SF, "orders")
    plan = text(profile.year_profile(orders_source(orders), AS_OF))
    assert plan.count("FileScan") == 1
    assert "LessThan(o_orderdate" in plan
    read_schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert {c.split(":")[0] for c in read_schema.split(",")} == {"o_orderstatus", "o_totalprice", "o_orderdate"}
    assert plan.count("Exchange") == 1
    assert "Python" not in plan


def test_write_selection_is_pushed(spark):
    (orders,) = read(spark, SF, "orders")
    plan = text(archivable(orders_source(orders), AS_OF, [1995, 1996], {1998: dt.datetime(1998, 9, 1)}))
    for bound in ("1995-01-01", "1997-01-01", "1998-09-01"):
        assert re.search(r"PushedFilters:.*" + bound, plan)


def test_reference_rule_is_preaggregated_and_splittable(spark):
    """A rule on another table joins one row per key, by a join whose hot keys AQE can split."""
    orders, _ = read(spark, SF, "orders", "lineitem")
    plan = text(profile.year_profile(orders_source(orders, [PENDING, BIG, RETURNED]), AS_OF))
    assert "ExistenceJoin" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
    assert re.search(r"keys=\[l_orderkey#\d+L\], functions=\[partial_count\(1\)\]", plan)


@contextlib.contextmanager
def tiny_limits(spark):
    """Sort-merge joins only, and kilobytes where a cluster has gigabytes."""
    conf = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_reference_key_is_split(spark):
    """Half of both sides on one key."""
    with tiny_limits(spark):
        big = spark.range(0, 40_000, 1, 16).selectExpr(
            "id", "CASE WHEN id % 2 = 0 THEN 7 ELSE id END AS k", "DATE '2001-01-01' + CAST(id % 300 AS INT) AS at"
        )
        spark.range(20_000).selectExpr("CASE WHEN id % 2 = 0 THEN 7 ELSE id * 3 END AS k").createOrReplaceTempView("refs")
        rule = tm.Rule("ref", "custom_sql", value="EXISTS (SELECT 1 FROM refs r WHERE r.k = {source_alias}.k)")
        source = tm.Source("t", big, "at", 1, rules=(rule,))
        df = profile.year_profile(source, dt.date(2010, 1, 1))
        (got,) = df.collect()  # the plan below is the one that ran
        keys = {i * 3 for i in range(1, 20_000, 2)} | {7}
        kept = sum(1 for i in range(40_000) if (7 if i % 2 == 0 else i) not in keys)
        assert (got.total_rows, got.kept_rows, got.protected["ref"]) == (40_000, kept, 40_000 - kept)
        assert "SortMergeJoin(skew=true)" in text(df)
        rows = archivable(source, dt.date(2010, 1, 1), [2001], {})
        assert len(rows.collect()) == kept
        assert "SortMergeJoin(skew=true)" in text(rows)


def test_hot_log_key_is_split(spark):
    """A run that wrote a third of the log, in one slice."""
    log = spark.range(0, 60_000, 1, 16).selectExpr(
        "CAST(id AS STRING) AS audit_id",
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE CAST(id AS STRING) END AS archive_run_id",
        "'t' AS table_name", "2020 AS year",
        "CASE WHEN id % 3 = 2 THEN 'FAILED' ELSE 'STARTED' END AS status",
        "TIMESTAMP '2024-01-01' AS created_at",
    )
    with tiny_limits(spark):
        df = audit_state.open_runs(log)
        assert len(df.collect()) == 40_000
        assert "SortMergeJoin(skew=true)" in text(df)


def test_copies_of_one_late_row(spark):
    """Late rows that are mostly copies of each other: counted exactly, hashes combined map-side."""
    rows = spark.range(0, 40_000, 1, 16).selectExpr("CASE WHEN id % 2 = 0 THEN 0 ELSE id END AS id", "2020 AS slice_year")
    have = rows.withColumn("_wm", F.lit("2020-01-01").cast("timestamp_ntz"))
    held = rows.where("id % 5 = 1")
    marks = spark.createDataFrame([(2020,)], "slice_year INT").withColumn("high_water", F.lit("2020-06-01").cast("timestamp_ntz"))
    with tiny_limits(spark):
        df = reports.late_arrivals(have, held, marks)
        found = {r.id: r.copies for r in df.collect()}
        assert found.pop(0) == 20_000
        assert set(found) == {i for i in range(1, 40_000, 2) if i % 5 != 1} and set(found.values()) == {1}
        assert "functions=[partial_sum(_n" in text(df)


def test_hot_year_is_split_over_files(spark, life):
    """One write job, many files for the big year: no single task writes it."""
    store, audit = life
    df = spark.range(0, 200_000, 1, 16).selectExpr(
        "id", "CASE WHEN id % 50 = 0 THEN DATE '2001-05-05' ELSE DATE '2002-05-05' END AS at", "md5(CAST(id AS STRING)) AS pad"
    )
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(key, "256KB")
    try:
        tm.archive(tm.Source("hot", df, "at", 1), store, audit, "r", dt.date(2010, 1, 1))
    finally:
        spark.conf.unset(key)
    files = store.read("hot").inputFiles()
    assert sum("slice_year=2002" in f for f in files) >= 4
    assert store.read("hot").count() == 200_000


def test_latest_rows_need_no_window(spark):
    log = audit(spark, SF)
    for df in (audit_state.latest_status(log), audit_state.slice_summary(log), audit_state.prior_archived(log)):
        plan = text(df)
        assert "Window" not in plan and "partial_max" in plan
    from tidemark.queries.report_queries import log as dry_log

    assert "Window" not in text(reports.drift(dry_log(spark, SF)))


def test_open_runs_is_an_anti_join(spark):
    plan = text(audit_state.open_runs(audit(spark, SF)))
    assert "LeftAnti" in plan and "NestedLoop" not in plan


def test_jobs_do_not_grow_with_years(spark, life):
    """One more decade of slices, the same number of Spark jobs."""
    (lineitem,) = read(spark, SF, "lineitem")
    store, audit_log = life
    tracker = spark.sparkContext.statusTracker()

    def jobs(name, source):
        spark.sparkContext.setJobGroup(name, name)
        tm.archive(source, store, audit_log, name, AS_OF)
        n = len(tracker.getJobIdsForGroup(name))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return n

    spread = spark.range(20_000).selectExpr("id", "DATE '1960-01-01' + CAST(id AS INT) % 14000 AS at")
    few = jobs("few", lineitem_source(lineitem))
    many = jobs("many", tm.Source("many", spread, "at", 5))
    assert store.states(["many"]).count() == 39
    assert many <= few + 2
