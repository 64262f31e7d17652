"""Queries: archive, append, verify, delete, wipe and roll back slices, read back from disk."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, functions as F

from .. import archive, archive_tables, compact, delete_archived, dry_run, plan, plan_delete, rollback, wipe, work_plan as plan_work
from ..operators import decisions, profile, reports, verification
from ..sources.audit_log import PAYLOAD_DDL
from ..sources.publication import publish_source
from ..sources.slices import SliceStore
from ..sources.tables import Source
from .base import (
    AS_OF, EVENTS_AS_OF, FIRST_LOAD_SQL, KEPT_SQL, LAST_YEAR, MIDDAY, ORDER_COLUMNS, ORDERS_N, RETURNED, Y,
    events_source, first_load, lifecycle, lineitem_source, orders_source, query, read,
)

ARCHIVED_SQL = f"SELECT *, {Y} AS slice_year FROM orders WHERE year(o_orderdate) <= {LAST_YEAR} AND {KEPT_SQL}"
LINE_KEPT_SQL = f"SELECT *, CAST(year(l_shipdate) AS INTEGER) AS slice_year FROM lineitem WHERE year(l_shipdate) <= {LAST_YEAR} AND l_returnflag <> 'R'"

# What the slices hold after the first load, and after the append run on top of it.
FIRST_SQL = f"{ARCHIVED_SQL} AND {FIRST_LOAD_SQL}"
MARKS_SQL = f"SELECT slice_year, max(o_orderdate) AS mark FROM ({FIRST_SQL}) f GROUP BY 1"
SECOND_SQL = f"SELECT a.* FROM ({ARCHIVED_SQL}) a JOIN ({MARKS_SQL}) m USING (slice_year) WHERE a.o_orderdate > m.mark"
APPENDED_SQL = f"SELECT * FROM ({FIRST_SQL}) x UNION ALL SELECT * FROM ({SECOND_SQL}) y"


def archived_orders(spark, d, **more):
    """Orders archived once: (store, audit, source)."""
    (orders,) = read(spark, d, "orders")
    store, log = lifecycle(spark)
    source = orders_source(orders, **more)
    archive(source, store, log, "r1", AS_OF)
    return store, log, source


def appended_orders(spark, d):
    """The first load archived, then the whole table."""
    (orders,) = read(spark, d, "orders")
    store, log = lifecycle(spark)
    archive(orders_source(first_load(orders)), store, log, "r1", AS_OF)
    archive(orders_source(orders), store, log, "r2", AS_OF)
    return store, log, orders_source(orders)


def appended_both(spark, d):
    """Orders and events, each archived in two runs; both clocks reach the same years."""
    orders, events = read(spark, d, "orders", "events")
    store, log = lifecycle(spark)
    early = events.where(f"ts <= TIMESTAMP_NTZ '{MIDDAY}'")
    kept_years = EVENTS_AS_OF.year - LAST_YEAR
    for run_id, o, e in (("r1", first_load(orders), early), ("r2", orders, events)):
        archive_tables(
            [orders_source(o, retention_years=kept_years), events_source(e)], store, log, run_id, EVENTS_AS_OF
        )
    return store


@query("archive_create", ARCHIVED_SQL)
def archive_create(spark, d) -> DataFrame:
    store, _, _ = archived_orders(spark, d)
    return store.read("orders")


@query(
    "archive_create_custom_sql",
    f"""
    SELECT {Y} AS slice_year, count(*) AS row_count, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_price
    FROM orders o WHERE year(o_orderdate) <= {LAST_YEAR}
      AND NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_returnflag = 'R')
    GROUP BY 1
    """,
)
def archive_create_custom_sql(spark, d) -> DataFrame:
    orders, _ = read(spark, d, "orders", "lineitem")
    store, log = lifecycle(spark)
    archive(orders_source(orders, [RETURNED]), store, log, "r1", AS_OF)
    return store.read("orders").groupBy("slice_year").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total_price"),
    )


@query(
    "archive_append",
    f"""
    SELECT 'orders' AS table_id, slice_year, count(*) AS row_count, count(DISTINCT o_orderkey) AS distinct_keys, max(o_orderdate) AS wm_hi
    FROM ({APPENDED_SQL}) a GROUP BY slice_year
    UNION ALL
    SELECT 'events', CAST(year(ts) AS INTEGER), count(*), count(DISTINCT event_id), max(ts) FROM events GROUP BY 2
    """,
)
def archive_append(spark, d) -> DataFrame:
    store = appended_both(spark, d)

    def shape(table: str, key: str, wm: str) -> DataFrame:
        return store.read(table).groupBy("slice_year").agg(
            F.count(F.lit(1)).alias("row_count"),
            F.countDistinct(key).alias("distinct_keys"),
            F.max(wm).alias("wm_hi"),
        ).select(F.lit(table).alias("table_id"), "*")

    return shape("orders", "o_orderkey", "o_orderdate").unionByName(shape("events", "event_id", "ts"))


COUNTS_SQL = f"""
    SELECT 'orders' AS table_name, slice_year AS year, count(*) AS kept FROM ({ARCHIVED_SQL}) o GROUP BY 2
    UNION ALL SELECT 'lineitem', slice_year, count(*) FROM ({LINE_KEPT_SQL}) l GROUP BY 2
"""
TOTALS_SQL = f"""
    SELECT 'orders' AS table_name, {Y} AS year, count(*) AS total FROM orders WHERE year(o_orderdate) <= {LAST_YEAR} GROUP BY 2
    UNION ALL SELECT 'lineitem', CAST(year(l_shipdate) AS INTEGER), count(*) FROM lineitem WHERE year(l_shipdate) <= {LAST_YEAR} GROUP BY 2
"""


@query(
    "archive_live",
    f"""
    WITH c AS ({COUNTS_SQL}), t AS ({TOTALS_SQL})
    SELECT 'r1' AS archive_run_id, table_name, year, 'STARTED' AS status, CAST(0 AS BIGINT) AS record_count,
           CAST(NULL AS VARCHAR) AS archive_mode, CAST(NULL AS BIGINT) AS archive_delta_version, CAST(NULL AS BIGINT) AS source_year_count FROM c
    UNION ALL SELECT 'r1', table_name, year, 'ARCHIVED', kept, 'CREATE', 0, total FROM c JOIN t USING (table_name, year)
    UNION ALL SELECT 'r2', table_name, year, 'STARTED', 0, NULL, NULL, NULL FROM c
    UNION ALL SELECT 'r2', table_name, year, 'SKIPPED', 0, 'SKIP', NULL, total FROM c JOIN t USING (table_name, year)
    """,
)
def archive_live(spark, d) -> DataFrame:
    orders, lineitem = read(spark, d, "orders", "lineitem")
    store, log = lifecycle(spark)
    sources = [orders_source(orders), lineitem_source(lineitem)]
    archive_tables(sources, store, log, "r1", AS_OF)
    archive_tables(sources, store, log, "r2", AS_OF)
    return log.rows().select(
        "archive_run_id", "table_name", "year", "status", "record_count", "archive_mode",
        "archive_delta_version", "source_year_count",
    )


@query("slice_read", f"SELECT {', '.join(ORDER_COLUMNS)} FROM ({ARCHIVED_SQL}) a WHERE slice_year = 1997")
def slice_read(spark, d) -> DataFrame:
    store, _, _ = archived_orders(spark, d)
    return store.read("orders", [1997]).drop("slice_year")


def troubled_store(spark, d):
    """Orders VALID; lineitem written but never published; events published but not written."""
    store, log, source = archived_orders(spark, d)
    lineitem, events = read(spark, d, "lineitem", "events")
    line = lineitem_source(lineitem)
    rows = lineitem.where(line.in_years(None, LAST_YEAR)).withColumn("slice_year", line.year())
    store.write_rows(rows, "lineitem", "crashed")
    e = events_source(events)
    years = events.groupBy(e.year().alias("year")).count().collect()
    store.publish(
        [
            {
                "table_id": "events", "year": r.year, "version": 0, "op": "CREATE", "run_id": "gone",
                "dirs": [store.slice_dir("events", "gone", r.year)], "row_count": r["count"],
            }
            for r in years
        ]
    )
    return store, log, [source, line, e]


@query(
    "slice_state",
    f"""
    SELECT 'orders' AS table_id, slice_year AS year, 'VALID' AS slice_state, count(*) AS row_count FROM ({ARCHIVED_SQL}) a GROUP BY 2
    UNION ALL SELECT DISTINCT 'lineitem', CAST(year(l_shipdate) AS INTEGER), 'ORPHAN', CAST(0 AS BIGINT) FROM lineitem WHERE year(l_shipdate) <= {LAST_YEAR}
    UNION ALL SELECT DISTINCT 'events', CAST(year(ts) AS INTEGER), 'MISSING', CAST(0 AS BIGINT) FROM events
    """,
)
def slice_state(spark, d) -> DataFrame:
    store, _, _ = troubled_store(spark, d)
    return store.states().select("table_id", "year", "slice_state", "row_count")


@query(
    "slice_health",
    f"""
    SELECT DISTINCT 'orders' AS table_id, {Y} AS slice_year, 'MISSING' AS slice_state FROM orders WHERE year(o_orderdate) > {LAST_YEAR}
    UNION ALL SELECT DISTINCT 'lineitem', CAST(year(l_shipdate) AS INTEGER), CASE WHEN year(l_shipdate) <= {LAST_YEAR} THEN 'ORPHAN' ELSE 'MISSING' END FROM lineitem
    UNION ALL SELECT DISTINCT 'events', CAST(year(ts) AS INTEGER), 'MISSING' FROM events
    """,
)
def slice_health(spark, d) -> DataFrame:
    store, _, sources = troubled_store(spark, d)
    eligible = plan_work(sources, EVENTS_AS_OF)
    return reports.slice_health(eligible, store.states()).select("table_id", "slice_year", "slice_state")


@query(
    "slice_versions",
    f"""
    SELECT 'orders' AS table_id, slice_year AS year,
           CAST(CASE WHEN s.n IS NULL THEN 0 ELSE 1 END AS BIGINT) AS latest_version,
           CASE WHEN s.n IS NULL THEN '0' ELSE '0,1' END AS versions
    FROM (SELECT slice_year FROM ({FIRST_SQL}) f GROUP BY 1) f
    LEFT JOIN (SELECT slice_year, count(*) AS n FROM ({SECOND_SQL}) s GROUP BY 1) s USING (slice_year)
    """,
)
def slice_versions(spark, d) -> DataFrame:
    store, _, _ = appended_orders(spark, d)
    return store.history().withColumn(
        "versions", F.array_join(F.col("versions").cast("array<string>"), ",")
    )


@query(
    "slice_wipe",
    f"""
    WITH c AS (SELECT slice_year AS year, count(*) AS n FROM ({ARCHIVED_SQL}) a GROUP BY 1)
    SELECT year, CAST(0 AS BIGINT) AS version, 'CREATE' AS op, n AS row_count FROM c
    UNION ALL SELECT year, 1, 'WIPE', 0 FROM c WHERE year IN (1996, 1998)
    UNION ALL SELECT year, 2, 'CREATE', n FROM c WHERE year IN (1996, 1998)
    """,
)
def slice_wipe(spark, d) -> DataFrame:
    store, log, source = archived_orders(spark, d)
    requests = spark.createDataFrame(
        [("orders", 1996, "bad load"), ("orders", 1998, "bad load"), ("orders", 2001, "not archived")],
        "table_id STRING, year INT, wipe_reason STRING",
    )
    wipe(store, log, requests, "w1", dry_run=False)
    archive(source, store, log, "r2", AS_OF)  # the emptied slices are refilled
    return store.versions().select("year", "version", "op", "row_count")


@query(
    "slice_rollback",
    f"""
    WITH f AS (SELECT slice_year, count(*) AS n FROM ({FIRST_SQL}) f GROUP BY 1),
         a AS (SELECT slice_year, count(*) AS n FROM ({APPENDED_SQL}) a GROUP BY 1)
    SELECT slice_year, CASE WHEN slice_year IN (1995, 1997) THEN f.n ELSE a.n END AS row_count FROM f JOIN a USING (slice_year)
    """,
)
def slice_rollback(spark, d) -> DataFrame:
    store, log, _ = appended_orders(spark, d)
    requests = (
        log.rows()
        .where("archive_run_id = 'r1' AND status = 'ARCHIVED' AND year IN (1995, 1997)")
        .select(F.col("audit_id").alias("target_audit_id"), F.col("table_name").alias("table_id"), "year")
    )
    rollback(store, log, requests, "b1", dry_run=False)
    return store.counts("orders")


@query(
    "slice_compact",
    f"""
    SELECT a.slice_year, a.row_count, a.total_price, CASE WHEN s.slice_year IS NULL THEN 'CREATE' ELSE 'COMPACT' END AS op,
           CAST(CASE WHEN s.slice_year IS NULL THEN 0 ELSE 2 END AS BIGINT) AS version, CAST(1 AS BIGINT) AS directories
    FROM (SELECT slice_year, count(*) AS row_count, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_price
          FROM ({APPENDED_SQL}) x GROUP BY 1) a
    LEFT JOIN (SELECT DISTINCT slice_year FROM ({SECOND_SQL}) y) s USING (slice_year)
    """,
)
def slice_compact(spark, d) -> DataFrame:
    """Slices of several appends, rewritten as one directory each; slices of one file stay."""
    store, log, _ = appended_orders(spark, d)
    compact(store, log, "orders", "c1")
    held = store.read("orders").groupBy("slice_year").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total_price"),
    )
    state = store.latest().select(F.col("year").alias("slice_year"), "op", "version", F.size("live_dirs").cast("long").alias("directories"))
    return held.join(state, "slice_year")


@query(
    "slice_manifest",
    f"""
    WITH f AS (SELECT slice_year, count(*) AS n, min(o_orderdate) AS lo, max(o_orderdate) AS hi FROM ({FIRST_SQL}) f GROUP BY 1),
         s AS (SELECT slice_year, count(*) AS n, max(o_orderdate) AS hi FROM ({SECOND_SQL}) s GROUP BY 1)
    SELECT 'orders' AS table_id, slice_year, CAST(0 AS BIGINT) AS version, 'CREATE' AS op, n AS row_count, n AS rows_this_run,
           lo AS wm_lo, hi AS wm_hi, n AS recorded FROM f
    UNION ALL SELECT 'orders', slice_year, 1, 'APPEND', f.n + s.n, s.n, lo, s.hi, s.n FROM f JOIN s USING (slice_year)
    """,
)
def slice_manifest(spark, d) -> DataFrame:
    store, _, _ = appended_orders(spark, d)
    return store.manifest().select(
        "table_id", "slice_year", "version", "op", "row_count", "rows_this_run", "wm_lo", "wm_hi",
        F.get_json_object("metadata", "$.record_count").cast("bigint").alias("recorded"),
    )


@query(
    "slice_high_water",
    f"""
    SELECT 'orders' AS table_id, slice_year, max(o_orderdate) AS high_water FROM ({APPENDED_SQL}) a GROUP BY 2
    UNION ALL SELECT 'events', CAST(year(ts) AS INTEGER), max(ts) FROM events GROUP BY 2
    """,
)
def slice_high_water(spark, d) -> DataFrame:
    store = appended_both(spark, d)
    return (
        store.high_water("orders", "o_orderdate")
        .select(F.lit("orders").alias("table_id"), "*")
        .unionByName(store.high_water("events", "ts").select(F.lit("events").alias("table_id"), "*"))
    )


@query(
    "slice_counts",
    f"""SELECT table_name AS table_id, year AS slice_year, kept AS row_count FROM ({COUNTS_SQL}) c""",
)
def slice_counts(spark, d) -> DataFrame:
    orders, lineitem = read(spark, d, "orders", "lineitem")
    store, log = lifecycle(spark)
    archive_tables([orders_source(orders), lineitem_source(lineitem)], store, log, "r1", AS_OF)
    return store.counts("orders").select(F.lit("orders").alias("table_id"), "*").unionByName(
        store.counts("lineitem").select(F.lit("lineitem").alias("table_id"), "*")
    )


@query(
    "run_window",
    f"SELECT slice_year, count(*) AS row_count, min(o_orderdate) AS wm_lo, max(o_orderdate) AS wm_hi FROM ({SECOND_SQL}) s GROUP BY 1",
)
def run_window(spark, d) -> DataFrame:
    store, _, source = appended_orders(spark, d)
    return store.written(store.run_dir("orders", "r2"), source.rows.schema, "o_orderdate")


@query(
    "verify_counts",
    f"SELECT slice_year, count(*) AS archive_count, count(*) AS source_count, FALSE AS drifted FROM ({ARCHIVED_SQL}) a GROUP BY 1",
)
def verify_counts(spark, d) -> DataFrame:
    store, _, source = archived_orders(spark, d)
    written = store.written(store.run_dir("orders", "r1"), source.rows.schema, "o_orderdate")
    return decisions.drift(written, profile.year_profile(source, AS_OF))


# After the archive a price changes in 1996, and the rows of 1997 were never archived.
ALTERED = "CASE WHEN year(o_orderdate) = 1996 AND o_orderkey % 40 = 0 THEN o_totalprice - 1 ELSE o_totalprice END"


@query(
    "verify_fingerprint",
    f"""
    WITH s AS (SELECT slice_year, count(*) AS n, count(*) FILTER (WHERE slice_year = 1996 AND o_orderkey % 40 = 0) AS altered
               FROM ({ARCHIVED_SQL}) a GROUP BY 1)
    SELECT slice_year, CASE WHEN slice_year <> 1997 THEN n END AS row_count, n AS source_rows,
           slice_year <> 1997 AND altered = 0 AS content_equal FROM s
    """,
)
def verify_fingerprint(spark, d) -> DataFrame:
    (orders,) = read(spark, d, "orders")
    store, log = lifecycle(spark)
    archive(orders_source(orders.where("year(o_orderdate) <> 1997")), store, log, "r1", AS_OF)
    kept = orders.where("o_totalprice <= 200000 OR o_totalprice IS NULL")  # the change must not lift the protection
    changed = kept.withColumn("o_totalprice", F.expr(ALTERED)).unionByName(orders.where("o_totalprice > 200000"))
    return verification.verify(orders_source(changed), store, AS_OF)


class _Falsified(SliceStore):
    """A store whose writer changes prices of 1996 on the way to disk; no count shows it."""

    def _save(self, rows, path):
        changed = F.expr("CASE WHEN slice_year = 1996 AND o_orderkey % 40 = 0 THEN o_totalprice - 1 ELSE o_totalprice END")
        super()._save(rows.withColumn("o_totalprice", changed), path)


@query(
    "verify_written",
    f"""
    SELECT slice_year AS year, CASE WHEN altered > 0 THEN 'FAILED' ELSE 'ARCHIVED' END AS status,
           CASE WHEN altered > 0 THEN 0 ELSE n END AS record_count
    FROM (SELECT slice_year, count(*) AS n, count(*) FILTER (WHERE slice_year = 1996 AND o_orderkey % 40 = 0) AS altered
          FROM ({ARCHIVED_SQL}) a GROUP BY 1) x
    """,
)
def verify_written(spark, d) -> DataFrame:
    """What is read back is compared with what the writing tasks saw; a slice that differs is not published."""
    (orders,) = read(spark, d, "orders")
    store, log = lifecycle(spark)
    archive(orders_source(orders), _Falsified(spark, store.base), log, "r1", AS_OF)
    return log.rows().where("status <> 'STARTED'").select("year", "status", "record_count")


@query(
    "delete_contained",
    f"""
    SELECT slice_year AS year, CASE WHEN altered > 0 THEN 'VERIFY_FAILED' ELSE 'ARCHIVED_AND_DELETED' END AS status, n AS record_count,
           CASE WHEN altered > 0 THEN n ELSE 0 END AS left_in_source
    FROM (SELECT slice_year, count(*) AS n, count(*) FILTER (WHERE slice_year = 1996 AND o_orderkey % 40 = 0) AS altered
          FROM ({ARCHIVED_SQL}) a GROUP BY 1) x
    """,
)
def delete_contained(spark, d) -> DataFrame:
    """Prices of 1996 changed after the archive: the counts agree, and still nothing of that year is deleted."""
    (orders,) = read(spark, d, "orders")
    store, log = lifecycle(spark)
    archive(orders_source(orders), store, log, "r1", AS_OF)
    kept = F.expr("o_orderstatus <> 'P' AND NOT (o_totalprice > 200000)")
    changed = orders.withColumn("o_totalprice", F.when(kept, F.expr(ALTERED)).otherwise(F.col("o_totalprice")))
    source = orders_source(own_table(spark, store, changed, "orders"))
    done = delete_archived(source, store, log, "x1", AS_OF, list(range(1990, LAST_YEAR + 1)), dry_run=False)
    left = (done.source_after.read(spark) if done.source_after else source.rows).where(kept)
    left = left.groupBy(F.year("o_orderdate").alias("year")).agg(F.count(F.lit(1)).alias("left_in_source"))
    return (
        log.rows().where("status IN ('ARCHIVED_AND_DELETED', 'VERIFY_FAILED')").select("year", "status", "record_count")
        .join(left, "year", "left").withColumn("left_in_source", F.coalesce("left_in_source", F.lit(0)))
    )


@query(
    "drift_check",
    f"""
    SELECT slice_year, f.n AS archive_count, a.n AS source_count, f.n <> a.n AS drifted
    FROM (SELECT slice_year, count(*) AS n FROM ({FIRST_SQL}) f GROUP BY 1) f
    JOIN (SELECT slice_year, count(*) AS n FROM ({ARCHIVED_SQL}) a GROUP BY 1) a USING (slice_year)
    """,
)
def drift_check(spark, d) -> DataFrame:
    (orders,) = read(spark, d, "orders")
    store, log = lifecycle(spark)
    archive(orders_source(first_load(orders)), store, log, "r1", AS_OF)
    return decisions.drift(store.counts("orders"), profile.year_profile(orders_source(orders), AS_OF))


@query(
    "reconcile_release",
    f"""
    SELECT slice_year AS year, CASE WHEN s.n IS NULL THEN 'SKIPPED' WHEN slice_year = 1996 THEN 'FAILED' ELSE 'ARCHIVED' END AS status,
           CASE WHEN slice_year = 1996 THEN 0 ELSE coalesce(s.n, 0) END AS record_count
    FROM (SELECT DISTINCT slice_year FROM ({FIRST_SQL}) f) f
    LEFT JOIN (SELECT slice_year, count(*) AS n FROM ({SECOND_SQL}) s GROUP BY 1) s USING (slice_year)
    """,
)
def reconcile_release(spark, d) -> DataFrame:
    """Two slices failed a verification; the one that was reconciled is appended to again."""
    (orders,) = read(spark, d, "orders")
    store, log = lifecycle(spark)
    archive(orders_source(first_load(orders)), store, log, "r1", AS_OF)
    failed = {"table_name": "orders", "status": "VERIFY_FAILED", "record_count": 0}
    log.record("r0", [{**failed, "year": 1995}, {**failed, "year": 1996}])
    log.reconcile("orders", [1995], "source was reloaded; counts agree")
    archive(orders_source(orders), store, log, "r2", AS_OF)
    return log.rows().where("archive_run_id = 'r2' AND status <> 'STARTED'").select("year", "status", "record_count")


def own_table(spark, store, rows: DataFrame, name: str) -> DataFrame:
    """A source table this run may replace, laid out by date as aged tables usually are."""
    path = f"{store.base}/tables/{name}"
    rows.repartitionByRange(8, "o_orderdate").write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


@query(
    "source_after_delete",
    f"SELECT {', '.join(ORDER_COLUMNS)} FROM orders WHERE NOT (year(o_orderdate) <= {LAST_YEAR} AND {KEPT_SQL})",
)
def source_after_delete(spark, d) -> DataFrame:
    (orders,) = read(spark, d, "orders")
    store, log = lifecycle(spark)
    source = orders_source(own_table(spark, store, orders, "orders"), delete_after=True)
    return archive(source, store, log, "r1", AS_OF).source_after.read(spark)


def laid_out(spark, store, rows: DataFrame, name: str, column: str) -> DataFrame:
    """The rows as a table partitioned by one of their columns."""
    path = f"{store.base}/tables/{name}"
    rows.write.partitionBy(column).parquet(path)
    return spark.read.schema(rows.schema).parquet(path).select(*rows.columns)


@query("archive_partitioned", ARCHIVED_SQL)
def archive_partitioned(spark, d) -> DataFrame:
    """A source partitioned by a column keeps that column's values."""
    (orders,) = read(spark, d, "orders")
    store, log = lifecycle(spark)
    source = orders_source(laid_out(spark, store, orders, "orders", "o_orderstatus"))
    archive(source, store, log, "r1", AS_OF)
    return store.read("orders").select(*orders.columns, "slice_year")


LEFT_SQL = f"SELECT {', '.join(ORDER_COLUMNS)} FROM orders WHERE NOT (year(o_orderdate) <= {LAST_YEAR} AND {KEPT_SQL})"


@query("delete_durable", LEFT_SQL)
def delete_durable(spark, d) -> DataFrame:
    """Rows that a delete took out stay out when the source is built anew."""
    (orders,) = read(spark, d, "orders")
    store, log = lifecycle(spark)
    table = own_table(spark, store, orders, "orders")
    archive(orders_source(table, delete_after=True), store, log, "r1", AS_OF)
    return store.source_snapshot("orders", table).read().select(*ORDER_COLUMNS)


@query("source_published", LEFT_SQL)
def source_published(spark, d) -> DataFrame:
    """After a publication any session that reads the table by its name has it without the archived rows."""
    (orders,) = read(spark, d, "orders")
    store, log = lifecycle(spark)
    name = f"orders_{uuid.uuid4().hex}"
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in orders.schema)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY (o_orderstatus) LOCATION '{store.base}/tables/orders'")
    orders.select(*spark.table(name).columns).write.insertInto(name)
    archive(orders_source(spark.table(name), delete_after=True), store, log, "r1", AS_OF)
    publish_source(store, "orders", name, "p1")
    return spark.newSession().table(name).select(*ORDER_COLUMNS)


@query(
    "delete_live",
    f"SELECT {', '.join(ORDER_COLUMNS)} FROM orders WHERE NOT (year(o_orderdate) IN (1996, 1998) AND {KEPT_SQL})",
)
def delete_live(spark, d) -> DataFrame:
    """The delete job, live, over two archived years."""
    (orders,) = read(spark, d, "orders")
    store, log = lifecycle(spark)
    table = own_table(spark, store, orders, "orders")
    archive(orders_source(table), store, log, "r1", AS_OF)
    delete_archived(orders_source(table), store, log, "x1", AS_OF, [1996, 1998], dry_run=False)
    return store.source_snapshot("orders", table).read().select(*ORDER_COLUMNS)


@query(
    "resume_delete",
    f"""
    SELECT year, status, n AS record_count FROM (
        SELECT slice_year AS year, CASE WHEN slice_year = 1998 THEN 'VERIFY_FAILED' ELSE 'ARCHIVED_AND_DELETED' END AS status,
               count(*) FILTER (WHERE slice_year <> 1998 OR o_orderkey % 50 <> 0) AS n
        FROM ({ARCHIVED_SQL}) a GROUP BY 1) x
    UNION ALL
    SELECT year, 'IN_SOURCE', count(*) FROM (
        SELECT {Y} AS year FROM orders WHERE NOT (year(o_orderdate) <= {LAST_YEAR} AND year(o_orderdate) <> 1998 AND {KEPT_SQL})) s GROUP BY 1
    """,
)
def resume_delete(spark, d) -> DataFrame:
    (orders,) = read(spark, d, "orders")
    store, log = lifecycle(spark)
    whole = own_table(spark, store, orders, "orders")
    # The attempt that stopped before its delete saw fewer rows in 1998.
    seen = whole.where("NOT (year(o_orderdate) = 1998 AND o_orderkey % 50 = 0)")
    archive(orders_source(seen), store, log, "r1", AS_OF)
    again = archive(orders_source(whole, delete_after=True), store, log, "r1", AS_OF)
    left = again.source_after.read(spark).groupBy(F.year("o_orderdate").alias("year")).agg(
        F.count(F.lit(1)).alias("record_count")
    )
    done = log.rows().where("status IN ('ARCHIVED_AND_DELETED', 'VERIFY_FAILED')")
    return done.select("year", "status", "record_count").unionByName(
        left.select("year", F.lit("IN_SOURCE").alias("status"), "record_count")
    )


@query(
    "late_arrivals",
    f"""
    SELECT a.*, CAST(1 AS BIGINT) AS copies FROM ({ARCHIVED_SQL}) a JOIN ({MARKS_SQL}) m USING (slice_year)
    WHERE a.o_orderdate <= m.mark AND NOT ({FIRST_LOAD_SQL.replace('o_order', 'a.o_order')})
    """,
)
def late_arrivals(spark, d) -> DataFrame:
    (orders,) = read(spark, d, "orders")
    store, log = lifecycle(spark)
    archive(orders_source(first_load(orders)), store, log, "r1", AS_OF)
    return reports.late_rows(orders_source(orders), store, AS_OF)


# -- plans --------------------------------------------------------------------------------


@query(
    "work_plan",
    f"""
    SELECT table_name AS table_id, year AS slice_year, CAST({LAST_YEAR} AS INTEGER) AS last_eligible_year FROM ({TOTALS_SQL}) t
    """,
)
def work_plan(spark, d) -> DataFrame:
    orders, lineitem, events = read(spark, d, "orders", "lineitem", "events")
    at = lambda name: f"{d}/{name}.parquet"
    return plan_work(
        [
            orders_source(orders, location=at("orders")),
            lineitem_source(lineitem, location=at("lineitem")),
            events_source(events, location=at("events")),
        ],
        AS_OF,
    )


@query(
    "dry_run_plan",
    f"""
    SELECT table_name AS table_id, year AS slice_year, 'CREATE' AS action, CAST(NULL AS VARCHAR) AS reason,
           total AS total_eligible, kept AS would_archive FROM ({TOTALS_SQL}) t JOIN ({COUNTS_SQL}) c USING (table_name, year)
    """,
)
def dry_run_plan(spark, d) -> DataFrame:
    orders, lineitem = read(spark, d, "orders", "lineitem")
    store, log = lifecycle(spark)
    plans = [plan(s, store, log.rows(), "r1", AS_OF) for s in (orders_source(orders), lineitem_source(lineitem))]
    return plans[0].unionByName(plans[1]).select(
        "table_id", "slice_year", "action", "reason", F.col("total_rows").alias("total_eligible"), "would_archive"
    )


@query(
    "dry_run_audit",
    f"""
    SELECT CAST(year(wm) AS INTEGER) AS year, 'WOULD_ARCHIVE' AS action, count(*) AS total_eligible,
           count(*) FILTER (WHERE {KEPT_SQL}) AS would_archive,
           count(*) FILTER (WHERE o_orderstatus = 'P') AS pending, count(*) FILTER (WHERE o_totalprice > 200000) AS big,
           CAST(NULL AS BIGINT) AS null_date_count
    FROM ({ORDERS_N}) t WHERE year(wm) <= {LAST_YEAR} GROUP BY 1
    UNION ALL SELECT NULL, 'SKIP', 0, 0, NULL, NULL, count(*) FROM ({ORDERS_N}) n WHERE wm IS NULL HAVING count(*) > 0
    """,
)
def dry_run_audit(spark, d) -> DataFrame:
    read(spark, d, "orders")
    store, log = lifecycle(spark)
    base = orders_source(spark.sql(ORDERS_N))
    dry_run(Source("orders", base.rows, "wm", base.retention_years, rules=base.rules), store, log, "d1", AS_OF)
    return log.rows().withColumn("p", F.from_json("conditions_applied", PAYLOAD_DDL)).select(
        "year", "p.action", "p.total_eligible", "p.would_archive",
        F.col("p.per_condition_counts")["pending"].alias("pending"),
        F.col("p.per_condition_counts")["big"].alias("big"),
        "null_date_count",
    )


@query(
    "delete_plan",
    f"""
    WITH f AS (SELECT slice_year, count(*) FILTER (WHERE slice_year <> 1996 OR o_orderkey % 50 <> 0) AS held,
                      count(*) AS kept FROM ({ARCHIVED_SQL}) a GROUP BY 1)
    SELECT 'orders' AS table_id, slice_year,
           CASE slice_year WHEN 1995 THEN 'SKIP_NOT_ELIGIBLE' WHEN 1996 THEN 'SKIP_DRIFT' ELSE 'WOULD_DELETE' END AS action,
           CASE slice_year WHEN 1995 THEN 'verify_failed_present' WHEN 1996 THEN 'source_drift' END AS reason,
           held AS archive_count, kept AS source_count FROM f
    UNION ALL SELECT 'orders', 2000, 'SKIP_NOT_ELIGIBLE', 'not_archived_state', 0,
           count(*) FILTER (WHERE {KEPT_SQL}) FROM orders WHERE year(o_orderdate) = 2000
    """,
)
def delete_plan(spark, d) -> DataFrame:
    (orders,) = read(spark, d, "orders")
    store, log = lifecycle(spark)
    seen = orders.where("NOT (year(o_orderdate) = 1996 AND o_orderkey % 50 = 0)")
    archive(orders_source(seen), store, log, "r1", AS_OF)
    log.record("r0", [{"table_name": "orders", "year": 1995, "status": "VERIFY_FAILED", "record_count": 0}])
    return plan_delete(
        orders_source(orders), store, log.rows(), "x1", AS_OF, dt.datetime.now(dt.timezone.utc),
        years=list(range(1995, 2001)),
    )
