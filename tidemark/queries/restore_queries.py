"""Queries: restore, union and schema drift."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from .. import archive, restore
from ..functions import evolution
from ..plans.restore import mismatch
from ..session import local_frame
from .base import AS_OF, ORDER_COLUMNS, first_load, lifecycle, orders_source, query, read
from .slice_queries import APPENDED_SQL, ARCHIVED_SQL, FIRST_SQL, SECOND_SQL, appended_orders, archived_orders

COLS = ", ".join(ORDER_COLUMNS)


@query("restore_year", f"SELECT {COLS} FROM ({ARCHIVED_SQL}) a WHERE slice_year = 1997")
def restore_year(spark, d) -> DataFrame:
    store, log, _ = archived_orders(spark, d)
    restore(store, log, "orders", [1995, 1997, 2001], prefix="restored_", unified=False)
    return spark.table("restored_orders_year_1997")


@query(
    "restore_unified",
    f"SELECT {COLS} FROM orders UNION ALL SELECT {COLS} FROM ({ARCHIVED_SQL}) a WHERE slice_year IN (1995, 1998)",
)
def restore_unified(spark, d) -> DataFrame:
    store, log, source = archived_orders(spark, d)
    restore(store, log, "orders", [1995, 1998], live=source.rows, prefix="restored_")
    return spark.table("restored_orders_unified")


@query(
    "restore_view",
    f"""
    SELECT {COLS}, 'orders' AS target FROM orders
    UNION ALL SELECT {COLS}, 'orders' FROM ({APPENDED_SQL}) a WHERE slice_year IN (1995, 1998)
    """,
)
def restore_view(spark, d) -> DataFrame:
    """Years of several appends as views of the catalogue, read by name from another session."""
    store, log, source = appended_orders(spark, d)
    schema = f"restored_{uuid.uuid4().hex}"
    spark.sql(f"CREATE SCHEMA {schema} LOCATION '{store.base}/schema'")
    source.rows.write.parquet(f"{store.base}/tables/orders")
    spark.sql(f"CREATE TABLE {schema}.orders USING parquet LOCATION '{store.base}/tables/orders'")
    restore(store, log, "orders", [1995, 1998, 2001], target_schema=schema, live_table=f"{schema}.orders")
    (recorded,) = log.restores().where(F.col("target_schema") == schema).select("source_table").collect()
    return spark.newSession().table(f"{schema}.orders_unified").select(*ORDER_COLUMNS, F.lit(recorded.source_table).alias("target"))


@query(
    "restore_audit",
    """
    WITH y AS (SELECT count(DISTINCT year(o_orderdate)) AS n FROM orders WHERE year(o_orderdate) IN (1996, 1999))
    SELECT 'orders' AS source_table, '[1996, 1999]' AS years, CAST(n AS INTEGER) AS tables_created, 'COMPLETED' AS status FROM y
    UNION ALL SELECT 'orders', '[1996, 2001]', 1, 'PARTIAL_COMPLETED'
    UNION ALL SELECT 'orders', '[2001]', 0, 'FAILED'
    """,
)
def restore_audit(spark, d) -> DataFrame:
    store, log, _ = archived_orders(spark, d)
    for years in ([1996, 1999], [1996, 2001], [2001]):
        try:
            restore(store, log, "orders", years, prefix="checked_")
        except LookupError:
            pass  # recorded as FAILED
    return log.restores().select("source_table", "years", "tables_created", "status")


def participant(orders: DataFrame, year: int) -> DataFrame:
    """A year of the table as its slice might look after changes of the schema."""
    rows = orders.where(f"year(o_orderdate) = {year}")
    changed = {
        0: lambda: rows.withColumnRenamed("o_custkey", "customer"),
        1: lambda: rows.withColumn("o_custkey", F.col("o_custkey").cast("int")),
        2: lambda: rows.drop("o_orderpriority"),
        3: lambda: rows,
    }
    return changed[year % 4]()


@query(
    "schema_compat",
    f"""
    SELECT 'live' AS participant, CAST(NULL AS VARCHAR) AS mismatch, count(*) AS row_count FROM orders
    UNION ALL
    SELECT 'year_' || CAST(year(o_orderdate) AS VARCHAR),
           CASE year(o_orderdate) % 4 WHEN 1 THEN 'column types differ: o_custkey: bigint vs int'
                WHEN 3 THEN NULL ELSE 'column names or order differ' END, count(*)
    FROM orders GROUP BY year(o_orderdate)
    """,
)
def schema_compat(spark, d) -> DataFrame:
    """Every year of the table against the live table; rows are counted in one scan."""
    (orders,) = read(spark, d, "orders")
    counts = orders.groupBy(F.year("o_orderdate").alias("year")).agg(F.count(F.lit(1)).alias("row_count")).collect()
    found = [("live", None, sum(r.row_count for r in counts))]
    found += [(f"year_{r.year}", mismatch(orders.schema, participant(orders, r.year).schema), r.row_count) for r in counts]
    return local_frame(spark, found, "participant STRING, mismatch STRING, row_count BIGINT")


def old_rows(orders: DataFrame) -> DataFrame:
    return orders.where(f"o_orderdate < TIMESTAMP_NTZ '1998-01-01'")


def new_rows(orders: DataFrame) -> DataFrame:
    return orders.where(f"o_orderdate >= TIMESTAMP_NTZ '1998-01-01'")


OLD = "o_orderdate < TIMESTAMP '1998-01-01'"


@query(
    "evolve_append",
    f"""
    SELECT {COLS}, CASE WHEN {OLD} THEN NULL ELSE 'r' || CAST(o_custkey % 5 AS VARCHAR) END AS region FROM (
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
               CASE WHEN {OLD} THEN o_orderpriority END AS o_orderpriority FROM orders) t
    """,
)
def evolve_append(spark, d) -> DataFrame:
    (orders,) = read(spark, d, "orders")
    old = old_rows(orders).withColumn("o_custkey", F.col("o_custkey").cast("int"))
    new = new_rows(orders).drop("o_orderpriority").withColumn(
        "region", F.concat(F.lit("r"), (F.col("o_custkey") % 5).cast("string"))
    )
    return evolution.merge_append(old, new)


@query(
    "evolve_add",
    f"""
    SELECT *, CAST(NULL AS VARCHAR) AS region FROM ({FIRST_SQL}) f
    UNION ALL SELECT *, 'r' || CAST(o_custkey % 5 AS VARCHAR) FROM ({SECOND_SQL}) s
    """,
)
def evolve_add(spark, d) -> DataFrame:
    """A column added between two archive runs, read back from the slices."""
    (orders,) = read(spark, d, "orders")
    store, log = lifecycle(spark)
    wider = orders.withColumn("region", F.concat(F.lit("r"), (F.col("o_custkey") % 5).cast("string")))
    archive(orders_source(first_load(orders)), store, log, "r1", AS_OF)
    archive(orders_source(wider), store, log, "r2", AS_OF, merge_schema=True)
    return store.read("orders")


@query(
    "evolve_drop",
    f"""
    SELECT * FROM ({FIRST_SQL}) f
    UNION ALL SELECT * REPLACE (CAST(NULL AS VARCHAR) AS o_orderpriority) FROM ({SECOND_SQL}) s
    """,
)
def evolve_drop(spark, d) -> DataFrame:
    (orders,) = read(spark, d, "orders")
    store, log = lifecycle(spark)
    archive(orders_source(first_load(orders)), store, log, "r1", AS_OF)
    archive(orders_source(orders.drop("o_orderpriority")), store, log, "r2", AS_OF, merge_schema=True)
    return store.read("orders")


@query("evolve_widen", f"SELECT * FROM ({APPENDED_SQL}) a")
def evolve_widen(spark, d) -> DataFrame:
    (orders,) = read(spark, d, "orders")
    store, log = lifecycle(spark)
    narrow = orders.withColumn("o_custkey", F.col("o_custkey").cast("int"))
    archive(orders_source(first_load(narrow)), store, log, "r1", AS_OF)
    archive(orders_source(orders), store, log, "r2", AS_OF, merge_schema=True)
    return store.read("orders")


@query("evolve_mixed", f"SELECT * FROM ({ARCHIVED_SQL}) a")
def evolve_mixed(spark, d) -> DataFrame:
    """Slices that are narrow in different columns, or hold an old one, are read together at the widest types."""
    (orders,) = read(spark, d, "orders")
    store, log = lifecycle(spark)
    parts = {
        1995: orders.withColumn("o_custkey", F.col("o_custkey").cast("int")),
        1996: orders.withColumn("o_orderkey", F.col("o_orderkey").cast("int")),
        1997: orders.withColumn("former", F.lit("x")),
    }
    for year, rows in parts.items():
        archive(orders_source(rows.where(f"year(o_orderdate) = {year}")), store, log, f"r{year}", AS_OF)
    archive(orders_source(orders.where("year(o_orderdate) NOT IN (1995, 1996, 1997)")), store, log, "rest", AS_OF)
    return store.read("orders").drop("former")


@query(
    "evolve_refuse",
    f"""
    SELECT c.*, n.batch_rows FROM (VALUES
        ('narrow', 'o_custkey', 'narrower', FALSE), ('retype', 'o_orderdate', 'refused', FALSE),
        ('add_without_merge', 'region', 'added', FALSE), ('add_with_merge', 'region', 'added', TRUE),
        ('widen_without_merge', 'o_custkey', 'widened', FALSE)) AS c(case_name, column_name, kind, allowed),
    (SELECT count(*) AS batch_rows FROM orders WHERE NOT ({OLD})) n
    """,
)
def evolve_refuse(spark, d) -> DataFrame:
    """Which appends are refused, with the size of the batch that would be turned away."""
    (orders,) = read(spark, d, "orders")
    old, new = old_rows(orders), new_rows(orders)
    as_int = F.col("o_custkey").cast("int")
    cases = [
        ("narrow", old, new.withColumn("o_custkey", as_int), True),
        ("retype", old, new.withColumn("o_orderdate", F.col("o_orderdate").cast("string")), True),
        ("add_without_merge", old, new.withColumn("region", F.lit("x")), False),
        ("add_with_merge", old, new.withColumn("region", F.lit("x")), True),
        ("widen_without_merge", old.withColumn("o_custkey", as_int), new, False),
    ]
    found = [
        (name, c.column, c.kind, c.allowed(merge))
        for name, a, b, merge in cases
        for c in evolution.changes(a.schema, b.schema)
        if c.kind != "same"
    ]
    verdicts = spark.createDataFrame(
        found, "case_name STRING, column_name STRING, kind STRING, allowed BOOLEAN"
    )
    # one row of counts against a handful of verdicts
    return verdicts.crossJoin(new.agg(F.count(F.lit(1)).alias("batch_rows")))
