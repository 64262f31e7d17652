"""Registry of queries and their reference SQL, and the inputs they share."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from types import SimpleNamespace

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.rules import Rule
from ..session import workspace
from ..sources.audit_log import AuditLog
from ..sources.slices import SliceStore
from ..sources.tables import Source

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

AS_OF = dt.date(2004, 6, 30)
RETENTION = 5
LAST_YEAR = AS_OF.year - RETENTION
EVENTS_AS_OF = dt.date(2030, 6, 30)


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` gives the same result in DuckDB."""

    def keep(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return keep


def load(spark: SparkSession, sf_dir: str) -> SimpleNamespace:
    """All tables, lazily; also as temporary views for rules written in SQL."""
    t = SimpleNamespace()
    for name in TABLES:
        df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        df.createOrReplaceTempView(name)
        setattr(t, name, df)
    return t


def read(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    """Only the named tables, also as temporary views."""
    found = []
    for name in names:
        df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        df.createOrReplaceTempView(name)
        found.append(df)
    return found


def lifecycle(spark: SparkSession) -> tuple[SliceStore, AuditLog]:
    """A slice store and audit log in a fresh workspace."""
    base = workspace(spark, "query")
    return SliceStore(spark, base), AuditLog(spark, base)


PENDING = Rule("pending", "same_table", "o_orderstatus", "equals", "P")
BIG = Rule("big", "same_table", "o_totalprice", "greater_than", 200000)
RETURNED = Rule(
    "returned",
    "custom_sql",
    value="EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = {source_alias}.o_orderkey "
    "AND l.l_returnflag = 'R')",
)
FLAG_R = Rule("flag_r", "same_table", "l_returnflag", "equals", "R")

ORDER_COLUMNS = (
    "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority",
)


def orders_source(rows: DataFrame, rules=(PENDING, BIG), retention_years=RETENTION, **more) -> Source:
    return Source("orders", rows, "o_orderdate", retention_years, rules=tuple(rules), **more)


def lineitem_source(rows: DataFrame, rules=(FLAG_R,), **more) -> Source:
    return Source("lineitem", rows, "l_shipdate", RETENTION, rules=tuple(rules), **more)


def events_source(rows: DataFrame, **more) -> Source:
    return Source("events", rows, "ts", RETENTION, **more)


# First load of the append scenarios: each year up to 30 September, some rows held back.
def _month_day() -> F.Column:
    return F.month("o_orderdate") * 100 + F.dayofmonth("o_orderdate")


def first_load(orders: DataFrame) -> DataFrame:
    return orders.where((_month_day() <= 930) & (F.col("o_orderkey") % 50 != 0))


FIRST_LOAD_SQL = "month(o_orderdate) * 100 + day(o_orderdate) <= 930 AND o_orderkey % 50 <> 0"
MIDDAY = "2024-01-20 12:00:00"

KEPT_SQL = "o_orderstatus <> 'P' AND NOT (o_totalprice > 200000)"
Y = "CAST(year(o_orderdate) AS INTEGER)"

# Orders with NULL dates and NULL statuses.
ORDERS_N = (
    "SELECT *, CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_orderdate END AS wm, "
    "CASE WHEN o_orderkey % 89 = 0 THEN NULL ELSE o_orderstatus END AS status_n FROM orders"
)

# An audit log derived from the events table; the same text runs in Spark and DuckDB.
AUDIT = """
SELECT CAST(event_id AS STRING) AS audit_id,
       'run_' || CAST(event_id % 40 AS STRING) AS archive_run_id,
       'tbl_' || CAST(user_id % 12 AS STRING) AS table_name,
       CAST(2015 + event_id % 9 AS INT) AS year,
       CASE event_type WHEN 'signup' THEN 'STARTED' WHEN 'view' THEN 'DRY_RUN'
                       WHEN 'click' THEN 'ARCHIVED' WHEN 'purchase' THEN 'ARCHIVED_AND_DELETED'
                       ELSE 'VERIFY_FAILED' END AS status,
       CAST(floor(value) AS BIGINT) AS record_count,
       ts AS created_at,
       CASE WHEN event_id % 7 = 0 THEN NULL ELSE ts END AS watermark_value,
       CAST(user_id * 10 AS BIGINT) AS source_year_count
FROM events
"""

# The same with a table per user and wipes, so that more slices lack one status or another.
AUDIT_WIDE = """
SELECT CAST(event_id AS STRING) AS audit_id,
       'run_' || CAST(event_id % 40 AS STRING) AS archive_run_id,
       'tbl_' || CAST(user_id AS STRING) AS table_name,
       CAST(2015 + event_id % 9 AS INT) AS year,
       CASE WHEN event_type = 'error' AND event_id % 4 = 0 THEN 'RECOVERY_ARCHIVE_ROLLED_BACK'
            WHEN event_type = 'error' AND event_id % 4 = 1 THEN 'RECOVERY_ARCHIVE_DELETED'
            WHEN event_type = 'error' AND event_id % 4 = 2 THEN 'FAILED'
            WHEN event_type = 'error' THEN 'VERIFY_FAILED'
            WHEN event_type = 'signup' THEN 'STARTED'
            WHEN event_type = 'view' THEN 'DRY_RUN'
            WHEN event_type = 'click' THEN 'ARCHIVED'
            ELSE 'ARCHIVED_AND_DELETED' END AS status,
       CAST(floor(value) AS BIGINT) AS record_count,
       ts AS created_at,
       CASE WHEN event_id % 7 = 0 THEN NULL ELSE ts END AS watermark_value,
       CAST(user_id * 10 AS BIGINT) AS source_year_count,
       CAST(CASE WHEN event_id % 7 = 0 THEN NULL ELSE event_id % 4 END AS BIGINT) AS archive_delta_version
FROM events
"""


def audit(spark: SparkSession, sf_dir: str, text: str = AUDIT) -> DataFrame:
    read(spark, sf_dir, "events")
    return spark.sql(text)
