"""Queries: year selection, profile and exclusion rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.rules import Rule
from ..operators import config, profile
from ..sources.tables import Source
from .base import (
    AS_OF, BIG, EVENTS_AS_OF, FIRST_LOAD_SQL, LAST_YEAR, MIDDAY, ORDERS_N, PENDING, RETENTION,
    RETURNED, Y, events_source, first_load, lineitem_source, orders_source, query, read,
)
from .configs import CONDITIONS_SQL, configs

STATUS_P = Rule("status_p", "same_table", "status_n", "equals", "P")


def nullable_orders(spark, d, rules) -> Source:
    read(spark, d, "orders", "lineitem", "customer")
    return Source("orders", spark.sql(ORDERS_N), "wm", RETENTION, rules=tuple(rules))


@query(
    "eligible_years",
    f"""
    SELECT DISTINCT 'orders' AS table_id, {Y} AS slice_year FROM orders WHERE year(o_orderdate) <= {LAST_YEAR}
    UNION ALL
    SELECT DISTINCT 'lineitem', CAST(year(l_shipdate) AS INTEGER) FROM lineitem WHERE year(l_shipdate) <= {LAST_YEAR}
    """,
)
def eligible_years(spark, d) -> DataFrame:
    orders, lineitem = read(spark, d, "orders", "lineitem")
    return profile.eligible_years(orders_source(orders), AS_OF).unionByName(
        profile.eligible_years(lineitem_source(lineitem), AS_OF)
    )


@query(
    "year_profile",
    f"""
    SELECT CAST(year(wm) AS INTEGER) AS slice_year, count(*) AS total_rows,
           count(*) FILTER (WHERE wm IS NOT NULL AND NOT (status_n = 'P') AND NOT (o_totalprice > 200000)) AS kept_rows,
           count(*) FILTER (WHERE status_n = 'P') AS protected_status,
           count(*) FILTER (WHERE o_totalprice > 200000) AS protected_price,
           min(wm) FILTER (WHERE NOT (status_n = 'P') AND NOT (o_totalprice > 200000)) AS wm_lo,
           max(wm) FILTER (WHERE NOT (status_n = 'P') AND NOT (o_totalprice > 200000)) AS wm_hi
    FROM ({ORDERS_N}) t WHERE wm IS NULL OR year(wm) <= {LAST_YEAR} GROUP BY 1
    """,
)
def year_profile(spark, d) -> DataFrame:
    p = profile.year_profile(nullable_orders(spark, d, [STATUS_P, BIG]), AS_OF)
    return p.select(
        "slice_year",
        "total_rows",
        "kept_rows",
        F.col("protected")["status_p"].alias("protected_status"),
        F.col("protected")["big"].alias("protected_price"),
        "wm_lo",
        "wm_hi",
    )


@query(
    "null_watermark",
    f"""
    SELECT 'orders' AS table_id, count(*) FILTER (WHERE wm IS NULL) AS null_rows FROM ({ORDERS_N}) t
    UNION ALL SELECT 'lineitem', count(*) FILTER (WHERE l_shipdate IS NULL) FROM lineitem
    """,
)
def null_watermark(spark, d) -> DataFrame:
    (lineitem,) = read(spark, d, "lineitem")
    return profile.null_watermarks(nullable_orders(spark, d, [])).unionByName(
        profile.null_watermarks(lineitem_source(lineitem))
    )


@query(
    "append_candidates",
    f"""
    WITH om AS (SELECT {Y} AS slice_year, max(o_orderdate) AS high_water FROM orders
                WHERE {FIRST_LOAD_SQL} GROUP BY 1),
         em AS (SELECT CAST(year(ts) AS INTEGER) AS slice_year, max(ts) AS high_water FROM events
                WHERE ts <= TIMESTAMP '{MIDDAY}' GROUP BY 1)
    SELECT 'orders' AS table_id, slice_year, high_water,
           count(*) FILTER (WHERE o_orderdate > high_water AND o_orderstatus <> 'P') AS new_rows
    FROM orders JOIN om ON year(o_orderdate) = slice_year
    WHERE slice_year <= {LAST_YEAR} GROUP BY slice_year, high_water
    UNION ALL
    SELECT 'events', slice_year, high_water, count(*) FILTER (WHERE ts > high_water)
    FROM events JOIN em ON year(ts) = slice_year GROUP BY slice_year, high_water
    """,
)
def append_candidates(spark, d) -> DataFrame:
    orders, events = read(spark, d, "orders", "events")
    o, e = orders_source(orders, [PENDING]), events_source(events)
    om = first_load(orders).groupBy(o.year().alias("slice_year")).agg(F.max("o_orderdate").alias("high_water"))
    em = (
        events.where(f"ts <= TIMESTAMP_NTZ '{MIDDAY}'")
        .groupBy(e.year().alias("slice_year"))
        .agg(F.max("ts").alias("high_water"))
    )
    return profile.append_candidates(o, AS_OF, om).unionByName(
        profile.append_candidates(e, EVENTS_AS_OF, em)
    )


@query(
    "condition_table",
    f"""
    SELECT c.table_id, CAST(position AS INTEGER) AS position, name, type, "column", operator, value,
           'c1,c2' AS condition_names
    FROM ({CONDITIONS_SQL}) c
    """,
)
def condition_table(spark, d) -> DataFrame:
    c = configs(spark, d)
    names = config.condition_names(c).select(
        "table_id", F.array_join("condition_names", ",").alias("condition_names")
    )
    return config.exploded_conditions(c).join(names, "table_id")


# name -> (rule, the same predicate in DuckDB)
OPERATORS = {
    "excl_equals": (STATUS_P, "status_n = 'P'"),
    "excl_not_equals": (Rule("r", "same_table", "status_n", "not_equals", "F"), "status_n <> 'F'"),
    "excl_in": (Rule("r", "same_table", "status_n", "in", ["O", "P"]), "status_n IN ('O', 'P')"),
    "excl_in_text": (Rule("r", "same_table", "status_n", "in", "'O', P"), "status_n IN ('O', 'P')"),
    "excl_within_years": (
        Rule("r", "same_table", "wm", "within_years", 5), "wm >= DATE '2004-06-30' - INTERVAL 1825 DAY",
    ),
    "excl_within_months": (
        Rule("r", "same_table", "wm", "within_months", 60), "wm >= DATE '2004-06-30' - INTERVAL 60 MONTH",
    ),
    "excl_greater_than": (BIG, "o_totalprice > 200000"),
    "excl_is_not_null": (Rule("r", "same_table", "status_n", "is_not_null"), "status_n IS NOT NULL"),
    "excl_custom_sql": (
        RETURNED,
        "EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = t.o_orderkey AND l.l_returnflag = 'R')",
    ),
}


# Shapes a count per key cannot say: an inequality, and several subqueries in one rule.
OPERATORS["excl_range_sql"] = (
    Rule("r", "custom_sql", value="EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = {source_alias}.o_orderkey "
         "AND l.l_shipdate > {source_alias}.o_orderdate AND l.l_returnflag = 'R')"),
    "EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = t.o_orderkey AND l.l_shipdate > t.o_orderdate AND l.l_returnflag = 'R')",
)
OPERATORS["excl_two_subqueries"] = (
    Rule("r", "custom_sql", value="NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = {source_alias}.o_orderkey) "
         "OR ({source_alias}.o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0) AND {source_alias}.status_n <> 'IN (SELECT x FROM y)')"),
    "NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = t.o_orderkey) "
    "OR (t.o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0) AND t.status_n <> 'IN (SELECT x FROM y)')",
)


def _register_operator(name: str, rule: Rule, predicate: str) -> None:
    flags = f"SELECT t.wm, ({predicate}) AS f FROM ({ORDERS_N}) t"

    @query(
        name,
        f"""
        SELECT CAST(year(wm) AS INTEGER) AS slice_year, count(*) AS total_rows,
               count(*) FILTER (WHERE f) AS protected_rows,
               count(*) FILTER (WHERE NOT f AND wm IS NOT NULL) AS kept_rows
        FROM ({flags}) x GROUP BY 1
        """,
    )
    def run(spark, d) -> DataFrame:
        p = profile.year_profile(nullable_orders(spark, d, [rule]), AS_OF, eligible_only=False)
        return p.select(
            "slice_year", "total_rows", F.col("protected")[rule.name].alias("protected_rows"), "kept_rows"
        )


for _name, (_rule, _predicate) in OPERATORS.items():
    _register_operator(_name, _rule, _predicate)


COMBINED = [STATUS_P, BIG, Rule("recent", "same_table", "wm", "within_months", 90), RETURNED]
COMBINED_SQL = f"""
    SELECT CAST(year(wm) AS INTEGER) AS slice_year, wm,
           status_n = 'P' AS f1, o_totalprice > 200000 AS f2,
           wm >= DATE '2004-06-30' - INTERVAL 90 MONTH AS f3,
           EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = t.o_orderkey AND l.l_returnflag = 'R') AS f4
    FROM ({ORDERS_N}) t WHERE year(wm) <= {LAST_YEAR}
"""


@query(
    "excl_combined",
    f"""
    SELECT slice_year, count(*) AS total_rows,
           count(*) FILTER (WHERE NOT f1 AND NOT f2 AND NOT f3 AND NOT f4) AS kept_rows
    FROM ({COMBINED_SQL}) x GROUP BY 1
    """,
)
def excl_combined(spark, d) -> DataFrame:
    p = profile.year_profile(nullable_orders(spark, d, COMBINED), AS_OF)
    return p.where("slice_year IS NOT NULL").select("slice_year", "total_rows", "kept_rows")


@query(
    "condition_breakdown",
    " UNION ALL ".join(
        f"SELECT 'orders' AS table_id, slice_year, '{n}' AS condition_name, "
        f"count(*) FILTER (WHERE f{i}) AS rows_protected FROM ({COMBINED_SQL}) x{i} GROUP BY slice_year"
        for i, n in enumerate(["status_p", "big", "recent", "returned"], 1)
    ),
)
def condition_breakdown(spark, d) -> DataFrame:
    return profile.condition_breakdown(
        profile.year_profile(nullable_orders(spark, d, COMBINED), AS_OF)
    )
