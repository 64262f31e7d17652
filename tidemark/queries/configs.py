"""Table configuration and a table catalogue derived from the part table (one table per part)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .base import read

NAMES = """
    'cat' AS source_catalog,
    'sch_' || CAST(p_partkey % 5 AS STRING) AS source_schema,
    't_' || CAST(p_partkey AS STRING) AS source_table,
    'cat.sch_' || CAST(p_partkey % 5 AS STRING) || '.t_' || CAST(p_partkey AS STRING) AS table_id
"""

CONFIG = f"""
SELECT p_partkey, p_brand, {NAMES},
       CASE p_partkey % 7 WHEN 0 THEN '' WHEN 1 THEN 'bad-name' ELSE 'event_date' END AS watermark_column,
       CASE WHEN p_size % 3 = 0 THEN NULL ELSE CAST(p_size % 10 AS INT) END AS retention_years,
       CASE p_partkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'America/New_York' WHEN 2 THEN 'UTC' ELSE 'Mars/Base' END AS timezone,
       p_partkey % 3 <> 0 AS is_active,
       CASE WHEN p_partkey % 11 = 0 THEN '  ' ELSE '/archive/' || p_type END AS archive_base_path,
       p_size % 2 = 0 AS delete_after_archive,
       CASE WHEN p_partkey % 5 = 0 THEN 'alice' ELSE 'scanner' END AS modified_by,
       CAST(NULL AS STRING) AS reason,
       CAST(NULL AS STRING) AS change_reason,
       'scan_0' AS scan_run_id
FROM part
"""

FIRST = {
    "scope": "CASE p_partkey % 6 WHEN 0 THEN 'bogus' ELSE 'same_table' END",
    "column": "CASE p_partkey % 8 WHEN 0 THEN CAST(NULL AS STRING) ELSE 'status' END",
    "operator": "CASE p_partkey % 9 WHEN 0 THEN 'like' WHEN 1 THEN 'is_not_null' ELSE 'equals' END",
    "value": "CASE p_partkey % 4 WHEN 0 THEN CAST(NULL AS STRING) ELSE p_brand END",
}
SECOND_VALUE = (
    "CASE p_partkey % 10 WHEN 0 THEN 'x = 1' "
    "ELSE 'EXISTS (SELECT 1 FROM other o WHERE o.id = {source_alias}.id)' END"
)

CONDITIONS_SQL = f"""
SELECT table_id, 0 AS position, 'c1' AS name, {FIRST['scope']} AS type, {FIRST['column']} AS "column",
       {FIRST['operator']} AS operator, {FIRST['value']} AS value FROM ({CONFIG}) k1
UNION ALL
SELECT table_id, 1, 'c2', 'custom_sql', CAST(NULL AS STRING), CAST(NULL AS STRING), {SECOND_VALUE} FROM ({CONFIG}) k2
"""


def configs(spark, d) -> DataFrame:
    """The configuration with its exclusion conditions in their stored shape."""
    read(spark, d, "part")
    null = "CAST(NULL AS STRING)"
    conditions = f"""array(
        named_struct('name', 'c1', 'scope', {FIRST['scope']}, 'column', {FIRST['column']},
                     'operator', {FIRST['operator']}, 'value', {FIRST['value']}, 'sql', {null}),
        named_struct('name', 'c2', 'scope', 'custom_sql', 'column', {null},
                     'operator', {null}, 'value', {SECOND_VALUE}, 'sql', {null}))"""
    return (
        spark.sql(CONFIG).withColumn("exclusion_conditions", F.expr(conditions)).drop("p_partkey", "p_brand")
    )


CATALOGUE = f"""
SELECT {NAMES}, CASE WHEN p_size % 7 = 0 THEN NULL ELSE CAST(p_size AS DOUBLE) / 2 END AS size_gb,
       CASE p_partkey % 12 WHEN 0 THEN 'id,claim_date,x' WHEN 1 THEN 'svc_dt,other' WHEN 2 THEN 'start_date,end_date'
            WHEN 3 THEN 'a,b' WHEN 4 THEN 'dt,dt' WHEN 5 THEN 'load_ts,event_date,name' WHEN 6 THEN 'ts,x_date'
            WHEN 7 THEN 'claim_date,svc_date' WHEN 8 THEN 'load_ts,dt' WHEN 9 THEN 'svc_dt,end_dt,claim_date'
            WHEN 10 THEN 'dt' ELSE 'name,last_date' END AS column_list
FROM part
"""
