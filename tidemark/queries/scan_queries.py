"""Queries: table scanner and configuration, over one table per part."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from ..operators import config, scan
from ..plans.scanning import ConfigStore, run_scan_job
from ..session import workspace
from ..sources import tables
from .base import TABLES, query, read
from .configs import CATALOGUE, CONDITIONS_SQL, CONFIG, configs

RUN = "scan_1"
TEMPLATES = [
    scan.Template("cat", "sch_0", ("claim_date", ".*_date$", "dt"), "/archive/s0", 7, False),
    scan.Template("cat", "sch_1", (".*_dt$", ".*_date$"), "/archive/s1", 5, True, 4.0),
    scan.Template("cat", "sch_2", ("[", ".*date", "ts"), "/archive/s2", None, False),
    scan.Template("cat", "sch_3", ("load_ts", "dt"), "/archive/s3", 3, True, 10.0),
    scan.Template("cat", "sch_4", (".*_date", "dt"), "/archive/s4", 6, False, 0.0, ("t_4", "t_9", "t_14")),
]
FOUND_SCHEMAS = "('sch_0', 'sch_1', 'sch_2', 'sch_3', 'sch_4')"


def _text(v) -> str:
    return "NULL" if v is None else f"'{v}'" if isinstance(v, str) else str(v)


TEMPLATE_SQL = "SELECT * FROM (VALUES " + ", ".join(
    f"('{t.source_schema}', '{t.archive_base_path}', {_text(t.default_retention_years)}, "
    f"{str(t.delete_after_archive).upper()}, {t.min_table_size_gb})"
    for t in TEMPLATES
) + ") AS v(source_schema, archive_base_path, retention_years, delete_after_archive, min_gb)"
PATTERN_SQL = "SELECT * FROM (VALUES " + ", ".join(
    f"('{t.source_schema}', {i}, '{p}')" for t in TEMPLATES for i, p in scan.usable_patterns(t.patterns)
) + ") AS v(source_schema, pos, pattern)"
COLUMNS_SQL = f"""
    SELECT source_catalog, source_schema, source_table, unnest(string_split(column_list, ',')) AS column_name,
           CAST(unnest(generate_series(1, len(string_split(column_list, ',')))) AS INTEGER) AS ordinal
    FROM ({CATALOGUE}) c
"""
TABLES_SQL = f"""
    SELECT source_catalog, source_schema, source_table, table_id, size_gb FROM ({CATALOGUE}) c
"""
EXCLUDED = "source_schema = 'sch_4' AND source_table IN ('t_4', 't_9', 't_14')"
MATCH_SQL = f"""
    SELECT t.source_catalog, t.source_schema, t.source_table, t.table_id, t.size_gb,
           CASE WHEN h.n IS NULL THEN 'unmatched' WHEN h.n = 1 THEN 'matched' ELSE 'ambiguous' END AS match_status,
           CASE WHEN h.n = 1 THEN h.names END AS matched_column, h.pattern AS matched_pattern, h.names
    FROM ({TABLES_SQL}) t LEFT JOIN (
        SELECT source_schema, source_table, pattern, n, names FROM (
            SELECT *, row_number() OVER (PARTITION BY source_schema, source_table ORDER BY pos) AS rn FROM (
                SELECT c.source_schema, c.source_table, p.pos, p.pattern,
                       CASE WHEN count(*) FILTER (WHERE column_name = pattern) > 0
                            THEN count(*) FILTER (WHERE column_name = pattern) ELSE count(*) END AS n,
                       CASE WHEN count(*) FILTER (WHERE column_name = pattern) > 0
                            THEN string_agg(column_name, ', ' ORDER BY ordinal) FILTER (WHERE column_name = pattern)
                            ELSE string_agg(column_name, ', ' ORDER BY ordinal) END AS names
                FROM ({COLUMNS_SQL}) c JOIN ({PATTERN_SQL}) p ON p.source_schema = c.source_schema
                WHERE column_name = pattern OR regexp_full_match(column_name, pattern)
                GROUP BY 1, 2, 3, 4) g) r WHERE rn = 1) h
    ON h.source_schema = t.source_schema AND h.source_table = t.source_table
    WHERE NOT ({EXCLUDED.replace('source_', 't.source_')})
"""
SIZE_REASON = (
    "CASE WHEN p.min_gb = 0 THEN NULL WHEN m.size_gb IS NULL THEN 'table size unknown' "
    "WHEN m.size_gb < p.min_gb THEN printf('table size %.1f GB is below minimum threshold of %.1f GB', m.size_gb, CAST(p.min_gb AS DOUBLE)) END"
)
PROPOSED_SQL = f"""
    SELECT m.table_id, m.source_catalog, m.source_schema, m.source_table,
           m.matched_column AS watermark_column, CAST(p.retention_years AS INTEGER) AS retention_years,
           p.archive_base_path, p.delete_after_archive,
           r.reason IS NULL AS is_active, r.reason, m.match_status, m.matched_column, m.matched_pattern, m.names, m.size_gb,
           m.match_status = 'matched' AND {SIZE_REASON} IS NULL AS size_check_passed,
           m.match_status = 'matched' AND p.min_gb > 0 AND m.size_gb IS NULL AS size_unknown
    FROM ({MATCH_SQL}) m JOIN ({TEMPLATE_SQL}) p ON p.source_schema = m.source_schema,
    LATERAL (SELECT CASE m.match_status WHEN 'unmatched' THEN 'no date column matched — no pattern matched any column'
        WHEN 'ambiguous' THEN 'ambiguous date column: pattern ''' || m.matched_pattern || ''' matched [' || m.names || ']'
        ELSE {SIZE_REASON} END AS reason) r
"""
# Configuration before the scan: tables t_k with k % 4 = 3 are not known yet.
EXISTING_SQL = f"SELECT * FROM ({CONFIG}) e WHERE p_partkey % 4 <> 3"


class Scanned:
    """The scan of the derived catalogue."""

    def __init__(self, spark, d):
        read(spark, d, "part")
        listed = spark.sql(CATALOGUE).withColumn("columns", F.split("column_list", ","))
        self.columns = tables.columns_of(listed.select(*scan.TABLE, "columns"))
        self.tables = listed.select(*scan.TABLE)
        self.sizes = listed.select(*scan.TABLE, "size_gb")
        self.templates = scan.templates_frame(spark, TEMPLATES)
        self.existing = configs(spark, d).where("CAST(substr(source_table, 3) AS BIGINT) % 4 <> 3")
        self.matches = scan.match_columns(self.columns, self.templates)
        self.proposed = scan.propose(self.matches, self.sizes, self.templates)
        self.staged = scan.staging(self.proposed, RUN)


@query("scan_columns", f"SELECT * FROM ({COLUMNS_SQL}) c")
def scan_columns(spark, d) -> DataFrame:
    return Scanned(spark, d).columns.orderBy(*scan.TABLE, "ordinal")


@query(
    "scan_match",
    f"""SELECT source_catalog, source_schema, source_table, match_status, matched_column, matched_pattern,
        coalesce(names, '') AS all_matched_columns FROM ({MATCH_SQL}) m""",
)
def scan_match(spark, d) -> DataFrame:
    return Scanned(spark, d).matches.withColumn(
        "all_matched_columns", F.array_join("all_matched_columns", ", ")
    )


STAGED = ", ".join(scan.STAGED)


@query("scan_config", f"SELECT {STAGED}, match_status, size_check_passed FROM ({PROPOSED_SQL}) p")
def scan_config(spark, d) -> DataFrame:
    return Scanned(spark, d).proposed.select(*scan.STAGED, "match_status", "size_check_passed")


@query("scan_staging", f"SELECT {STAGED}, 'scanner' AS modified_by, '{RUN}' AS scan_run_id FROM ({PROPOSED_SQL}) p")
def scan_staging(spark, d) -> DataFrame:
    path = workspace(spark, "staging")
    path += "/table_configs_staging"
    staged = Scanned(spark, d).staged
    staged.write.mode("append").parquet(path)
    return spark.read.schema(staged.schema).parquet(path)


LOG_SQL = f"""
    SELECT '{RUN}' AS scan_run_id, t.table_id, t.source_catalog, t.source_schema, t.source_table,
           coalesce(p.match_status, 'excluded') AS match_status, p.matched_column, p.matched_pattern,
           CASE WHEN p.match_status = 'ambiguous' THEN 'pattern ''' || p.matched_pattern || ''' matched [' || p.names || ']' END AS ambiguity_detail,
           p.size_gb AS table_size_gb, coalesce(p.size_check_passed, FALSE) AS size_check_passed,
           coalesce(p.is_active, FALSE) AS is_active,
           CASE WHEN p.match_status IS NULL THEN 'excluded by template exclude_tables' ELSE p.reason END AS inactive_reason,
           CASE WHEN p.match_status IS NULL THEN NULL WHEN e.table_id IS NULL THEN 'added'
                WHEN e.modified_by = 'scanner' THEN 'updated' ELSE 'preserved' END AS merge_action,
           coalesce(p.size_unknown, FALSE) AS size_unknown
    FROM ({TABLES_SQL}) t LEFT JOIN ({PROPOSED_SQL}) p ON p.table_id = t.table_id
         LEFT JOIN ({EXISTING_SQL}) e ON e.table_id = t.table_id
"""


def _log(spark, d) -> DataFrame:
    s = Scanned(spark, d)
    return scan.log_rows(s.tables, s.proposed, s.existing, RUN)


@query("scan_log", f"SELECT * EXCLUDE (size_unknown) FROM ({LOG_SQL}) l")
def scan_log(spark, d) -> DataFrame:
    return _log(spark, d).drop("all_matched_columns", "log_id", "workspace_id", "scanned_by", "created_at")


@query(
    "scan_summary",
    f"""
    SELECT count(*) FILTER (WHERE match_status = 'matched' AND is_active) AS tables_matched,
           count(*) FILTER (WHERE match_status = 'ambiguous') AS tables_ambiguous,
           count(*) FILTER (WHERE match_status = 'unmatched') AS tables_unmatched,
           count(*) FILTER (WHERE match_status = 'excluded') AS tables_excluded,
           count(*) FILTER (WHERE match_status = 'matched' AND NOT is_active AND NOT size_unknown) AS tables_below_size_threshold,
           count(*) FILTER (WHERE size_unknown) AS tables_size_unknown,
           count(*) FILTER (WHERE merge_action = 'preserved') AS tables_preserved
    FROM ({LOG_SQL}) l
    """,
)
def scan_summary(spark, d) -> DataFrame:
    s = Scanned(spark, d)
    return scan.run_scan(s.columns, s.sizes, s.existing, s.templates, RUN)["summary"]


NAMES_SQL = ", ".join(f"'{t}'" for t in TABLES)


@query(
    "scan_job",
    f"""
    WITH c AS (SELECT table_name, column_name FROM information_schema.columns WHERE table_name IN ({NAMES_SQL})),
    h AS (SELECT table_name, count(*) FILTER (WHERE column_name = 'ts') AS ts, count(*) FILTER (WHERE column_name LIKE '%date') AS dates,
                 min(column_name) FILTER (WHERE column_name LIKE '%date') AS first_date FROM c GROUP BY 1)
    SELECT table_name AS source_table, CASE WHEN ts = 1 THEN 'ts' WHEN dates = 1 THEN first_date END AS watermark_column,
           ts = 1 OR dates = 1 AND table_name <> 'orders' AS is_active, CASE WHEN table_name = 'orders' THEN 'inactive' ELSE 'updated' END AS last_action,
           CASE WHEN table_name = 'orders' THEN 'dropped: not found in scan s2' WHEN ts = 1 OR dates = 1 THEN NULL
                WHEN dates > 1 THEN 'ambiguous' ELSE 'unmatched' END AS why,
           table_name <> 'orders' AS scanned_again, TRUE AS has_size
    FROM h
    """,
)
def scan_job(spark, d) -> DataFrame:
    """Two scans of real tables of the session's catalogue; one table is dropped between them."""
    base = workspace(spark, "scan")
    schema = f"scanned_{uuid.uuid4().hex}"
    spark.sql(f"CREATE SCHEMA {schema} LOCATION '{base}/schema'")
    for name in TABLES:
        spark.sql(f"CREATE TABLE {schema}.{name} USING parquet LOCATION '{d}/{name}.parquet'")
    configs_ = ConfigStore(spark, base)
    template = scan.Template("spark_catalog", schema, ("ts", ".*date"), "/archive", 5, False, 0.0, ())
    run_scan_job(spark, [template], configs_, "s1")
    spark.sql(f"DROP TABLE {schema}.orders")
    run_scan_job(spark, [template], configs_, "s2")
    log = configs_.log().groupBy("source_table").agg(
        F.bool_or(F.col("scan_run_id") == "s2").alias("scanned_again"), F.bool_and(F.col("table_size_gb") > 0).alias("has_size")
    )
    why = F.when(F.col("reason").startswith("ambiguous"), "ambiguous").when(F.col("reason").startswith("no date"), "unmatched")
    return configs_.config().join(log, "source_table").select(
        "source_table", "watermark_column", "is_active",
        F.when(F.col("change_reason").startswith("marked inactive"), "inactive")
        .when(F.col("change_reason") == "updated by scan s2", "updated").alias("last_action"),
        F.coalesce(why, "reason").alias("why"), "scanned_again", "has_size",
    )


@query(
    "table_size",
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count, TRUE AS has_size FROM {t}" for t in TABLES),
)
def table_size(spark, d) -> DataFrame:
    """Sizes from file lengths, beside the number of rows of each table."""
    counted = None
    for name in TABLES:
        one = spark.read.parquet(f"{d}/{name}.parquet").agg(F.count(F.lit(1)).alias("row_count"))
        one = one.select(F.lit(name).alias("table_name"), "row_count")
        counted = one if counted is None else counted.unionByName(one)
    return counted.join(tables.sizes(spark, d), "table_name", "left").select(
        "table_name", "row_count", F.coalesce(F.col("size_gb") > 0, F.lit(False)).alias("has_size")
    )


@query(
    "config_merge",
    f"""
    WITH e AS ({EXISTING_SQL}), p AS ({PROPOSED_SQL}),
    j AS (SELECT e.table_id AS eid, p.table_id AS pid, p.table_id IS NOT NULL AND e.modified_by = 'scanner' AS upd,
                 e.watermark_column AS ew, p.watermark_column AS pw, e.retention_years AS er, p.retention_years AS pr,
                 e.is_active AS ea, p.is_active AS pa, e.reason AS es, p.reason AS ps, e.modified_by AS em,
                 e.change_reason AS ec, e.scan_run_id AS ei
          FROM e FULL OUTER JOIN p ON p.table_id = e.table_id)
    SELECT coalesce(eid, pid) AS table_id,
           CASE WHEN eid IS NULL OR upd THEN pw ELSE ew END AS watermark_column,
           CASE WHEN eid IS NULL OR upd THEN pr ELSE er END AS retention_years,
           CASE WHEN eid IS NULL OR upd THEN pa ELSE ea END AS is_active,
           CASE WHEN eid IS NULL OR upd THEN ps ELSE es END AS reason,
           CASE WHEN eid IS NULL THEN 'scanner' ELSE em END AS modified_by,
           CASE WHEN eid IS NULL THEN 'added by scan {RUN}' WHEN upd THEN 'updated by scan {RUN}' ELSE ec END AS change_reason,
           CASE WHEN eid IS NULL OR upd THEN '{RUN}' ELSE ei END AS scan_run_id,
           CAST(CASE WHEN eid IS NULL THEN NULL ELSE 2 END AS INTEGER) AS n_conditions
    FROM j
    """,
)
def config_merge(spark, d) -> DataFrame:
    s = Scanned(spark, d)
    return scan.merge(s.existing, s.staged, RUN).select(
        "table_id", "watermark_column", "retention_years", "is_active", "reason", "modified_by",
        "change_reason", "scan_run_id", F.size("exclusion_conditions").alias("n_conditions"),
    ).withColumn("n_conditions", F.when(F.col("n_conditions") >= 0, F.col("n_conditions")))


SCANNED = ("sch_0", "sch_1")  # a scan of two of the schemas
GONE = f"modified_by = 'scanner' AND source_schema IN ('sch_0', 'sch_1') AND p_partkey % 6 = 5"


@query(
    "config_deactivate",
    f"""
    SELECT table_id, CASE WHEN {GONE} THEN FALSE ELSE is_active END AS is_active,
           CASE WHEN {GONE} THEN 'dropped: not found in scan {RUN}' ELSE reason END AS reason,
           CASE WHEN {GONE} THEN 'marked inactive by scan {RUN}' ELSE change_reason END AS change_reason,
           CASE WHEN {GONE} THEN '{RUN}' ELSE scan_run_id END AS scan_run_id
    FROM ({CONFIG}) c
    """,
)
def config_deactivate(spark, d) -> DataFrame:
    c = configs(spark, d)
    found = c.where("CAST(substr(source_table, 3) AS BIGINT) % 6 <> 5")
    scanned = scan.templates_frame(spark, [t for t in TEMPLATES if t.source_schema in SCANNED])
    return scan.deactivate(c, found, scanned, RUN).select(
        "table_id", "is_active", "reason", "change_reason", "scan_run_id"
    )


@query(
    "effective_config",
    f"""SELECT table_id, coalesce(retention_years, 7) AS retention_years, coalesce(timezone, 'America/Chicago') AS timezone
        FROM ({CONFIG}) c""",
)
def effective_config(spark, d) -> DataFrame:
    return config.effective(configs(spark, d), 7, "America/Chicago").select(
        "table_id", "retention_years", "timezone"
    )


@query(
    "config_subset",
    f"SELECT table_id, retention_years FROM ({CONFIG}) c WHERE is_active AND source_catalog = 'cat' "
    "AND source_schema = 'sch_2' AND (retention_years > 3)",
)
def config_subset(spark, d) -> DataFrame:
    return config.subset(
        configs(spark, d), source_catalog="cat", source_schema="sch_2", filter_expr="retention_years > 3"
    ).select("table_id", "retention_years")


# Every fiftieth id is repeated here.
DUPED = "CASE WHEN p_partkey % 50 = 5 THEN 'cat.sch_0.t_' || CAST(p_partkey - 5 AS STRING) ELSE table_id END"


@query(
    "config_violations",
    f"""
    WITH c AS (SELECT {DUPED} AS table_id, watermark_column, is_active, archive_base_path, timezone FROM ({CONFIG}) k)
    SELECT table_id, 'archive_base_path is missing' AS violation FROM c WHERE trim(archive_base_path) = ''
    UNION ALL SELECT table_id, 'watermark_column is missing' FROM c WHERE is_active AND trim(watermark_column) = ''
    UNION ALL SELECT table_id, 'watermark_column is not an identifier' FROM c WHERE is_active AND watermark_column = 'bad-name'
    UNION ALL SELECT table_id, 'timezone is not known' FROM c WHERE timezone = 'Mars/Base'
    UNION ALL SELECT table_id, 'table_id is not unique' FROM c GROUP BY table_id HAVING count(*) > 1
    """,
)
def config_violations(spark, d) -> DataFrame:
    key = F.expr("CAST(substr(source_table, 3) AS BIGINT)")
    duped = F.when(key % 50 == 5, F.concat(F.lit("cat.sch_0.t_"), (key - 5).cast("string"))).otherwise(
        F.col("table_id")
    )
    return config.table_violations(configs(spark, d).withColumn("table_id", duped))


@query(
    "condition_violations",
    f"""
    WITH c AS (SELECT table_id, CAST(position AS INTEGER) AS position, type, "column" AS col, operator, value FROM ({CONDITIONS_SQL}) k)
    SELECT table_id, position, 'type is not known' AS violation FROM c WHERE type = 'bogus'
    UNION ALL SELECT table_id, position, 'operator is not known' FROM c WHERE type = 'same_table' AND operator = 'like'
    UNION ALL SELECT table_id, position, 'column is missing' FROM c WHERE type = 'same_table' AND col IS NULL
    UNION ALL SELECT table_id, position, 'value is missing' FROM c
              WHERE type = 'same_table' AND value IS NULL AND operator <> 'is_not_null'
    UNION ALL SELECT table_id, position, 'custom_sql does not mention {{source_alias}}' FROM c
              WHERE type = 'custom_sql' AND value NOT LIKE '%{{source_alias}}%'
    """,
)
def condition_violations(spark, d) -> DataFrame:
    return config.condition_violations(configs(spark, d))
