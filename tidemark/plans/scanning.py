"""The scan as a job: catalogue in; staging, configuration and log out.

The matches of a scan are computed once and written; staging, configuration, log and summary are made of what
was written. A configuration is a directory of its own, and one appended row says which is the current one, so readers
see the configuration before the scan or after it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from ..operators import scan
from ..schemas import TABLE_CONFIG_DDL
from ..session import local_frame
from ..sources.slices import check_name
from ..sources.tables import append_batch, file_listing, location, read_or_empty

_POINTER_DDL = "version BIGINT, scan_run_id STRING, dir STRING, committed_at TIMESTAMP"
_LISTED_DDL = "source_catalog STRING, source_schema STRING, source_table STRING, columns ARRAY<STRING>, location STRING"


@dataclass(frozen=True)
class ConfigStore:
    """Where scans keep the table configuration, their staging rows and their log."""

    spark: SparkSession
    base: str

    def versions(self) -> DataFrame:
        return read_or_empty(self.spark, f"{self.base}/table_configs_versions", _POINTER_DDL)

    def current(self) -> Row | None:
        return self.versions().orderBy(F.col("version").desc(), F.col("committed_at")).first()

    def config(self, version: int | None = None) -> DataFrame:
        """The current configuration, or an earlier one; empty before the first scan."""
        known = self.versions() if version is None else self.versions().where(F.col("version") == version)
        found = known.orderBy(F.col("version").desc(), F.col("committed_at")).first()
        if found is None:
            return self.spark.createDataFrame([], TABLE_CONFIG_DDL)
        return self.spark.read.schema(TABLE_CONFIG_DDL).parquet(found.dir)

    def publish(self, config: DataFrame, scan_run_id: str) -> int:
        """Write a configuration and make it the current one; its version."""
        before = self.current()
        version = 0 if before is None else before.version + 1
        directory = f"{self.base}/table_configs/{version}-{scan_run_id}"
        config.write.parquet(directory)
        row = [(version, scan_run_id, directory, dt.datetime.now(dt.timezone.utc))]
        append_batch(local_frame(self.spark, row, _POINTER_DDL).coalesce(1), f"{self.base}/table_configs_versions")
        return version

    def staging(self) -> DataFrame:
        return self.spark.read.option("recursiveFileLookup", "true").parquet(f"{self.base}/table_configs_staging")

    def log(self) -> DataFrame:
        return self.spark.read.option("recursiveFileLookup", "true").parquet(f"{self.base}/scanner_log")


def catalogue(spark: SparkSession, schemas: Sequence[tuple[str, str]], max_parallel: int = 8) -> DataFrame:
    """(source_catalog, source_schema, source_table, columns, location) of the tables of the given schemas.

    Metadata calls only, two per table, a few at a time: nothing is listed or read. Views are no tables here. A table
    whose metadata cannot be read has no columns, and so is unmatched.
    """
    names = [
        (catalog, schema, t.name)
        for catalog, schema in dict.fromkeys(schemas)
        for t in spark.catalog.listTables(f"`{catalog}`.`{schema}`" if catalog else f"`{schema}`")
        if not t.isTemporary and t.tableType != "VIEW"
    ]

    def look(name: tuple[str, str, str]) -> tuple:
        full = ".".join(f"`{part}`" for part in name if part)
        try:
            columns = [c.name for c in spark.catalog.listColumns(full)]
            place = location(spark, full)
        except Exception:  # a table somebody dropped meanwhile, or one of a broken format
            return (*name, [], None)
        return (*name, columns, place)

    with ThreadPoolExecutor(max_parallel) as pool:
        rows = list(pool.map(inheritable_thread_target(spark)(look), names))
    return local_frame(spark, rows, _LISTED_DDL)


def catalogue_sizes(spark: SparkSession, listed: DataFrame) -> DataFrame:
    """(table, size_gb) from the lengths of the files below each table's location; contents are never read.

    Every file is joined to its table by one of the folders above it. Tables without a location have no size.
    """
    places = listed.where("location IS NOT NULL").select(*scan.TABLE, _plain(F.col("location")).alias("_place"))
    roots = [r.location for r in listed.where("location IS NOT NULL").select("location").distinct().collect()]  # one per table
    if not roots:
        return listed.select(*scan.TABLE, F.lit(None).cast("double").alias("size_gb"))
    parts = F.split(_plain(F.col("path")), "/")
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    files = file_listing(spark, *roots, names="*").select("length", F.explode(above).alias("_place"))
    found = files.join(places, "_place").groupBy(*scan.TABLE).agg((F.sum("length") / F.lit(float(1 << 30))).alias("size_gb"))
    return listed.select(*scan.TABLE).join(found, list(scan.TABLE), "left")


def _plain(path):
    """A path without its scheme and the slashes after it."""
    return F.rtrim(F.regexp_replace(path, "^[A-Za-z0-9]+:/*", "/"), F.lit("/"))


def run_scan_job(
    spark: SparkSession,
    templates: Sequence[scan.Template],
    configs: ConfigStore,
    scan_run_id: str,
    force: bool = False,
    workspace_id: str | None = None,
) -> dict[str, int]:
    """Scan the schemas of the templates in the session's catalogue; the counters of the scan.

    Order: list, match and write the matches; append the staging rows; publish the configuration; append the log.
    Without templates nothing is touched.
    """
    check_name(scan_run_id)
    frame = scan.templates_frame(spark, templates)
    if not templates:
        return scan.summary(_no_log(spark)).first().asDict()
    listed = catalogue(spark, [(t.source_catalog, t.source_schema) for t in templates])
    columns = listed.select(*scan.TABLE, F.posexplode_outer("columns").alias("_pos", "column_name"))
    columns = columns.select(*scan.TABLE, F.coalesce("column_name", F.lit("")).alias("column_name"), (F.coalesce("_pos", F.lit(0)) + 1).alias("ordinal"))
    kept = f"{configs.base}/scans/{scan_run_id}"
    made = scan.propose(scan.match_columns(columns, frame), catalogue_sizes(spark, listed), frame)
    made.write.parquet(kept)
    proposed = spark.read.schema(made.schema).parquet(kept)
    staged = scan.staging(proposed, scan_run_id).withColumn("scan_timestamp", F.current_timestamp())
    append_batch(staged, f"{configs.base}/table_configs_staging")
    existing = configs.config()
    merged = scan.merge(existing, staged, scan_run_id, force, changed_at=F.current_timestamp())
    log = scan.log_rows(listed.select(*scan.TABLE), proposed, existing, scan_run_id, force, workspace_id)
    configs.publish(scan.deactivate(merged, staged, frame, scan_run_id), scan_run_id)
    batch = f"{configs.base}/scanner_log/{scan_run_id}"
    log.write.parquet(batch)
    return scan.summary(spark.read.schema(log.schema).parquet(batch)).first().asDict()


def _no_log(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [], "match_status STRING, is_active BOOLEAN, size_check_passed BOOLEAN, table_size_gb DOUBLE, merge_action STRING"
    )
