"""Source tables: what to archive, plus listings of tables, columns and sizes."""

from __future__ import annotations

import datetime as dt
import re
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import rules as R, watermarks as W
from .snapshots import Snapshot


_RESERVED = re.compile(r"(?i)^(slice_year|high_water|_keep|_wm|_doomed|_source_file|_hash|_h1|_h2|_n|_key_\d+|_verdict_\d+(_\d+)?|_protected_\d+)$")


@dataclass(frozen=True)
class Source:
    """One table under lifecycle management.

    ``rows`` should come from ``spark.read``: such a DataFrame keeps the file list it was
    created with, so profile, write, verification and delete of one run see one snapshot.
    """

    table_id: str
    rows: DataFrame
    watermark: str
    retention_years: int
    rules: tuple = ()
    timezone: str | None = None
    delete_after: bool = False
    catalog: str = ""
    schema: str = ""
    snapshot: Snapshot | None = None  # where ``rows`` come from, if deletes have been published
    location: str | None = None  # of the Parquet files, if ``rows`` are all of theirs and the watermark is in the files
    rule_list: tuple[R.Rule, ...] = field(init=False)

    def __post_init__(self):
        object.__setattr__(self, "rule_list", tuple(R.Rule.of(r) for r in self.rules))
        taken = [c for c in self.rows.columns if _RESERVED.match(c)]
        if taken:
            raise ValueError(f"{self.table_id}: column names {taken} are used by the jobs themselves")

    def last_eligible_year(self, as_of: dt.date) -> int:
        return as_of.year - self.retention_years

    def whole_location(self) -> str | None:
        """``location``, if ``rows`` are nothing but a read of it."""
        deleted = self.snapshot is not None and self.snapshot.deletes
        if self.location is None or deleted or self.rows._jdf.queryExecution().optimizedPlan().children().nonEmpty():
            return None
        return self.location

    def year(self) -> Column:
        return W.year_of(self.rows, self.watermark, self.timezone)

    def instant(self) -> Column:
        return W.instant(self.rows, self.watermark)

    def in_years(self, first: int | None, last: int) -> Column:
        return W.within_years(self.rows, self.watermark, first, last, self.timezone)

    def flagged(self, as_of: dt.date, rows: DataFrame | None = None) -> DataFrame:
        """``rows`` (default: all) with ``slice_year``, one flag per rule, and ``_keep``."""
        rows = self.rows if rows is None else rows
        return R.with_flags(rows, self.rule_list, as_of, self.catalog, self.schema).withColumn(
            "slice_year", self.year()
        )


def listing(tables: Mapping[str, DataFrame], spark: SparkSession) -> DataFrame:
    """(table_name, column_name, ordinal) of the given DataFrames, from their schemas only."""
    rows = [
        (name, f.name, i + 1) for name, df in tables.items() for i, f in enumerate(df.schema)
    ]
    return spark.createDataFrame(rows, "table_name STRING, column_name STRING, ordinal INT")


def catalog_listing(spark: SparkSession, database: str) -> DataFrame:
    """The same for every table of a catalog database; metadata calls only."""
    names = [t.name for t in spark.catalog.listTables(database)]
    return listing({n: spark.table(f"`{database}`.`{n}`") for n in names}, spark)


def location(spark: SparkSession, name: str, spec: str = "") -> str | None:
    """Where the catalogue says that a table, or one partition of it, stands."""
    about = [(r.col_name, r.data_type) for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name} {spec}").collect()]
    begin = next((i for i, (c, _) in enumerate(about) if c.startswith("# Detailed")), 0)  # columns come before
    return next((value for c, value in about[begin:] if c == "Location"), None)  # that of the partition before its table's


def parquet_location(spark: SparkSession, name: str, watermark: str) -> str | None:
    """Where a table of the catalogue stands, if it is Parquet and its watermark is a column of the files."""
    about = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    columns = spark.catalog.listColumns(name)
    in_files = any(c.name == watermark and not c.isPartition for c in columns)
    return location(spark, name) if in_files and (about.get("Provider") or "").lower() == "parquet" else None


def qualified(spark: SparkSession, path: str) -> str:
    """A path with its scheme and authority, spelled as ``_metadata.file_path`` spells the files below it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return plain_scheme(fs.makeQualified(where).toUri().toString())


def plain_scheme(path: str) -> str:
    return re.sub(r"^file:/+", "file:/", path)


def columns_of(tables: DataFrame, columns: str = "columns") -> DataFrame:
    """One row per column from a table listing that carries an ordered array of names."""
    keys = [c for c in tables.columns if c != columns]
    return tables.select(*keys, F.posexplode(columns).alias("_pos", "column_name")).select(
        *keys, "column_name", (F.col("_pos") + 1).alias("ordinal")
    )


def base_name(full_name: Column) -> Column:
    """Last segment of a dotted name."""
    return F.element_at(F.split(full_name, r"\."), -1)


def sizes(spark: SparkSession, root: str) -> DataFrame:
    """(table_name, size_gb) from file lengths below ``root``; contents are never read."""
    files = file_listing(spark, root)
    plain_root = re.sub(r"^[a-z0-9]+:/*", "/", root).rstrip("/")
    below = F.substring_index("path", plain_root + "/", -1)
    table = F.regexp_replace(F.element_at(F.split(below, "/"), 1), r"\.parquet$", "")
    return files.groupBy(table.alias("table_name")).agg(
        (F.sum("length") / F.lit(float(1024**3))).alias("size_gb")
    )


def file_listing(spark: SparkSession, *roots: str, names: str = "*.parquet") -> DataFrame:
    """(path, length) of the files called like ``names`` below some paths or patterns; contents are never read.

    Files of this format are packed into tasks by their length. The listing is planned in a session of its own, in which
    a task may take any length, so that their number is that of the cores, whatever the files hold.
    """
    lister = spark.newSession()
    lister.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 60))
    return (
        lister.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", names)
        .load(list(roots))
        .select("path", "length")
    )


def append_batch(rows: DataFrame, path: str) -> None:
    """Append to a log table as a directory of its own, so that runs can append at once.

    Two Spark jobs that append to one directory share its staging area and break each other.
    """
    rows.write.parquet(f"{path}/{uuid.uuid4().hex}")


def read_or_empty(spark: SparkSession, path: str, schema_ddl: str) -> DataFrame:
    """A log table that may not exist yet."""
    if not found(spark, path):
        return spark.createDataFrame([], schema_ddl)
    return spark.read.schema(schema_ddl).option("recursiveFileLookup", "true").parquet(path)


def found(spark: SparkSession, pattern: str) -> bool:
    """Whether a path, or any path of a pattern, exists."""
    where = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    fs = where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return bool(fs.globStatus(where))
