"""Year slices: plain Parquet directories plus one Parquet table of slice versions.

Rows live in ``{base}/data/{table}/run={run}/slice_year={year}/``; a run writes all its
years in one job. The versions table says which directories make up a slice at each
version. A version row names only the directories it adds and the version its chain of appends begins
with; a slice's directories are those of its chain up to the version. A rollback, a wipe and a compaction begin
a chain of their own. Nothing already published is rewritten, and a directory that no version names
is invisible.
"""

from __future__ import annotations

import datetime as dt
import re
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession, functions as F, types as T

from ..functions import digest, evolution, watermarks as W
from ..schemas import MANIFEST_DDL, ddl
from ..session import footer_reader, local_frame
from .snapshots import Snapshot
from .tables import append_batch, file_listing, found, read_or_empty

_DELETES_DDL = "table_id STRING, run_id STRING, dir STRING, deleted_at TIMESTAMP"
_PUBLICATIONS_DDL = (
    "table_id STRING, run_id STRING, name STRING, spec STRING, old STRING, new STRING, folded ARRAY<STRING>, "
    "state STRING, noted_at TIMESTAMP"
)
VALID, MISSING, ORPHAN = "VALID", "MISSING", "ORPHAN"

_SLICE_FILE = r"(.*/data/([^/]+)/run=([^/]+)/slice_year=(-?\d+))/[^/]+$"
_UNSAFE = re.compile(r"[/\\\[\]{}*?^,:%=#\x00-\x1f]|^[._]|^$")


def safe_name(name: str) -> bool:
    return not _UNSAFE.search(name)


def check_name(*names: str) -> None:
    """Refuse table and run ids that could not be a directory name or would act as a pattern."""
    for name in names:
        if not safe_name(name):
            raise ValueError(f"{name!r} cannot name a table or run: it holds a sign that paths or patterns use")


@dataclass(frozen=True)
class SliceStore:
    spark: SparkSession
    base: str

    # -- locations ---------------------------------------------------------------
    @property
    def versions_path(self) -> str:
        return f"{self.base}/versions"

    def table_dir(self, table_id: str) -> str:
        return f"{self.base}/data/{table_id}"

    def run_dir(self, table_id: str, run_id: str) -> str:
        return f"{self.table_dir(table_id)}/run={run_id}"

    def slice_dir(self, table_id: str, run_id: str, year: int) -> str:
        return f"{self.run_dir(table_id, run_id)}/slice_year={year}"

    # -- rows --------------------------------------------------------------------
    def write_rows(self, rows: DataFrame, table_id: str, run_id: str) -> str:
        """Write every year of a run in one job; ``rows`` carries ``slice_year``.

        The rebalance hint lets adaptive execution cut a hot year into advisory-size files
        and pack small years together. Partitioning is by column value, so a task retried
        after a lost executor produces the same rows again.
        """
        path = self.fresh(self.run_dir(table_id, run_id))
        self._save(rows.hint("rebalance", "slice_year"), path)
        return path

    def write_checked(
        self, rows: DataFrame, table_id: str, run_id: str, years: list[int]
    ) -> tuple[str, dict[int, tuple[int, tuple]]]:
        """``write_rows``, and per year the count and content sums of the rows that went into the write.

        They are observed by the writing tasks themselves, above the last exchange, so that a task repeated
        after a lost executor counts once. A metric or two per calendar year of one table.
        """
        path = self.fresh(self.run_dir(table_id, run_id))
        names = [c for c in rows.columns if c != "slice_year"]
        hashes = [h.cast("decimal(28,0)") for h in digest.row_hashes(rows, names)]
        metrics = []
        for y in years:
            own = F.col("slice_year") == y
            metrics.append(F.count_if(own).alias(f"n {y}"))
            metrics += [F.sum(F.when(own, h)).alias(f"{k} {y}") for k, h in zip("ab", hashes)]
        seen = Observation(f"write {table_id} {run_id}")
        self._save(rows.hint("rebalance", "slice_year").observe(seen, *metrics), path)
        found = seen.get
        return path, {y: (found[f"n {y}"], (found[f"a {y}"], found[f"b {y}"])) for y in years}

    def _save(self, rows: DataFrame, path: str) -> None:
        rows.write.partitionBy("slice_year").parquet(path)

    def fresh(self, path: str) -> str:
        """``path``, or with an attempt number if an earlier attempt of the run left it behind."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path
        fs = hadoop(path).getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
        attempt, found = 1, path
        while fs.exists(hadoop(found)):
            attempt += 1
            found = f"{path}.attempt-{attempt}"
        return found

    def written(self, path: str, schema: T.StructType, watermark: str, content: bool = False) -> DataFrame:
        """Per-year count and watermark window of what a run really wrote; ``content`` adds the content sums.

        Without ``content`` the answer comes from the footers where these can give it, else from the watermark column.
        """
        if not content:
            found = self._window_of_footers(path, watermark)
            if found is not None:
                return found
        rows = self.spark.read.schema(_with_year(schema)).parquet(path)
        watermark = W.instant(rows, watermark)
        sums = digest.content_sums(rows, schema.names) if content else ()
        return rows.groupBy("slice_year").agg(
            F.count(F.lit(1)).alias("row_count"),
            F.min(watermark).alias("wm_lo"),
            F.max(watermark).alias("wm_hi"),
            *[s.alias(name) for s, name in zip(sums, ("sum_a", "sum_b"))],
        )

    def _window_of_footers(self, path: str, watermark: str) -> DataFrame | None:
        """``written`` by aggregates pushed into the reader; None if the files' columns do not allow it.

        The files of a run come from one write, so the first footer names the columns of all. TIMESTAMP_NTZ is stored
        as microseconds; its extremes are pushed as integers.
        """
        try:
            stored = self.spark.read.parquet(path).schema
        except AnalysisException:  # the run wrote no file
            return None
        files = T.StructType([f for f in stored if f.name != "slice_year"])
        if watermark not in files.names or any(isinstance(f.dataType, _NESTED) for f in files):
            return None
        dtype = files[watermark].dataType
        if isinstance(dtype, T.TimestampNTZType):
            files = T.StructType([T.StructField(f.name, T.LongType()) if f.name == watermark else f for f in files])
            instant = "timestampadd(MICROSECOND, {}, TIMESTAMP_NTZ '1970-01-01 00:00:00')"
        elif isinstance(dtype, T.DateType):
            instant = "CAST({} AS TIMESTAMP_NTZ)"
        else:
            return None
        rows = footer_reader(self.spark).schema(_with_year(files)).parquet(path)
        wm = W.col(watermark)
        found = rows.groupBy("slice_year").agg(
            F.count("*").alias("row_count"), F.min(wm).alias("_lo"), F.max(wm).alias("_hi")
        )
        return found.select(
            "slice_year", "row_count", *[F.expr(instant.format(c)).alias(n) for c, n in (("_lo", "wm_lo"), ("_hi", "wm_hi"))]
        )

    def read(
        self, table_id: str, years: list[int] | None = None, version: int | None = None
    ) -> DataFrame:
        """Rows of the table's slices with ``slice_year``; newest version unless given.

        Directory names are metadata: years times appends of one table.
        """
        current = self.at(version) if version is not None else self.latest()
        wanted = current.where(F.col("table_id") == table_id)
        if years is not None:
            wanted = wanted.where(F.col("year").isin([int(y) for y in years]))
        found = wanted.select("schema_ddl", "live_dirs").collect()
        if not any(r.schema_ddl for r in found):
            raise LookupError(f"no slice of {table_id} for years {years}")
        return self.rows_of(table_id, found)

    def rows_of(self, table_id: str, versions: list[Row]) -> DataFrame:
        """Rows of given version rows (schema_ddl, live_dirs) of one table."""
        schema = evolution.common([ddl(r.schema_ddl) for r in versions if r.schema_ddl])
        return self.rows_in(table_id, schema, [d for r in versions for d in r.live_dirs])

    def rows_in(self, table_id: str, schema: T.StructType, dirs: list[str]) -> DataFrame:
        """Rows of directories of one table, with ``slice_year``."""
        with_year = _with_year(schema)
        if not dirs:
            return self.spark.createDataFrame([], with_year)
        return (
            self.spark.read.schema(with_year)
            .option("basePath", self.table_dir(table_id))
            .parquet(*dirs)
            .select(*[F.col(f"`{n}`") for n in with_year.names])
        )

    def counts(self, table_id: str, years: list[int] | None = None) -> DataFrame:
        """Rows per slice as the footers of its live files say; files may differ in their columns."""
        wanted = self.latest().where(F.col("table_id") == table_id)
        if years is not None:
            wanted = wanted.where(F.col("year").isin([int(y) for y in years]))
        found = wanted.select("schema_ddl", "live_dirs").collect()
        if not any(r.schema_ddl for r in found):
            raise LookupError(f"no slice of {table_id} for years {years}")
        dirs = [d for r in found for d in r.live_dirs]
        if not dirs:
            return self.spark.createDataFrame([], "slice_year INT, row_count BIGINT")
        rows = footer_reader(self.spark).schema("slice_year INT").option("basePath", self.table_dir(table_id)).parquet(*dirs)
        per_run = rows.groupBy("run", "slice_year").agg(F.count("*").alias("n"))  # all partition columns: pushed
        return per_run.groupBy("slice_year").agg(F.sum("n").alias("row_count"))

    def high_water(self, table_id: str, watermark: str) -> DataFrame:
        """Highest archived watermark per slice, at full precision."""
        return self.read(table_id).groupBy("slice_year").agg(F.max(watermark).alias("high_water"))

    def content(self, rows: DataFrame, names: list[str]) -> DataFrame:
        """Count and content sums of rows per ``slice_year``."""
        sums = [s.alias(k) for s, k in zip(digest.content_sums(rows, names), ("sum_a", "sum_b"))]
        return rows.groupBy("slice_year").agg(F.count(F.lit(1)).alias("row_count"), *sums)

    def fingerprints(self, table_id: str) -> DataFrame:
        rows = self.read(table_id)
        names = [c for c in rows.columns if c != "slice_year"]
        return rows.groupBy("slice_year").agg(
            F.count(F.lit(1)).alias("row_count"), digest.content_digest(rows, names).alias("digest")
        )

    # -- deletes from sources -----------------------------------------------------
    def publish_delete(self, table_id: str, run_id: str, directory: str) -> None:
        """Remember that a delete left the source of a table at ``directory``."""
        row = [(table_id, run_id, directory, dt.datetime.now(dt.timezone.utc))]
        append_batch(local_frame(self.spark, row, _DELETES_DDL).coalesce(1), f"{self.base}/source_deletes")

    def source_snapshot(self, table_id: str, rows: DataFrame) -> Snapshot:
        """The source ``rows`` without what this store's deletes took out of it; one row per delete is read.

        Deletes that a publication has folded into the table are left out. Raises while one is unfinished.
        """
        deletes = read_or_empty(self.spark, f"{self.base}/source_deletes", _DELETES_DDL)
        done = [r.dir for r in deletes.where(F.col("table_id") == table_id).orderBy("deleted_at").select("dir").collect()]
        if done:
            folds = self.publications(table_id).groupBy("run_id", "folded").agg(
                F.count_if(F.col("state") == "PREPARED").alias("prepared"), F.count_if(F.col("state") == "DONE").alias("done")
            ).collect()
            unfinished = [r.run_id for r in folds if r.done < r.prepared]
            if unfinished:
                raise RuntimeError(f"publication {unfinished[0]} of {table_id} is unfinished: call finish first")
            folded = {d for r in folds for d in r.folded}
            done = [d for d in done if d not in folded]
        return Snapshot(rows, tuple(done))

    def publications(self, table_id: str | None = None) -> DataFrame:
        """What publications of sources switched, one row per step and location."""
        noted = read_or_empty(self.spark, f"{self.base}/source_publications", _PUBLICATIONS_DDL)
        return noted if table_id is None else noted.where(F.col("table_id") == table_id)

    def note_publication(self, rows: list[tuple]) -> None:
        """(table_id, run_id, name, spec, old, new, folded, state) of some switches."""
        if rows:
            now = dt.datetime.now(dt.timezone.utc)
            frame = local_frame(self.spark, [(*r, now) for r in rows], _PUBLICATIONS_DDL)
            append_batch(frame.coalesce(1), f"{self.base}/source_publications")

    # -- versions ----------------------------------------------------------------
    def versions(self) -> DataFrame:
        return read_or_empty(self.spark, self.versions_path, MANIFEST_DDL)

    def publish(self, rows: list[dict]) -> None:
        """Append version rows (at most tables x years of one run) as one file; without ``chain`` one begins."""
        if not rows:
            return
        names = ddl(MANIFEST_DDL).names
        now = dt.datetime.now(dt.timezone.utc)
        data = [tuple({"committed_at": now, "chain": r["version"], **r}.get(n) for n in names) for r in rows]
        frame = local_frame(self.spark, data, MANIFEST_DDL).withColumn("committed_by", F.current_user())
        append_batch(frame.coalesce(1), self.versions_path)

    def latest(self) -> DataFrame:
        return _newest(self.versions())

    def at(self, version: int) -> DataFrame:
        """The slices that have this version, as they were then."""
        return _newest(self.versions().where(F.col("version") <= version)).where(F.col("version") == version)

    def resolved(self, wanted: DataFrame) -> DataFrame:
        """The given versions (table_id, year, version), one per slice, with ``live_dirs``."""
        upto = wanted.select("table_id", "year", F.col("version").alias("_upto"))
        known = self.versions().join(upto, ["table_id", "year"]).where("version <= _upto").drop("_upto")
        return _newest(known).join(wanted, ["table_id", "year", "version"], "left_semi")

    def history(self) -> DataFrame:
        """Latest version and the ascending list of versions per slice."""
        return (
            self.versions()
            .groupBy("table_id", "year")
            .agg(
                F.max("version").alias("latest_version"),
                F.sort_array(F.collect_set("version")).alias("versions"),
            )
        )

    def directories(self, table_ids: list[str] | None = None) -> DataFrame:
        """Slice directories that hold files: (table_id, run_id, year, dir).

        Spark's file index lists the tables asked for; paths are reduced to directories in Spark, and
        nothing is read or collected.
        """
        if table_ids is not None and not table_ids:
            return self.spark.createDataFrame([], "table_id STRING, run_id STRING, year INT, dir STRING")
        which = "{" + ",".join(table_ids) + "}" if table_ids else "*"
        part = lambda i: F.regexp_extract("path", _SLICE_FILE, i)
        root = f"{self.base}/data/{which}"
        if not found(self.spark, root):
            return self.spark.createDataFrame([], "table_id STRING, run_id STRING, year INT, dir STRING")
        listed = file_listing(self.spark, root)
        return (
            listed.where(part(1) != "")
            .select(part(2).alias("table_id"), part(3).alias("run_id"), part(4).cast("int").alias("year"))
            .distinct()
            .withColumn(
                "dir",
                F.concat(F.lit(f"{self.base}/data/"), "table_id", F.lit("/run="), "run_id", F.lit("/slice_year="), F.col("year").cast("string")),
            )
        )

    def states(self, table_ids: list[str] | None = None) -> DataFrame:
        """Every known slice (of the given tables) with its state and newest version.

        VALID: a version row whose directories all exist. MISSING: a version row with a
        directory gone. ORPHAN: files on disk under no version row at all. Version rows and
        directories meet in one aggregation; a slice has a handful of either per run.
        """
        row = F.struct("version", "chain", "row_count", "wm_lo", "wm_hi", "schema_ddl")
        versions = self.versions()
        if table_ids is not None:
            versions = versions.where(F.col("table_id").isin(table_ids))
        versions = versions.select("table_id", "year", row.alias("row"), _part().alias("part"), F.lit(None).cast("string").alias("dir"))
        on_disk = self.directories(table_ids).select("table_id", "year", F.lit(None).alias("row"), F.lit(None).alias("part"), "dir")
        known = F.col("row").isNotNull()
        gone = known & (F.size(F.array_except("live_dirs", "dirs")) > 0)
        return (
            versions.union(on_disk)
            .groupBy("table_id", "year")
            .agg(F.max_by("row", "row.version").alias("row"), F.collect_list("part").alias("parts"), F.collect_set("dir").alias("dirs"))
            .withColumn("live_dirs", _chained("row"))
            .select(
                "table_id",
                "year",
                F.when(gone, MISSING).when(known, VALID).otherwise(ORPHAN).alias("slice_state"),
                F.when(known & ~gone, F.col("row.row_count")).otherwise(F.lit(0)).alias("row_count"),
                "row.version",
                "row.chain",
                "live_dirs",
                "row.wm_lo",
                "row.wm_hi",
                "row.schema_ddl",
            )
        )

    def manifest(self) -> DataFrame:
        """Every version with the slice metadata as one JSON document."""
        v = self.versions()
        return v.select(
            "table_id",
            F.col("year").alias("slice_year"),
            "version",
            "op",
            "row_count",
            "rows_this_run",
            "wm_lo",
            "wm_hi",
            F.to_json(
                F.struct(
                    F.col("rows_this_run").alias("record_count"),
                    F.col("conditions").alias("conditions_applied"),
                    "mode",
                    F.col("wm_hi").alias("watermark_value"),
                    "source_year_count",
                    "retention_years",
                    F.col("table_id").alias("source_table"),
                    F.col("run_id").alias("archive_run_id"),
                    F.col("committed_by").alias("archived_by"),
                    F.col("committed_at").alias("archived_at"),
                )
            ).alias("metadata"),
        )

    def recoverable(self, table_ids: list[str] | None = None) -> DataFrame:
        """Versions whose directories all still exist: the ones a rollback can reach."""
        v = self.versions().select("table_id", "year", "version", "chain", "dirs")
        if table_ids is not None:
            v = v.where(F.col("table_id").isin(table_ids))
        # a lost directory takes all later versions of its chain along
        gone = (
            v.select("table_id", "year", "version", "chain", F.explode("dirs").alias("dir"))
            .join(self.directories(table_ids).select("dir"), "dir", "left_anti")
            .groupBy("table_id", "year", "chain")
            .agg(F.min("version").alias("_gone"))
        )
        return v.join(gone, ["table_id", "year", "chain"], "left").where("_gone IS NULL OR version < _gone").select(
            "table_id", "year", "version"
        )


_NESTED = (T.ArrayType, T.MapType, T.StructType, T.VariantType)


def _with_year(schema: T.StructType) -> T.StructType:
    return T.StructType(schema.fields + [T.StructField("slice_year", T.IntegerType())])


def _newest(versions: DataFrame) -> DataFrame:
    """Newest version row per slice with ``live_dirs``, by mergeable aggregates, not a window.

    The directories come from the rows of the newest row's chain: one small struct per version of a slice.
    """
    rest = [c for c in versions.columns if c not in ("table_id", "year")]
    ordered = ["version"] + [c for c in rest if c != "version"]
    return (
        versions.groupBy("table_id", "year")
        .agg(F.max_by(F.struct(*ordered), F.col("version")).alias("row"), F.collect_list(_part()).alias("parts"))
        .select("table_id", "year", "row.*", _chained("row").alias("live_dirs"))
        .select(*versions.columns, "live_dirs")
    )


def _part() -> Column:
    return F.struct("version", "chain", "dirs")


def _chained(row: str) -> Column:
    """Directories of ``parts`` in the chain of ``row``, oldest first."""
    own = F.filter("parts", lambda p: (p["chain"] == F.col(f"{row}.chain")) & (p["version"] <= F.col(f"{row}.version")))
    return F.flatten(F.transform(F.array_sort(own), lambda p: p["dirs"]))
