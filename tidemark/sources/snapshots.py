"""Source snapshots: the table as it is read, minus what deletes took out of it.

Parquet tables have no DELETE. A delete writes two small tables into a directory of its own: the
files it touched (``files``), and the rows of these files that stay (``rows``). A snapshot is the
table and the list of such directories: rows of touched files are left out, and the rewritten ones
are read instead. Files without a doomed row are read as before, partition columns
included. File names stay in tables; only directory names, one per delete, reach the driver.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions import digest, evolution

FILE = "_source_file"
DOOMED = "_doomed"
_FILES_DDL = "file STRING, n BIGINT, d BIGINT"
_DOOMED_DDL = "file STRING, slice_year INT, d BIGINT, sum_a DECIMAL(38,0), sum_b DECIMAL(38,0)"
MAX_BROADCAST_BYTES = 32 << 20  # of written tables of file names, compressed


@dataclass(frozen=True)
class Snapshot:
    """``rows`` as its own format reads it, and the directories of the deletes since, oldest first."""

    rows: DataFrame
    deletes: tuple[str, ...] = ()

    @property
    def schema(self) -> T.StructType:
        return self.rows.schema

    def read(self, spark: SparkSession | None = None) -> DataFrame:
        """The rows that are left."""
        return self.with_files().drop(FILE) if self.deletes else self.rows

    def with_files(self) -> DataFrame:
        """The same with the file each row stands in."""
        spark = self.rows.sparkSession
        names = [F.col(f"`{c}`") for c in self.schema.names]

        def located(df: DataFrame) -> DataFrame:
            return df.select(*names, F.col("_metadata.file_path").alias(FILE))

        out = located(self.rows)
        if not self.deletes:
            return out
        for d in self.deletes:
            out = out.unionByName(located(spark.read.schema(self.schema).parquet(f"{d}/rows")))
        gone = [f"{d}/files" for d in self.deletes]
        return _near(out, spark.read.schema(_FILES_DDL).parquet(*gone), "left_anti", *gone)

    def after(self, directory: str) -> "Snapshot":
        return replace(self, deletes=(*self.deletes, directory))


def _few(spark: SparkSession, paths: list[str]) -> bool:
    """Whether the tables of file names at these paths are small enough together to be broadcast."""
    size = 0
    for path in paths:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
        size += fs.getContentSummary(where).getLength()
    return size <= MAX_BROADCAST_BYTES


def _near(rows: DataFrame, files: DataFrame, how: str, *paths: str) -> DataFrame:
    """``rows`` in (left_semi) or outside (left_anti) the named ``files``: by a hash of the name and the name itself."""
    names = files.select(F.xxhash64("file").alias("_hash"), F.col("file").alias("_name")).distinct()
    names = F.broadcast(names) if _few(files.sparkSession, list(paths)) else names
    return rows.join(names, (F.xxhash64(FILE) == F.col("_hash")) & (F.col(FILE) == F.col("_name")), how)


def touched_rows(old: Snapshot) -> DataFrame:
    """Rows of the table itself, with their file, in the files that the deletes touched."""
    located = Snapshot(old.rows).with_files()
    gone = [f"{d}/files" for d in old.deletes]
    return _near(located, old.rows.sparkSession.read.schema(_FILES_DDL).parquet(*gone), "left_semi", *gone)


def doom(
    old: Snapshot, inside: Column, mark: Callable[[DataFrame], DataFrame], shape: T.StructType, path: str
) -> DataFrame:
    """Write what a delete would take: (file, slice_year, d, sum_a, sum_b), one row per file and year.

    ``inside`` bounds the doomed rows by raw columns, so that it reaches the reader: only rows inside are
    marked. ``mark`` adds ``slice_year`` and a boolean ``_doomed`` to the rows it is given; NULL keeps a row. The sums are
    content sums of the doomed rows as ``shape``, from the same scan.
    """
    if old.rows._jdf.queryExecution().optimizedPlan().children().nonEmpty():
        raise ValueError("delete refused: the source rows must be a plain read of a table, without filter or projection")
    doomed = mark(old.with_files().where(inside)).where(F.coalesce(F.col(DOOMED), F.lit(False)))
    extra = [T.StructField(FILE, T.StringType()), T.StructField("slice_year", T.IntegerType())]
    shaped = evolution.conform(doomed, T.StructType(shape.fields + extra))
    first, second = digest.content_sums(shaped, shape.names)
    shaped.groupBy(F.col(FILE).alias("file"), "slice_year").agg(
        F.count(F.lit(1)).alias("d"), first.alias("sum_a"), second.alias("sum_b")
    ).write.parquet(f"{path}/doomed")
    return old.rows.sparkSession.read.schema(_DOOMED_DDL).parquet(f"{path}/doomed")


def without(
    old: Snapshot, doomed: DataFrame, mark: Callable[[DataFrame], DataFrame], path: str, expected: int | None = None
) -> Snapshot:
    """``old`` minus the rows that ``mark`` dooms in the files of ``doomed``; nothing old is changed.

    Files are counted by a scan without data columns, and only those that keep a row are rewritten. With
    ``expected``, any other number of doomed rows is refused.
    """
    spark = old.rows.sparkSession
    hit = doomed.groupBy("file").agg(F.sum("d").alias("d"))
    located = old.with_files()
    total = _near(located, hit, "left_semi", f"{path}/doomed").groupBy(F.col(FILE).alias("file")).agg(F.count(F.lit(1)).alias("n"))
    total.join(hit, "file").select("file", "n", "d").write.parquet(f"{path}/files")
    touched = spark.read.schema(_FILES_DDL).parquet(f"{path}/files")
    count = touched.agg(F.coalesce(F.sum("d"), F.lit(0))).first()[0]
    if expected is not None and count != expected:
        raise ValueError(f"delete refused: {expected} rows were archived, {count} would be removed")
    if not count:
        return old
    left = mark(_near(located, touched.where("d < n"), "left_semi", f"{path}/files"))
    kept = left.where(~F.coalesce(F.col(DOOMED), F.lit(False)))
    kept.select(*[F.col(f"`{c}`") for c in old.schema.names]).write.parquet(f"{path}/rows")
    return old.after(path)
