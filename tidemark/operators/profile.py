"""One-pass profile of a source: every per-year count a run needs, from a single scan.

Counts per year, per rule, above the high-water mark and of NULL watermarks are all
conditional aggregates of one ``groupBy(year)``. Partial aggregation leaves one small row
per task and year to shuffle, so a hot year costs nothing extra.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions import rules as R, watermarks as W
from ..session import local_frame
from ..sources.tables import Source, qualified


def eligible_years(source: Source, as_of: dt.date) -> DataFrame:
    """Distinct years at or before the retention boundary, ascending."""
    return (
        source.rows.where(source.in_years(None, source.last_eligible_year(as_of)))
        .select(F.lit(source.table_id).alias("table_id"), source.year().alias("slice_year"))
        .distinct()
        .orderBy("slice_year")
    )


def eligible_years_of(sources: list[Source], as_of: dt.date) -> DataFrame:
    """``eligible_years`` of many tables that stand in Parquet files under the same watermark column, by one scan.

    Each file gives one row per year; which tables it belongs to is found from the folders above it, so the plan
    does not grow with the number of tables. The boundary pushed is the latest of the tables'; each table's own comes after.
    """
    spark, first = sources[0].rows.sparkSession, sources[0]
    known = local_frame(
        spark,
        [(qualified(spark, s.location), s.table_id, s.last_eligible_year(as_of)) for s in sources],
        "_folder STRING, table_id STRING, last_eligible_year INT",
    )
    dtype = W.type_of(first.rows, first.watermark)
    shape = T.StructType([T.StructField(first.watermark, dtype)])
    places = sorted({s.location for s in sources})
    rows = spark.read.schema(shape).option("recursiveFileLookup", "true").parquet(*places)
    latest = max(s.last_eligible_year(as_of) for s in sources)
    file = F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "file:/")
    per_file = (
        rows.where(first.in_years(None, latest)).select(file.alias("_file"), first.year().alias("slice_year")).distinct()
    )
    parts = F.split("_file", "/")
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))
    return (
        per_file.select("slice_year", F.explode(above).alias("_folder"))
        .join(known, "_folder")
        .where("slice_year <= last_eligible_year")
        .select("table_id", "slice_year", "last_eligible_year")
        .distinct()
    )


def _scope(source: Source, as_of: dt.date, eligible_only: bool, years: list[int] | None) -> DataFrame:
    if years is not None:
        runs = [source.in_years(a, b) for a, b in W.year_runs(int(y) for y in years)]
        return source.rows.where(reduce(or_, runs, F.lit(False)))
    if not eligible_only:
        return source.rows
    # both branches reach the Parquet reader
    return source.rows.where(
        source.in_years(None, source.last_eligible_year(as_of)) | F.col(f"`{source.watermark}`").isNull()
    )


def year_profile(
    source: Source,
    as_of: dt.date,
    marks: DataFrame | None = None,
    eligible_only: bool = True,
    years: list[int] | None = None,
) -> DataFrame:
    """Per year: total, kept, new and per-rule rows, and the window of the kept watermarks.

    ``marks`` is (slice_year, high_water), one row per calendar year, hence broadcast. The
    row with a NULL year counts the rows that have no watermark. With ``years``, only these are read.
    """
    rows = source.flagged(as_of, _scope(source, as_of, eligible_only, years))
    rows = rows.withColumn("_wm", source.instant())
    above: Column = F.lit(False)
    if marks is not None:
        rows = rows.join(F.broadcast(marks.select("slice_year", "high_water")), "slice_year", "left")
        above = F.col("_wm") > F.col("high_water")
    keep = F.col(R.KEEP)
    dated = F.col("slice_year").isNotNull()
    per_rule = [
        item
        for i, rule in enumerate(source.rule_list)
        for item in (F.lit(rule.name), F.count_if(F.col(R.flag_name(i))))
    ]
    protected = (
        F.create_map(*per_rule) if per_rule else F.create_map().cast("map<string,bigint>")
    )
    return (
        rows.groupBy("slice_year")
        .agg(
            F.count(F.lit(1)).alias("total_rows"),
            F.count_if(keep & dated).alias("kept_rows"),
            F.count_if(keep & above).alias("new_rows"),
            F.min(F.when(keep, F.col("_wm"))).alias("wm_lo"),
            F.max(F.when(keep, F.col("_wm"))).alias("wm_hi"),
            protected.alias("protected"),
        )
        .select(F.lit(source.table_id).alias("table_id"), "*")
    )


def null_watermarks(source: Source) -> DataFrame:
    """Rows without a date; they are never archived. Counted per table, not per year."""
    return source.rows.agg(
        F.count_if(F.col(f"`{source.watermark}`").isNull()).alias("null_rows")
    ).select(F.lit(source.table_id).alias("table_id"), "null_rows")


def condition_breakdown(profile: DataFrame) -> DataFrame:
    """Long form of the per-rule counts."""
    return profile.where("slice_year IS NOT NULL").select(
        "table_id", "slice_year", F.explode("protected").alias("condition_name", "rows_protected")
    )


def append_candidates(source: Source, as_of: dt.date, marks: DataFrame) -> DataFrame:
    """Rows above each slice's high-water mark that the rules let through."""
    return (
        year_profile(source, as_of, marks)
        .join(F.broadcast(marks), "slice_year")
        .select("table_id", "slice_year", "high_water", "new_rows")
    )
