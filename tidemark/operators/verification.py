"""Is what the slices hold what the source would archive? Counts and content, year by year."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F, types as T

from ..functions import digest, evolution, rules as R
from ..functions.skew import unique_lookup
from ..sources.slices import SliceStore
from ..sources.tables import Source


def verify(source: Source, store: SliceStore, as_of: dt.date) -> DataFrame:
    """slice_year, row_count (slice), source_rows and content_equal for every year that either side knows.

    The source side is all eligible years, minus protected rows. A year that only one side has is not
    equal. One scan of each side, one row per year and task shuffled.
    """
    names = [c for c in source.rows.columns]
    eligible = source.rows.where(source.in_years(None, source.last_eligible_year(as_of)))
    wanted = (
        source.flagged(as_of, eligible).where(F.col(R.KEEP)).groupBy("slice_year")
        .agg(F.count(F.lit(1)).alias("source_rows"), digest.content_digest(source.rows, names).alias("source_digest"))
    )
    try:
        held = store.fingerprints(source.table_id)
    except LookupError:
        held = store.spark.createDataFrame([], "slice_year INT, row_count BIGINT, digest DECIMAL(38,0)")
    return held.join(wanted, "slice_year", "full_outer").select(
        "slice_year",
        "row_count",
        "source_rows",
        F.coalesce(F.col("digest") == F.col("source_digest"), F.lit(False)).alias("content_equal"),
    )


def shape_of(source: T.StructType, slices: list[T.StructType]) -> T.StructType:
    """The columns of the source, each at the widest type that it or a slice has: what both sides are compared by.

    A column that a slice does not have counts as NULL there, so a row with a value in it is not archived.
    """
    widest = {f.name: f for f in evolution.common([source, *slices])}
    return T.StructType([widest[f.name] for f in source])


def not_archived(rows: DataFrame, archived: DataFrame) -> DataFrame:
    """``rows`` that ``archived`` does not hold, as multisets per ``slice_year``, with the number of ``copies`` lacking.

    Both have the same columns. Two row hashes are counted on both sides first, combined before the shuffle, so that
    copies of one row do not pile up; only rows whose hashes are in surplus are then compared by their columns.
    """
    names = [c for c in rows.columns if c != "slice_year"]
    key = ["slice_year", "_h1", "_h2"]

    def hashed(side: DataFrame, n: int) -> DataFrame:
        first, second = digest.row_hashes(side, names)
        values = F.to_json(F.struct(*[F.col(f"`{c}`") for c in names]), {"ignoreNullFields": "false"})
        return side.select("*", first.alias("_h1"), second.alias("_h2"), values.alias("_row"), F.lit(n).alias("_n"))

    have, held = hashed(rows, 1), hashed(archived, -1)
    counted = have.select(*key, "_n").unionByName(held.select(*key, "_n"))
    surplus = unique_lookup(counted, key, F.sum("_n").alias("_n")).where("_n > 0").drop("_n")
    columns = ["slice_year", "_row", "_n"]
    suspects = have.join(surplus, key, "left_semi").select(*columns).unionByName(held.join(surplus, key, "left_semi").select(*columns))
    return suspects.groupBy("slice_year", F.col("_row").alias("row")).agg(F.sum("_n").alias("copies")).where("copies > 0")
