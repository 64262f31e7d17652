"""Tables between the steps of one query, in the folder that all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.session import workspace

LAST = (1 << 63) - 1


_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write once and read back, so that a lost executor costs no recomputation.

    The shuffle files of the write are removed when it ends: nothing reads them again.
    """
    spark = df.sparkSession
    path = workspace(spark, label)
    before = spark.conf.get(_CLEAN, "false")
    spark.conf.set(_CLEAN, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEAN, before)
    return spark.read.schema(df.schema).parquet(path)


def keyed(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id, text and ``more`` only, with ``did``: the id, a null id as the largest."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("did"),
        F.col("text").cast("string").alias("text"),
        *more,
    )
