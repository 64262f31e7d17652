"""Session helpers: where scratch tables go, and the settings the jobs rely on."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, DataFrameReader, SparkSession, types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Adaptive execution sizes shuffles, splits hot join keys and hot years at run time.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def workspace(spark: SparkSession, label: str = "run") -> str:
    """A fresh directory that every executor can reach.

    The cluster names its shared folder in ``spark.checkpoint.dir``. A machine-local
    folder is used only by a local master. Either goes away with the driver.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        path = f"{shared.rstrip('/')}/tidemark-{label}-{uuid.uuid4().hex}"
        atexit.register(_remove, spark, path)
        return path
    if not spark.conf.get("spark.master", "local").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix=f"tidemark-{label}-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def _remove(spark: SparkSession, path: str) -> None:
    """Remove a shared workspace when the driver ends, if its session still lives."""
    try:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(where, True)
    except Exception:  # the JVM may be gone already
        return


def footer_reader(spark: SparkSession) -> DataFrameReader:
    """A reader whose COUNT, MIN and MAX per partition directory come from Parquet footers; no row is decoded.

    Spark does this only for exactly all partition columns as grouping columns and without other filters, and it takes
    the footer's MIN or MAX *by position*: the schema must name all columns of the files in their own order, none of
    them nested. COUNT needs no columns at all.
    """
    reader = spark.newSession()
    reader.conf.set("spark.sql.sources.useV1SourceList", "")
    reader.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    for name in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone"):
        reader.conf.set(name, spark.conf.get(name))
    return reader.read


def local_frame(spark: SparkSession, rows: list, schema: str | T.StructType) -> DataFrame:
    """A few driver rows (tuples in schema order) as a local relation, which costs no job."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    if not rows:
        return spark.createDataFrame([], schema)
    columns = list(zip(*rows))
    arrow = to_arrow_schema(schema)
    table = pa.Table.from_arrays(
        [pa.array(values, type=f.type) for values, f in zip(columns, arrow)], schema=arrow
    )
    return spark.createDataFrame(table, schema)
