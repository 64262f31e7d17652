import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]
os.environ["PYTHONPATH"] = os.pathsep.join([str(ROOT), *filter(None, [os.environ.get("PYTHONPATH")])])  # for Spark's workers

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.maxMetadataStringLength", "2000")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def life(spark, tmp_path):
    """A slice store and an audit log in a fresh folder."""
    from tidemark import AuditLog, SliceStore

    return SliceStore(spark, str(tmp_path)), AuditLog(spark, str(tmp_path))


@pytest.fixture
def table(spark, tmp_path):
    """Write rows as a Parquet table and read it back: table(rows, ddl, files=1, name='t')."""

    def make(rows, ddl, files=1, name="t"):
        path = f"{tmp_path}/source_{name}"
        spark.createDataFrame(rows, ddl).coalesce(files).write.parquet(path)
        return spark.read.schema(ddl).parquet(path)

    return make
