"""The scan as a job over the session's catalogue."""

import uuid

import pytest

from tidemark.operators.scan import Template
from tidemark.plans import scanning
from tidemark.plans.scanning import ConfigStore, run_scan_job


@pytest.fixture
def schema(spark, tmp_path):
    name = f"c_{uuid.uuid4().hex}"
    spark.sql(f"CREATE SCHEMA {name} LOCATION '{tmp_path}/schema'")
    spark.sql(f"CREATE TABLE {name}.claims (id INT, claim_date DATE) USING parquet")
    spark.sql(f"INSERT INTO {name}.claims VALUES (1, DATE '2020-01-01')")
    spark.sql(f"CREATE TABLE {name}.parted (id INT, load_dt DATE, p INT) USING parquet PARTITIONED BY (p)")
    spark.sql(f"INSERT INTO {name}.parted VALUES (1, DATE '2020-01-01', 1), (2, DATE '2020-01-01', 2)")
    spark.sql(f"CREATE TABLE {name}.both (a_date DATE, b_date DATE) USING json")
    spark.sql(f"CREATE TABLE {name}.plain (id INT) USING parquet")
    spark.sql(f"CREATE TABLE {name}.secret (x_date DATE) USING parquet")
    spark.sql(f"CREATE VIEW {name}.seen AS SELECT * FROM {name}.claims")
    yield name
    spark.sql(f"DROP SCHEMA {name} CASCADE")


def test_scan_job(spark, tmp_path, schema):
    configs = ConfigStore(spark, f"{tmp_path}/config")
    template = Template("spark_catalog", schema, (".*_dt", ".*_date"), "/archive", 5, False, 0.0, ("secret",))
    counts = run_scan_job(spark, [template], configs, "s1")
    assert counts["tables_matched"] == 2 and counts["tables_ambiguous"] == 1 and counts["tables_unmatched"] == 1
    assert counts["tables_excluded"] == 1 and counts["tables_preserved"] == 0
    rows = {r.source_table: r for r in configs.config().collect()}
    assert {t: r.watermark_column for t, r in rows.items()} == {"claims": "claim_date", "parted": "load_dt", "both": None, "plain": None}
    assert rows["claims"].modified_at is not None and rows["claims"].change_reason == "added by scan s1"
    sizes = {r.source_table: r.table_size_gb for r in configs.log().collect()}
    assert sizes["claims"] > 0 and sizes["parted"] > 0 and not sizes["plain"]
    assert configs.staging().count() == 4 and configs.current().version == 0

    # a person takes a row over; a table goes; the next scan keeps the one and switches the other off
    from pyspark.sql import functions as F

    own = F.col("source_table") == "claims"
    edited = configs.config().withColumn("modified_by", F.when(own, "ann").otherwise(F.col("modified_by"))).withColumn(
        "retention_years", F.when(own, 9).otherwise(F.col("retention_years"))
    )
    configs.publish(edited, "by-hand")
    spark.sql(f"DROP TABLE {schema}.parted")
    assert run_scan_job(spark, [template], configs, "s2")["tables_preserved"] == 1
    rows = {r.source_table: r for r in configs.config().collect()}
    assert (rows["claims"].retention_years, rows["claims"].scan_run_id) == (9, "s1")
    assert not rows["parted"].is_active and rows["parted"].reason == "dropped: not found in scan s2"
    assert configs.log().count() == 9 and [r.version for r in configs.versions().orderBy("version").collect()] == [0, 1, 2]
    assert configs.config(0).count() == 4


def test_a_scan_that_dies_leaves_the_configuration(spark, tmp_path, schema, monkeypatch):
    configs = ConfigStore(spark, f"{tmp_path}/config")
    template = Template("spark_catalog", schema, (".*_date",), "/archive", 5)
    run_scan_job(spark, [template], configs, "s1")
    before = configs.config().count()
    with monkeypatch.context() as m:
        m.setattr(scanning, "append_batch", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            run_scan_job(spark, [template], configs, "s2")
    assert configs.current().scan_run_id == "s1" and configs.config().count() == before
    assert run_scan_job(spark, [], configs, "s3")["tables_matched"] == 0 and configs.current().scan_run_id == "s1"
