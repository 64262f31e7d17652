"""Restored years that other sessions can query, until they expire."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F
from test_lifecycle import AS_OF, DDL, ids, rows, source

import tidemark as tm
from tidemark.plans.restore import drop_expired, restored


@pytest.fixture
def schema(spark, tmp_path):
    name = f"s_{uuid.uuid4().hex}"
    spark.sql(f"CREATE SCHEMA {name} LOCATION '{tmp_path}/schema'")
    yield name
    spark.sql(f"DROP SCHEMA {name} CASCADE")


def test_restored_tables_outlive_the_session(spark, life, table, schema):
    store, audit = life
    first = rows(0, 2018, 6) + rows(50, 2020, 4)
    tm.archive(source(table(first, DDL, name="a")), store, audit, "r1", AS_OF)
    data = first + rows(70, 2020, 3, month=9)
    live = table(data, DDL, name="b")
    tm.archive(source(live), store, audit, "r2", AS_OF)  # 2020 has two directories
    live.write.saveAsTable(f"{schema}.t")
    soon = dt.datetime(2030, 1, 1, tzinfo=dt.timezone.utc)
    done = tm.restore(
        store, audit, "db.t", [2018, 2019, 2020], prefix="p_", target_schema=schema, live_table=f"{schema}.t",
        run_id="v1", expires_at=soon,
    )
    assert done.status == "PARTIAL_COMPLETED" and done.skipped == [2019]
    other = spark.newSession()
    assert ids(other.table(f"{schema}.p_t_year_2018")) == list(range(6))
    assert ids(other.table(f"{schema}.p_t_year_2020")) == [50, 51, 52, 53, 70, 71, 72]
    assert other.table(f"{schema}.p_t_unified").count() == 13 + 13
    assert other.table(f"{schema}.p_t_year_2018").columns == ["id", "status", "amount", "at"]
    row = audit.restores().first()
    assert (row.target_schema, row.target_catalog, row.status) == (schema, "spark_catalog", "PARTIAL_COMPLETED")
    # only the asked year's directories are read
    plan = other.table(f"{schema}.p_t_year_2018")._jdf.queryExecution().executedPlan().toString()
    assert "slice_year" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
    # again, with other years: the old table gives way
    tm.restore(store, audit, "db.t", [2020], prefix="p_", target_schema=schema, run_id="v2", expires_at=soon)
    assert other.table(f"{schema}.p_t_unified").count() == 7
    # expiry drops views and table, and leaves the slices
    assert drop_expired(store, dt.datetime(2029, 1, 1, tzinfo=dt.timezone.utc)) == []
    assert set(drop_expired(store, soon)) == {"p_t_year_2018", "p_t_year_2020", "p_t_unified", "p_t_restored"}
    assert restored(store).count() == 0 and not spark.catalog.tableExists(f"{schema}.p_t_unified")
    assert store.read("db.t").count() == 13


def test_evolved_slices_and_refusals(spark, life, table, schema):
    store, audit = life
    tm.archive(source(table(rows(0, 2018, 3), DDL, name="a")), store, audit, "r1", AS_OF)
    wide = table([(*r, "n") for r in rows(50, 2020, 2)], DDL.replace("id INT", "id BIGINT") + ", note STRING", name="b")
    tm.archive(source(wide), store, audit, "r2", AS_OF)
    tm.restore(store, audit, "db.t", [2018, 2020], target_schema=schema, unified=False)
    other = spark.newSession()
    assert other.table(f"{schema}.t_year_2018").dtypes == spark.createDataFrame([], DDL).dtypes
    assert [tuple(r) for r in other.table(f"{schema}.t_year_2020").select("id", "note").orderBy("id").collect()] == [(50, "n"), (51, "n")]
    with pytest.raises(ValueError, match="by name"):
        tm.restore(store, audit, "db.t", [2018], target_schema=schema, live=wide)
    with pytest.raises(ValueError, match="column"):
        tm.restore(store, audit, "db.t", [2018, 2020], target_schema=schema)
    assert audit.restores().where(F.col("status") == "FAILED").count() == 1
