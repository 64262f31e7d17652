"""Deletes reach the catalogue table, whoever reads it, and free the files they replaced."""

import datetime as dt
import os
import uuid

import pytest
from test_lifecycle import AS_OF, BASE, DDL, ids, rows, source

import tidemark as tm
from tidemark.sources import publication

LATER = dt.datetime(2100, 1, 1, tzinfo=dt.timezone.utc)


@pytest.fixture
def named(spark, tmp_path):
    """named(rows, partition=None): a catalogue table in a folder of its own."""
    made = []

    def make(data, partition=None, managed=False):
        name = f"t_{uuid.uuid4().hex}"
        by = f"PARTITIONED BY ({partition})" if partition else ""
        at = "" if managed else f"LOCATION '{tmp_path}/tables/{name}'"
        spark.sql(f"CREATE TABLE {name} ({DDL}) USING parquet {by} {at}")
        spark.createDataFrame(data, DDL).select(*spark.table(name).columns).coalesce(1).write.insertInto(name)
        made.append(name)
        return name

    yield make
    for name in made:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


@pytest.mark.parametrize("partition,managed", [(None, False), ("status", False), ("status", True)])
def test_every_session_sees_the_delete(spark, life, named, partition, managed):
    store, audit = life
    name = named(BASE, partition, managed)
    tm.archive(source(spark.table(name), delete_after=True), store, audit, "r1", AS_OF)
    assert len(ids(spark.newSession().table(name))) == len(BASE)  # not yet
    publication.publish_source(store, "db.t", name, "p1")
    left = list(range(200, 220)) + [300, 301, 302]
    assert ids(spark.newSession().table(name)) == left
    assert store.source_snapshot("db.t", spark.table(name)).deletes == ()
    assert ids(store.source_snapshot("db.t", spark.table(name)).read()) == left
    assert publication.publish_source(store, "db.t", name, "p2") is None
    # the replaced files go after their time, and the table does not miss them
    old = publication.replaced(store).collect()
    assert old and all(os.path.isdir(r.dir.removeprefix("file:")) for r in old)
    assert publication.remove_replaced(store, dt.datetime(2000, 1, 1, tzinfo=dt.timezone.utc)) == 0
    assert publication.remove_replaced(store, LATER) == len(old)
    assert not any(os.path.isdir(r.dir.removeprefix("file:")) for r in old) and publication.replaced(store).count() == 0
    assert ids(spark.newSession().table(name)) == left


def test_untouched_partitions_stay_where_they_are(spark, life, named):
    store, audit = life
    data = rows(0, 2018, 10) + rows(50, 2023, 10, status="new") + rows(80, 2018, 3, status="it's; odd=1/2")
    name = named(data + [(99, None, 1.0, dt.datetime(2018, 1, 1))], "status")
    tm.archive(tm.Source("db.t", spark.table(name), "at", 5, delete_after=True), store, audit, "r1", AS_OF)
    publication.publish_source(store, "db.t", name, "p1")
    assert ids(spark.newSession().table(name)) == list(range(50, 60))
    specs = {r.spec for r in store.publications().where("state = 'DONE'").collect()}
    assert len(specs) == 3 and not any("'new'" in s for s in specs)
    # new rows and a second delete, on top of the first publication
    more = spark.createDataFrame(rows(200, 2019, 4) + rows(300, 2024, 2), DDL)
    more.select(*spark.table(name).columns).write.insertInto(name)
    tm.archive(
        tm.Source("db.t", store.source_snapshot("db.t", spark.table(name)).read(), "at", 5, delete_after=True), store, audit, "r2", AS_OF
    )
    publication.publish_source(store, "db.t", name, "p2")
    assert ids(spark.newSession().table(name)) == list(range(50, 60)) + [300, 301]
    assert len(ids(store.read("db.t"))) == 14 + 4


def test_a_publication_cut_short_is_finished(spark, life, named, monkeypatch):
    store, audit = life
    name = named(BASE, "status")
    tm.archive(source(spark.table(name), delete_after=True), store, audit, "r1", AS_OF)
    with monkeypatch.context() as m:
        m.setattr(publication, "_make_directory", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            publication.publish_source(store, "db.t", name, "p1")
    with pytest.raises(RuntimeError, match="unfinished"):
        store.source_snapshot("db.t", spark.table(name))
    assert publication.finish(store, "db.t") == 1
    assert ids(spark.newSession().table(name)) == list(range(200, 220)) + [300, 301, 302]
    assert store.source_snapshot("db.t", spark.table(name)).deletes == ()
