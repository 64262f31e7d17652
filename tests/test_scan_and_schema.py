import pytest

from tidemark.functions import evolution
from tidemark.operators import scan
from tidemark.sources import tables
from pyspark.sql import functions as F, types as T

# (columns, patterns in order, expected status, column, pattern)
VECTORS = [
    (["key", "booked_on", "note"], ["booked_on", ".*_on"], ("matched", "booked_on", "booked_on")),
    (["shipped_ts", "weight"], ["closed_at", ".*_ts$"], ("matched", "shipped_ts", ".*_ts$")),
    (["opened_at", "note", "closed_at"], [".+_at"], ("ambiguous", None, ".+_at")),
    (["weight", "note"], ["booked_on", "closed_at"], ("unmatched", None, None)),
    (["day", "day"], ["day"], ("ambiguous", None, "day")),
    (["ts", "xts"], ["[", ".?ts", "ts"], ("ambiguous", None, ".?ts")),  # a broken pattern is skipped
    (["opened", "opened_by"], ["opened"], ("matched", "opened", "opened")),  # whole names only
]


def columns(spark, lists):
    rows = [("c", f"s{i}", "t", names) for i, names in enumerate(lists)]
    return tables.columns_of(
        spark.createDataFrame(rows, "source_catalog STRING, source_schema STRING, source_table STRING, columns ARRAY<STRING>")
    )


def test_match_vectors(spark):
    templates = scan.templates_frame(
        spark, [scan.Template("c", f"s{i}", tuple(p)) for i, (_, p, _) in enumerate(VECTORS)]
    )
    got = scan.match_columns(columns(spark, [v[0] for v in VECTORS]), templates).orderBy("source_schema").collect()
    assert [(r.match_status, r.matched_column, r.matched_pattern) for r in got] == [v[2] for v in VECTORS]
    assert got[2].all_matched_columns == ["opened_at", "closed_at"]


def test_duplicate_template_refused(spark):
    with pytest.raises(ValueError, match="duplicate"):
        scan.templates_frame(spark, [scan.Template("c", "s", ("a",)), scan.Template("c", "s", ("b",))])


def scanned(spark, existing, templates, lists, sizes=()):
    cols = columns(spark, lists)
    size = spark.createDataFrame(
        [("c", f"s{i}", "t", g) for i, g in enumerate(sizes)],
        "source_catalog STRING, source_schema STRING, source_table STRING, size_gb DOUBLE",
    )
    return scan.run_scan(cols, size, existing, scan.templates_frame(spark, templates), "run")


def existing(spark, rows):
    from tidemark.schemas import TABLE_CONFIG_DDL

    names = T.StructType.fromDDL(TABLE_CONFIG_DDL).names
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], TABLE_CONFIG_DDL)


RULE = [("r", "same_table", "a", "equals", "b", None)]


def row(schema, owner, **more):
    return {
        "table_id": f"c.{schema}.t", "source_catalog": "c", "source_schema": schema, "source_table": "t",
        "watermark_column": "old", "is_active": True, "modified_by": owner, "exclusion_conditions": RULE, **more,
    }


def test_merge_keeps_manual_rows_rules_and_other_schemas(spark):
    old = existing(spark, [
        row("s0", "scanner"), row("s1", "alice"), row("s1x", "scanner"),
        {**row("s0", "scanner"), "table_id": "c.s0.gone", "source_table": "gone"},
    ])
    templates = [scan.Template("c", "s0", ("dt",), default_retention_years=3), scan.Template("c", "s1", ("dt",)),
                 scan.Template("c", "s2", ("dt",), min_table_size_gb=2.0)]
    result = scanned(spark, old, templates, [["dt"], ["dt"], ["dt"]], [5.0, 5.0, 1.0])
    config = {r.table_id: r for r in result["config"].collect()}
    assert config["c.s0.t"].watermark_column == "dt" and config["c.s0.t"].retention_years == 3
    assert config["c.s0.t"].exclusion_conditions[0].name == "r"  # a rescan keeps the rules
    assert config["c.s1.t"].watermark_column == "old" and config["c.s1.t"].change_reason is None
    assert config["c.s1x.t"].is_active  # a schema outside this scan is left alone
    assert not config["c.s0.gone"].is_active and "not found" in config["c.s0.gone"].reason
    assert not config["c.s2.t"].is_active and config["c.s2.t"].reason == (
        "table size 1.0 GB is below minimum threshold of 2.0 GB"
    )
    actions = {r.table_id: r.merge_action for r in result["log"].collect()}
    assert actions == {"c.s0.t": "updated", "c.s1.t": "preserved", "c.s2.t": "added"}
    assert result["summary"].first().asDict() == {
        "tables_matched": 2, "tables_ambiguous": 0, "tables_unmatched": 0, "tables_excluded": 0,
        "tables_below_size_threshold": 1, "tables_size_unknown": 0, "tables_preserved": 1,
    }
    forced = scan.run_scan(columns(spark, [["dt"], ["dt"]]), spark.createDataFrame([], "source_catalog STRING, source_schema STRING, source_table STRING, size_gb DOUBLE"),
                           old, scan.templates_frame(spark, templates[:2]), "run", force=True)
    assert {r.table_id: r.watermark_column for r in forced["config"].collect()}["c.s1.t"] == "dt"


def test_excluded_and_unknown_size(spark):
    templates = [scan.Template("c", "s0", ("dt",), exclude_tables=("t",)), scan.Template("c", "s1", ("dt",), min_table_size_gb=1.0)]
    result = scanned(spark, existing(spark, []), templates, [["dt"], ["dt"]])
    log = {r.table_id: (r.match_status, r.inactive_reason) for r in result["log"].collect()}
    assert log == {"c.s0.t": ("excluded", "excluded by template exclude_tables"), "c.s1.t": ("matched", "table size unknown")}
    assert result["summary"].first().tables_size_unknown == 1
    assert [r.table_id for r in result["staging"].collect()] == ["c.s1.t"]


def test_listing_and_sizes(spark, tmp_path):
    spark.range(10).write.parquet(f"{tmp_path}/a")
    spark.range(5).selectExpr("id", "id AS ts").write.parquet(f"{tmp_path}/b")
    frames = {n: spark.read.parquet(f"{tmp_path}/{n}") for n in "ab"}
    listed = tables.listing(frames, spark).orderBy("table_name", "ordinal").collect()
    assert [tuple(r) for r in listed] == [("a", "id", 1), ("b", "id", 1), ("b", "ts", 2)]
    sizes = {r.table_name: r.size_gb for r in tables.sizes(spark, str(tmp_path)).collect()}
    on_disk = {n: sum(p.stat().st_size for p in (tmp_path / n).glob("*.parquet")) / 1024**3 for n in "ab"}
    assert sizes == pytest.approx(on_disk)


BASE = "id INT, name STRING, at TIMESTAMP"


@pytest.mark.parametrize(
    "batch, plain, merged",
    [
        ("id INT, name STRING, at TIMESTAMP", True, True),
        ("id BIGINT, name STRING, at TIMESTAMP", False, True),  # widen
        ("id INT, name STRING, at TIMESTAMP, region STRING", False, True),  # add
        ("id INT, at TIMESTAMP", True, True),  # drop
        ("id SMALLINT, name STRING, at TIMESTAMP", False, False),  # narrow
        ("id INT, name STRING, at STRING", False, False),  # retype
    ],
)
def test_drift_matrix(spark, batch, plain, merged):
    old, new = T.StructType.fromDDL(BASE), T.StructType.fromDDL(batch)
    for merge, allowed in ((False, plain), (True, merged)):
        if allowed:
            evolution.reconciled(old, new, merge)
        else:
            with pytest.raises(evolution.SchemaDrift):
                evolution.reconciled(old, new, merge)


def test_merge_append_fills_and_widens(spark):
    old = spark.createDataFrame([(1, "a")], "id INT, name STRING")
    new = spark.createDataFrame([(2**40, "x")], "id BIGINT, region STRING")
    got = evolution.merge_append(old, new)
    assert got.schema.simpleString() == "struct<id:bigint,name:string,region:string>"
    assert sorted(tuple(r) for r in got.collect()) == [(1, "a", None), (2**40, None, "x")]


def test_base_name(spark):
    assert spark.range(1).select(tables.base_name(F.lit("a.b.c"))).first()[0] == "c"


def test_common_schema_is_the_widest(spark):
    a = T.StructType.fromDDL("x BIGINT, y INT, old STRING")
    b = T.StructType.fromDDL("x INT, y BIGINT, new DOUBLE")
    assert evolution.common([a, b]) == T.StructType.fromDDL("x BIGINT, y BIGINT, old STRING, new DOUBLE")
    with pytest.raises(evolution.SchemaDrift):
        evolution.common([a, T.StructType.fromDDL("x STRING")])
