import datetime as dt

import duckdb
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tidemark.functions import rules as R

AS_OF = dt.date(2024, 2, 29)
DDL = "id INT, status STRING, amount DOUBLE, seen DATE"


def flags(spark, rows, *rules):
    df = R.with_flags(spark.createDataFrame(rows, DDL), rules, AS_OF)
    return [(r["_protected_0"], r["_keep"]) for r in df.orderBy("id").collect()]


ROWS = [
    (1, "Active", 12.5, dt.date(2024, 1, 1)),
    (2, "Closed", 12.0, dt.date(2017, 3, 1)),
    (3, None, None, None),
]


@pytest.mark.parametrize(
    "rule, expected",
    [
        (("same_table", "status", "equals", "Active"), [True, False, None]),
        (("same_table", "status", "not_equals", "Active"), [False, True, None]),
        (("same_table", "status", "in", ["Active", "New"]), [True, False, None]),
        (("same_table", "status", "in", "'Closed', 'Old'"), [False, True, None]),
        (("same_table", "amount", "greater_than", 12), [True, False, None]),
        (("same_table", "amount", "greater_than", "12.4"), [True, False, None]),
        (("same_table", "amount", "equals", "12.5"), [True, False, None]),
        (("same_table", "seen", "within_months", "2"), [True, False, None]),
        (("same_table", "status", "is_not_null", None), [True, True, False]),
        (("custom_sql", None, None, "{source_alias}.status = 'Active'"), [True, False, None]),
    ],
)
def test_operator(spark, rule, expected):
    got = flags(spark, ROWS, R.Rule("r", *rule))
    assert [f for f, _ in got] == expected
    # a NULL flag neither keeps nor protects for certain: the row stays in the source
    assert [k for _, k in got] == [None if f is None else not f for f in expected]


def test_within_years_counts_365_days(spark):
    edge = AS_OF - dt.timedelta(days=7 * 365)
    rows = [(1, "x", 1.0, edge), (2, "x", 1.0, edge - dt.timedelta(days=1))]
    assert [f for f, _ in flags(spark, rows, R.Rule("r", "same_table", "seen", "within_years", 7))] == [True, False]


@pytest.mark.parametrize(
    "rule",
    [
        R.Rule("r", "same_table", "status", "like", "x"),
        R.Rule("r", "same_table", "nowhere", "equals", "x"),
        R.Rule("r", "same_table", "amount", "greater_than", "many"),
        R.Rule("r", "same_table", "seen", "within_years", True),
        R.Rule("r", "same_table", "status", "in", 5),
        R.Rule("r", "other", "status", "equals", "x"),
        R.Rule("r", "custom_sql", value="{source_alias}.nowhere = 1"),
    ],
)
def test_bad_rule_is_named(spark, rule):
    with pytest.raises(R.RuleError, match="'r'"):
        flags(spark, ROWS, rule)


def test_stored_condition_becomes_rule(spark):
    row = spark.range(1).select(
        F.struct(F.lit("n").alias("name"), F.lit("same_table").alias("scope"), F.lit("c").alias("column"),
                 F.lit("equals").alias("operator"), F.lit("v").alias("value"), F.lit(None).alias("sql")).alias("c")
    ).first().c
    assert R.Rule.of(row) == R.Rule("n", "same_table", "c", "equals", "v")


def test_exists_rewrite():
    text = "EXISTS (SELECT 1 FROM a x WHERE x.k = src.k) AND src.v > 1"
    assert R.counted_exists(text) == "0 < (SELECT count(*) FROM a x WHERE x.k = src.k) AND src.v > 1"
    assert R.counted_exists("NOT EXISTS (SELECT * FROM a WHERE a.k = src.k)") == "0 = (SELECT count(*) FROM a WHERE a.k = src.k)"
    assert R.counted_exists("src.k IN (SELECT k FROM a)") == "src.k IN (SELECT DISTINCT k FROM a)"
    for other in (
        "EXISTS (SELECT 1 FROM a WHERE a.k = src.k GROUP BY a.k HAVING count(*) > 1)",
        "EXISTS (SELECT 1 FROM a WHERE a.k IN (SELECT k FROM b))",
        "src.v > 1",
    ):
        assert R.counted_exists(other) == other


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    data=st.lists(
        st.tuples(st.sampled_from(["A", "B", "C", None]), st.sampled_from([1.0, 5.0, 9.0, None])),
        min_size=1, max_size=25,
    ),
    value=st.sampled_from(["A", "B"]),
    limit=st.integers(0, 9),
    spare=st.sampled_from([("not_equals", "C"), ("is_not_null", None)]),
)
def test_rule_algebra(spark, data, value, limit, spare):
    """keep is the three-valued AND of the negated flags."""
    rules = [
        R.Rule("a", "same_table", "status", "equals", value),
        R.Rule("b", "same_table", "amount", "greater_than", limit),
        R.Rule("c", "same_table", "status", *spare),
    ]
    rows = [(i, s, a, None) for i, (s, a) in enumerate(data)]
    got = R.with_flags(spark.createDataFrame(rows, DDL), rules, AS_OF).orderBy("id").collect()

    def expected(s, a):
        f1 = None if s is None else s == value
        f2 = None if a is None else a > limit
        f3 = (s is not None) if spare[0] == "is_not_null" else (None if s is None else s != "C")
        if True in (f1, f2, f3):
            return False
        return None if None in (f1, f2, f3) else True

    assert [r["_keep"] for r in got] == [expected(s, a) for s, a in data]


@pytest.mark.parametrize("operator,value", [("equals", "abc"), ("not_equals", None), ("in", ["1", "x"]), ("in", "1, x"), ("in", "1 2 (")])
def test_a_value_of_another_type_is_refused(spark, operator, value):
    df = spark.createDataFrame([(1,)], "n INT")
    with pytest.raises(R.RuleError):
        R.with_flags(df, [R.Rule("r", "same_table", "n", operator, value)], dt.date(2024, 1, 1))


def test_written_lists():
    read = lambda text: R.list_items(R.Rule("r", value=text))
    assert read("'a', 'it''s', b ,\"c d\"") == ["a", "it's", "b", "c d"]
    assert read("1, 2,3") == ["1", "2", "3"]


@pytest.mark.parametrize("text,protected", [
    ("EXISTS (SELECT * FROM seen s WHERE s.k = {source_alias}.k)", {1}),
    ("NOT EXISTS (SELECT 1 FROM seen s WHERE s.k = {source_alias}.k)", {2, None}),
    ("{source_alias}.k IN (SELECT k FROM seen)", {1}),
    ("EXISTS (SELECT s.k FROM seen s WHERE s.k = {source_alias}.k)", {1}),
])
def test_every_spelling_is_aggregated_first(spark, text, protected):
    spark.createDataFrame([(1,)] * 50 + [(7,)], "k INT").createOrReplaceTempView("seen")
    df = spark.createDataFrame([(1,), (2,), (None,)], "k INT")
    out = R.with_flags(df, [R.Rule("r", "custom_sql", value=text)], dt.date(2024, 1, 1))
    assert {r.k for r in out.where("_protected_0").collect()} == protected
    assert "keys=[k" in out._jdf.queryExecution().optimizedPlan().toString() or "Aggregate [k" in out._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("text,said", [
    ("EXISTS (SELECT 1 FROM a WHERE a.k = src.k AND a.d > src.d)", "coalesce((SELECT max(a.d) FROM a WHERE a.k = src.k) > src.d, false)"),
    ("NOT EXISTS (SELECT 1 FROM a WHERE src.d >= a.d AND a.k = src.k AND a.x = 'AND')",
     "NOT coalesce((SELECT min(a.d) FROM a WHERE a.k = src.k AND a.x = 'AND') <= src.d, false)"),
    ("exists (select * from a where a.d between 1 and 2 and src.k = a.k) or not exists (select 1 from b where b.k=src.k)",
     "0 < (SELECT count(*) from a WHERE a.d between 1 and 2 AND src.k = a.k) or 0 = (SELECT count(*) from b WHERE b.k=src.k)"),
    ("src.v IN (SELECT v FROM a) AND src.note <> 'x IN (SELECT a FROM b)'", "src.v IN (SELECT DISTINCT v FROM a) AND src.note <> 'x IN (SELECT a FROM b)'"),
])
def test_shapes(text, said):
    assert R.counted_exists(text) == said


@pytest.mark.parametrize("text", [
    "EXISTS (SELECT 1 FROM a WHERE a.k = src.k AND a.lo <= src.d AND a.hi >= src.d)",
    "EXISTS (SELECT 1 FROM a WHERE a.k = src.k AND (a.d > src.d OR a.e > 1))",
    "EXISTS (SELECT 1 FROM a WHERE a.k = src.k AND a.d <> src.d)",
    "EXISTS (SELECT 1 FROM a JOIN b ON a.k = src.k)",
    "EXISTS (SELECT count(*) FROM a WHERE a.k = src.k)",
    "1 + src.v IN (SELECT v FROM a)",
    "src.note = 'EXISTS (SELECT 1 FROM a WHERE a.k = src.k)' -- IN (SELECT v FROM a)",
])
def test_other_shapes_stay(text):
    assert R.counted_exists(text) == text


@pytest.fixture
def looked_up(spark):
    spark.createDataFrame([(1, 5), (1, 9), (2, None), (3, 1)], "k INT, d INT").createOrReplaceTempView("seen")
    spark.createDataFrame([(3,), (4,), (None,)], "v INT").createOrReplaceTempView("banned")
    return spark.createDataFrame(
        [(1, 4, "a"), (1, 9, "b"), (2, 0, "c"), (3, 1, "d"), (None, 1, "e"), (1, None, "f"), (4, 4, "x IN (SELECT a FROM b)")],
        "k INT, v INT, note STRING",
    )


@pytest.mark.parametrize("text", [
    "EXISTS (SELECT 1 FROM seen s WHERE s.k = {source_alias}.k AND s.d > {source_alias}.v)",
    "NOT EXISTS (SELECT 1 FROM seen s WHERE s.k = {source_alias}.k AND {source_alias}.v >= s.d)",
    "EXISTS (SELECT 1 FROM seen s WHERE s.k = {source_alias}.k AND s.d >= {source_alias}.v AND s.d <= {source_alias}.v + 3)",
    "EXISTS (SELECT 1 FROM seen s WHERE s.d < {source_alias}.v)",
    "EXISTS (SELECT 1 FROM seen s WHERE s.k = {source_alias}.k) OR {source_alias}.v IN (SELECT v FROM banned)",
    "{source_alias}.note = 'x IN (SELECT a FROM b)' AND NOT EXISTS (SELECT 1 FROM seen s WHERE s.k = {source_alias}.k)",
    "{source_alias}.k IN (SELECT v FROM banned)",
    "{source_alias}.k NOT IN (SELECT v FROM banned)",
    "{source_alias}.k IN (SELECT v FROM banned WHERE v > 99)",
    "{source_alias}.v NOT IN (SELECT v FROM banned WHERE v > 3) AND ({source_alias}.k = 1 OR NOT {source_alias}.k IN (SELECT k FROM seen))",
])
def test_verdicts_are_those_of_the_rule_as_written(spark, looked_up, text):
    """Against DuckDB, the third value included."""
    got = R.with_flags(looked_up, [R.Rule("r", "custom_sql", value=text)], AS_OF)
    con = duckdb.connect()
    for name, df in (("seen", spark.table("seen")), ("banned", spark.table("banned")), ("src", looked_up)):
        con.execute(f"CREATE TABLE {name} ({', '.join(f'{c} {t}' for c, t in df.dtypes)})")
        con.executemany(f"INSERT INTO {name} VALUES ({', '.join('?' * len(df.columns))})", [list(r) for r in df.collect()])
    want = dict(con.execute(f"SELECT note, {text.replace('{source_alias}', 'src')} FROM src").fetchall())
    assert {r.note: r["_protected_0"] for r in got.collect()} == want


def test_rules_of_one_key_share_a_scan_and_no_nested_loop(spark, looked_up, tmp_path):
    looked_up.write.parquet(f"{tmp_path}/src")
    rows = spark.read.parquet(f"{tmp_path}/src")
    rules = [
        R.Rule("a", "custom_sql", value="EXISTS (SELECT 1 FROM seen s WHERE s.k = {source_alias}.k)"),
        R.Rule("b", "custom_sql", value="NOT EXISTS (SELECT 1 FROM seen s WHERE s.k = {source_alias}.k AND s.d > 3) OR {source_alias}.k IN (SELECT v FROM banned)"),
        R.Rule("c", "custom_sql", value="EXISTS (SELECT 1 FROM seen s WHERE s.k = {source_alias}.k AND s.d > {source_alias}.v)"),
    ]
    plan = R.with_flags(rows, rules, AS_OF)._jdf.queryExecution()
    executed = plan.executedPlan().toString()
    assert "NestedLoop" not in executed
    assert plan.optimizedPlan().toString().count("Relation [") == 1 + 2  # the source, keys (k), keys (k, v)
    assert "Existence" not in R.with_flags(rows, [rules[0], rules[2]], AS_OF)._jdf.queryExecution().executedPlan().toString()
