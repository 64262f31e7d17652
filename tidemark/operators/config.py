"""Table configuration as DataFrames: inheritance, subset, and rule checks as violation rows."""

from __future__ import annotations

from functools import reduce
from operator import and_
from zoneinfo import available_timezones

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, functions as F

from ..functions import rules as R
from ..schemas import RULE_OPERATORS, RULE_TYPES, TABLE_CONFIG_DDL

# What a table must say itself: the columns that name it and its place, but for inherited defaults.
REQUIRED = tuple(
    item.split()[0]
    for item in TABLE_CONFIG_DDL.partition("delete_after_archive")[0].split(",")
    if item.strip() and not item.strip().startswith("retention_years")
)
IDENTIFIER = r"^[A-Za-z_][A-Za-z0-9_]*$"


class ConfigError(ValueError):
    """A configuration request that cannot be served."""


def effective(config: DataFrame, default_retention_years: int, default_timezone: str | None) -> DataFrame:
    """Per-table values with global defaults filled in; the time zone ends at UTC."""
    own_zone = F.col("timezone") if "timezone" in config.columns else F.lit(None).cast("string")
    return config.withColumn(
        "retention_years", F.coalesce("retention_years", F.lit(default_retention_years))
    ).withColumn("timezone", F.coalesce(own_zone, F.lit(default_timezone or "UTC")))


def subset(
    config: DataFrame,
    *,
    active_only: bool = True,
    source_catalog: str | None = None,
    source_schema: str | None = None,
    table_id: str | None = None,
    filter_expr: str | None = None,
) -> DataFrame:
    """Config rows matching all given filters; a bad predicate is a ConfigError."""
    tests: list[Column] = []
    if active_only:
        tests.append(F.col("is_active"))
    for name, value in (
        ("source_catalog", source_catalog),
        ("source_schema", source_schema),
        ("table_id", table_id),
    ):
        if value is not None:
            tests.append(F.col(name) == value)
    if filter_expr:
        tests.append(F.expr(filter_expr))
    try:
        return config.where(reduce(and_, tests)) if tests else config
    except AnalysisException as exc:
        raise ConfigError(f"filter_expr cannot be applied: {filter_expr}") from exc


def _blank(c: Column) -> Column:
    return c.isNull() | (F.trim(c) == "")


def _violations(rows: DataFrame, keys: list[str], checks: list[tuple[Column, str]]) -> DataFrame:
    found = F.filter(
        F.array(*[F.when(test, F.lit(message)) for test, message in checks]), lambda m: m.isNotNull()
    )
    return rows.select(*keys, F.explode(found).alias("violation"))


def table_violations(config: DataFrame) -> DataFrame:
    """One row per broken rule: required fields, identifier, time zone, unique table ids.

    Inactive rows may lack a watermark column. Fields are checked on the rows; duplicates
    are counted per id, pre-aggregated, and reported once.
    """
    active = F.coalesce(F.col("is_active"), F.lit(True))
    checks = []
    for name in REQUIRED:
        test = _blank(F.col(name))
        checks.append((test & active if name == "watermark_column" else test, f"{name} is missing"))
    checks.append(
        (
            active & ~_blank(F.col("watermark_column")) & ~F.col("watermark_column").rlike(IDENTIFIER),
            "watermark_column is not an identifier",
        )
    )
    if "timezone" in config.columns:
        zone = F.col("timezone")
        known = F.trim(zone).isin(*sorted(available_timezones()))
        checks.append((zone.isNotNull() & ~known, "timezone is not known"))
    duplicates = (
        config.groupBy("table_id")
        .count()
        .where("count > 1")
        .select("table_id", F.lit("table_id is not unique").alias("violation"))
    )
    return _violations(config, ["table_id"], checks).unionByName(duplicates)


def exploded_conditions(config: DataFrame) -> DataFrame:
    """One row per stored condition, normalised, with its position."""
    return config.select(
        "table_id", F.posexplode(R.normalised(F.col("exclusion_conditions"))).alias("position", "c")
    ).select("table_id", "position", "c.*")


def condition_violations(config: DataFrame) -> DataFrame:
    """One row per broken rule of a stored exclusion condition."""
    same = F.col("type") == "same_table"
    known_type = F.coalesce(F.col("type").isin(*RULE_TYPES), F.lit(False))
    known_op = F.coalesce(F.col("operator").isin(*RULE_OPERATORS), F.lit(False))
    checks = [
        (_blank(F.col("name")), "name is missing"),
        (~known_type, "type is not known"),
        (same & ~known_op, "operator is not known"),
        (same & _blank(F.col("column")), "column is missing"),
        (same & F.col("value").isNull() & F.coalesce(F.col("operator") != "is_not_null", F.lit(True)), "value is missing"),
        (
            (F.col("type") == "custom_sql") & ~F.coalesce(F.col("value").contains("{source_alias}"), F.lit(False)),
            "custom_sql does not mention {source_alias}",
        ),
    ]
    return _violations(exploded_conditions(config), ["table_id", "position"], checks)


def condition_names(config: DataFrame) -> DataFrame:
    return config.select("table_id", R.names(F.col("exclusion_conditions")).alias("condition_names"))
