"""Exclusion rules: named predicates that protect rows from being archived.

A rule becomes one boolean flag column. A row is kept for the archive when NO flag is
true under three-valued logic: a NULL flag makes ``keep`` NULL, so the row stays in the
source ("keep when in doubt").
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce
from operator import and_
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, functions as F

from ..session import local_frame
from . import subqueries
from .skew import unique_lookup
from .watermarks import col

ALIAS = "src"


class RuleError(ValueError):
    """A rule that cannot be applied; names the rule."""


@dataclass(frozen=True)
class Rule:
    name: str
    type: str = "same_table"
    column: str | None = None
    operator: str | None = None
    value: Any = None

    @classmethod
    def of(cls, item) -> "Rule":
        """Accept a Rule, mapping or Row; the stored field ``scope`` is the rule type."""
        if isinstance(item, Rule):
            return item
        d = dict(item) if isinstance(item, Mapping) else item.asDict()
        return cls(
            name=d["name"],
            type=d.get("type") or d.get("scope"),
            column=d.get("column"),
            operator=d.get("operator"),
            value=d.get("value"),
        )


def _whole(rule: Rule) -> int:
    if isinstance(rule.value, bool):
        raise RuleError(f"rule {rule.name!r}: value must be a whole number")
    try:
        return int(rule.value)
    except (TypeError, ValueError) as exc:
        raise RuleError(f"rule {rule.name!r}: value must be a whole number") from exc


def _number(rule: Rule) -> Column:
    try:
        if isinstance(rule.value, bool):
            raise ValueError(rule.value)
        n = Decimal(str(rule.value))
    except (ArithmeticError, ValueError) as exc:
        raise RuleError(f"rule {rule.name!r}: value must be a number") from exc
    return F.lit(int(n)) if n == n.to_integral_value() else F.lit(n)


_ITEM = re.compile(r"\s*(?:'((?:[^']|'')*)'|\"([^\"]*)\"|([^',\"()\s][^',\"()]*?))\s*(?:,|$)")


def list_items(rule: Rule) -> list[str]:
    """Values of a list written as text, quoted or not: ``'a', 'b'`` or ``1, 2``."""
    text, at, out = rule.value.strip(), 0, []
    while at < len(text):
        m = _ITEM.match(text, at)
        if not m:
            raise RuleError(f"rule {rule.name!r}: cannot read the list {rule.value!r}")
        out.append(m[1].replace("''", "'") if m[1] is not None else m[2] if m[2] is not None else m[3])
        at = m.end()
    if not out:
        raise RuleError(f"rule {rule.name!r}: 'in' needs a list")
    return out


def counted_exists(text: str) -> str:
    """The text with its subquery predicates said as aggregates per key where their shape allows it.

    Both forms are true, false and unknown for the same rows. Catalyst turns the first, used as a flag, into an
    existence join with every row of the referenced table. It turns the second into an
    aggregate of that table by the key, combined map-side, and then a join, whatever the spelling.
    """
    found = subqueries.nodes(text)
    return subqueries.replaced(text, found, [n.sql for n in found])


def _parts(text: str, prefix: str) -> tuple[dict[str, str], str]:
    """Predicates of a rule that look into other tables, by column name, and the rule in terms of these columns.

    A rule that cannot be taken apart is one predicate as a whole.
    """
    found = subqueries.nodes(text)
    rest = subqueries.replaced(text, found, ["true"] * len(found))
    if not found or subqueries.has_select(rest) or not all(subqueries.outer_columns(n.verdict) for n in found):
        return {prefix: counted_exists(text)}, prefix
    names = [f"{prefix}_{k}" for k in range(len(found))]
    return {name: n.verdict for name, n in zip(names, found)}, subqueries.replaced(text, found, names)


def _looked_up(
    out: DataFrame, rows: DataFrame, asked: list[tuple[str, str, str]], catalog: str, schema: str
) -> DataFrame:
    """Add the flags of predicates (column, text, rule name) with a subquery, safely for hot keys on either side.

    A predicate can only depend on the source columns it mentions, so it is decided once per
    distinct combination of them in ``rows``, and the verdicts are joined to ``out``. All predicates of the same
    columns share one table of verdicts, and so one more scan of the source. A key
    that owns a third of the source is one row in the first step; in the second, its rows
    are split over tasks by adaptive execution.
    """
    groups: dict[tuple[str, ...], list[tuple[str, str, str]]] = {}
    for item in asked:
        groups.setdefault(tuple(sorted(subqueries.outer_columns(item[1]))), []).append(item)
    for columns, own in groups.items():
        keys = [f"_key_{i}" for i in range(len(columns))]
        verdicts = rows.select(*[col(c) for c in columns]).distinct().alias(ALIAS)
        verdicts = verdicts.select(*[col(c) for c in columns], *[col(c).alias(k) for c, k in zip(columns, keys)]).alias(ALIAS)
        names = []
        for name, text, rule in own:
            try:
                verdicts = verdicts.withColumn(name, F.expr(fill_placeholders(text, catalog, schema))).alias(ALIAS)
            except AnalysisException as exc:
                raise RuleError(f"rule {rule!r} cannot be applied: {exc}") from exc
            names.append(name)
        verdicts = unique_lookup(verdicts, keys, *[F.max(n).alias(n) for n in names])
        same = reduce(and_, [col(c).eqNullSafe(F.col(k)) for c, k in zip(columns, keys)])
        out = out.join(verdicts, same, "left").drop(*keys)
    return out


def fill_placeholders(text: str, catalog: str, schema: str) -> str:
    for mark, name in (
        ("{source_alias}", ALIAS), ("{source_catalog}", catalog), ("{source_schema}", schema),
    ):
        text = text.replace(mark, name)
    return text


def flag(rule: Rule, rows: DataFrame, as_of: dt.date, catalog: str = "", schema: str = "") -> Column:
    """The rule as a boolean column over ``rows`` (aliased ``src`` for custom SQL)."""
    if rule.type == "custom_sql":
        return F.expr(counted_exists(fill_placeholders(str(rule.value or ""), catalog, schema)))
    if rule.type != "same_table":
        raise RuleError(f"rule {rule.name!r}: unknown type {rule.type!r}")
    target = col(rule.column)
    try:
        dtype = rows.schema[rule.column].dataType
    except KeyError as exc:
        raise RuleError(f"rule {rule.name!r}: no column {rule.column!r}") from exc

    def typed(value) -> Column:
        if value is None:
            raise RuleError(f"rule {rule.name!r}: no value to compare {rule.column!r} with")
        cast = F.lit(str(value)).try_cast(dtype)
        # one local row, no job: a value of another type would protect every row without a word
        if local_frame(rows.sparkSession, [(1,)], "one INT").select(cast.isNull()).first()[0]:
            raise RuleError(f"rule {rule.name!r}: {value!r} is no {dtype.simpleString()}")
        return cast

    op = rule.operator
    if op == "equals":
        return target == typed(rule.value)
    if op == "not_equals":
        return target != typed(rule.value)
    if op == "in":
        if isinstance(rule.value, (list, tuple)):
            return target.isin(*[typed(v) for v in rule.value])
        if isinstance(rule.value, str):  # a written-out list, as stored in string configs
            return target.isin(*[typed(v) for v in list_items(rule)])
        raise RuleError(f"rule {rule.name!r}: 'in' needs a list")
    if op == "within_years":  # a year counts 365 days here
        return target >= F.date_add(F.lit(as_of), -_whole(rule) * 365)
    if op == "within_months":
        return target >= F.add_months(F.lit(as_of), -_whole(rule))
    if op == "greater_than":
        return target > _number(rule)
    if op == "is_not_null":
        return target.isNotNull()
    raise RuleError(f"rule {rule.name!r}: unknown operator {op!r}")


def flag_name(i: int) -> str:
    return f"_protected_{i}"


KEEP = "_keep"


def with_flags(
    rows: DataFrame, rules: Iterable[Rule], as_of: dt.date, catalog: str = "", schema: str = ""
) -> DataFrame:
    """Add one flag column per rule and the combined ``_keep`` column."""
    rules = [Rule.of(r) for r in rules]
    out = rows
    asked, told = [], {}
    for i, rule in enumerate(rules):
        text = str(rule.value)
        if rule.type == "custom_sql" and subqueries.has_select(text) and subqueries.outer_columns(text):
            parts, told[i] = _parts(text, f"_verdict_{i}")
            asked += [(name, part, rule.name) for name, part in parts.items()]
    out = _looked_up(out, rows, asked, catalog, schema)
    for i, rule in enumerate(rules):
        try:
            if i in told:
                out = out.alias(ALIAS).withColumn(flag_name(i), F.expr(fill_placeholders(told[i], catalog, schema)))
            else:
                out = out.alias(ALIAS).withColumn(flag_name(i), flag(rule, rows, as_of, catalog, schema))
        except AnalysisException as exc:
            raise RuleError(f"rule {rule.name!r} cannot be applied: {exc}") from exc
    return out.drop(*[name for name, _, _ in asked]).withColumn(KEEP, keep_all(rules))


def keep_all(rules: Iterable[Rule]) -> Column:
    terms = [~F.col(flag_name(i)) for i, _ in enumerate(rules)]
    return reduce(and_, terms) if terms else F.lit(True)


def drop_flags(rows: DataFrame) -> DataFrame:
    return rows.drop(KEEP, *[c for c in rows.columns if c.startswith("_protected_")])


def normalised(conditions: Column) -> Column:
    """Stored condition structs (scope, sql) as canonical ones (type, no sql)."""
    return F.transform(
        conditions,
        lambda c: F.struct(
            c["name"].alias("name"),
            c["scope"].alias("type"),
            c["column"].alias("column"),
            c["operator"].alias("operator"),
            c["value"].alias("value"),
        ),
    )


def names(conditions: Column) -> Column:
    return F.transform(conditions, lambda c: c["name"])
