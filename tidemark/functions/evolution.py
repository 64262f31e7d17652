"""Schema drift between a slice and the batch appended to it.

Allowed with merging on: new columns (old rows NULL), columns gone from the source (new
rows NULL) and widening. Refused always: narrowing and any other type change. With merging
off, only an unchanged schema or a missing column passes.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F, types as T

# Ordered widening families; a type may become any later type of its family.
_FAMILIES = (
    (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()),
    (T.FloatType(), T.DoubleType()),
)


class SchemaDrift(ValueError):
    """An append whose schema cannot be reconciled with the slice."""


@dataclass(frozen=True)
class Change:
    column: str
    kind: str  # same | added | dropped | widened | narrower | refused
    slice_type: str | None
    batch_type: str | None

    def allowed(self, merge: bool) -> bool:
        if self.kind in ("same", "dropped"):
            return True
        return merge and self.kind in ("added", "widened")


def _kind(old: T.DataType, new: T.DataType) -> str:
    if old == new:
        return "same"
    for family in _FAMILIES:
        if old in family and new in family:
            return "widened" if family.index(new) > family.index(old) else "narrower"
    return "refused"


def changes(slice_schema: T.StructType, batch_schema: T.StructType) -> list[Change]:
    batch = {f.name: f.dataType for f in batch_schema}
    known = {f.name for f in slice_schema}
    found = []
    for f in slice_schema:
        if f.name not in batch:
            found.append(Change(f.name, "dropped", f.dataType.simpleString(), None))
        else:
            found.append(
                Change(
                    f.name,
                    _kind(f.dataType, batch[f.name]),
                    f.dataType.simpleString(),
                    batch[f.name].simpleString(),
                )
            )
    found += [
        Change(f.name, "added", None, f.dataType.simpleString())
        for f in batch_schema
        if f.name not in known
    ]
    return found


def reconciled(
    slice_schema: T.StructType, batch_schema: T.StructType, merge: bool = True
) -> T.StructType:
    """The schema of the slice after the append, or SchemaDrift."""
    refused = [c for c in changes(slice_schema, batch_schema) if not c.allowed(merge)]
    if refused:
        raise SchemaDrift(
            "; ".join(f"{c.column}: {c.slice_type} -> {c.batch_type} ({c.kind})" for c in refused)
        )
    batch = {f.name: f.dataType for f in batch_schema}
    known = {f.name for f in slice_schema}
    fields = [T.StructField(f.name, batch.get(f.name, f.dataType), True) for f in slice_schema]
    fields += [T.StructField(f.name, f.dataType, True) for f in batch_schema if f.name not in known]
    return T.StructType(fields)


def _widest(a: T.DataType, b: T.DataType) -> T.DataType:
    kind = _kind(a, b)
    if kind == "refused":
        raise SchemaDrift(f"{a.simpleString()} and {b.simpleString()} cannot be read as one column")
    return b if kind == "widened" else a


def common(schemas: list[T.StructType]) -> T.StructType:
    """The schema under which files of all these schemas can be read: every column, at its widest."""
    found: dict[str, T.DataType] = {}
    for schema in schemas:
        for f in schema:
            found[f.name] = _widest(found[f.name], f.dataType) if f.name in found else f.dataType
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in found.items()])


def conform(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``rows`` onto ``schema``: order, widen, and fill absent columns with NULL."""
    have = set(rows.columns)
    return rows.select(
        *[
            (F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )


def merge_append(old: DataFrame, new: DataFrame, merge: bool = True) -> DataFrame:
    """``old`` plus ``new`` under the reconciled schema."""
    target = reconciled(old.schema, new.schema, merge)
    return conform(old, target).unionByName(conform(new, target))
