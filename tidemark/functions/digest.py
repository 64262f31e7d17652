"""Order-free content digest of a set of rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T


def _has_map(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.MapType):
        return True
    if isinstance(dtype, T.ArrayType):
        return _has_map(dtype.elementType)
    return isinstance(dtype, T.StructType) and any(_has_map(f.dataType) for f in dtype)


def hashable(rows: DataFrame, name: str) -> Column:
    """A column as something that can be hashed: maps have no order, so their entries are sorted."""
    dtype, c = rows.schema[name].dataType, F.col(f"`{name}`")
    if not _has_map(dtype):
        return c
    if isinstance(dtype, T.MapType) and not _has_map(dtype.valueType):
        return F.sort_array(F.map_entries(c))
    return F.to_json(F.struct(c))


def row_hashes(rows: DataFrame, columns: Sequence[str]) -> tuple[Column, Column]:
    """Two 64-bit hashes of a row. The second is taken over a hash of each column: Spark's hash skips NULLs, and a
    value that moved from one NULL column to another must not go unseen."""
    values = [hashable(rows, c) for c in columns]
    return F.xxhash64(*values), F.xxhash64(F.lit(len(values)), *[F.xxhash64(v) for v in values])


def content_sums(rows: DataFrame, columns: Sequence[str]) -> tuple[Column, Column]:
    """Sums of both row hashes: equal for equal multisets of rows, and mergeable."""
    first, second = row_hashes(rows, columns)
    return F.sum(first.cast("decimal(28,0)")), F.sum(second.cast("decimal(28,0)"))


def content_digest(rows: DataFrame, columns: Sequence[str]) -> Column:
    """Sum of row hashes as DECIMAL(38,0).

    A sum, not an XOR: equal pairs of rows must not cancel. Partial sums combine map-side,
    and DECIMAL(38,0) holds 10**19 rows even if all of them are equal.
    """
    hashed = F.xxhash64(*[hashable(rows, c) for c in columns])
    return F.sum(hashed.cast("decimal(28,0)"))
