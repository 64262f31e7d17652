"""Column expressions over watermark columns of type DATE, TIMESTAMP or TIMESTAMP_NTZ.

Range predicates are written as half-open bounds on the raw column, because
``year(col) = y`` never reaches the Parquet reader while ``col >= lo AND col < hi`` does.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F, types as T


def type_of(rows: DataFrame, name: str) -> T.DataType:
    return rows.schema[name].dataType


def col(name: str) -> Column:
    return F.col(f"`{name}`")


def year_of(rows: DataFrame, name: str, timezone: str | None = None) -> Column:
    """Calendar year of the watermark, in ``timezone`` when the column is zoned."""
    if timezone and isinstance(type_of(rows, name), T.TimestampType):
        return F.year(F.convert_timezone(None, F.lit(timezone), col(name)))
    return F.year(col(name))


def instant(rows: DataFrame, name: str) -> Column:
    """The watermark at full precision as TIMESTAMP_NTZ (UTC for zoned columns)."""
    if isinstance(type_of(rows, name), T.TimestampType):
        return F.convert_timezone(None, F.lit("UTC"), col(name))
    return col(name).cast("timestamp_ntz")


def _boundary(year: int, dtype: T.DataType, timezone: str | None) -> Column:
    text = f"{year:04d}-01-01"
    if isinstance(dtype, T.TimestampType):
        text += f" 00:00:00 {timezone}" if timezone else " 00:00:00"
    return F.lit(text).cast(dtype)


def within_years(
    rows: DataFrame, name: str, first: int | None, last: int, timezone: str | None = None
) -> Column:
    """``first-01-01 <= wm < (last+1)-01-01``; open at the bottom when first is None."""
    dtype = type_of(rows, name)
    test = col(name) < _boundary(last + 1, dtype, timezone)
    if first is not None:
        test = (col(name) >= _boundary(first, dtype, timezone)) & test
    return test


def literal(rows: DataFrame, name: str, value: dt.datetime) -> Column:
    """A stored (zone-free, UTC) watermark as a literal of the column's own type."""
    dtype = type_of(rows, name)
    text = value.isoformat(sep=" ")
    if isinstance(dtype, T.TimestampType):
        return F.lit(text + " UTC").cast(dtype)
    if isinstance(dtype, T.DateType):
        return F.lit(value.date().isoformat()).cast(dtype)
    return F.lit(text).cast(dtype)


def year_runs(years) -> list[tuple[int, int]]:
    """Merge calendar years into inclusive runs: {1995, 1996, 1999} -> (1995,1996), (1999,1999)."""
    runs: list[tuple[int, int]] = []
    for y in sorted(set(years)):
        if runs and y == runs[-1][1] + 1:
            runs[-1] = (runs[-1][0], y)
        else:
            runs.append((y, y))
    return runs
