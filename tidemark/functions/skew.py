"""Lookup tables that leave adaptive execution free to split a hot key on the other side.

A skewed join is split only when both of its inputs come straight from an exchange. A
lookup table that was just aggregated by the join key has none: its partitioning is reused.
Grouping by one column more, itself a hash of the key, changes no row but makes the join
shuffle the (small, already unique) lookup table once more, and the split becomes possible.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def unique_lookup(rows: DataFrame, keys: list[str], *values: Column) -> DataFrame:
    """One row per key, with mergeable aggregates ``values``, arriving by its own exchange.

    ``rows`` must not be partitioned by ``keys`` yet, or that partitioning is reused again.
    """
    spread = rows.groupBy(*keys, F.xxhash64(*keys).alias("_spread"))
    grouped = spread.agg(*values) if values else rows.select(*keys, F.xxhash64(*keys).alias("_spread")).distinct()
    return grouped.drop("_spread")
