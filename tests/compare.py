"""Compare a query with its reference SQL in DuckDB: columns, row count and values."""

from __future__ import annotations

import datetime as dt
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, float):
        return None if v != v else round(v, 9)
    if isinstance(v, Decimal):
        return float(v)
    if isinstance(v, dt.datetime) and v.tzinfo:
        return v.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return v


def multiset(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def differences(spark_df, con, sql: str) -> list[str]:
    result = con.execute(sql)
    want_columns = [c[0] for c in result.description]
    want = multiset(want_columns, result.fetchall())
    got = multiset(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    out = []
    if sorted(want_columns) != sorted(spark_df.columns):
        out.append(f"columns {sorted(spark_df.columns)} != {sorted(want_columns)}")
    if want != got:
        out.append(f"rows {sum(got.values())} vs {sum(want.values())}")
        out += [f"only Spark: {r}" for r in list((got - want))[:3]]
        out += [f"only SQL:   {r}" for r in list((want - got))[:3]]
    return out
