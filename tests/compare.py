"""Run a check query in Spark and its reference SQL in DuckDB, and compare all rows."""

from __future__ import annotations

import datetime
import decimal
import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def _plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 9)
    if isinstance(v, (datetime.datetime, datetime.date)):
        return str(v)
    return v


def rows(columns: list[str], data) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in data)


def difference(spark, folder: str, query, sql: str) -> str | None:
    """None if equal, else what differs."""
    df = query(spark, folder)
    reference = connect(folder).execute(sql)
    names = [d[0] for d in reference.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    ours, theirs = rows(df.columns, df.collect()), rows(names, reference.fetchall())
    if ours == theirs:
        return None
    return f"{sum(ours.values())} rows against {sum(theirs.values())}; only ours {list((ours - theirs).items())[:2]}; only reference {list((theirs - ours).items())[:2]}"
