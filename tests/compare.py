"""Compare a Spark result with its SQL counterpart, as sets of whole rows."""

from collections import Counter
from datetime import datetime
from decimal import Decimal

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, Decimal):
        return ("num", float(v)) if v == v.to_integral_value() else ("dec", str(v.normalize()))
    if isinstance(v, bool):
        return ("bool", v)
    if isinstance(v, (int, float)):
        return ("num", float(v))
    if isinstance(v, datetime):
        return ("ts", v.isoformat())
    return v


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def difference(df, con, sql):
    """None if both give the same columns and rows, else a description."""
    cur = con.execute(sql)
    want_cols = [d[0] for d in cur.description]
    if sorted(df.columns) != sorted(want_cols):
        return f"columns {sorted(df.columns)} != {sorted(want_cols)}"
    got, want = bag(df.columns, df.collect()), bag(want_cols, cur.fetchall())
    if got == want:
        return None
    return (
        f"{sum(got.values())} rows, want {sum(want.values())}; "
        f"only in Spark: {list((got - want).items())[:3]}; only in SQL: {list((want - got).items())[:3]}"
    )
