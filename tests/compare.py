"""Spark rows against the checking database's rows, order left out."""

from __future__ import annotations

import math
from collections import Counter

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 6))
    return value if value is None or isinstance(value, (int, str, bool)) else str(value)


def difference(df, con, sql: str) -> str | None:
    """None when both give the same rows, otherwise what differs."""
    names = sorted(df.columns)
    mine = Counter(tuple(_plain(r[n]) for n in names) for r in df.collect())
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    if sorted(columns) != names:
        return f"columns {names} against {sorted(columns)}"
    order = [columns.index(n) for n in names]
    theirs = Counter(tuple(_plain(r[i]) for i in order) for r in result.fetchall())
    if mine == theirs:
        return None
    extra, missing = mine - theirs, theirs - mine
    return (
        f"{sum(mine.values())} rows against {sum(theirs.values())}; only here {sum(extra.values())}: "
        f"{list(extra)[:2]}; only there {sum(missing.values())}: {list(missing)[:2]} ({names})"
    )
