"""Compare a query's Spark result with its SQL run by DuckDB on the same files."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{os.path.join(sf_dir, name)}.parquet')")
    return con


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    return v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_value(r[i]) for i in order) for r in rows), key=repr)


def compare(df, con, sql: str) -> tuple[int, str | None]:
    """Row count and, if the results differ, the first difference."""
    got_rows = _rows(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want_rows = _rows(names, cur.fetchall())
    if sorted(names) != sorted(df.columns):
        return len(got_rows), f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(got_rows) != len(want_rows):
        only = [r for r in got_rows if r not in set(want_rows)][:2]
        miss = [r for r in want_rows if r not in set(got_rows)][:2]
        return len(got_rows), f"{len(got_rows)} rows != {len(want_rows)}; only spark {str(only)[:300]}; only sql {str(miss)[:300]}"
    for a, b in zip(got_rows, want_rows):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return len(got_rows), f"spark {str(a)[:500]} ({[type(x).__name__ for x in a]}) != sql {str(b)[:500]} ({[type(x).__name__ for x in b]})"
    return len(got_rows), None
