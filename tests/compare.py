"""Order-insensitive comparison of a query and its SQL."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def canon(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return 0.0 if value == 0 else float(f"{value:.9g}")
    if isinstance(value, (list, tuple)):
        return tuple(canon(v) for v in value)
    if isinstance(value, dict):
        return tuple(sorted((k, canon(v)) for k, v in value.items()))
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda at: columns[at])
    return Counter(tuple(canon(row[at]) for at in order) for row in rows)


def differences(df, con, sql):
    """Problems found, or an empty list."""
    got_cols = df.columns
    got = df.collect()
    cur = con.execute(sql)
    want_cols = [d[0] for d in cur.description]
    want = cur.fetchall()
    problems = []
    if sorted(got_cols) != sorted(want_cols):
        return [f"columns {sorted(got_cols)} != {sorted(want_cols)}"]
    if not got:
        problems.append("no rows")
    for c, kind in zip(want_cols, [str(d[1]) for d in cur.description]):
        if "HUGEINT" in kind or "DECIMAL" in kind:
            problems.append(f"sql column {c} is {kind}")
    a, b = rows_of(got_cols, [tuple(r) for r in got]), rows_of(want_cols, want)
    if a != b:
        problems.append(
            f"{len(got)} vs {len(want)} rows; only spark {sum((a - b).values())} {list((a - b).items())[:3]}; "
            f"only sql {sum((b - a).values())} {list((b - a).items())[:3]}"
        )
    return problems
