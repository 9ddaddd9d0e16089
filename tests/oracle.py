"""Run a query and its SQL side by side and compare all values."""

from __future__ import annotations

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _canonical(rows, names) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])

    def value(v):
        if v is None or (isinstance(v, float) and pd.isna(v)):
            return "\0"
        return repr(v)

    return sorted(tuple(value(r[i]) for i in order) for r in rows)


def difference(spark, con, query, folder: str) -> str | None:
    """None when both give the same names and rows, else the first things that differ."""
    df = query.run(spark, folder)
    got = [tuple(r) for r in df.collect()]
    result = con.execute(query.sql)
    names = [c[0] for c in result.description]
    want = result.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    kinds = dict(df.dtypes)
    wide = {n: str(c[1]) for n, c in zip(names, result.description, strict=True)}
    same = {"bigint": "BIGINT", "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE"}
    odd = {n: (k, wide[n]) for n, k in kinds.items() if k in same and same[k] != wide[n]}
    a, b = _canonical(got, df.columns), _canonical(want, names)
    if a != b:
        only = [x for x in a if x not in set(b)][:3], [x for x in b if x not in set(a)][:3]
        return f"{len(a)} rows against {len(b)}; only here {only[0]}; only there {only[1]}"
    if not a:
        return "no rows"
    return f"types {odd}" if odd else None
