"""Run a query in Spark and its SQL in DuckDB and compare the rows without regard to order."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _key(row):
    return tuple((v is None, str(type(v)) if v is None else "", v) for v in row)


def _clean(v):
    return 0.0 if isinstance(v, float) and v == 0 else v  # no negative zero


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_clean(r[i]) for i in order) for r in rows]
    return sorted(names), sorted(out, key=_key)


def differences(con, df, sql: str) -> list[str]:
    """Human-readable differences; empty if the results are equal."""
    cursor = con.execute(sql)
    want_names, want = _rows([d[0] for d in cursor.description], cursor.fetchall())
    got_names, got = _rows(df.columns, [tuple(r) for r in df.collect()])
    if got_names != want_names:
        return [f"columns {got_names} != {want_names}"]
    if len(got) != len(want):
        return [f"{len(got)} rows != {len(want)}"]
    out = []
    for g, w in zip(got, want):
        for name, a, b in zip(got_names, g, w):
            same_type = type(a) is type(b) or a is None or b is None
            if a != b or not same_type or (isinstance(a, float) and math.isnan(a)):
                out.append(f"{name}: {a!r} != {b!r} in {g} / {w}")
                break
    return out
