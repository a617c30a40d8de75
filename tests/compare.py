"""Run one registered query on Spark and its SQL twin on DuckDB and compare the rows."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _norm(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, int):
        return value
    return str(value)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(
        (tuple(_norm(r[i]) for i in order) for r in rows), key=lambda r: tuple((v is None, str(v)) for v in r)
    )


def difference(spark, query, sql, sf_dir):
    """None if both sides agree, else a short description."""
    df = query(spark, sf_dir)
    con = connect(sf_dir)
    cur = con.execute(sql)
    want_names = [c[0] for c in cur.description]
    if sorted(df.columns) != sorted(want_names):
        return f"columns {sorted(df.columns)} vs {sorted(want_names)}"
    got, want = rows_of(df.columns, df.collect()), rows_of(want_names, cur.fetchall())
    if len(got) != len(want):
        return f"{len(got)} rows vs {len(want)}; first {got[:1]} vs {want[:1]}"
    wrong = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(wrong)} of {len(want)} rows differ, first {wrong[0]}" if wrong else None
