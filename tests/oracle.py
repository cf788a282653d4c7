"""Runs a query and its SQL oracle on the same tables and compares the rows."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import math
import os

import duckdb

TESTDATA = os.environ.get("TESTDATA", "/root/testdata")


def oracle_connection(sf: str):
    con = duckdb.connect()
    for path in glob.glob(f"{TESTDATA}/sf{sf}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}") + 0.0
    if isinstance(v, decimal.Decimal):
        return str(v.normalize())
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def compare(spark, con, run, sql, sf):
    """None when equal, else what differs."""
    df = run(spark, f"{TESTDATA}/sf{sf}")
    mine = rows_of(df.columns, [tuple(x) for x in df.collect()])
    res = con.execute(sql)
    names = [c[0] for c in res.description]
    theirs = rows_of(names, res.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns: {sorted(set(df.columns) ^ set(names))}"
    if len(mine) != len(theirs):
        return f"rows: {len(mine)} against {len(theirs)}"
    bad = [(a, b) for a, b in zip(mine, theirs) if a != b]
    if bad:
        return f"{len(bad)} of {len(mine)} rows differ, columns {sorted(names)}: {bad[0]}"
    types = [
        (n, str(t)) for n, t in [(c[0], c[1]) for c in res.description] if str(t) in ("HUGEINT", "UHUGEINT")
    ]
    return f"oracle types: {types}" if types else None
