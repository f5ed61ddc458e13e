"""Strict comparison of a registered query with its SQL."""

import datetime as dt
import decimal
import glob
import os

import duckdb

import __spark_entry__ as contract


def connect(sf_dir):
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        path = f"{path}/*.parquet" if os.path.isdir(path) else path
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(columns), sorted(plain, key=lambda r: tuple((v is None, str(v)) for v in r))


def compare(spark, con, name, sf_dir):
    """Problem text, or None if columns, types and rows agree."""
    df = contract.queries()[name](spark, sf_dir)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(contract.oracle_sql()[name])
    want = _rows([d[0] for d in cur.description], cur.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"{len(got[1])} rows != {len(want[1])}"
    bad = [(g, w) for g, w in zip(got[1], want[1]) if g != w]
    if bad:
        return f"{len(bad)} of {len(got[1])} rows differ, first {bad[0]}"
    kinds = [(g, w) for g, w in zip(got[1], want[1])
             if any(type(a) is not type(b) for a, b in zip(g, w))]
    return f"types differ: {kinds[0]}" if kinds else None
