"""Compare a query with its SQL the way the driver does: sorted columns, any row order."""

from __future__ import annotations

import datetime
import decimal
import math
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.10g}")
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, (bytes, bytearray)):
        return bytes(value)
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(df, con, sql: str) -> str:
    """Empty text when equal, else what differs."""
    got_cols, got = _rows(df.columns, [tuple(r) for r in df.collect()])
    rel = con.execute(sql)
    want_cols, want = _rows([d[0] for d in rel.description], rel.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} <> {want_cols}"
    if got != want:
        extra, lack = got - want, want - got
        return (f"{sum(got.values())} rows <> {sum(want.values())}; only ours {sum(extra.values())}: "
                f"{list(extra)[:3]}; only sql {sum(lack.values())}: {list(lack)[:3]}")
    if not got:
        return "no rows"
    return ""
