"""Runs a registered query and its SQL on the same tables and compares them cell by cell."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import pathlib

import duckdb

TABLES = [p.stem for p in pathlib.Path("/root/testdata/sf0.001").glob("*.parquet")]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.isoformat()
    return v


def _canonical(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cells = [tuple(_cell(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(cells, key=lambda r: tuple((v is not None, str(type(v)), v if v is not None else 0) for v in r))


def difference(spark, con, sf_dir: str, query, sql: str) -> str | None:
    """None when equal, else a short description."""
    got = query(spark, sf_dir)
    mine_cols, mine = _canonical(got.columns, got.collect())
    rel = con.sql(sql)
    their_cols, theirs = _canonical(rel.columns, rel.fetchall())
    if mine_cols != their_cols:
        return f"columns {mine_cols} / {their_cols}"
    if len(mine) != len(theirs):
        return f"rows {len(mine)} / {len(theirs)}"
    for m, t in zip(mine, theirs):
        if m != t:
            bad = [(c, x, y) for c, x, y in zip(mine_cols, m, t) if x != y]
            return f"{len(mine)} rows, first difference {bad[:4]} in {m}"
    return None if mine else "no rows"
