"""Run a named query and its oracle on the same folder and compare values without order."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

from oracle.sql import ORACLES
from tidepanel import catalogue
from tidepanel.sources.star import Star


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_cell(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def differences(spark, con, sf_dir: str, name: str) -> list[str]:
    """Empty when column names, column types' families, row count and every value agree."""
    df = catalogue.run(name, Star(spark, sf_dir))
    got_cols, got = _rows(df.columns, [tuple(r) for r in df.collect()])
    rel = con.execute(ORACLES[name])
    want_cols, want = _rows([d[0] for d in rel.description], rel.fetchall())
    out = []
    if got_cols != want_cols:
        return [f"columns {got_cols} != {want_cols}"]
    if len(got) != len(want):
        out.append(f"rows {len(got)} != {len(want)}")
    families = lambda rows: [
        next((type(r[i]).__name__ for r in rows if r[i] is not None), None) for i in range(len(got_cols))
    ]
    if families(got) != families(want):
        out.append(f"types {families(got)} != {families(want)}")
    bad = [(a, b) for a, b in zip(got, want) if a != b]
    out += [f"{a} != {b}" for a, b in bad[:3]]
    if bad:
        out.append(f"{len(bad)} rows differ")
    return out
