"""Runs registered queries against their SQL twins and reports differences."""

from __future__ import annotations

import glob
import os
import time

import duckdb

from registry.oracles import oracle_sql
from registry.queries import QUERIES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    return float(value) if type(value).__name__ == "Decimal" else value


def difference(spark, con, sf_dir: str, name: str, truth: str) -> str | None:
    """None when rows, names and values agree; otherwise what differs first."""
    began = time.time()
    frame = QUERIES[name](spark, sf_dir)
    columns = sorted(frame.columns)
    got = sorted((tuple(_plain(r[c]) for c in columns) for r in frame.collect()), key=repr)
    spent = time.time() - began
    told = con.execute(truth)
    names = [d[0] for d in told.description]
    if sorted(names) != columns:
        return f"columns differ: {sorted(set(names) ^ set(columns))}"
    at = [names.index(c) for c in columns]
    want = sorted((tuple(_plain(r[i]) for i in at) for r in told.fetchall()), key=repr)
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if repr(g) != repr(w)]
    if bad:
        return f"{len(bad)} of {len(got)} rows differ in {columns}; first {bad[0][0]} expected {bad[0][1]}"
    print(f"{name}: {len(got)} rows agree, {spent:.1f}s", flush=True)
    return None
