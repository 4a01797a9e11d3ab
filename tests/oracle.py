"""Run a registered query and its SQL side by side."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return str(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(df, con, sql):
    """Differences as text, or an empty string."""
    cur = con.execute(sql)
    want_cols = [d[0] for d in cur.description]
    want = _rows(want_cols, cur.fetchall())
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    if sorted(want_cols) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(want_cols)}"
    if len(got) != len(want):
        return f"{len(got)} rows, SQL has {len(want)}; e.g. {got[:2]} / {want[:2]}"
    wrong = [(g, w) for g, w in zip(got, want) if g != w]
    if wrong:
        return f"{len(wrong)} of {len(got)} rows differ, e.g. {wrong[0]}"
    return "" if got else "both empty"
