"""Side-by-side comparison of a query and its SQL."""

import math
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
SMALL = "/root/testdata/sf0.001"


def connect(folder):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for file in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def canonical(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, str):
        return value
    return f"{type(value).__name__} {value}"


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(canonical(row[i]) for i in order) for row in rows)


def compare(df, con, sql):
    """Problems found, as texts."""
    got_rows = [tuple(row) for row in df.collect()]
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    want_rows = result.fetchall()
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)}, want {sorted(names)}"]
    want, got = rows_of(names, want_rows), rows_of(df.columns, got_rows)
    if len(want) != len(got):
        return [f"{len(got)} rows, want {len(want)}"]
    return [f"got {g}, want {w}" for g, w in zip(got, want) if g != w][:3]
