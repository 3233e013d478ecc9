"""Compare a Spark result with DuckDB's answer to its SQL over the same Parquet files."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _rows(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


def differences(df, con, sql: str) -> str:
    """Empty if both give the same columns and rows, else what differs."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    want = _rows(names, result.fetchall())
    got = _rows(df.columns, [tuple(row) for row in df.collect()])
    if got == want:
        return ""
    missing, extra = want - got, got - want
    return (
        f"{sum(got.values())} rows, {sum(want.values())} expected; "
        f"missing {list(missing.items())[:3]}; extra {list(extra.items())[:3]}"
    )
