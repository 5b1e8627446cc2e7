"""Compare a Spark result with DuckDB on the same parquet tables."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return ("nan",) if math.isnan(value) else value
    return value


def _rows(records, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = [tuple(_plain(r[i]) for i in order) for r in records]
    return sorted(rows, key=repr)


def spark_rows(frame):
    return sorted(frame.columns), _rows([tuple(r) for r in frame.collect()], frame.columns)


def duck_rows(con, sql):
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    return sorted(columns), _rows(result.fetchall(), columns)


def difference(con, frame, sql) -> str | None:
    """None when both sides agree, else what differs."""
    s_cols, s_rows = spark_rows(frame)
    d_cols, d_rows = duck_rows(con, sql)
    if s_cols != d_cols:
        return f"columns {s_cols} != {d_cols}"
    if len(s_rows) != len(d_rows):
        return f"row counts {len(s_rows)} != {len(d_rows)}"
    if not s_rows:
        return "no rows on either side"
    wrong = [(a, b) for a, b in zip(s_rows, d_rows) if a != b]
    return f"{len(wrong)} rows differ, e.g. {wrong[0]}" if wrong else None
