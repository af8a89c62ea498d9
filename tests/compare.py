"""Compare a registered query with its SQL counterpart, value by value."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def normal(value):
    if isinstance(value, float) and math.isnan(value):
        return ("nan",)
    if isinstance(value, float) and value == 0:
        return 0.0
    return value


def _sorted(rows):
    return sorted(rows, key=lambda r: tuple((v is None, type(v).__name__, str(v)) for v in r))


def rows_of_spark(df):
    names = sorted(df.columns)
    return names, _sorted(tuple(normal(r[c]) for c in names) for r in df.collect())


def rows_of_sql(con, sql):
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    order = sorted(names)
    at = [names.index(c) for c in order]
    return order, _sorted(tuple(normal(r[i]) for i in at) for r in result.fetchall())


def differences(df, con, sql) -> list[str]:
    left_names, left = rows_of_spark(df)
    right_names, right = rows_of_sql(con, sql)
    if left_names != right_names:
        return [f"columns {left_names} != {right_names}"]
    if len(left) != len(right):
        return [f"rows {len(left)} != {len(right)}"]
    bad = [
        f"{dict(zip(left_names, a))} != {dict(zip(right_names, b))}"
        for a, b in zip(left, right)
        if a != b or [type(x) for x in a] != [type(x) for x in b]
    ]
    return [f"{len(bad)} of {len(left)} rows differ", *bad[:3]] if bad else []
