"""Runs a registered query and its SQL twin and compares them row by row."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    return value


def rows_of(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def differences(df, con, sql: str) -> str | None:
    """What differs between the DataFrame and the SQL, or None."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    wanted = rows_of(names, cursor.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    seen = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if seen == wanted:
        return None if seen else "no rows"
    extra, missing = seen - wanted, wanted - seen
    return (
        f"{sum(seen.values())} vs {sum(wanted.values())} rows; only Spark {sum(extra.values())}: "
        f"{list(extra)[:2]}; only SQL: {list(missing)[:2]} columns {sorted(names)}"
    )
