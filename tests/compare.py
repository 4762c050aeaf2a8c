"""Run a registered query and its SQL twin and compare them value by value."""

from __future__ import annotations

import datetime as dt
import math
from pathlib import Path

import duckdb


def sql_engine(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, float):
        return value + 0.0
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def family(type_name: str) -> str:
    t = type_name.lower()
    for prefix, name in (("timestamp", "timestamp"), ("decimal", "decimal"), ("varchar", "string")):
        if t.startswith(prefix):
            return name
    return {"integer": "int", "int": "int", "bigint": "long", "double": "double", "boolean": "bool"}.get(t, t)


def differences(spark_df, relation, limit: int = 5) -> list[str]:
    found = []
    got = canonical(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    want = canonical(relation.columns, relation.fetchall())
    if got[0] != want[0]:
        return [f"columns {got[0]} against {want[0]}"]
    kinds = {n: family(t) for n, t in spark_df.dtypes}
    for name, kind in zip(relation.columns, relation.types):
        if kinds[name] != family(str(kind)):
            found.append(f"type of {name}: {kinds[name]} against {kind}")
    if len(got[1]) != len(want[1]):
        found.append(f"{len(got[1])} rows against {len(want[1])}")
    odd = [(a, b) for a, b in zip(got[1], want[1]) if a != b]
    if odd:
        found.append(f"{len(odd)} of {len(got[1])} rows differ")
        found += [f"{a} | {b}" for a, b in odd[:limit]]
    return found
