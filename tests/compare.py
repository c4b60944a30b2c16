"""Order-insensitive comparison of a Spark query with its SQL on DuckDB."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else ("f", value + 0.0)
    return value


def _kind(type_name: str) -> str:
    t = type_name.lower()
    names = {"string": "varchar", "timestamp_ntz": "timestamp", "long": "bigint", "integer": "integer", "int": "integer",
             "short": "smallint", "byte": "tinyint"}
    return names.get(t, t)


def differences(df, con, sql) -> list[str]:
    names = sorted(df.columns)
    rel = con.sql(sql)
    found = []
    if names != sorted(rel.columns):
        return [f"columns {names} <> {sorted(rel.columns)}"]
    ours = {f.name: _kind(f.dataType.typeName()) for f in df.schema.fields}
    theirs = {n: _kind(str(t)) for n, t in zip(rel.columns, rel.types)}
    if ours != theirs:
        found.append(f"types {[(n, ours[n], theirs[n]) for n in names if ours[n] != theirs[n]]}")
    cols = ", ".join(f'"{n}"' for n in names)
    left = sorted((tuple(_plain(v) for v in r) for r in df.select(*names).collect()), key=repr)
    right = sorted((tuple(_plain(v) for v in r) for r in con.sql(f"SELECT {cols} FROM ({sql})").fetchall()), key=repr)
    if len(left) != len(right):
        found.append(f"rows {len(left)} <> {len(right)}")
    bad = [(a, b) for a, b in zip(left, right) if a != b]
    if bad:
        found.append(f"{len(bad)} differing rows of {names}, first: {bad[0]}")
    if not left:
        found.append("empty result")
    return found
