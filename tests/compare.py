"""Running a registered query on Spark and its SQL twin on DuckDB and comparing all rows."""

from __future__ import annotations

import datetime as dt
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"create view {name} as select * from '{path}'")
    return con


def _cell(value):
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, float):
        return repr(value)
    return repr(value)


# Spark's names of the types that the other engine calls so; other types have the same name.
TYPES = {"bigint": "bigint", "int": "integer", "double": "double", "string": "varchar", "boolean": "boolean"}


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark, con, query, sql, sf_dir):
    """None when equal, otherwise a short description."""
    df = query(spark, sf_dir)
    mine = df.collect()
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = cursor.fetchall()
    if names != df.columns:
        return f"columns {df.columns} vs {names}", len(mine)
    kinds = [str(d[1]).lower() for d in cursor.description]
    for name, mine_is, theirs_is in zip(names, (k for _, k in df.dtypes), kinds):
        if TYPES.get(mine_is, theirs_is) != theirs_is:
            return f"{name}: {mine_is} vs {theirs_is}", len(mine)
    a, b = _rows(df.columns, mine), _rows(names, theirs)
    if a == b:
        return None, len(mine)
    only_a, only_b = sorted(set(a) - set(b))[:3], sorted(set(b) - set(a))[:3]
    return f"{len(a)} vs {len(b)} rows {sorted(df.columns)}\n  spark {only_a}\n  duck  {only_b}", len(mine)
