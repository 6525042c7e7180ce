"""Run a named query and its SQL counterpart and compare columns, types and values."""

from __future__ import annotations

import datetime
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()

KINDS = {"bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN", "date": "DATE",
         "timestamp_ntz": "TIMESTAMP"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value: object) -> str:
    if value is None:
        return "∅"
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.12g}"
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return str(value)


def difference(spark, con, fn, sql: str, sf_dir: str) -> str | None:
    """None when both agree, otherwise what differs."""
    df = fn(spark, sf_dir)
    names = sorted(df.columns)
    ours = sorted(tuple(_plain(row[n]) for n in names) for row in df.collect())
    cursor = con.execute(sql)
    described = {d[0]: str(d[1]) for d in cursor.description}
    if sorted(described) != names:
        return f"columns {names} against {sorted(described)}"
    for field in df.schema:
        wanted = KINDS.get(field.dataType.simpleString())
        if wanted != described[field.name]:
            return f"type of {field.name}: {field.dataType.simpleString()} against {described[field.name]}"
    order = [list(described).index(n) for n in names]
    theirs = sorted(tuple(_plain(row[i]) for i in order) for row in cursor.fetchall())
    if len(ours) != len(theirs):
        return f"{len(ours)} rows against {len(theirs)}"
    wrong = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if wrong:
        return f"{len(wrong)} rows differ, first: {wrong[0]}"
    return None if ours else "no rows"
