"""Comparing a query's rows with its SQL counterpart in DuckDB."""

from __future__ import annotations

import os
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"create view {name} as select * from '{path}'")
    return con


def difference(spark_df, con, sql: str) -> str | None:
    """None when columns, types of integer width, and rows agree; else what differs."""
    names = sorted(spark_df.columns)
    result = con.sql(sql)
    if sorted(result.columns) != names:
        return f"columns {names} against {sorted(result.columns)}"
    kinds = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "boolean": "BOOLEAN", "double": "DOUBLE"}
    theirs = dict(zip(result.columns, map(str, result.types)))
    for field in spark_df.schema.fields:
        mine = kinds.get(field.dataType.simpleString(), field.dataType.simpleString())
        if theirs[field.name] != mine:
            return f"type of {field.name}: {mine} against {theirs[field.name]}"
    ours = Counter(tuple(r) for r in spark_df.select(*names).collect())
    quoted = ", ".join(f'"{n}"' for n in names)
    wanted = Counter(con.sql(f"select {quoted} from ({sql})").fetchall())
    if ours == wanted:
        return None
    extra, lacking = ours - wanted, wanted - ours
    return (
        f"{sum(ours.values())} rows against {sum(wanted.values())}; "
        f"extra {list(extra.items())[:3]}; lacking {list(lacking.items())[:3]}"
    )
