"""Comparing a Spark result with DuckDB's, by column type and by row values."""

from __future__ import annotations

from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()
SQL_TYPES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs, as readable lines; empty when both sides agree."""
    names = sorted(df.columns)
    relation = con.sql(sql)
    if names != sorted(relation.columns):
        return [f"columns {names} != {sorted(relation.columns)}"]
    given = {f.name: SQL_TYPES.get(f.dataType.simpleString()) for f in df.schema}
    wanted = dict(zip(relation.columns, map(str, relation.types)))
    lines = [f"type of {n}: {given[n]} != {wanted[n]}" for n in names if given[n] != wanted[n]]
    ours = Counter(tuple(r) for r in df.select(names).collect())
    theirs = Counter(relation.select(*names).fetchall())
    only_ours, only_theirs = ours - theirs, theirs - ours
    if only_ours or only_theirs:
        lines.append(f"{sum(ours.values())} rows != {sum(theirs.values())} rows")
        lines += [f"only Spark:  {str(r)[:400]}" for r in list(only_ours)[:2]]
        lines += [f"only DuckDB: {str(r)[:400]}" for r in list(only_theirs)[:2]]
    return lines
