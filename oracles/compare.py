"""Compare a Spark result with a DuckDB result, row by row, in any order."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"create view {file.stem} as select * from '{file}'")
    return con


def _row(row, order) -> tuple:
    values = [row[i] for i in order]
    return tuple(f"{v:.12g}" if isinstance(v, float) else str(v) for v in values)


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when equal, else a short description of the first differences."""
    relation = con.sql(sql)
    if sorted(df.columns) != sorted(relation.columns):
        return f"columns {sorted(df.columns)} != {sorted(relation.columns)}"
    names = sorted(df.columns)
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR"}
    kinds |= {"timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}
    ours = {name: kinds.get(kind, kind) for name, kind in df.dtypes}
    theirs = dict(zip(relation.columns, map(str, relation.types)))
    if ours != theirs:
        return f"types {ours} != {theirs}"
    spark_rows = df.collect()
    left = Counter(_row(r, [df.columns.index(n) for n in names]) for r in spark_rows)
    right = Counter(
        _row(r, [relation.columns.index(n) for n in names]) for r in relation.fetchall()
    )
    if left == right:
        return None
    return (
        f"{sum(left.values())} vs {sum(right.values())} rows on {names}; "
        f"only Spark {list((left - right).items())[:3]}; "
        f"only DuckDB {list((right - left).items())[:3]}"
    )
