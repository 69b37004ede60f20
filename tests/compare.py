"""Compare a Spark result with the result of its SQL counterpart."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return value


def kind(name: str) -> str:
    """Type family under one name for both engines."""
    name = name.lower()
    families = {"varchar": "string", "integer": "int", "hugeint": "hugeint", "timestamp_ntz": "timestamp"}
    return families.get(name, name)


def ordered(rows):
    return sorted(rows, key=lambda row: tuple((v is None, str(v)) for v in row))


def differences(df, con, sql: str) -> list[str]:
    """What differs, as messages; empty when columns, types and rows agree."""
    found = []
    result = con.execute(sql)
    sql_columns = [d[0] for d in result.description]
    sql_types = {d[0]: kind(str(d[1])) for d in result.description}
    if sorted(df.columns) != sorted(sql_columns):
        return [f"columns {sorted(df.columns)} / {sorted(sql_columns)}"]
    spark_types = {name: kind(t) for name, t in df.dtypes}
    found += [f"type of {c}: {spark_types[c]} / {sql_types[c]}" for c in df.columns if spark_types[c] != sql_types[c]]
    names = sorted(df.columns)
    at = [sql_columns.index(c) for c in names]
    sql_rows = ordered([tuple(plain(row[i]) for i in at) for row in result.fetchall()])
    spark_rows = ordered([tuple(plain(v) for v in row) for row in df.select(*(f"`{n}`" for n in names)).collect()])
    if len(sql_rows) != len(spark_rows):
        found.append(f"rows {len(spark_rows)} / {len(sql_rows)}")
    for left, right in zip(spark_rows, sql_rows):
        if left != right:
            found.append(f"{names}: {left} / {right}"[:900])
            break
    if not spark_rows:
        found.append("no rows")
    return found
