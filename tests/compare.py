"""Compare a Spark result with a DuckDB result, rows in any order, columns by name."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return v


def spark_rows(df):
    columns = sorted(df.columns)
    rows = df.select(*[f"`{c}`" for c in columns]).collect()
    return columns, Counter(tuple(_cell(v) for v in r) for r in rows)


def duck_rows(con, sql):
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = Counter(tuple(_cell(r[i]) for i in order) for r in result.fetchall())
    return [names[i] for i in order], rows


def same_types(df, con, sql):
    """Column types, reduced to the names both engines share."""
    spark = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    kinds = {
        "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
        "BOOLEAN": "boolean", "DATE": "date", "FLOAT": "float",
    }
    duck = {r[0]: kinds.get(r[1], r[1]) for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    return {c: (spark.get(c), duck.get(c)) for c in {*spark, *duck} if spark.get(c) != duck.get(c)}
