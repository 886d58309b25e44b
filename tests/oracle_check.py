"""Compare a Spark result with the result of the oracle SQL, by name and value."""

from __future__ import annotations

import math

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


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9) + 0.0)
    if isinstance(value, bool) or value is None:
        return str(value)
    return repr(value) if not isinstance(value, int) else str(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


KIND = {
    "bigint": "int", "int": "int", "integer": "int", "hugeint": "hugeint", "double": "float",
    "float": "float", "string": "text", "varchar": "text", "date": "date", "boolean": "bool",
}


def compare(spark_df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    found = con.execute(sql)
    columns = [c[0] for c in found.description]
    oracle_types = {c[0]: KIND.get(str(c[1]).lower(), str(c[1]).lower()) for c in found.description}
    spark_types = {n: KIND.get(t, t) for n, t in spark_df.dtypes}
    if sorted(columns) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(columns)}"
    if oracle_types != spark_types:
        return f"types {spark_types} != {oracle_types}"
    wanted = _rows(columns, found.fetchall())
    got = _rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if len(got) != len(wanted):
        return f"{len(got)} rows != {len(wanted)}"
    diff = [(g, w) for g, w in zip(got, wanted) if g != w]
    return f"{len(diff)} rows differ, first {diff[0]}" if diff else None
