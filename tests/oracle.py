"""Comparison of a Spark result with a DuckDB result as multisets of rows."""

from collections import Counter

import duckdb

from redress.plans.feed import TABLES


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "double": "DOUBLE",
}


def rows(columns: list[str], data) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(row[i] for i in order) for row in data)


def compare(df, con, sql: str) -> None:
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(names)
    kinds = {d[0]: str(d[1]) for d in result.description}
    assert {name: TYPES[kind] for name, kind in df.dtypes} == kinds
    spark_rows = rows(df.columns, df.collect())
    duck_rows = rows(names, result.fetchall())
    extra, missing = spark_rows - duck_rows, duck_rows - spark_rows
    assert not extra and not missing, (
        f"{sum(extra.values())} extra, {sum(missing.values())} missing; "
        f"extra {list(extra)[:2]}, missing {list(missing)[:2]}"
    )
    assert sum(spark_rows.values()) > 0 or "complaint_id IS NULL" in sql
