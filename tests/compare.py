"""Row-by-row comparison of a query with its SQL, in any order of rows and columns."""

from __future__ import annotations

import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = os.path.join(folder, f"{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _sorted_rows(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return [columns[i] for i in order], sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    return _sorted_rows(df.columns, [tuple(row) for row in df.collect()])


def sql_rows(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], list[tuple]]:
    result = con.execute(sql)
    return _sorted_rows([d[0] for d in result.description], result.fetchall())
